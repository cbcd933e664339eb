import math

import pytest
from helpers import START, candle, closes, ema, series, walk, wilder
from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.clock import FeatureClock
from tidemark.plans import contracts
from tidemark.plans.engine import FeatureEngine, FeatureInput
from tidemark.plans.registry import Feature, FeatureColumn, default_registry


def compute(spark, rows, columns, **options):
    out = FeatureEngine(**options).compute(FeatureInput(series(spark, rows))).select("timestamp_utc", *columns).orderBy("timestamp_utc").collect()
    return {c: [r[c] for r in out] for c in columns}


@pytest.fixture(scope="module")
def walked(spark):
    rows = walk(700)
    names = ["mom_ema_dev_12", "mom_ema_dev_50", "mom_macd_hist", "mom_rsi_14", "mom_rsi_28", "vol_atr_14", "vol_atr_28", "mr_hurst_proxy_48", "mr_zscore_24", "ret_log_cc_3", "vol_realized_12", "ms_bars_since_high_24", "mom_slope_12", "mr_autocorr_lag1_24"]
    return rows, compute(spark, rows, names)


def near(a, b, tol=1e-10):
    assert [x is None for x in a] == [x is None for x in b]
    assert max(abs(x - y) for x, y in zip(a, b) if x is not None) < tol


def test_recursive_filters_equal_exact_loops(walked):
    rows, got = walked
    c, h, l = ([r[k] for r in rows] for k in (8, 6, 7))
    for n in (12, 50):
        near(got[f"mom_ema_dev_{n}"], [None if e is None else (x - e) / e for x, e in zip(c, ema(c, n))])
    fast, slow = ema(c, 12), ema(c, 26)
    line = [None if s is None else f - s for f, s in zip(fast, slow)]
    signal = ema([x or 0.0 for x in line], 9, start=25)
    near(got["mom_macd_hist"], [None if s is None else (m - s) / x for m, s, x in zip(line, signal, c)])
    up, down = ([0.0] + [max(s * (c[i] - c[i - 1]), 0) for i in range(1, len(c))] for s in (1, -1))
    for n in (14, 28):
        near(got[f"mom_rsi_{n}"], [None if u is None else 100 - 100 / (1 + u / d) for u, d in zip(wilder(up, n), wilder(down, n))], 1e-9)
        tr = [0.0] + [max(h[i] - l[i], abs(h[i] - c[i - 1]), abs(l[i] - c[i - 1])) for i in range(1, len(c))]
        near(got[f"vol_atr_{n}"], wilder(tr, n))


def test_windows_equal_loops(walked):
    rows, got = walked
    c, h = [r[8] for r in rows], [r[6] for r in rows]
    lr = [None] + [math.log(b) - math.log(a) for a, b in zip(c, c[1:])]
    near(got["ret_log_cc_3"], [None] * 3 + [math.log(c[i]) - math.log(c[i - 3]) for i in range(3, len(c))])

    def std(x):
        m = sum(x) / len(x)
        return math.sqrt(sum((y - m) ** 2 for y in x) / (len(x) - 1))

    near(got["vol_realized_12"], [None] * 12 + [std(lr[i - 11 : i + 1]) for i in range(12, len(c))])

    def hurst(x):
        m, s, zs, z = sum(x) / len(x), std(x), [0.0], 0.0
        for y in x:
            z += y - m
            zs.append(z)
        return min(1, max(0, math.log((max(zs) - min(zs)) / s) / math.log(len(x))))

    near(got["mr_hurst_proxy_48"], [None] * 48 + [hurst(lr[i - 47 : i + 1]) for i in range(48, len(c))], 1e-9)
    last = [None] * 23 + [min(k for k in range(24) if h[i - k] == max(h[i - 23 : i + 1])) for i in range(23, len(c))]
    assert got["ms_bars_since_high_24"] == last

    def slope(x):
        y, n = [math.log(v) for v in x], len(x)
        k = sum((i - (n - 1) / 2) * v for i, v in enumerate(y)) / sum((i - (n - 1) / 2) ** 2 for i in range(n))
        return k * n / (abs(y[-1]) + 1e-8)

    near(got["mom_slope_12"], [None] * 11 + [slope(c[i - 11 : i + 1]) for i in range(11, len(c))], 1e-9)


def test_flat_rising_and_falling(spark):
    flat = compute(spark, closes([100.0] * 120), ["mom_rsi_14", "mr_zscore_24", "mr_hurst_proxy_48", "mr_autocorr_lag1_24", "vol_realized_12", "vol_gk_realized_12", "ms_price_position_12", "ms_consec_up_5"])
    assert flat["mom_rsi_14"][13] is None and set(flat["mom_rsi_14"][14:]) == {50.0}
    assert flat["mr_zscore_24"][22] is None and set(flat["mr_zscore_24"][23:]) == {0.0}
    assert flat["mr_hurst_proxy_48"][47] is None and set(flat["mr_hurst_proxy_48"][48:]) == {0.5}
    assert set(flat["mr_autocorr_lag1_24"][25:]) == {0.0} and set(flat["vol_realized_12"][12:]) == {0.0}
    assert flat["vol_gk_realized_12"][10] is None and flat["vol_gk_realized_12"][11] == 0.0
    assert set(flat["ms_price_position_12"][11:]) == {0.5} and flat["ms_consec_up_5"][4] is None
    up = compute(spark, closes([100.0 + i for i in range(30)]), ["mom_rsi_14", "ms_consec_up_5", "ms_consec_down_5"])
    assert set(up["mom_rsi_14"][14:]) == {100.0} and up["ms_consec_up_5"][10] == 5 and up["ms_consec_down_5"][10] == 0
    assert set(compute(spark, closes([100.0 - i for i in range(30)]), ["mom_rsi_14"])["mom_rsi_14"][14:]) == {0.0}


def test_pivot_is_known_late_and_never_early(spark):
    highs = [10, 11, 12, 20, 12, 11, 10, 9, 8, 7]
    rows = [candle(START + timedelta(seconds=300 * i), 5, h, 4, 5) for i, h in enumerate(highs)]
    got = compute(spark, rows, ["ms_is_pivot_high_3", "ms_pivot_high_timestamp_3", "ms_pivot_high_age_bars_3"])
    assert got["ms_is_pivot_high_3"][:6] == [None] * 6 and got["ms_is_pivot_high_3"][6] is True
    assert got["ms_pivot_high_age_bars_3"][6] == 3 and got["ms_pivot_high_timestamp_3"][6].timestamp() == rows[3][0].timestamp()
    assert got["ms_is_pivot_high_3"][7:] == [False] * 3 and got["ms_pivot_high_age_bars_3"][7] is None


def test_zero_volume(spark):
    rows = [candle(START, v=0.0, tb=0.0, n=0), candle(START + timedelta(seconds=300), v=10.0, tb=6.0, n=5)]
    got = compute(spark, rows, ["liq_taker_buy_ratio", "liq_avg_trade_size", "liq_delta_proxy", "domain_nan_feature_count"])
    assert got["liq_taker_buy_ratio"] == [None, 0.6] and got["liq_avg_trade_size"] == [None, 2.0]
    assert got["liq_delta_proxy"][0] is None and abs(got["liq_delta_proxy"][1] - 0.2) < 1e-12 and got["domain_nan_feature_count"] == [3, 0]


def full_input(spark, n=400):
    minutes = walk(n * 5 + 4000, 60, "1m", START - timedelta(seconds=4000 * 60))
    from tidemark.operators.resample import resample_all

    m = series(spark, minutes)
    every = resample_all(m, ("5m", "15m", "1h"))
    pick = lambda tf: every.where(F.col("timeframe") == tf)
    return FeatureInput(pick("5m").where(F.col("timestamp_utc") >= F.lit(START)), m, pick("15m"), pick("1h"))


def test_schema_warmup_and_validity(spark):
    engine = FeatureEngine()
    registry = engine.features
    assert (len(registry), len(registry.columns), len(registry.schema()), registry.max_history) == (108, 116, 128, 311)
    out = engine.compute(full_input(spark)).cache()
    assert out.columns == registry.schema().fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in registry.schema()]
    rows = out.orderBy("timestamp_utc").collect()
    assert [r["is_warmup"] for r in rows] == [i < 311 for i in range(len(rows))]
    assert all(r["is_valid"] for r in rows[311:]) and not any(r["is_valid"] for r in rows[:311])
    contracts.check_output(out, registry)
    assert contracts.warmup_violations(out, ("venue", "instrument"), 311).count() == 0


def test_missing_context_makes_rows_invalid(spark):
    inp = full_input(spark)
    cut = FeatureInput(inp.primary, inp.micro, inp.low.where(F.col("timestamp_utc") < F.lit(START + timedelta(hours=30))), inp.high)
    rows = FeatureEngine().compute(cut).orderBy("timestamp_utc").collect()
    assert rows[320]["is_valid"] and not rows[-1]["is_valid"] and rows[-1]["nan_feature_count"] == 7


def test_gap_taints_the_window_after_it(spark):
    rows = walk(800)
    del rows[400]
    got = compute(spark, rows, ["has_data_gap"])["has_data_gap"]
    assert got == [400 <= i < 711 for i in range(len(rows))]


def test_blocks_and_prefixes_do_not_change_values(spark):
    """Halo blocks give the same values, and so do prefixes: nothing looks ahead."""
    rows = walk(3600)
    names = [c.name for f in default_registry() if f.family not in ("mtf",) for c in f.columns]
    whole = FeatureEngine(block=1 << 20).compute(FeatureInput(series(spark, rows))).select("timestamp_utc", "is_warmup", *names).orderBy("timestamp_utc").collect()
    blocks = FeatureEngine(block=1300).compute(FeatureInput(series(spark, rows))).select("timestamp_utc", "is_warmup", *names).orderBy("timestamp_utc").collect()
    prefix = FeatureEngine().compute(FeatureInput(series(spark, rows[:500]))).select("timestamp_utc", "is_warmup", *names).orderBy("timestamp_utc").collect()
    assert len(whole) == len(blocks) == 3600
    for other in (blocks, prefix):
        for a, b in zip(whole, other):
            for x, y in zip(a, b):
                assert x == y or isinstance(x, float) and abs(x - y) <= 1e-9 * max(1, abs(x)), (a["timestamp_utc"], x, y)


def test_alignment_never_looks_ahead(spark):
    clock = FeatureClock()
    t = spark.range(288).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 300).alias("t"))
    for step in (900, 3600):
        bad = t.where((F.unix_seconds(clock.align(F.col("t"), step)) + step > F.unix_seconds("t") + 300) | (F.unix_seconds(clock.align(F.col("t"), step)) + 2 * step <= F.unix_seconds("t") + 300))
        assert bad.count() == 0
    got = spark.sql("select timestamp'2024-01-01 14:05:00' t").select(clock.align(F.col("t"), 900).cast("string"), clock.align(F.col("t"), 3600).cast("string")).first()
    assert tuple(got) == ("2024-01-01 13:45:00", "2024-01-01 13:00:00")


def test_registry_rejects_names_twice_and_computes_what_is_added():
    r = default_registry()
    with pytest.raises(ValueError):
        r.register(Feature("mom_rsi_14", "x", (FeatureColumn("other"),), 1))
    with pytest.raises(ValueError):
        r.register(Feature("other", "x", (FeatureColumn("mom_rsi_14"),), 1))
    with pytest.raises(KeyError):
        r.get("absent")


def test_registered_feature_is_computed(spark):
    r = default_registry()
    r.register(Feature("range_1", "own", (FeatureColumn("range_1"),), 1, lambda f: f.H - f.L))
    out = FeatureEngine(registry=r).compute(FeatureInput(series(spark, walk(5)))).select("range_1").collect()
    assert all(x["range_1"] > 0 for x in out)


def test_input_contract(spark):
    rows = walk(10)
    contracts.check_input(series(spark, rows), ("venue", "instrument"))
    with pytest.raises(contracts.ContractError):
        contracts.check_input(series(spark, rows + rows[:1]), ("venue", "instrument"))
    with pytest.raises(contracts.ContractError):
        contracts.check_input(series(spark, []), ("venue", "instrument"))
    with pytest.raises(contracts.ContractError):
        contracts.check_input(series(spark, [candle(START, 0.0)]), ("venue", "instrument"))


def test_segments_restart(spark):
    rows = walk(60)
    got = compute(spark, rows[:30] + rows[31:], ["mom_ema_dev_12", "ret_log_cc_1", "is_warmup"], segment_on_gap=True)
    assert got["ret_log_cc_1"][30] is None and got["mom_ema_dev_12"][40] is None and got["mom_ema_dev_12"][41] is not None


def test_own_sessions(spark):
    rows = closes([100.0] * 3, start=START.replace(hour=5))
    got = compute(spark, rows, ["time_session_flags"], sessions={"early": (4, 6, 1), "late": (20, 24, 2), "wide": (0, 24, 4)})
    assert got["time_session_flags"] == [5, 5, 5]


def test_empty_series(spark):
    assert FeatureEngine().compute(FeatureInput(series(spark, []))).count() == 0


def test_hurst_known_answer(spark):
    """R = 0.03625 and S = 0.0203100960... for these eight returns."""
    r = default_registry()
    from tidemark.functions import meanreversion

    r.register(Feature("mr_hurst_proxy_8", "own", (FeatureColumn("mr_hurst_proxy_8"),), 9, lambda f: meanreversion.hurst_proxy(8), 2, {"n": 8}))
    c = [100.0]
    for x in (0.01, -0.02, 0.03, -0.01, 0.02, -0.03, 0.01, 0.0):
        c.append(c[-1] * math.exp(x))
    got = compute(spark, closes(c), ["mr_hurst_proxy_8"], registry=r)["mr_hurst_proxy_8"]
    assert got[:8] == [None] * 8 and abs(got[8] - 0.2785946451494484) <= 1e-12


def std(x):
    m = math.fsum(x) / len(x)
    return math.sqrt(math.fsum((y - m) ** 2 for y in x) / (len(x) - 1))


def relative(a, b, tol=1e-10):
    assert [x is None for x in a] == [x is None for x in b]
    assert max(abs(x - y) / max(abs(y), 1e-300) if x != y else 0.0 for x, y in zip(a, b) if x is not None) < tol


def test_nothing_is_lost_after_a_jump(spark):
    """One return of 0.5 among returns of about 1e-4 (smaller ones are lost in the digits of a logarithm): deviations,
    correlations and slopes hold relative to plain loops."""
    import random

    r, price, c = random.Random(8), 100.0, []
    for i in range(260):
        price *= math.exp(0.5 if i == 90 else r.gauss(0, 1e-4))
        c.append(price)
    got = compute(spark, closes(c), ["vol_realized_12", "vol_realized_96", "mr_autocorr_lag1_24", "mom_slope_48", "mr_hurst_proxy_48"], block=4096)
    lr = [None] + [math.log(b) - math.log(a) for a, b in zip(c, c[1:])]
    for n in (12, 96):
        relative(got[f"vol_realized_{n}"], [None] * n + [std(lr[i - n + 1 : i + 1]) for i in range(n, len(c))])

    def corr(i, n=24):
        a, b = lr[i - n + 1 : i + 1], lr[i - n : i]
        ma, mb = math.fsum(a) / n, math.fsum(b) / n
        return math.fsum((x - ma) * (y - mb) for x, y in zip(a, b)) / math.sqrt(math.fsum((x - ma) ** 2 for x in a) * math.fsum((y - mb) ** 2 for y in b))

    near(got["mr_autocorr_lag1_24"], [None] * 25 + [corr(i) for i in range(25, len(c))])

    def slope(i, n=48):
        y = [math.log(v) for v in c[i - n + 1 : i + 1]]
        return math.fsum((k - (n - 1) / 2) * (v - y[-1]) for k, v in enumerate(y)) / (n * (n * n - 1) / 12) * n / (abs(y[-1]) + 1e-8)

    # Slopes of calm windows are as sure as the logarithms they come from: some 1e-15 on movements of 1e-4.
    near(got["mom_slope_48"], [None] * 47 + [slope(i) for i in range(47, len(c))], 1e-12)


def test_slope_far_into_a_series(spark):
    """At an index of a million and a half the slope is what it is at the start."""
    from tidemark.functions import Frame, momentum

    df = series(spark, walk(200)).withColumn("_lnc", F.ln("close"))
    order = F.row_number().over(Window.orderBy("timestamp_utc")) - 1
    both = [[r["s"] for r in df.withColumn("_rn", order + at).select("timestamp_utc", momentum.slope(Frame(), 48).alias("s")).orderBy("timestamp_utc").collect()] for at in (0, 1_500_000)]
    relative(both[1][47:], both[0][47:], 1e-10)
    assert all(x is None for x in both[0][:47])


def plain_stale_sum(gk, n):
    """The running sum as tables made with it have it, value by value."""
    out, total, lacks = [None] * len(gk), math.fsum(x for x in gk[: n - 1] if x is not None), None in gk[: n - 1]
    for i in range(n - 1, len(gk)):
        window, there = gk[i - n + 1 : i + 1], None not in gk[i - n + 1 : i + 1]
        if i > n - 1 and not lacks and gk[i] is not None and window[0] is not None:
            total += gk[i] - window[0]
            out[i] = total / n
        else:
            out[i] = math.fsum(window) / n if there else None
            lacks = lacks if i == n - 1 else not there
    return out


@pytest.mark.parametrize("gone", [(), (40,), (3,), (11,), (11, 15), (2, 11), (11, 22, 50, 51)])
def test_legacy_garman_klass_equals_a_plain_loop(spark, gone):
    from tidemark.functions import volatility

    gk = [None if i in gone else 1e-4 * (1 + math.sin(i * 1.7)) for i in range(80)]
    df = spark.createDataFrame([("s", START + timedelta(minutes=5 * i), i, x) for i, x in enumerate(gk)], "instrument string, timestamp_utc timestamp, _rn int, _gk double")
    got = volatility.garman_klass_legacy(df, ("instrument",), (12,)).orderBy("timestamp_utc").collect()
    near([r["_gk_legacy_12"] for r in got], plain_stale_sum(gk, 12), 1e-15)


def test_legacy_mode_from_its_first_row(spark):
    rows = walk(60)
    got = compute(spark, rows, ["vol_gk_realized_12"], gk_mode="legacy")["vol_gk_realized_12"]
    gk = [0.5 * (math.log(r[6]) - math.log(r[7])) ** 2 - (2 * math.log(2) - 1) * (math.log(r[8]) - math.log(r[5])) ** 2 for r in rows]
    near(got, [None if v is None or v < 0 else math.sqrt(v) for v in plain_stale_sum(gk, 12)])
