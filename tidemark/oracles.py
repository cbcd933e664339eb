"""DuckDB SQL that computes what the queries compute, written from the formulas and not from the engine.

Recursion is a recursive CTE over the bar index, and rolling columns are window frames.
"""

from __future__ import annotations


def bars(seconds: int, name: str = "bars", *, per_type: bool = False) -> str:
    """CTEs `ticks` and `name`: bars of the events with their index."""
    inst = "upper(event_type)" if per_type else "'EVT'"
    return f"""ticks AS (SELECT {inst} AS inst, ts, value AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS q, event_type IN ('purchase', 'click') AS tb FROM events),
{more_bars(seconds, name)}"""


#: CTE `ticks`: one every 20 seconds by order key.
ORDER_TICKS = """ticks AS (SELECT 'ORD' AS inst, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(20 * o_orderkey) AS ts, 100.0::DOUBLE + (cents % 5000) / 100.0::DOUBLE AS price, cents % 50 + 1 AS q, cents % 3 = 0 AS tb
  FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders))"""


def more_bars(seconds: int, name: str) -> str:
    return f"""{name} AS (SELECT *, row_number() OVER (PARTITION BY inst ORDER BY ts) - 1 AS rn FROM (
  SELECT inst, time_bucket(INTERVAL '{seconds} seconds', ts) AS ts, arg_min(price, ts) AS o, max(price) AS h, min(price) AS l, arg_max(price, ts) AS c,
    CAST(sum(q) AS DOUBLE) AS v, sum(price * q) AS qv, count(*) AS n, CAST(sum(CASE WHEN tb THEN q ELSE 0 END) AS DOUBLE) AS tb,
    sum(CASE WHEN tb THEN price * q ELSE 0.0 END) AS tq FROM ticks GROUP BY 1, 2))"""


def shared(source: str = "bars", name: str = "s") -> str:
    """CTE `name`: what features share."""
    return f"""{name}1 AS (SELECT *, lag(c) OVER w AS c1, lag(ts) OVER w AS ts1 FROM {source} WINDOW w AS (PARTITION BY inst ORDER BY ts)),
{name}2 AS (SELECT *, CASE WHEN c > 0 AND c1 > 0 THEN ln(c) - ln(c1) END AS lr, CASE WHEN c1 IS NOT NULL THEN greatest(h - l, abs(h - c1), abs(l - c1)) END AS tr,
  CASE WHEN c1 IS NOT NULL THEN greatest(c - c1, 0) END AS up, CASE WHEN c1 IS NOT NULL THEN greatest(c1 - c, 0) END AS dn,
  CASE WHEN least(o, h, l, c) > 0 AND h >= l THEN 0.5 * (ln(h) - ln(l)) ** 2 - (2 * ln(2) - 1) * (ln(c) - ln(o)) ** 2 END AS gk FROM {name}1),
{name} AS (SELECT *, lag(lr) OVER (PARTITION BY inst ORDER BY ts) AS lr1 FROM {name}2)"""


def w(n: int, skip: int = 0) -> str:
    return f"(PARTITION BY inst ORDER BY ts ROWS BETWEEN {n - 1 + skip} PRECEDING AND {f'{skip} PRECEDING' if skip else 'CURRENT ROW'})"


def over(agg: str, x: str, n: int) -> str:
    return f"{agg}({x}) OVER {w(n)}"


def full(n: int, x: str) -> str:
    return f"CASE WHEN rn >= {n - 1} THEN {x} END"


def allthere(col: str, n: int, x: str) -> str:
    return f"CASE WHEN count({col}) OVER {w(n)} = {n} THEN {x} END"


def clamp(x: str, low: float, high: float) -> str:
    return f"greatest({low}, least({high}, {x}))"


def lag(x: str, n: int) -> str:
    return f"lag({x}, {n}) OVER (PARTITION BY inst ORDER BY ts)"


def recursion(source: str, name: str, filters: dict[str, tuple[str, float, float, int, int]]) -> str:
    """CTEs: `name` with one column per filter: (input, decay, weight, index of the seed, bars of the seed)."""
    seeds = ", ".join(f"avg({x}) OVER {w(k)} AS seed_{c}" for c, (x, _, _, _, k) in filters.items())
    inputs = ", ".join(f"{x} AS x_{c}" for c, (x, *_) in filters.items())
    start = ", ".join(f"CASE WHEN {at} = 0 THEN seed_{c} END AS {c}" for c, (_, _, _, at, _) in filters.items())
    step = ", ".join(f"CASE WHEN n.rn = {at} THEN n.seed_{c} WHEN n.rn > {at} THEN p.{c} * {a!r} + n.x_{c} * {b!r} END" for c, (_, a, b, at, _) in filters.items())
    return f"""{name}_in AS (SELECT inst, ts, rn, {inputs}, {seeds} FROM {source}),
{name} AS (SELECT inst, ts, rn, {start} FROM {name}_in WHERE rn = 0
  UNION ALL SELECT n.inst, n.ts, n.rn, {step} FROM {name} p JOIN {name}_in n ON n.inst = p.inst AND n.rn = p.rn + 1)"""


def ema(x: str, n: int, start: int = 0):
    return (x, (n - 1) / (n + 1), 2 / (n + 1), start + n - 1, n)


def wilder(x: str, n: int):
    return (x, (n - 1) / n, 1 / n, n, n)


FILTERS = {"e12": ema("c", 12), "e26": ema("c", 26), "e50": ema("c", 50), "u14": wilder("up", 14), "d14": wilder("dn", 14), "u28": wilder("up", 28), "d28": wilder("dn", 28), "a14": wilder("tr", 14), "a28": wilder("tr", 28)}


def rsi(u: str, d: str) -> str:
    return f"CASE WHEN {u} IS NULL OR {d} IS NULL THEN NULL WHEN {d} = 0 AND {u} = 0 THEN 50.0 WHEN {d} = 0 THEN 100.0 WHEN {u} = 0 THEN 0.0 ELSE 100.0 - 100.0 / (1.0 + {u} / {d}) END"


def filtered(source: str = "s", name: str = "f") -> str:
    """CTEs: `name` = source with the recursive columns and the signal line."""
    return f"""{recursion(source, "rec", FILTERS)},
lined AS (SELECT inst, ts, rn, e12 - e26 AS line FROM rec),
{recursion("lined", "sig", {"signal": ema("line", 9, 25)})},
{name} AS (SELECT {source}.*, {', '.join('rec.' + c for c in FILTERS)}, lined.line, sig.signal FROM {source} JOIN rec USING (inst, ts) JOIN lined USING (inst, ts) JOIN sig USING (inst, ts))"""


def z(x: str, n: int) -> str:
    dev = f"stddev_samp({x}) OVER {w(n)}"
    return allthere(x, n, f"CASE WHEN {dev} > 0 THEN {clamp(f'({x} - avg({x}) OVER {w(n)}) / ({dev})', -10, 10)} ELSE 0.0 END")


def returns() -> dict[str, str]:
    out = {f"ret_log_cc_{n}": f"CASE WHEN c > 0 AND {lag('c', n)} > 0 THEN ln(c) - ln({lag('c', n)}) END" for n in (1, 3, 6, 12, 24, 48, 96)}
    out["ret_log_oc"] = "CASE WHEN c > 0 AND o > 0 THEN ln(c) - ln(o) END"
    for name, part in (("price_body_ratio", "abs(c - o)"), ("price_upper_wick_ratio", "h - greatest(o, c)"), ("price_lower_wick_ratio", "least(o, c) - l")):
        out[name] = clamp(f"({part}) / (h - l + 1e-8)", 0, 1)
    out["price_midpoint"] = "(h + l) / 2"
    return out


def momentum() -> dict[str, str]:
    out = {f"mom_roc_{n}": f"CASE WHEN {lag('c', n)} > 0 THEN (c - {lag('c', n)}) / {lag('c', n)} END" for n in (6, 12, 24, 48)}
    for n in (12, 24, 48):
        out[f"mom_slope_{n}"] = full(n, f"CASE WHEN min(c) OVER {w(n)} > 0 THEN regr_slope(ln(c), rn) OVER {w(n)} * {n} / (abs(ln(c)) + 1e-8) END")
    for n in (12, 24, 48, 96):
        out[f"mom_sma_dev_{n}"] = full(n, f"CASE WHEN {over('avg', 'c', n)} > 0 THEN (c - {over('avg', 'c', n)}) / ({over('avg', 'c', n)}) END")
    for n in (12, 26, 50):
        out[f"mom_ema_dev_{n}"] = f"CASE WHEN e{n} > 0 THEN (c - e{n}) / e{n} END"
    out["mom_macd_hist"] = "CASE WHEN signal IS NOT NULL AND c > 0 THEN (line - signal) / c END"
    for n in (14, 28):
        out[f"mom_rsi_{n}"] = rsi(f"u{n}", f"d{n}")
    return out


def stale_sum(n: int) -> str:
    """CTEs: `gl{n}`, the mean of a running sum with two defects, step by step: the sum, whether a value was found to lack, the mean."""
    return f"""gi{n} AS (SELECT inst, rn, gk, lag(gk, {n - 1}) OVER {{0}} AS gone, count(gk) OVER {w(n)} AS there, avg(gk) OVER {w(n)} AS mean, sum(gk) OVER {w(n - 1, 1)} AS start, count(gk) OVER {w(n - 1, 1)} AS early FROM s),
gl{n} AS (SELECT inst, rn, coalesce(start, 0.0) AS total, early < {n - 1} AS lacks, CASE WHEN there = {n} THEN mean END AS raw FROM gi{n} WHERE rn = {n - 1}
  UNION ALL SELECT i.inst, i.rn, CASE WHEN i.gk IS NOT NULL AND i.gone IS NOT NULL AND NOT p.lacks THEN p.total + (i.gk - i.gone) ELSE p.total END,
    CASE WHEN i.gk IS NOT NULL AND i.gone IS NOT NULL AND NOT p.lacks THEN false ELSE i.there < {n} END,
    CASE WHEN i.gk IS NOT NULL AND i.gone IS NOT NULL AND NOT p.lacks THEN (p.total + (i.gk - i.gone)) / {n} WHEN i.there = {n} THEN i.mean END
  FROM gl{n} p JOIN gi{n} i ON i.inst = p.inst AND i.rn = p.rn + 1)""".replace("{0}", "(PARTITION BY inst ORDER BY ts)")


def volatility() -> dict[str, str]:
    out = {}
    for n in (14, 28):
        out[f"vol_atr_{n}"] = f"a{n}"
        out[f"vol_atr_pct_{n}"] = f"CASE WHEN c > 0 THEN a{n} / c END"
    for n in (12, 24, 48, 96):
        out[f"vol_realized_{n}"] = allthere("lr", n, over("stddev_samp", "lr", n))
    for n in (12, 24):
        mean = over("avg", "gk", n)
        out[f"vol_gk_realized_{n}"] = full(n, allthere("gk", n, f"CASE WHEN {mean} >= 0 THEN sqrt({mean}) WHEN abs({mean}) <= 1e-12 THEN 0.0 END"))
    out["vol_zscore_12_96"] = z("vr12", 96)
    return out


def liquidity() -> dict[str, str]:
    out = {
        "liq_taker_buy_ratio": f"CASE WHEN v > 0 THEN {clamp('tb / v', 0, 1)} END",
        "liq_avg_trade_size": "CASE WHEN v > 0 AND n > 0 THEN v / n END",
        "liq_dollar_volume": "qv",
        "liq_delta_proxy": f"CASE WHEN v > 0 THEN {clamp('(2 * tb - v) / v', -1, 1)} END",
    }
    for n in (12, 48):
        vwap = f"({over('sum', 'qv', n)} / ({over('sum', 'v', n)}))"
        out[f"liq_vwap_dev_{n}"] = full(n, f"CASE WHEN {over('sum', 'v', n)} > 0 AND {vwap} > 0 THEN (c - {vwap}) / {vwap} END")
    for n in (12, 24, 48):
        out[f"liq_vol_ratio_{n}"] = full(n, f"CASE WHEN {over('avg', 'v', n)} > 0 THEN v / ({over('avg', 'v', n)}) END")
    for n in (12, 48):
        share = f"{over('sum', '2 * tb - v', n)} / ({over('sum', 'v', n)})"
        out[f"liq_cum_delta_{n}"] = full(n, f"CASE WHEN {over('sum', 'v', n)} > 0 THEN {clamp(share, -1, 1)} END")
    return out


def position(n: int) -> str:
    high, low = over("max", "h", n), over("min", "l", n)
    return full(n, f"CASE WHEN {high} > {low} THEN {clamp(f'(c - ({low})) / (({high}) - ({low}))', 0, 1)} ELSE 0.5 END")


def structure() -> dict[str, str]:
    out = {}
    for n in (12, 24, 48, 96):
        out[f"ms_high_{n}"] = full(n, over("max", "h", n))
        out[f"ms_low_{n}"] = full(n, over("min", "l", n))
        out[f"ms_price_position_{n}"] = position(n)
    for n in (24, 96):
        out[f"ms_bars_since_high_{n}"] = full(n, f"CAST(rn - (max({{'x': h, 'i': rn}}) OVER {w(n)}).i AS SMALLINT)")
        out[f"ms_bars_since_low_{n}"] = full(n, f"CAST(rn + (min({{'x': l, 'i': -rn}}) OVER {w(n)}).i AS SMALLINT)")
    for s in (3, 5):
        for side, x, agg, sign in (("high", "h", "max", ">"), ("low", "l", "min", "<")):
            flag = f"({lag(x, s)} {sign} {agg}({x}) OVER {w(s, s + 1)} AND {lag(x, s)} {sign} {agg}({x}) OVER {w(s)})"
            out[f"ms_is_pivot_{side}_{s}"] = full(2 * s + 1, flag)
            out[f"ms_pivot_{side}_timestamp_{s}"] = f"CASE WHEN rn >= {2 * s} AND {flag} THEN {lag('ts', s)} END"
            out[f"ms_pivot_{side}_age_bars_{s}"] = f"CASE WHEN rn >= {2 * s} AND {flag} THEN CAST({s} AS SMALLINT) END"
    for name, sign in (("up", ">"), ("down", "<")):
        steps = [f"{'c' if k == 0 else lag('c', k)} {sign} {lag('c', k + 1)}" for k in range(5)]
        cases = " ".join(f"WHEN NOT ({s}) THEN {k}" for k, s in enumerate(steps))
        out[f"ms_consec_{name}_5"] = full(6, f"CAST(CASE {cases} ELSE 5 END AS SMALLINT)")
    return out


def mean_reversion() -> dict[str, str]:
    out = {f"mr_zscore_{n}": full(n, z("c", n)) for n in (24, 48, 96)}
    for n in (12, 48):
        out[f"mr_mean_dev_{n}"] = full(n, f"(c - {over('avg', 'c', n)}) / ({over('avg', 'c', n)} + 1e-8)")
    for n in (48, 96):
        steps = f"list_transform(range(0, {n + 1}), lambda k: coalesce(list_sum(list_slice(l{n}, 1, k)), 0) - k * m{n})"
        span = f"(list_max({steps}) - list_min({steps}))"
        out[f"mr_hurst_proxy_{n}"] = f"CASE WHEN len(l{n}) = {n} THEN CASE WHEN d{n}s > 0 AND {span} > 0 THEN {clamp(f'ln({span} / d{n}s) / ln({n})', 0, 1)} ELSE 0.5 END END"
    for n in (24, 96):
        a, b = over("stddev_samp", "lr", n), over("stddev_samp", "lr1", n)
        value = clamp(f"(covar_samp(lr, lr1) OVER {w(n)}) / (({a}) * ({b}))", -1, 1)
        out[f"mr_autocorr_lag1_{n}"] = f"CASE WHEN count(lr) OVER {w(n)} = {n} AND count(lr1) OVER {w(n)} = {n} THEN CASE WHEN {a} > 0 AND {b} > 0 THEN {value} ELSE 0.0 END END"
    return out


def time(step: int) -> dict[str, str]:
    hour, dow = "extract(hour FROM ts)", "(extract(isodow FROM ts) - 1)"
    short = lambda x: f"CAST({x} AS SMALLINT)"
    since = f"({hour} * 3600 + extract(minute FROM ts) * 60) // {step}"
    return {
        "time_hour_utc": short(hour),
        "time_dow": short(dow),
        "time_hour_sin": f"sin(2 * pi() * {hour} / 24)",
        "time_hour_cos": f"cos(2 * pi() * {hour} / 24)",
        "time_dow_sin": f"sin(2 * pi() * {dow} / 7)",
        "time_dow_cos": f"cos(2 * pi() * {dow} / 7)",
        "time_session_flags": short(f"(CASE WHEN {hour} < 8 THEN 1 ELSE 0 END) + (CASE WHEN {hour} >= 7 AND {hour} < 16 THEN 2 ELSE 0 END) + (CASE WHEN {hour} >= 13 AND {hour} < 22 THEN 4 ELSE 0 END)"),
        "time_bars_since_midnight": short(since),
        "time_bars_since_week_open": short(f"{dow} * {86400 // step} + {since}"),
    }


def hurst_lists(source: str = "s", name: str = "g") -> str:
    """CTE: source with the inputs of columns that need windows of windows."""
    cols = ", ".join(f"list(lr) FILTER (lr IS NOT NULL) OVER {w(n)} AS l{n}, avg(lr) OVER {w(n)} AS m{n}, stddev_samp(lr) OVER {w(n)} AS d{n}s" for n in (48, 96))
    return f"{name} AS (SELECT *, {allthere('lr', 12, over('stddev_samp', 'lr', 12))} AS vr12, {cols} FROM {source})"


def higher(step: int, tag: str, columns: dict[str, str], filters: dict) -> str:
    """CTE `tag`: the columns on bars of `step` seconds."""
    cols = ", ".join(f"{x} AS {c}" for c, x in columns.items())
    rec = recursion(f"{tag}s", f"{tag}r", filters)
    names = ", ".join(f"{tag}r.{c}" for c in filters)
    return f"""{more_bars(step, tag + 'b')}, {shared(tag + 'b', tag + 's')}, {rec},
{tag}j AS (SELECT {tag}s.*, {names} FROM {tag}s JOIN {tag}r USING (inst, ts)), {tag} AS (SELECT inst AS hinst, ts AS hts, {cols} FROM {tag}j)"""


def mtf(primary: int, micro: int, low: int, high: int) -> str:
    """CTE `m`: inst, ts and the 17 columns for bars of the CTE `bars`."""
    ret = lambda n: f"CASE WHEN c > 0 AND {lag('c', n)} > 0 THEN ln(c) - ln({lag('c', n)}) END"
    taker = f"CASE WHEN v > 0 THEN {clamp('tb / v', 0, 1)} END"
    lows = {"mtf_15m_ret_log_cc_4": ret(4), "mtf_15m_ret_log_cc_16": ret(16), "mtf_15m_mom_rsi_14": rsi("u14", "d14"), "mtf_15m_vol_atr_pct_14": "CASE WHEN c > 0 THEN a14 / c END", "mtf_15m_price_position_16": position(16), "mtf_15m_liq_taker_buy_ratio": taker, "mtf_15m_liq_vol_ratio_16": full(16, f"CASE WHEN {over('avg', 'v', 16)} > 0 THEN v / ({over('avg', 'v', 16)}) END")}
    highs = {"mtf_1h_ret_log_cc_4": ret(4), "mtf_1h_ret_log_cc_24": ret(24), "mtf_1h_mom_rsi_14": rsi("u14", "d14"), "mtf_1h_vol_realized_24": allthere("lr", 24, over("stddev_samp", "lr", 24)), "mtf_1h_price_position_24": position(24), "mtf_1h_mr_zscore_24": full(24, z("c", 24)), "mtf_1h_liq_taker_buy_ratio": taker}
    n = primary // micro
    middle, sxx = (n - 1) / 2, sum((k - (n - 1) / 2) ** 2 for k in range(n))
    align = lambda step: f"epoch_ms(CAST(floor((epoch(b.ts) - {step - primary}) / {step}) * {step} * 1000 AS BIGINT))"
    return f"""{higher(low, 'lo', lows, {k: FILTERS[k] for k in ('u14', 'd14', 'a14')})},
{higher(high, 'hi', highs, {k: FILTERS[k] for k in ('u14', 'd14')})},
{more_bars(micro, 'mi')},
mic AS (SELECT inst AS minst, time_bucket(INTERVAL '{primary} seconds', ts) AS mts, count(*) AS k,
  CASE WHEN avg(v) > 0 THEN stddev_samp(v) / avg(v) END AS mtf_1m_vol_dispersion,
  CASE WHEN min(v) > 0 THEN sum(((epoch(ts) - epoch(time_bucket(INTERVAL '{primary} seconds', ts))) / {micro} - {middle}) * tb / v) / {sxx} END AS mtf_1m_taker_trend,
  CASE WHEN sum(abs(ln(c) - ln(o))) > 0 THEN {clamp('(arg_max(ln(c) - ln(o), ts) - arg_min(ln(c) - ln(o), ts)) / sum(abs(ln(c) - ln(o)))', -1, 1)} ELSE 0.0 END AS mtf_1m_return_skew
  FROM mi GROUP BY 1, 2 HAVING count(*) = {n}),
m AS (SELECT b.inst, b.ts, {', '.join(lows)}, {', '.join(highs)}, mtf_1m_vol_dispersion, mtf_1m_taker_trend, mtf_1m_return_skew FROM bars b
  LEFT JOIN lo ON lo.hinst = b.inst AND lo.hts = {align(low)} LEFT JOIN hi ON hi.hinst = b.inst AND hi.hts = {align(high)}
  LEFT JOIN mic ON minst = b.inst AND mts = b.ts)"""


def shown(columns: dict[str, str], doubles: set[str]) -> str:
    return ", ".join(f"{f'round({x}, 6)' if c in doubles else x} AS {c}" for c, x in columns.items())
