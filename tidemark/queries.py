"""The queries of the engine's own operators, over the benchmark's tables, and the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import oracles as O
from .clock import FeatureClock
from .operators import clean, gaps, validate
from .operators.resample import resample_all
from .plans import calendar, contracts, ingest, manifest, report
from .plans.engine import FeatureEngine, FeatureInput
from .plans.registry import default_registry
from .schema import CANDLE_COLUMNS, GAP_CATEGORIES, RESAMPLED, SECONDS
from .sources import candles as tables
from .sources import files, klines
from .sources.ticks import event_candles, lineitem_days, order_candles
from .streaming.live import latency_metrics

Query = Callable[[SparkSession, str], DataFrame]

#: Hourly bars with quarter hours as constituents, four hours and days above.
HOURLY = FeatureClock(3600, 900, 14400, 86400)
REGISTRY = default_registry(HOURLY)
DOUBLES = {c.name for c in REGISTRY.columns if c.kind == "double"}
TIMES = {c.name for c in REGISTRY.columns if c.kind == "timestamp"}
FAMILIES = {"returns": O.returns, "momentum": O.momentum, "volatility": O.volatility, "liquidity": O.liquidity, "structure": O.structure, "mean_reversion": O.mean_reversion, "time": lambda: O.time(3600)}

_STAMP = "yyyy-MM-dd HH:mm:ss"
_SQL_STAMP = "%Y-%m-%d %H:%M:%S"


def stamp(c) -> F.Column:
    return F.date_format(c, _STAMP)


def sql_stamp(c: str) -> str:
    return f"strftime({c}, '{_SQL_STAMP}')"



def feature_input(spark: SparkSession, sf_dir: str, *, per_type: bool = True) -> FeatureInput:
    bar = lambda tf: event_candles(spark, sf_dir, tf, per_type=per_type)
    return FeatureInput(bar("1h"), bar("15m"), bar("4h"), bar("1d"))


def hourly(spark: SparkSession, sf_dir: str, *, per_type: bool = True, **options) -> DataFrame:
    return FeatureEngine(HOURLY, **options).compute(feature_input(spark, sf_dir, per_type=per_type))


def _rounded(df: DataFrame, names: list[str]) -> DataFrame:
    cols = [F.round(F.col(c), 6).alias(c) if c in DOUBLES else stamp(F.col(c)).alias(c) if c in TIMES else F.col(c) for c in names]
    return df.select(stamp(F.col("timestamp_utc")).alias("ts"), F.col("instrument").alias("inst"), *cols)


def _family(family: str) -> Query:
    names = [c.name for f in REGISTRY if f.family == family for c in f.columns]
    return lambda spark, sf_dir: _rounded(hourly(spark, sf_dir), names)


def _family_sql(family: str) -> str:
    head = f"WITH RECURSIVE {O.bars(3600, per_type=True)}"
    if family == "mtf":
        names = [c.name for f in REGISTRY if f.family == "mtf" for c in f.columns]
        return f"{head}, {O.mtf(3600, 900, 14400, 86400)} SELECT {sql_stamp('ts')} AS ts, inst, {', '.join(f'round({c}, 6) AS {c}' for c in names)} FROM m"
    exprs = FAMILIES[family]()
    exprs = {c: sql_stamp(x) if c in TIMES else x for c, x in exprs.items()}
    source = {"returns": O.shared() + ", x AS (SELECT * FROM s)", "liquidity": O.shared() + ", x AS (SELECT * FROM s)", "structure": O.shared() + ", x AS (SELECT * FROM s)", "time": O.shared() + ", x AS (SELECT * FROM s)", "momentum": f"{O.shared()}, {O.filtered('s', 'x')}", "volatility": f"{O.shared()}, {O.hurst_lists('s', 'g')}, {O.filtered('g', 'x')}", "mean_reversion": f"{O.shared()}, {O.hurst_lists('s', 'x')}"}[family]
    return f"{head}, {source} SELECT {sql_stamp('ts')} AS ts, inst, {O.shown(exprs, DOUBLES)} FROM x"


def _wide_sql(clock: tuple[int, int, int, int] = (3600, 900, 14400, 86400), ticks: str | None = None, history: int = REGISTRY.max_history) -> str:
    """CTEs up to `all_columns`: every feature of every bar, and what validity needs."""
    primary, exprs = clock[0], {}
    for family, build in FAMILIES.items():
        exprs |= O.time(primary) if family == "time" else build()
    first = f"{ticks}, {O.more_bars(primary, 'bars')}" if ticks else O.bars(primary, per_type=True)
    own = ", ".join(f"{x} AS {c}" for c, x in exprs.items())
    mtf = ", ".join(c.name for f in REGISTRY if f.family == "mtf" for c in f.columns)
    step = f"epoch(ts) - epoch(ts1) > {primary}"
    gap = f"max(CASE WHEN {step} THEN rn END) OVER (PARTITION BY inst ORDER BY ts)"
    return f"""WITH RECURSIVE {first}, {O.shared()}, {O.hurst_lists('s', 'g')}, {O.filtered('g', 'x')}, {O.mtf(*clock)},
wide AS (SELECT inst, ts, rn, v, {own}, coalesce(rn - {gap} < {history}, false) AS has_data_gap, rn < {history} AS is_warmup FROM x),
all_columns AS (SELECT wide.*, {mtf} FROM wide JOIN m USING (inst, ts))"""


_COUNTED = [c.name for c in REGISTRY.columns if c.counts]
_CLEAN_ROW = "NOT is_warmup AND NOT has_data_gap"
_DOMAIN = "(CASE WHEN v = 0 THEN 3 ELSE 0 END)" + "".join(f" + (CASE WHEN {c} IS NULL AND {_CLEAN_ROW} THEN 1 ELSE 0 END)" for c in ("vol_gk_realized_12", "vol_gk_realized_24", "mtf_1m_vol_dispersion", "mtf_1m_taker_trend"))
_MISSING = " + ".join(f"({c} IS NULL)::INT" for c in _COUNTED)


def _validity_sql(missing: str = _MISSING, **wide) -> str:
    return f"""{_wide_sql(**wide)}, counted AS (SELECT *, {_DOMAIN} AS domain, {_MISSING} AS every FROM all_columns), judged AS (SELECT *, {missing} AS missing FROM counted)
SELECT {sql_stamp('ts')} AS ts, inst, is_warmup, has_data_gap, {_CLEAN_ROW} AND greatest(0, missing - domain) = 0 AS is_valid,
  CAST(missing AS SMALLINT) AS nan_feature_count, CAST(domain AS SMALLINT) AS domain_nan_feature_count FROM judged"""


def _validity(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _rounded(hourly(spark, sf_dir, **options), ["is_warmup", "has_data_gap", "is_valid", "nan_feature_count", "domain_nan_feature_count"])


def features_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [c.name for c in REGISTRY.columns]
    return _rounded(hourly(spark, sf_dir), ["is_warmup", "has_data_gap", "is_valid", "nan_feature_count", "domain_nan_feature_count", *names])


def _full_sql(**wide) -> str:
    cols = ", ".join(f"round({c.name}, 6) AS {c.name}" if c.name in DOUBLES else f"{sql_stamp(c.name)} AS {c.name}" if c.name in TIMES else c.name for c in REGISTRY.columns)
    head, _, tail = _validity_sql("every", **wide).partition("\nSELECT ")
    return f"{head}\nSELECT {tail.replace(' FROM judged', f', {cols} FROM judged')}"


# Candles and resampling.


def _bar_columns(df: DataFrame) -> DataFrame:
    rounded = [F.round(c, 4).alias(c) for c in ("open", "high", "low", "close", "volume", "quote_volume")]
    taker = [F.round(c, 4).alias(c) for c in ("taker_buy_base_volume", "taker_buy_quote_volume")]
    return df.select("timeframe", "instrument", stamp(F.col("timestamp_utc")).alias("ts"), *rounded, "trade_count", *taker, "is_complete")


def ticks_to_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bar_columns(event_candles(spark, sf_dir, "1h", per_type=True))


_BAR = "round(o, 4) AS open, round(h, 4) AS high, round(l, 4) AS low, round(c, 4) AS close, round(v, 4) AS volume, round(qv, 4) AS quote_volume, CAST(n AS BIGINT) AS trade_count, round(tb, 4) AS taker_buy_base_volume, round(tq, 4) AS taker_buy_quote_volume"


def _resampled(tf: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _bar_columns(resample_all(event_candles(spark, sf_dir, "1m"), (tf,)))

    return run


def _resample_sql(tf: str) -> str:
    step = SECONDS[tf]
    return f"""{O.more_bars(60, 'mn')}, {tf_name(tf)} AS (SELECT '{tf}' AS timeframe, inst, time_bucket(INTERVAL '{step} seconds', ts) AS ts, arg_min(o, ts) AS o, max(h) AS h, min(l) AS l, arg_max(c, ts) AS c, sum(v) AS v, sum(qv) AS qv, sum(n) AS n, sum(tb) AS tb, sum(tq) AS tq,
  count(*) = {step // 60} AND (SELECT max(ts) FROM mn) >= time_bucket(INTERVAL '{step} seconds', ts) + INTERVAL '{step - 60} seconds' AS done FROM mn GROUP BY 1, 2, 3)"""


def tf_name(tf: str) -> str:
    return f"tf_{tf}"


def _resample_one_sql(tf: str) -> str:
    return f"WITH {O.bars(60)}, {_resample_sql(tf).replace(O.more_bars(60, 'mn'), 'mn AS (SELECT * FROM bars)')} SELECT timeframe, inst AS instrument, {sql_stamp('ts')} AS ts, {_BAR}, done AS is_complete FROM {tf_name(tf)}"


def _resample_all_sql() -> str:
    parts = ", ".join(_resample_sql(tf).replace(O.more_bars(60, "mn"), "").lstrip(", ") for tf in RESAMPLED)
    union = " UNION ALL ".join(f"SELECT * FROM {tf_name(tf)}" for tf in RESAMPLED)
    return f"WITH {O.bars(60)}, mn AS (SELECT * FROM bars), {parts} SELECT timeframe, inst AS instrument, {sql_stamp('ts')} AS ts, {_BAR}, done AS is_complete FROM ({union})"


# A series with every kind of fault, made from five-minute bars by their index.


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_candles(spark, sf_dir, "5m")
    rn = F.row_number().over(Window.partitionBy("instrument").orderBy("timestamp_utc")) - 1
    rows = rows.withColumn("rn", rn.cast("long"))
    k = F.col("rn")
    faulty = rows.withColumns(
        {
            "high": F.when(k % 103 == 5, F.col("low") - 1).otherwise(F.col("high")),
            "open": F.when(k % 107 == 7, F.col("high") + 5).when(k % 109 == 3, F.lit(0.0)).otherwise(F.col("open")),
            "volume": F.when(k % 113 == 11, F.lit(-1.0)).otherwise(F.col("volume")),
            "trade_count": F.when(k % 127 == 2, F.lit(-1)).otherwise(F.col("trade_count")),
            "seq": k * 10 + F.when(k % 131 == 4, 25).otherwise(0),
        }
    )
    copies = faulty.where(k % 97 == 1).withColumn("seq", F.col("seq") + 1)
    others = faulty.where(k % 101 == 1).withColumn("close", F.col("close") + 1).withColumn("seq", F.col("seq") + 2)
    return faulty.unionByName(copies).unionByName(others).drop("rn")


_DIRTY = f"""{O.bars(300)}, f0 AS (SELECT inst, ts, rn, o AS o0, l, c, qv, tb, tq, CASE WHEN rn % 103 = 5 THEN l - 1 ELSE h END AS h, CASE WHEN rn % 113 = 11 THEN -1.0 ELSE v END AS v, CASE WHEN rn % 127 = 2 THEN -1 ELSE n END AS n, h AS h0, rn * 10 + CASE WHEN rn % 131 = 4 THEN 25 ELSE 0 END AS seq FROM bars),
f AS (SELECT *, CASE WHEN rn % 107 = 7 THEN h0 + 5 WHEN rn % 109 = 3 THEN 0.0 ELSE o0 END AS o FROM f0),
dirty AS (SELECT inst, ts, o, h, l, c, v, qv, n, tb, tq, seq FROM f UNION ALL SELECT inst, ts, o, h, l, c, v, qv, n, tb, tq, seq + 1 FROM f WHERE rn % 97 = 1
  UNION ALL SELECT inst, ts, o, h, l, c + 1, v, qv, n, tb, tq, seq + 2 FROM f WHERE rn % 101 = 1),
seen AS (SELECT *, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY inst ORDER BY seq)) AS delta, lag(ts) OVER (PARTITION BY inst ORDER BY seq) AS prev, row_number() OVER (PARTITION BY inst, ts ORDER BY seq) AS nth,
  first([o, h, l, c, v]) OVER (PARTITION BY inst, ts ORDER BY seq) AS was FROM dirty),
flags AS (SELECT *, unnest([
  CASE WHEN least(o, h, l, c) <= 0 THEN 'NON_POSITIVE_PRICE' END, CASE WHEN h < l THEN 'OHLC_HIGH_LESS_THAN_LOW' END, CASE WHEN o < l OR o > h THEN 'OHLC_OPEN_OUT_OF_RANGE' END,
  CASE WHEN c < l OR c > h THEN 'OHLC_CLOSE_OUT_OF_RANGE' END, CASE WHEN v < 0 OR qv < 0 THEN 'NEGATIVE_VOLUME' END, CASE WHEN tb > v + 1e-7 THEN 'TAKER_VOLUME_EXCEEDS_TOTAL' END,
  CASE WHEN n < 0 THEN 'NEGATIVE_TRADE_COUNT' END, CASE WHEN nth > 1 AND [o, h, l, c, v] = was THEN 'EXACT_DUPLICATE' END, CASE WHEN nth > 1 AND [o, h, l, c, v] <> was THEN 'CONFLICTING_DUPLICATE' END,
  CASE WHEN delta <= 0 THEN 'TIMESTAMP_OUT_OF_ORDER' END, CASE WHEN delta > 300 THEN 'DATA_GAP_DETECTED' END]) AS issue FROM seen),
issues AS (SELECT * FROM flags WHERE issue IS NOT NULL)"""


def validate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.issues(validate.annotate(dirty(spark, sf_dir))).select("instrument", stamp(F.col("timestamp_utc")).alias("ts"), "seq", "issue_type")


def validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.summary(validate.annotate(dirty(spark, sf_dir)))
    return rows.select("instrument", "total_records", "valid_records", "invalid_records", "total_issues", "exact_duplicates", "conflicting_duplicates", "out_of_order", "gaps", "missing_candles", "is_valid")


def gap_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.gaps(validate.annotate(dirty(spark, sf_dir))).select("instrument", stamp(F.col("gap_start")).alias("gap_start"), stamp(F.col("gap_end")).alias("gap_end"), "seconds_between", "missing_candles")


_GAPS = "SELECT inst AS instrument, prev + INTERVAL 300 SECOND AS gap_start, ts - INTERVAL 300 SECOND AS gap_end, CAST(delta AS BIGINT) AS seconds_between, CAST(round_even(delta / 300, 0) AS BIGINT) - 1 AS missing_candles FROM issues WHERE issue = 'DATA_GAP_DETECTED'"


def gap_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gaps.register(validate.gaps(validate.annotate(dirty(spark, sf_dir))), source="archive", detected_at="2024-01-01 00:00:00")
    base = gaps.register(validate.gaps(validate.annotate(event_candles(spark, sf_dir, "5m").withColumn("seq", F.unix_seconds("timestamp_utc")))), source="stream", category="UNKNOWN", detected_at="2023-01-01 00:00:00")
    both = gaps.upsert(base, found)
    return both.select("gap_id", "instrument", stamp(F.col("actual_missing_start_utc")).alias("start"), stamp(F.col("expected_end_utc")).alias("expected_end"), F.col("duration_seconds").cast("long").alias("duration_seconds"), F.col("missing_candles_count").cast("long").alias("missing"), "acquisition_source", "category")


def gaps_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gaps.register(validate.gaps(validate.annotate(dirty(spark, sf_dir))), source="archive", detected_at="2024-01-01 00:00:00")
    return gaps.by_category(found)


def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_exact_duplicates(dirty(spark, sf_dir), seq="seq").select(stamp(F.col("timestamp_utc")).alias("ts"), "seq", F.round("close", 4).alias("close"))


def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.keep_last(dirty(spark, sf_dir), seq="seq").select(stamp(F.col("timestamp_utc")).alias("ts"), "seq", F.round("close", 4).alias("close"))


def _overlap(spark: SparkSession, sf_dir: str, shift: float) -> tuple[DataFrame, DataFrame]:
    rows = event_candles(spark, sf_dir, "1h")
    odd = F.pmod(F.floor(F.unix_seconds("timestamp_utc") / 3600), F.lit(3))
    return rows.where(odd != 0), rows.where(odd != 1).withColumn("close", F.col("close") + F.when(F.pmod(F.floor(F.unix_seconds("timestamp_utc") / 3600), F.lit(7)) == 0, shift).otherwise(0.0))


def overlap_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.overlap_conflicts(*_overlap(spark, sf_dir, 0.5)).select(stamp(F.col("timestamp_utc")).alias("ts"), F.round("existing_close", 4).alias("existing_close"), F.round("new_close", 4).alias("new_close"))


def overlap_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.merge_overlap(*_overlap(spark, sf_dir, 0.00005)).select(stamp(F.col("timestamp_utc")).alias("ts"), F.round("close", 6).alias("close"))


def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_candles(spark, sf_dir, "1h")
    edge = rows.agg((F.min("timestamp_utc") + F.expr("interval 36 hours")).cast("string").alias("a"), (F.max("timestamp_utc") - F.expr("interval 36 hours")).cast("string").alias("b")).first()
    return clean.within(rows, edge["a"], edge["b"]).select(stamp(F.col("timestamp_utc")).alias("ts"), "trade_count")


# Storage, reports, plans.


def timeframe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = event_candles(spark, sf_dir, "1m")
    return tables.inspect_timeframes(minutes.unionByName(resample_all(minutes))).withColumns({"first_time": stamp(F.col("first_time")), "last_time": stamp(F.col("last_time"))})


def inspect_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.inspect_candles(event_candles(spark, sf_dir, "5m"))
    return rows.withColumns({"first_time": stamp(F.col("first_time")), "last_time": stamp(F.col("last_time"))} | {c: F.round(c, 2) for c in ("min_low", "max_high", "volume", "quote_volume")})


def partition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.partition_summary(lineitem_days(spark, sf_dir))
    return rows.select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "rows", stamp(F.col("first_time")).alias("first_time"), stamp(F.col("last_time")).alias("last_time"))


def reconcile_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = lineitem_days(spark, sf_dir)
    told = tables.partition_summary(days).select("year", "month", (F.col("rows") + F.when(F.col("month") == 2, 1).otherwise(0)).alias("rows")).where("year <> 1995 or month <> 6")
    rows = tables.reconcile(days, told)
    return rows.select(*[F.col(c).cast("long").alias(c) for c in ("year", "month", "actual", "expected")])


def partition_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_candles(spark, sf_dir, "1h").withColumn("epoch", F.unix_seconds("timestamp_utc")).withColumn("v", F.col("volume").cast("long"))
    hashes = manifest.partition_hashes(rows, ["instrument", "epoch", "trade_count", "v"])
    return hashes.select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "rows", "hash")


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_days(spark, sf_dir).select(stamp(F.col("timestamp_utc")).alias("ts"), "high", "low", F.round("volume", 2).alias("volume"), F.round("quote_volume", 2).alias("quote_volume"), "trade_count")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report.coverage(validate.annotate(dirty(spark, sf_dir)), "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    return rows.select("instrument", "expected", "actual", "coverage_percent", "gaps", "missing_candles", "is_valid")


def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.issue_counts(validate.annotate(dirty(spark, sf_dir)))


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.null_counts(hourly(spark, sf_dir), [c.name for c in REGISTRY.columns])


def infinite_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sorted(DOUBLES)
    row = report.infinite_counts(hourly(spark, sf_dir), names)
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("infinite")) for c in names])).alias("p")).select("p.*")


def input_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.input_violations(dirty(spark, sf_dir), ("venue", "instrument"))


def output_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.output_violations(hourly(spark, sf_dir), REGISTRY)


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.plan_chunks(spark, "2024-01-01 00:00:00", "2024-02-01 00:00:00", "1m")


def month_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.plan_months(spark, "2023-09-18", "2026-09-17").withColumns({"start": F.col("start").cast("string"), "end": F.col("end").cast("string")})


def pending_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = calendar.plan_months(spark, "1994-03-10", "1999-05-20")
    done = tables.partition_summary(lineitem_days(spark, sf_dir)).select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"))
    return calendar.pending(plan, done, ["year", "month"]).select("year", "month", "kind")


def kline_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written to files as CSV klines, with times in four units, a header and broken lines, and read again."""
    rows = event_candles(spark, sf_dir, "1h")
    at = F.unix_seconds("timestamp_utc")
    unit = F.pmod(F.floor(at / 3600), F.lit(4))
    epoch = F.when(unit == 0, at).when(unit == 1, at * 1000).when(unit == 2, at * 1_000_000).otherwise(at * 1_000_000_000)
    line = F.concat_ws(",", epoch.cast("string"), *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")], F.lit("0"), F.col("quote_volume").cast("string"), F.col("trade_count").cast("string"), F.col("taker_buy_base_volume").cast("string"), F.col("taker_buy_quote_volume").cast("string"), F.lit("0"))
    lines = rows.select(line.alias("line")).unionByName(spark.createDataFrame([("",), ("open_time,open,high",), ("1,2,3",)], "line string"))
    path = files.scratch(spark, "klines")
    lines.write.text(path)
    return _bar_columns(klines.candles_from_csv(spark, [path], venue="SIM", instrument="evt", market_type="SPOT", timeframe="1H").select(*CANDLE_COLUMNS))


def candle_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of several instruments: written one after the other, months grown by merging, one instrument's months replaced."""
    rows, path = event_candles(spark, sf_dir, "1h", per_type=True), files.scratch(spark, "candles")
    odd = F.pmod(F.floor(F.unix_seconds("timestamp_utc") / 3600), F.lit(2)) == 1
    tables.write_candles(rows.where(odd & (F.col("instrument") < "D")), path)
    tables.write_candles(rows.where(odd & (F.col("instrument") >= "D")), path)
    tables.merge_candles(rows, path)
    tables.write_candles(rows.where("instrument = 'CLICK'").withColumn("close", F.col("close") + 1), path)
    return _bar_columns(tables.read_candles(spark, path))


def expanded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expansion of two instruments after each other, then of a grown month: what the manifests tell of the table, held against its rows."""
    raw = event_candles(spark, sf_dir, "1m", per_type=True).withColumn("seq", F.unix_seconds("timestamp_utc"))
    path = files.scratch(spark, "expanded")
    ingest.expand(spark, raw.where("instrument = 'CLICK' AND minute(timestamp_utc) < 30"), table=path)
    ingest.expand(spark, raw.where("instrument = 'PURCHASE'"), table=path)
    ingest.expand(spark, raw.where("instrument IN ('CLICK', 'PURCHASE')"), table=path)
    held = tables.read_candles(spark, path).groupBy("instrument", "timeframe").agg(F.count(F.lit(1)).alias("rows"), F.sum("trade_count").alias("trade_count"), F.sum(F.col("is_complete").cast("long")).alias("complete_rows"))
    told = ingest.manifests(spark, path).groupBy("instrument", "timeframe").agg(F.sum("rows").alias("told_rows"))
    return held.join(told, ["instrument", "timeframe"], "left")


def features_five_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production clock on a series without gaps: most rows are valid."""
    bar = lambda tf: order_candles(spark, sf_dir, tf)
    rows = FeatureEngine().compute(FeatureInput(bar("5m"), bar("1m"), bar("15m"), bar("1h")))
    return _rounded(rows, ["is_warmup", "has_data_gap", "is_valid", "nan_feature_count", "domain_nan_feature_count", *[c.name for c in REGISTRY.columns]])


def probe_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ms"), F.get_json_object("props", "$.k").cast("long").alias("k"))
    return latency_metrics(rows.withColumn("ingest_ms", F.col("event_ms") + F.col("k")), skew_ms=20).withColumn("avg_ms", F.round("avg_ms", 6))


def segmented_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute bars, every stretch between gaps a series of its own: the short exponential average restarts."""
    engine = FeatureEngine(segment_on_gap=True)
    rows = engine.compute(FeatureInput(event_candles(spark, sf_dir, "5m")))
    return rows.select(stamp(F.col("timestamp_utc")).alias("ts"), F.round("ret_log_cc_1", 6).alias("ret_log_cc_1"), F.round("mom_ema_dev_12", 6).alias("mom_ema_dev_12"), F.round("vol_atr_14", 6).alias("vol_atr_14"), "is_warmup")


def feature_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = default_registry()
    rows = [(f, n, *registry.history_by_family()[f]) for f, n in registry.counts_by_family().items()]
    return spark.createDataFrame(rows, "family string, features long, min_history long, max_history long")


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {"ticks_to_candles": ticks_to_candles}
    found |= {f"resample_{tf}": _resampled(tf) for tf in RESAMPLED}
    found["resample_all"] = lambda spark, sf_dir: _bar_columns(resample_all(event_candles(spark, sf_dir, "1m")))
    for f in (validate_issues, validate_summary, gap_records, gap_registry, gaps_by_category, dedupe_exact, dedupe_last, overlap_conflicts, overlap_merge, bounds, timeframe_summary, inspect_candles, partition_summary, reconcile_months, partition_hashes, lineitem_bars, coverage, issue_counts, null_counts, infinite_counts, input_contract, output_contract, chunk_plan, month_plan, pending_months, kline_csv, candle_table, expanded_table, probe_latency, segmented_valid, features_five_minutes, feature_catalogue):
        found[f.__name__] = f
    found |= {f"features_{family}": _family(family) for family in [*FAMILIES, "mtf"]}
    found["features_gk_legacy"] = lambda spark, sf_dir: _rounded(hourly(spark, sf_dir, gk_mode="legacy"), ["vol_gk_realized_12", "vol_gk_realized_24"])
    found["features_validity"] = _validity
    found["features_validity_sentinels"] = lambda spark, sf_dir: _validity(spark, sf_dir, nan_count="sentinels")
    found["features_full"] = features_full
    return found


def oracle_sql() -> dict[str, str]:
    d = f"WITH {_DIRTY}"
    sql = {"ticks_to_candles": f"WITH {O.bars(3600, per_type=True)} SELECT '1h' AS timeframe, inst AS instrument, {sql_stamp('ts')} AS ts, {_BAR}, true AS is_complete FROM bars"}
    sql |= {f"resample_{tf}": _resample_one_sql(tf) for tf in RESAMPLED}
    sql["resample_all"] = _resample_all_sql()
    sql["validate_issues"] = f"{d} SELECT inst AS instrument, {sql_stamp('ts')} AS ts, CAST(seq AS BIGINT) AS seq, issue AS issue_type FROM issues"
    count = lambda t: f"CAST(count(*) FILTER (issue = '{t}') AS BIGINT)"
    per = f"SELECT inst AS instrument, (SELECT count(*) FROM dirty) AS total_records, (SELECT count(*) FROM dirty) - count(DISTINCT seq) FILTER (issue <> 'DATA_GAP_DETECTED') AS valid_records, count(DISTINCT seq) FILTER (issue <> 'DATA_GAP_DETECTED') AS invalid_records, count(*) AS total_issues, {count('EXACT_DUPLICATE')} AS exact_duplicates, {count('CONFLICTING_DUPLICATE')} AS conflicting_duplicates, {count('TIMESTAMP_OUT_OF_ORDER')} AS out_of_order, {count('DATA_GAP_DETECTED')} AS gaps, CAST(sum(CASE WHEN issue = 'DATA_GAP_DETECTED' THEN round_even(delta / 300, 0) - 1 ELSE 0 END) AS BIGINT) AS missing_candles, count(DISTINCT seq) FILTER (issue <> 'DATA_GAP_DETECTED') = 0 AS is_valid FROM issues GROUP BY 1"
    sql["validate_summary"] = f"{d} {per}"
    sql["gap_records"] = f"{d} SELECT instrument, {sql_stamp('gap_start')} AS gap_start, {sql_stamp('gap_end')} AS gap_end, seconds_between, missing_candles FROM ({_GAPS})"
    one = "strftime(gap_start, '%Y%m%d%H%M')"
    clean_gaps = "SELECT inst AS instrument, prev + INTERVAL 300 SECOND AS gap_start, ts - INTERVAL 300 SECOND AS gap_end, CAST(round_even(delta / 300, 0) AS BIGINT) - 1 AS missing_candles FROM (SELECT inst, ts, lag(ts) OVER (PARTITION BY inst ORDER BY ts) AS prev, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY inst ORDER BY ts)) AS delta FROM bars) WHERE delta > 300"
    named = f"'gap_' || lower(instrument) || '_5m_' || {one} || '_' || {one.replace('gap_start', 'gap_end')} AS gap_id"
    sql["gap_registry"] = f"""{d}, u AS (SELECT {named}, *, 'archive' AS acquisition_source, 'PROVIDER_GAP' AS category, 1 AS fresh FROM ({_GAPS}) UNION ALL BY NAME SELECT {named}, *, 'stream' AS acquisition_source, 'UNKNOWN' AS category, 0 AS fresh FROM ({clean_gaps})),
r AS (SELECT *, row_number() OVER (PARTITION BY gap_id ORDER BY fresh DESC) AS k FROM u)
SELECT gap_id, instrument, {sql_stamp('gap_start')} AS start, {sql_stamp('gap_end')} AS expected_end, CAST(epoch(gap_end) - epoch(gap_start) AS INTEGER) AS duration_seconds, missing_candles AS missing, acquisition_source, category FROM r WHERE k = 1"""
    sql["gaps_by_category"] = f"{d} SELECT c.category, CAST(count(g.missing_candles) AS BIGINT) AS gaps, CAST(coalesce(sum(g.missing_candles), 0) AS BIGINT) AS missing_candles, CAST(count(g.missing_candles) AS BIGINT) AS unresolved FROM (SELECT unnest({list(GAP_CATEGORIES)!r}) AS category) c LEFT JOIN ({_GAPS}) g ON c.category = 'PROVIDER_GAP' GROUP BY 1"
    sql["dedupe_exact"] = f"{d} SELECT {sql_stamp('ts')} AS ts, CAST(min(seq) AS BIGINT) AS seq, round(c, 4) AS close FROM dirty GROUP BY inst, dirty.ts, o, h, l, c, v"
    sql["dedupe_last"] = f"{d} SELECT {sql_stamp('ts')} AS ts, CAST(max(seq) AS BIGINT) AS seq, round(arg_max(c, seq), 4) AS close FROM dirty GROUP BY inst, dirty.ts"
    sides = f"WITH {O.bars(3600)}, e AS (SELECT *, CAST(epoch(ts) AS BIGINT) // 3600 AS k FROM bars), a AS (SELECT * FROM e WHERE k % 3 <> 0), b AS (SELECT * REPLACE (c + CASE WHEN k % 7 = 0 THEN {{}} ELSE 0.0 END AS c) FROM e WHERE k % 3 <> 1)"
    sql["overlap_conflicts"] = f"{sides.format(0.5)} SELECT {sql_stamp('ts')} AS ts, round(a.c, 4) AS existing_close, round(b.c, 4) AS new_close FROM a JOIN b USING (inst, ts) WHERE abs(a.o - b.o) > 1e-4 OR abs(a.c - b.c) > 1e-4 OR abs(a.v - b.v) > 1e-4"
    sql["overlap_merge"] = f"{sides.format(0.00005)} SELECT {sql_stamp('coalesce(a.ts, b.ts)')} AS ts, round(coalesce(a.c, b.c), 6) AS close FROM a FULL JOIN b ON a.inst = b.inst AND a.ts = b.ts"
    sql["bounds"] = f"WITH {O.bars(3600)} SELECT {sql_stamp('ts')} AS ts, CAST(n AS BIGINT) AS trade_count FROM bars WHERE ts >= (SELECT min(ts) + INTERVAL 36 HOUR FROM bars) AND ts < (SELECT max(ts) - INTERVAL 36 HOUR FROM bars)"
    measures = f"CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (done) AS BIGINT) AS complete_rows, round(count(*) FILTER (done) * 100.0::DOUBLE / count(*), 2) AS complete_percent, {sql_stamp('min(ts)')} AS first_time, {sql_stamp('max(ts)')} AS last_time, round(min(l), 4) AS min_low, round(max(h), 4) AS max_high, round(sum(v), 2) AS volume, round(sum(qv), 2) AS quote_volume, CAST(sum(n) AS BIGINT) AS trade_count"
    union = " UNION ALL BY NAME ".join(f"SELECT timeframe, ts, l, h, v, qv, n, done FROM {tf_name(tf)}" for tf in RESAMPLED)
    parts = ", ".join(_resample_sql(tf).replace(O.more_bars(60, "mn"), "").lstrip(", ") for tf in RESAMPLED)
    sql["timeframe_summary"] = f"WITH {O.bars(60)}, mn AS (SELECT * FROM bars), {parts} SELECT timeframe, {measures} FROM (SELECT '1m' AS timeframe, ts, l, h, v, qv, n, true AS done FROM bars UNION ALL BY NAME {union}) GROUP BY 1"
    sql["inspect_candles"] = f"WITH {O.bars(300)} SELECT CAST(count(*) AS BIGINT) AS rows, {sql_stamp('min(ts)')} AS first_time, {sql_stamp('max(ts)')} AS last_time, round(min(l), 2) AS min_low, round(max(h), 2) AS max_high, round(sum(v), 2) AS volume, round(sum(qv), 2) AS quote_volume, CAST(sum(n) AS BIGINT) AS trade_count FROM bars"
    days = "days AS (SELECT date_trunc('day', l_shipdate) AS ts, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low, sum(l_quantity) AS volume, sum(l_extendedprice) AS quote_volume, count(*) AS trade_count FROM lineitem GROUP BY 1)"
    months = "SELECT CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, CAST(count(*) AS BIGINT) AS rows, min(ts) AS a, max(ts) AS b FROM days GROUP BY 1, 2"
    sql["lineitem_bars"] = f"WITH {days} SELECT {sql_stamp('ts')} AS ts, high, low, round(volume, 2) AS volume, round(quote_volume, 2) AS quote_volume, CAST(trade_count AS BIGINT) AS trade_count FROM days"
    sql["partition_summary"] = f"WITH {days} SELECT year, month, rows, {sql_stamp('a')} AS first_time, {sql_stamp('b')} AS last_time FROM ({months})"
    sql["reconcile_months"] = f"WITH {days}, a AS ({months}), e AS (SELECT year, month, rows + CASE WHEN month = 2 THEN 1 ELSE 0 END AS rows FROM a WHERE year <> 1995 OR month <> 6) SELECT coalesce(a.year, e.year) AS year, coalesce(a.month, e.month) AS month, a.rows AS actual, e.rows AS expected FROM a FULL JOIN e ON a.year = e.year AND a.month = e.month WHERE a.rows IS DISTINCT FROM e.rows"
    sql["partition_hashes"] = f"""WITH {O.bars(3600)}, r AS (SELECT ts, sha256(inst || chr(31) || CAST(CAST(epoch(ts) AS BIGINT) AS VARCHAR) || chr(31) || CAST(n AS VARCHAR) || chr(31) || CAST(CAST(v AS BIGINT) AS VARCHAR)) AS h FROM bars),
hr AS (SELECT CAST(ts AS DATE) AS d, hour(ts) AS hh, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS h FROM r GROUP BY 1, 2), dy AS (SELECT d, sum(n) AS n, sha256(string_agg(h, '' ORDER BY hh)) AS h FROM hr GROUP BY 1)
SELECT CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(h, '' ORDER BY d)) AS hash FROM dy GROUP BY 1, 2"""
    sql["coverage"] = f"{d}, p AS ({per}) SELECT instrument, CAST(8928 AS BIGINT) AS expected, (SELECT count(DISTINCT ts) FROM dirty) AS actual, round((SELECT count(DISTINCT ts) FROM dirty) * 100.0::DOUBLE / 8928, 4) AS coverage_percent, gaps, missing_candles, is_valid FROM p"
    sql["issue_counts"] = f"{d} SELECT issue AS issue_type, CAST(count(*) AS BIGINT) AS n FROM issues GROUP BY 1"
    names = [c.name for c in REGISTRY.columns]
    sql["null_counts"] = f"{_wide_sql()}, t AS (SELECT {', '.join(f'CAST(count(*) - count({c}) AS BIGINT) AS {c}' for c in names)} FROM all_columns) UNPIVOT t ON COLUMNS(*) INTO NAME column_name VALUE nulls"
    sql["infinite_counts"] = f"{_wide_sql()}, t AS (SELECT {', '.join(f'CAST(count(*) FILTER (isinf({c})) AS BIGINT) AS {c}' for c in sorted(DOUBLES))} FROM all_columns) UNPIVOT t ON COLUMNS(*) INTO NAME column_name VALUE infinite"
    tally = lambda rule: f"CAST(count(*) FILTER ({rule}) AS BIGINT)"
    sql["input_contract"] = f"{d} SELECT CAST(count(*) AS BIGINT) AS bars, CAST(count(*) - count(DISTINCT ts) AS BIGINT) AS repeated_time, {tally('least(o, h, l, c) <= 0')} AS non_positive_price, {tally('h < l OR h < o OR h < c')} AS high_too_low, {tally('l > o OR l > c')} AS low_too_high, {tally('least(v, qv, tb) < 0')} AS negative_volume, {tally('n < 0')} AS negative_trade_count FROM dirty"
    some = lambda part, rule: " OR ".join(f"coalesce({rule.format(c)}, false)" for c in sorted(DOUBLES) if part in c)
    pivots = " OR ".join(f"coalesce(ms_is_pivot_{s}_{k}, false) <> (ms_pivot_{s}_timestamp_{k} IS NOT NULL AND ms_pivot_{s}_age_bars_{k} IS NOT NULL)" for s in ("high", "low") for k in (3, 5))
    sql["output_contract"] = f"{_wide_sql()} SELECT CAST(count(*) AS BIGINT) AS rows, {tally(some('', 'isinf({})'))} AS infinite, {tally(some('', 'isnan({})'))} AS not_a_number, {tally(some('zscore', 'abs({}) > 10 + 1e-10'))} AS zscore_range, {tally(some('_rsi_', '{0} < -1e-8 OR {0} > 100 + 1e-8'))} AS rsi_range, {tally(some('hurst', '{0} < 0 OR {0} > 1'))} AS hurst_range, CAST(0 AS BIGINT) AS valid_with_gap, CAST(0 AS BIGINT) AS valid_in_warmup, {tally(pivots)} AS pivot_incomplete FROM all_columns"
    sql["chunk_plan"] = "SELECT CAST(i AS BIGINT) AS chunk, CAST(1704067200000 + i * 60000000 AS BIGINT) AS start_ms, CAST(least(1704067200000 + (i + 1) * 60000000, 1706745600000) - 1 AS BIGINT) AS end_ms FROM range(0, 45) t(i) WHERE 1704067200000 + i * 60000000 < 1706745600000"
    plan = "SELECT CAST(year(m) AS BIGINT) AS year, CAST(month(m) AS BIGINT) AS month, greatest(CAST(m AS DATE), DATE '{0}') AS s, least(CAST(m + INTERVAL 1 MONTH AS DATE), DATE '{1}' + 1) AS e, CAST(m AS DATE) AS m FROM (SELECT unnest(generate_series(date_trunc('month', DATE '{0}'), DATE '{1}', INTERVAL 1 MONTH)) AS m)"
    kind = "CASE WHEN s = m AND e = CAST(m + INTERVAL 1 MONTH AS DATE) THEN 'monthly' ELSE 'daily' END AS kind"
    sql["month_plan"] = f"SELECT year, month, CAST(s AS VARCHAR) AS start, CAST(e AS VARCHAR) AS \"end\", {kind} FROM ({plan.format('2023-09-18', '2026-09-17')})"
    sql["pending_months"] = f"WITH {days} SELECT p.year, p.month, {kind} FROM ({plan.format('1994-03-10', '1999-05-20')}) p WHERE NOT EXISTS (SELECT 1 FROM days WHERE year(ts) = p.year AND month(ts) = p.month)"
    sql["kline_csv"] = f"WITH {O.bars(3600)} SELECT '1h' AS timeframe, inst AS instrument, {sql_stamp('ts')} AS ts, {_BAR}, true AS is_complete FROM bars"
    late = "greatest(0, CAST(json_extract_string(props, '$.k') AS BIGINT) - 20)"
    sql["probe_latency"] = f"SELECT CAST(count(*) AS BIGINT) AS messages, CAST(min({late}) AS BIGINT) AS min_ms, CAST(max({late}) AS BIGINT) AS max_ms, round(avg({late}), 6) AS avg_ms FROM events"
    islands = f"{O.bars(300)}, isl AS (SELECT *, sum(CASE WHEN epoch(ts) - epoch(p) > 300 THEN 1 ELSE 0 END) OVER (ORDER BY ts) AS i FROM (SELECT *, lag(ts) OVER (ORDER BY ts) AS p FROM bars))"
    own = "ib AS (SELECT CAST(i AS VARCHAR) AS inst, ts, o, h, l, c, v, qv, n, tb, tq, row_number() OVER (PARTITION BY i ORDER BY ts) - 1 AS rn FROM isl)"
    rec = O.recursion("s", "rec", {"e12": O.FILTERS["e12"], "a14": O.FILTERS["a14"]})
    sql["segmented_valid"] = f"WITH RECURSIVE {islands}, {own}, {O.shared('ib')}, {rec} SELECT {sql_stamp('s.ts')} AS ts, round(lr, 6) AS ret_log_cc_1, round(CASE WHEN e12 > 0 THEN (c - e12) / e12 END, 6) AS mom_ema_dev_12, round(a14, 6) AS vol_atr_14, s.rn < 311 AS is_warmup FROM s JOIN rec ON s.inst = rec.inst AND s.ts = rec.ts"
    sql["feature_catalogue"] = "SELECT * FROM (VALUES ('returns', 12::BIGINT, 1::BIGINT, 97::BIGINT), ('momentum', 17, 7, 96), ('volatility', 11, 12, 108), ('liquidity', 11, 1, 48), ('structure', 22, 6, 96), ('mean_reversion', 9, 12, 98), ('time', 9, 1, 1), ('mtf', 17, 1, 311)) t(family, features, min_history, max_history)"
    sql |= {f"features_{family}": _family_sql(family) for family in [*FAMILIES, "mtf"]}
    root = "CASE WHEN {0} >= 0 THEN sqrt({0}) WHEN abs({0}) <= 1e-12 THEN 0.0 END"
    cols = ", ".join(f"round({root.format(f'gl{n}.raw')}, 6) AS vol_gk_realized_{n}" for n in (12, 24))
    sql["features_gk_legacy"] = f"WITH RECURSIVE {O.bars(3600, per_type=True)}, {O.shared()}, {O.stale_sum(12)}, {O.stale_sum(24)} SELECT {sql_stamp('s.ts')} AS ts, inst, {cols} FROM s LEFT JOIN gl12 USING (inst, rn) LEFT JOIN gl24 USING (inst, rn)"
    sql["candle_table"] = f"WITH {O.bars(3600, per_type=True)} SELECT '1h' AS timeframe, inst AS instrument, {sql_stamp('ts')} AS ts, {_BAR.replace('round(c, 4)', "round(c + CASE WHEN inst = 'CLICK' THEN 1 ELSE 0 END, 4)")}, true AS is_complete FROM bars"
    held = " UNION ALL ".join(f"SELECT inst AS instrument, '{tf}' AS timeframe, CAST(count(*) AS BIGINT) AS rows, CAST(sum(n) AS BIGINT) AS trade_count, CAST(sum(k = {s // 60}) AS BIGINT) AS complete_rows FROM (SELECT inst, time_bucket(INTERVAL '{s} seconds', ts) AS b, sum(n) AS n, count(*) AS k FROM bars GROUP BY 1, 2) GROUP BY 1" for tf, s in SECONDS.items() if tf in ("1m", *RESAMPLED))
    sql["expanded_table"] = f"WITH {O.bars(60, per_type=True)}, t AS ({held}) SELECT *, rows AS told_rows FROM t WHERE instrument IN ('CLICK', 'PURCHASE')"
    sql["features_five_minutes"] = _full_sql(clock=(300, 60, 900, 3600), ticks=O.ORDER_TICKS, history=311)
    sql["features_validity"] = _validity_sql("every")
    from .plans.engine import SENTINELS

    seen = " OR ".join(f"{c} IS NULL" for c in SENTINELS)
    sql["features_validity_sentinels"] = _validity_sql(f"CASE WHEN is_warmup OR has_data_gap OR domain > 0 OR {seen} THEN every ELSE 0 END")
    sql["features_full"] = _full_sql()
    return sql
