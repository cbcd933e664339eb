"""Quality reports."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import validate
from ..sources.candles import inspect_timeframes
from ..sources.files import write_text


def coverage(annotated: DataFrame, start, end, *, step: int | None = None, series: list[str] = validate.SERIES) -> DataFrame:
    """Per series: candles expected in [start, end), distinct ones there are, coverage in percent, issues and missing candles.

    A candle is expected every `step` seconds, by default those of the series' timeframe.
    """
    every = F.col("_step") if step is None else F.lit(step)
    expected = ((F.unix_seconds(F.lit(end).cast("timestamp")) - F.unix_seconds(F.lit(start).cast("timestamp"))) / every).cast("long")
    times = annotated.groupBy(*series, "timestamp_utc").agg(F.min("_step").alias("_step"))
    actual = times.groupBy(*series).agg(F.count(F.lit(1)).alias("actual"), F.min("_step").alias("_step"))
    out = validate.summary(annotated, series=series).join(actual, series).withColumn("expected", expected)
    percent = F.when(F.col("expected") > 0, F.round(F.col("actual") * 100.0 / F.col("expected"), 4)).otherwise(0.0)
    return out.select(*series, "expected", "actual", percent.alias("coverage_percent"), "exact_duplicates", "conflicting_duplicates", "out_of_order", "gaps", "missing_candles", "is_valid")


def issue_counts(annotated: DataFrame) -> DataFrame:
    return annotated.select(F.explode("issues").alias("issue_type")).groupBy("issue_type").agg(F.count(F.lit(1)).alias("n"))


def null_counts(features: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls) in one pass."""
    row = features.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("nulls")) for c in columns])
    return row.select(F.explode(pairs).alias("p")).select("p.column_name", "p.nulls")


def infinite_counts(features: DataFrame, columns: list[str]) -> DataFrame:
    return features.agg(*[F.sum(F.coalesce((F.abs(F.col(c)) == float("inf")).cast("long"), F.lit(0))).alias(c) for c in columns])


def markdown(candles: DataFrame) -> str:
    """The timeframe table as Markdown."""
    rows = inspect_timeframes(candles).orderBy("timeframe").collect()
    head = "| timeframe | rows | complete % | first | last | low | high | volume |\n|---|---|---|---|---|---|---|---|\n"
    return head + "".join(f"| {r['timeframe']} | {r['rows']} | {r['complete_percent']} | {r['first_time']} | {r['last_time']} | {r['min_low']} | {r['max_high']} | {r['volume']} |\n" for r in rows)


#: Issues that a quality summary counts together.
OHLC = ("OHLC",)
VOLUME = ("NEGATIVE_VOLUME", "TAKER_VOLUME_EXCEEDS_TOTAL")


def quality_summary(annotated: DataFrame, candles: DataFrame, start: str, end: str, *, step: int | None = None, landed: list[dict[str, Any]] | None = None, **more: Any) -> DataFrame:
    """One row per series of validated minutes: what was asked for and what came, issues by class, and `timeframes` of its table.

    Bounds are half open.  `landed` are the files told by ingestion, counted over all series; `more` are constants such as
    durations, as columns of their names.
    """
    keys = [k for k in validate.SERIES if k != "timeframe"]
    told = coverage(annotated, start, end, step=step)
    kind = lambda *parts: F.sum(F.size(F.filter("issues", lambda i: _any(i, parts))).cast("long"))
    counted = annotated.groupBy(*validate.SERIES).agg(
        F.min("timestamp_utc").alias("actual_start"), F.max("timestamp_utc").alias("actual_end"), F.count(F.lit(1)).alias("rows"), F.sum((F.size(F.filter("issues", lambda i: i != "DATA_GAP_DETECTED")) > 0).cast("long")).alias("invalid_rows"),
        kind(*OHLC).alias("ohlc_violations"), kind("NON_POSITIVE_PRICE").alias("non_positive_prices"), kind(*VOLUME).alias("volume_anomalies"), F.sum((~F.col("is_complete")).cast("long")).alias("incomplete_rows"),
    )
    bars = candles.groupBy(*keys, "timeframe").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_complete").cast("long")).alias("complete_rows"), F.min("timestamp_utc").alias("first_time"), F.max("timestamp_utc").alias("last_time"))
    bars = bars.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("timeframe", "rows", "complete_rows", (F.col("rows") - F.col("complete_rows")).alias("incomplete_rows"), "first_time", "last_time"))).alias("timeframes"))
    fixed = {"requested_start": F.lit(start).cast("timestamp"), "requested_end": F.lit(end).cast("timestamp"), "status": F.when(F.col("is_valid"), "PASS").otherwise("FAIL"), "raw_files": F.lit(len(landed or [])), "raw_bytes": F.lit(sum(t.get("bytes", 0) for t in landed or [])).cast("long")}
    out = counted.join(told, validate.SERIES).join(bars, keys, "left").withColumn("valid_rows", F.col("rows") - F.col("invalid_rows"))
    return out.withColumns(fixed | {k: F.lit(v) for k, v in more.items()})


def _any(issue, parts: tuple[str, ...]):
    """Whether an issue's name holds one of the parts."""
    found = F.lit(False)
    for p in parts:
        found = found | issue.contains(p)
    return found


def save_quality(spark: SparkSession, summary: DataFrame, path: str) -> list[dict[str, Any]]:
    """The summary, one row per series, as JSON at `path` and as Markdown beside it."""
    rows = [r.asDict(recursive=True) for r in summary.orderBy(*validate.SERIES).collect()]
    write_text(spark, path, json.dumps(rows, indent=2, sort_keys=True, default=str))
    lines: list[str] = []
    for r in rows:
        lines += [f"# {r['venue']} {r['instrument']} {r['market_type']} {r['timeframe']}: {r['status']}", ""]
        lines += [f"* {k}: {v}" for k, v in sorted(r.items()) if k not in (*validate.SERIES, "status", "timeframes")]
        lines += ["", "| timeframe | rows | complete | first | last |", "|---|---|---|---|---|"]
        lines += [f"| {t['timeframe']} | {t['rows']} | {t['complete_rows']} | {t['first_time']} | {t['last_time']} |" for t in r["timeframes"] or []]
        lines.append("")
    write_text(spark, path.rsplit(".json", 1)[0] + ".md", "\n".join(lines))
    return rows
