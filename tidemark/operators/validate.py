"""Validation of candle series: issues, gaps, and a summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SECONDS, SERIES
from .blocks import previous

GAP = "DATA_GAP_DETECTED"

# Names that existing reports use.
#: Issue types in the order in which a candle's issues are listed.  NON_UTC_TIMEZONE can't occur: Spark timestamps are instants.
ISSUE_TYPES = (
    "NON_UTC_TIMEZONE", "NON_POSITIVE_PRICE", "OHLC_HIGH_LESS_THAN_LOW", "OHLC_OPEN_OUT_OF_RANGE", "OHLC_CLOSE_OUT_OF_RANGE", "NEGATIVE_VOLUME",
    "TAKER_VOLUME_EXCEEDS_TOTAL", "NEGATIVE_TRADE_COUNT", "EXACT_DUPLICATE", "CONFLICTING_DUPLICATE", "TIMESTAMP_OUT_OF_ORDER", GAP,
    "TAKER_QUOTE_EXCEEDS_TOTAL", "EXTREME_RETURN",
)


def _step(default: int = 60) -> Column:
    out = F.lit(default)
    for tf, s in SECONDS.items():
        out = F.when(F.col("timeframe") == tf, s).otherwise(out)
    return out


def annotate(candles: DataFrame, *, seq: str = "seq", series: list[str] = SERIES, strict: bool = False, extreme: float = 0.10) -> DataFrame:
    """Candles with what rules look at: the step before, the first candle of the same time, and `issues`, an array of types.

    `seq` is the input order, an integer; order is judged by it.  `strict` adds the taker-quote and extreme-return rules.
    A series may be any part of the input: candles look back by blocks of `seq`, never over a whole series in one task.
    """
    same = Window.partitionBy(*series, "timestamp_utc").orderBy(seq)
    values = ("open", "high", "low", "close", "volume")
    rows = previous(candles, tuple(series), seq, F.shiftright(F.col(seq).cast("long"), 18), ("timestamp_utc", "close"))
    rows = rows.withColumnsRenamed({"_prev_timestamp_utc": "_prev", "_prev_close": "_close"})
    rows = rows.withColumn("_nth", F.row_number().over(same)).withColumn("_first", F.first(F.struct(*values)).over(same))
    rows = rows.withColumn("_delta", F.unix_seconds("timestamp_utc") - F.unix_seconds("_prev")).withColumn("_step", _step())
    o, h, l, c, v = (F.col(x) for x in values)
    equal = F.struct(*values) == F.col("_first")
    rules = {
        "NON_POSITIVE_PRICE": F.least(o, h, l, c) <= 0,
        "OHLC_HIGH_LESS_THAN_LOW": h < l,
        "OHLC_OPEN_OUT_OF_RANGE": (o < l) | (o > h),
        "OHLC_CLOSE_OUT_OF_RANGE": (c < l) | (c > h),
        "NEGATIVE_VOLUME": (v < 0) | (F.col("quote_volume") < 0),
        "TAKER_VOLUME_EXCEEDS_TOTAL": F.col("taker_buy_base_volume") > v + 1e-7,
        "NEGATIVE_TRADE_COUNT": F.col("trade_count") < 0,
        "EXACT_DUPLICATE": (F.col("_nth") > 1) & equal,
        "CONFLICTING_DUPLICATE": (F.col("_nth") > 1) & ~equal,
        "TIMESTAMP_OUT_OF_ORDER": F.col("_delta") <= 0,
        GAP: F.col("_delta") > F.col("_step"),
    }
    if strict:
        rules["TAKER_QUOTE_EXCEEDS_TOTAL"] = F.col("taker_buy_quote_volume") > F.col("quote_volume") + 1e-7
        rules["EXTREME_RETURN"] = (F.col("_close") > 0) & (F.abs(c / F.col("_close") - 1) > extreme)
    return rows.withColumn("issues", F.array_compact(F.array(*[F.when(r, F.lit(t)) for t, r in rules.items()])))


def issues(annotated: DataFrame, *, seq: str = "seq", series: list[str] = SERIES) -> DataFrame:
    """One row per candle and issue."""
    return annotated.select(*series, "timestamp_utc", F.col(seq).alias("seq"), F.explode("issues").alias("issue_type"))


def gaps(annotated: DataFrame, *, series: list[str] = SERIES) -> DataFrame:
    """One row per gap: its first and last missing candle and how many are missing (rounded half to even)."""
    step = F.col("_step")
    return annotated.where(F.array_contains("issues", GAP)).select(
        *series,
        F.timestamp_seconds(F.unix_seconds("_prev") + step).alias("gap_start"),
        F.timestamp_seconds(F.unix_seconds("timestamp_utc") - step).alias("gap_end"),
        F.col("_delta").alias("seconds_between"),
        (F.bround(F.col("_delta") / step, 0) - 1).cast("long").alias("missing_candles"),
    )


def summary(annotated: DataFrame, *, series: list[str] = SERIES) -> DataFrame:
    """Per series: counts by kind, and whether it is valid; gaps alone don't make it invalid.  No candles, no row: valid."""
    kinds = F.array_except("issues", F.array(F.lit(GAP)))
    has = lambda t: F.sum(F.array_contains("issues", t).cast("long"))
    out = annotated.groupBy(*series).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum((F.size(kinds) > 0).cast("long")).alias("invalid_records"),
        F.sum(F.size("issues").cast("long")).alias("total_issues"),
        has("EXACT_DUPLICATE").alias("exact_duplicates"),
        has("CONFLICTING_DUPLICATE").alias("conflicting_duplicates"),
        has("TIMESTAMP_OUT_OF_ORDER").alias("out_of_order"),
        has(GAP).alias("gaps"),
        F.sum(F.when(F.array_contains("issues", GAP), F.bround(F.col("_delta") / F.col("_step"), 0) - 1).otherwise(0)).cast("long").alias("missing_candles"),
        F.min("timestamp_utc").alias("first_time"),
        F.max("timestamp_utc").alias("last_time"),
    )
    return out.withColumn("is_valid", F.col("invalid_records") == 0).withColumn("valid_records", F.col("total_records") - F.col("invalid_records"))
