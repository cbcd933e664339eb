"""Fixed schemas and time tables."""

from __future__ import annotations

from pyspark.sql import types as T

_D = T.DoubleType()

# Column names, types, timeframes and categories are those of existing tables.

#: A candle: one bar of one series, keyed by its open time in UTC.
CANDLE_SCHEMA = T.StructType(
    [T.StructField("timestamp_utc", T.TimestampType(), False)]
    + [T.StructField(n, T.StringType(), False) for n in ("venue", "instrument", "market_type", "timeframe")]
    + [T.StructField(n, _D, False) for n in ("open", "high", "low", "close", "volume", "quote_volume")]
    + [T.StructField("trade_count", T.LongType(), False)]
    + [T.StructField(n, _D, False) for n in ("taker_buy_base_volume", "taker_buy_quote_volume")]
    + [T.StructField("is_complete", T.BooleanType(), False)]
)
CANDLE_COLUMNS = CANDLE_SCHEMA.fieldNames()

#: What names a series of one timeframe, and what names an instrument.
SERIES = ["venue", "instrument", "market_type", "timeframe"]
KEY = ["venue", "instrument"]

#: Timeframes and their seconds.
SECONDS = {"1m": 60, "3m": 180, "5m": 300, "15m": 900, "30m": 1800, "1h": 3600, "2h": 7200, "4h": 14400, "1d": 86400}

#: Timeframes that the resampler makes from one-minute candles.
RESAMPLED = ("5m", "15m", "1h", "4h", "1d")

GAP_CATEGORIES = ("UNKNOWN", "ACQUISITION_FAILURE", "PROVIDER_GAP", "EXCHANGE_MAINTENANCE_CONFIRMED")

REGISTERED_GAP_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("gap_id", "instrument", "venue", "timeframe")]
    + [T.StructField(n, T.TimestampType()) for n in ("expected_start_utc", "expected_end_utc", "actual_missing_start_utc", "actual_missing_end_utc")]
    + [T.StructField("duration_seconds", T.IntegerType()), T.StructField("missing_candles_count", T.IntegerType()), T.StructField("detected_at_utc", T.TimestampType())]
    + [T.StructField(n, T.StringType()) for n in ("acquisition_source", "category", "evidence")]
    + [T.StructField("is_resolved", T.BooleanType()), T.StructField("resolution_notes", T.StringType())]
)


def seconds(timeframe: str) -> int:
    """Seconds of a timeframe; an unknown one raises ValueError."""
    try:
        return SECONDS[timeframe]
    except KeyError:
        raise ValueError(f"unknown timeframe {timeframe!r}") from None
