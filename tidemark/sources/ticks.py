"""Ticks and daily bars from the benchmark's event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..clock import floor_to
from ..operators.resample import candles_from_ticks
from ..schema import CANDLE_COLUMNS

TAKER_EVENTS = ("purchase", "click")


def event_ticks(events: DataFrame, *, per_type: bool = False) -> DataFrame:
    """Price is the value, quantity k + 1; one instrument, or one per event type."""
    name = F.upper("event_type") if per_type else F.lit("EVT")
    return events.select(
        name.alias("instrument"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("quantity"),
        F.col("event_type").isin(*TAKER_EVENTS).alias("is_taker_buy"),
    )


def event_candles(spark: SparkSession, sf_dir: str, timeframe: str, *, per_type: bool = False) -> DataFrame:
    return candles_from_ticks(event_ticks(spark.read.parquet(f"{sf_dir}/events.parquet"), per_type=per_type), timeframe, venue="sim")


def order_ticks(orders: DataFrame, *, seconds: int = 20) -> DataFrame:
    """A tick every `seconds` by order key, without gaps: price and quantity from the cents of the total."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("o_orderkey") * seconds)
    return orders.select(F.lit("ORD").alias("instrument"), at.alias("ts"), (F.lit(100.0) + F.pmod(cents, F.lit(5000)) / 100.0).alias("price"), (F.pmod(cents, F.lit(50)) + 1).alias("quantity"), (F.pmod(cents, F.lit(3)) == 0).alias("is_taker_buy"))


def order_candles(spark: SparkSession, sf_dir: str, timeframe: str) -> DataFrame:
    return candles_from_ticks(order_ticks(spark.read.parquet(f"{sf_dir}/orders.parquet")), timeframe, venue="sim")


def lineitem_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily high, low and volume of unit prices; opens and closes have no total order in this table, so they are the extremes."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_shipdate").cast("timestamp").alias("ts"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "l_quantity", "l_extendedprice")
    days = rows.groupBy(floor_to(F.col("ts"), 86400).alias("timestamp_utc")).agg(F.max("price").alias("high"), F.min("price").alias("low"), F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("quote_volume"), F.count(F.lit(1)).alias("trade_count"))
    fixed = {"venue": F.lit("sim"), "instrument": F.lit("LINE"), "market_type": F.lit("spot"), "timeframe": F.lit("1d"), "open": F.col("low"), "close": F.col("high"), "taker_buy_base_volume": F.lit(0.0), "taker_buy_quote_volume": F.lit(0.0), "is_complete": F.lit(True)}
    return days.withColumns(fixed).select(*CANDLE_COLUMNS)
