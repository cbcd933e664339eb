"""Structured Streaming: live candles, the trade-stream probe, and recursive filters with state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CANDLE_COLUMNS, seconds
from ..sources.candles import PARTITIONS

TICK_SCHEMA = T.StructType([T.StructField("instrument", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("price", T.DoubleType()), T.StructField("quantity", T.LongType()), T.StructField("is_taker_buy", T.BooleanType())])


def tick_stream(spark: SparkSession, path: str, *, files_per_trigger: int = 100) -> DataFrame:
    """Ticks of Parquet files as they land in `path`."""
    return spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def live_candles(ticks: DataFrame, timeframe: str, *, venue: str, market_type: str = "spot", lateness: str = "0 seconds", order: str = "ts") -> DataFrame:
    """Candles of a stream of ticks; in append mode a candle comes out once the watermark has passed its end, so all that
    come out are complete.  Ticks later than `lateness` are dropped; they are mended by writing their month again in batch.  `order` names the sequence number of ticks, if several may have one time."""
    quote = F.col("price") * F.col("quantity")
    step = seconds(timeframe)
    bars = ticks.withWatermark("ts", lateness).groupBy("instrument", F.window("ts", f"{step} seconds").alias("w"))
    rows = bars.agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").cast("double").alias("volume"),
        F.sum(quote).alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(F.col("is_taker_buy"), F.col("quantity")).otherwise(0)).cast("double").alias("taker_buy_base_volume"),
        F.sum(F.when(F.col("is_taker_buy"), quote).otherwise(0.0)).alias("taker_buy_quote_volume"),
    )
    fixed = {"timestamp_utc": F.col("w.start"), "venue": F.lit(venue), "market_type": F.lit(market_type), "timeframe": F.lit(timeframe), "is_complete": F.lit(True)}
    return rows.withColumns(fixed).select(*CANDLE_COLUMNS)


def write_candle_stream(candles: DataFrame, path: str, checkpoint: str, *, once: bool = True):
    """Append candles to a candle table; with `once` all that is there, then stop."""
    months = candles.withColumn("year", F.year("timestamp_utc")).withColumn("month", F.month("timestamp_utc"))
    writer = months.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*PARTITIONS)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latency_metrics(received: DataFrame, *, event: str = "event_ms", ingest: str = "ingest_ms", skew_ms: int = 0) -> DataFrame:
    """Messages and latency in ms, ingest less event time less the clocks' skew, never below zero; of a batch or a stream."""
    delay = F.greatest(F.lit(0), F.col(ingest) - F.col(event) - skew_ms)
    return received.agg(F.count(F.lit(1)).alias("messages"), F.min(delay).alias("min_ms"), F.max(delay).alias("max_ms"), F.avg(delay).alias("avg_ms"))


def live_ema(candles: DataFrame, n: int, *, keys: tuple[str, ...] = ("venue", "instrument")) -> DataFrame:
    """The exponential average of closes of a stream of candles, SMA-seeded, with (count, sum, average) as state per series.

    Candles of a trigger are taken in time order; a candle not after the last one is dropped, as a filter can't go back.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    alpha = 2 / (n + 1)
    out = T.StructType([T.StructField(k, T.StringType()) for k in keys] + [T.StructField("timestamp_utc", T.TimestampType()), T.StructField("close", T.DoubleType()), T.StructField("ema", T.DoubleType())])
    held = T.StructType([T.StructField("count", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("last", T.LongType())])

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, value, last = state.get if state.exists else (0, 0.0, -(2**62))
        rows = []
        for r in pd.concat(list(frames)).sort_values("timestamp_utc").itertuples():
            at = r.timestamp_utc.value
            if at <= last:
                continue
            last, count = at, count + 1
            if count <= n:
                value += r.close
                if count == n:
                    value /= n
            else:
                value = alpha * r.close + (1 - alpha) * value
            rows.append((*key, r.timestamp_utc, r.close, value if count >= n else None))
        state.update((count, value, last))
        yield pd.DataFrame(rows, columns=[*keys, "timestamp_utc", "close", "ema"])

    return candles.select(*keys, "timestamp_utc", "close").groupBy(*keys).applyInPandasWithState(step, out, held, "append", GroupStateTimeout.NoTimeout)
