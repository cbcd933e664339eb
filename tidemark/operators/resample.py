"""Higher timeframes from one-minute candles, with explicit completeness.  Missing bars are never filled."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..clock import floor_to
from ..schema import CANDLE_COLUMNS, RESAMPLED, seconds

_SERIES = ("venue", "instrument", "market_type")

#: Candles of a bar that the bits of one long can tell apart.
BITS = 63


def bar_aggregates(ts: str = "timestamp_utc") -> list[Column]:  # of one series no two candles have one time
    """First open, highest high, lowest low, last close, sums."""
    return [
        F.min_by("open", ts).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", ts).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("quote_volume").alias("quote_volume"),
        F.sum("trade_count").cast("long").alias("trade_count"),
        F.sum("taker_buy_base_volume").alias("taker_buy_base_volume"),
        F.sum("taker_buy_quote_volume").alias("taker_buy_quote_volume"),
    ]


def resample(candles: DataFrame, timeframe: str, *, base_seconds: int = 60, distinct: bool = True) -> DataFrame:
    """Candles of `timeframe` from candles of `base_seconds`; empty buckets give no row.

    A bar is complete if it has all its minutes (distinct ones, unless `distinct` is off), all complete, and the series
    reaches its end.
    """
    return resample_all(candles, (timeframe,), base_seconds=base_seconds, distinct=distinct)


def resample_all(candles: DataFrame, timeframes: Iterable[str] = RESAMPLED, *, base_seconds: int = 60, distinct: bool = True) -> DataFrame:
    """All `timeframes`, told apart by `timeframe`; what each has is what the base candles say, not what other bars do.

    Aggregation is partial before the shuffle, so a row is sent per bucket and task, not per candle.  The distinct minutes
    of a bar are the bits of one long; bars of more candles than it has bits are put together from the bars of a shorter
    timeframe, whose sums, extremes, ends and bits are all that is needed.
    """
    steps = {tf: seconds(tf) for tf in timeframes}
    for tf, step in steps.items():
        if tf not in RESAMPLED or step <= base_seconds or step % base_seconds:
            raise ValueError(f"can't make {tf!r} from candles of {base_seconds} s")
    short = {tf: step for tf, step in steps.items() if step // base_seconds <= BITS}
    out = _finished(_bars(candles, short, base_seconds), candles, base_seconds, distinct) if short else None
    for tf, step in steps.items():
        if tf not in short:
            part = max((s for s in map(seconds, RESAMPLED) if s // base_seconds <= BITS and s > base_seconds and step % s == 0), default=None)
            if part is None:
                raise ValueError(f"can't make {tf!r} from candles of {base_seconds} s")
            parts = _bars(candles, {tf: part}, base_seconds).withColumn("timestamp_utc", F.col("_bucket"))
            whole = parts.groupBy(*_SERIES, "timeframe", F.lit(step).alias("_step"), floor_to(F.col("timestamp_utc"), step).alias("_bucket")).agg(*bar_aggregates(), F.sum("_n").alias("_n"), F.sum("_d").alias("_d"), F.bool_and("_all").alias("_all"))
            bars = _finished(whole, candles, base_seconds, distinct)
            out = bars if out is None else out.unionByName(bars)
    if out is None:
        raise ValueError("no timeframes")
    return out


def _bars(candles: DataFrame, steps: dict[str, int], base_seconds: int) -> DataFrame:
    """Bars with their numbers of candles (_n) and of distinct candles (_d), and whether all are complete."""
    ts = F.col("timestamp_utc")
    targets = F.array(*[F.struct(F.lit(tf).alias("tf"), F.lit(step).alias("step"), floor_to(ts, step).alias("bucket")) for tf, step in steps.items()])
    rows = candles.drop("timeframe").withColumn("_t", F.explode(targets)).select("*", F.col("_t.tf").alias("timeframe"), F.col("_t.step").alias("_step"), F.col("_t.bucket").alias("_bucket")).drop("_t")
    minute = ((F.unix_seconds("timestamp_utc") - F.unix_seconds("_bucket")) / base_seconds).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), minute)
    return rows.groupBy(*_SERIES, "timeframe", "_step", "_bucket").agg(*bar_aggregates(), F.count(F.lit(1)).alias("_n"), F.bit_count(F.bit_or(bit)).cast("long").alias("_d"), F.bool_and("is_complete").alias("_all"))


def _finished(bars: DataFrame, candles: DataFrame, base_seconds: int, distinct: bool) -> DataFrame:
    reach = candles.groupBy(*_SERIES).agg(F.max("timestamp_utc").alias("_reach"))
    count = F.col("_d") if distinct else F.col("_n")
    done = (count == (F.col("_step") / base_seconds).cast("int")) & F.col("_all") & (F.unix_seconds("_reach") >= F.unix_seconds("_bucket") + F.col("_step") - base_seconds)
    return bars.join(reach, list(_SERIES)).withColumn("is_complete", done).withColumn("timestamp_utc", F.col("_bucket")).select(*CANDLE_COLUMNS)


def candles_from_ticks(ticks: DataFrame, timeframe: str, *, venue: str, market_type: str = "spot", keys: tuple[str, ...] = ("instrument",), order: str = "ts") -> DataFrame:
    """Candles from ticks (instrument, ts, price, quantity, is_taker_buy); a bar is one of the buckets that have ticks.

    Ticks are ordered by the column `order`: where several have one time, it should be their sequence number.
    """
    quote = F.col("price") * F.col("quantity")
    taker = F.col("is_taker_buy")
    rows = ticks.groupBy(*keys, floor_to(F.col("ts"), seconds(timeframe)).alias("timestamp_utc")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").cast("double").alias("volume"),
        F.sum(quote).alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(taker, F.col("quantity")).otherwise(0)).cast("double").alias("taker_buy_base_volume"),
        F.sum(F.when(taker, quote).otherwise(0.0)).alias("taker_buy_quote_volume"),
    )
    return rows.withColumns({"venue": F.lit(venue), "market_type": F.lit(market_type), "timeframe": F.lit(timeframe), "is_complete": F.lit(True)}).select(*CANDLE_COLUMNS)
