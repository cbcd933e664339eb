"""Plans of what to fetch: chunks of a range and months of a history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import seconds


def plan_chunks(spark: SparkSession, start: str, end: str, timeframe: str, *, limit: int = 1000) -> DataFrame:
    """chunk, start_ms, end_ms (inclusive) of contiguous windows of `limit` steps over [start, end); UTC."""
    if limit < 1:
        raise ValueError("a chunk needs a step")
    step = seconds(timeframe) * 1000
    bounds = spark.range(1).select(*[(F.unix_seconds(F.to_timestamp(F.lit(x))) * 1000).alias(n) for x, n in ((start, "s"), (end, "e"))])
    if bounds.where("e > s").isEmpty():
        raise ValueError("the end must come after the start")
    chunks = bounds.select("e", F.posexplode(F.expr(f"sequence(s, e - 1, {step * limit}L)")).alias("chunk", "start_ms"))
    return chunks.select(F.col("chunk").cast("long").alias("chunk"), "start_ms", (F.least(F.col("start_ms") + step * limit, F.col("e")) - 1).alias("end_ms"))


def plan_months(spark: SparkSession, first: str, last: str) -> DataFrame:
    """year, month, start, end (exclusive), kind for every month that [first, last] touches (dates).

    A month that is only partly covered comes from daily archives, a full one from the monthly archive; `end` of the last
    is the day after `last`.
    """
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(first).cast("date"), "month"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("m"))
    start = F.greatest(F.col("m"), F.lit(first).cast("date"))
    end = F.least(F.add_months("m", 1), F.date_add(F.lit(last).cast("date"), 1))
    whole = (start == F.col("m")) & (end == F.add_months("m", 1))
    return months.select(F.year("m").cast("long").alias("year"), F.month("m").cast("long").alias("month"), start.alias("start"), end.alias("end"), F.when(whole, "monthly").otherwise("daily").alias("kind"))


def pending(plan: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """What of the plan isn't done yet."""
    return plan.join(done.select(*on).distinct(), on, "left_anti")
