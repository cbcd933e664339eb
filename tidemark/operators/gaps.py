"""The gap registry: found gaps with a category, as a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import GAP_CATEGORIES, REGISTERED_GAP_SCHEMA


def register(gaps: DataFrame, *, source: str, category: str = "PROVIDER_GAP", evidence: str = "", detected_at=None) -> DataFrame:
    """Registry rows for the validator's gaps (columns gap_start, gap_end, missing_candles and the series).

    Ids, ends and durations are those of existing registries: times to the minute, from the first missing candle to the
    last, so a single missing candle lasts 0 seconds.
    """
    if category not in GAP_CATEGORIES:
        raise ValueError(f"unknown category {category!r}")
    stamp = lambda c: F.date_format(c, "yyyyMMddHHmm")
    rows = gaps.select(
        F.concat_ws("_", F.lit("gap"), F.lower("instrument"), "timeframe", stamp(F.col("gap_start")), stamp(F.col("gap_end"))).alias("gap_id"),
        "instrument",
        "venue",
        "timeframe",
        F.col("gap_start").alias("expected_start_utc"),
        F.col("gap_end").alias("expected_end_utc"),
        F.col("gap_start").alias("actual_missing_start_utc"),
        F.col("gap_end").alias("actual_missing_end_utc"),
        (F.unix_seconds("gap_end") - F.unix_seconds("gap_start")).cast("int").alias("duration_seconds"),
        F.col("missing_candles").cast("int").alias("missing_candles_count"),
        (F.current_timestamp() if detected_at is None else F.lit(detected_at).cast("timestamp")).alias("detected_at_utc"),
        F.lit(source).alias("acquisition_source"),
        F.lit(category).alias("category"),
        F.lit(evidence).alias("evidence"),
        F.lit(False).alias("is_resolved"),
        F.lit(None).cast("string").alias("resolution_notes"),
    )
    return rows.select(*REGISTERED_GAP_SCHEMA.fieldNames())


def load(spark: SparkSession, path: str) -> DataFrame:
    """The registry at `path`; without one, an empty registry.  A corrupt one raises."""
    from ..sources.files import exists

    return spark.read.schema(REGISTERED_GAP_SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], REGISTERED_GAP_SCHEMA)


def upsert(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """New rows replace those of the same gap_id; of several new ones the one detected last stays."""
    both = registry.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    last = Window.partitionBy("gap_id").orderBy(F.desc("_new"), F.desc("detected_at_utc"))
    return both.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r", "_new")


def save(registry: DataFrame, path: str) -> None:
    """Replace the registry at `path` by one sorted by the start of the gaps."""
    from ..sources.files import replace

    replace(registry.orderBy("actual_missing_start_utc", "gap_id").coalesce(1), path)


def unresolved(registry: DataFrame) -> DataFrame:
    return registry.where(~F.col("is_resolved")).orderBy("actual_missing_start_utc")


def resolve(registry: DataFrame, gap_id: str, notes: str) -> DataFrame:
    hit = F.col("gap_id") == gap_id
    return registry.withColumn("is_resolved", F.col("is_resolved") | hit).withColumn("resolution_notes", F.when(hit, F.lit(notes)).otherwise(F.col("resolution_notes")))


def by_category(registry: DataFrame) -> DataFrame:
    """Gaps and missing candles of every category, also of those without any."""
    spark = registry.sparkSession
    names = spark.createDataFrame([(c,) for c in GAP_CATEGORIES], "category string")
    found = registry.groupBy("category").agg(F.count(F.lit(1)).alias("gaps"), F.sum("missing_candles_count").cast("long").alias("missing_candles"), F.sum((~F.col("is_resolved")).cast("long")).alias("unresolved"))
    return names.join(found, "category", "left").na.fill(0, ["gaps", "missing_candles", "unresolved"])
