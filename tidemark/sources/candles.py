"""Candle and feature tables as Parquet partitioned by series and month."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import merge_overlap
from ..schema import CANDLE_COLUMNS, CANDLE_SCHEMA, KEY, SERIES
from .files import delete, exists


def read_candles(spark: SparkSession, path: str | Iterable[str], *, columns: Iterable[str] | None = None) -> DataFrame:
    """Candles of tables, files or globs with the fixed schema; a missing path raises FileNotFoundError.

    Only the columns that are used reach the scan; filters on time, and on the series, year and month, prune.
    """
    paths = [path] if isinstance(path, str) else list(path)
    for p in paths:
        if not any(c in p for c in "*?[{") and not exists(spark, p):
            raise FileNotFoundError(p)
    schema = T.StructType([*CANDLE_SCHEMA.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    return spark.read.schema(schema).parquet(*paths).select(*(columns or CANDLE_COLUMNS))


def _months(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("timestamp_utc")).withColumn("month", F.month("timestamp_utc"))


#: What partitions a candle table: one series' month.
PARTITIONS = [*SERIES, "year", "month"]


def write_candles(candles: DataFrame, path: str, *, files_per_month: int = 1) -> None:
    """Rows in time order by series and month; months of series that come again are replaced, all others stay.  An empty table raises ValueError."""
    if candles.isEmpty():
        raise ValueError("there are no candles to write")
    _write(_months(candles), path, PARTITIONS, files_per_month)


def merge_candles(candles: DataFrame, path: str, *, tolerance: float = 1e-4, files_per_month: int = 1) -> None:
    """Add candles to the months that the table has: existing candles win, and a conflict raises OverlapConflict before anything changes.

    Only the months that are touched are read and written.
    """
    spark = candles.sparkSession
    if not exists(spark, path):
        return write_candles(candles, path, files_per_month=files_per_month)
    touched = _months(candles).select(*PARTITIONS).distinct()  # one row per series and month
    before = _months(read_candles(spark, path, columns=CANDLE_COLUMNS)).join(F.broadcast(touched), PARTITIONS, "left_semi").select(*CANDLE_COLUMNS)
    aside = f"{path.rstrip('/')}.merge-{uuid.uuid4().hex}"
    try:  # written aside: what is read must not be what is replaced
        merge_overlap(before, candles.select(*CANDLE_COLUMNS), tolerance=tolerance).write.parquet(aside)
        write_candles(spark.read.schema(CANDLE_SCHEMA).parquet(aside), path, files_per_month=files_per_month)
    finally:
        delete(spark, aside)


def _write(df: DataFrame, path: str, parts: list[str], files: int) -> None:
    salt = F.pmod(F.unix_seconds("timestamp_utc"), F.lit(files)) if files > 1 else F.lit(0)
    ordered = df.repartition(*[F.col(c) for c in parts], salt).sortWithinPartitions(*parts, "timestamp_utc")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*parts).parquet(path)


def write_features(features: DataFrame, path: str, *, files_per_month: int = 1) -> None:
    """venue=.../instrument=.../feature_set=.../year=.../month=..., rows in time order; months of series that come again are replaced."""
    if features.isEmpty():
        raise ValueError("there are no features to write")
    _write(_months(features).withColumn("feature_set", F.col("feature_set_version")), path, [*KEY, "feature_set", "year", "month"], files_per_month)


def read_features(spark: SparkSession, path: str, *, feature_set: str | None = None, year: int | None = None, month: int | None = None) -> DataFrame:
    found = spark.read.parquet(path).schema
    texts = T.StructType([T.StructField(c.name, T.StringType()) if c.name in (*KEY, "feature_set") else c for c in found])  # names of digits stay texts
    df = spark.read.schema(texts).parquet(path)
    for name, value in (("feature_set", feature_set), ("year", year), ("month", month)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def partitions(spark: SparkSession, path: str) -> DataFrame:
    """Months of a candle table by series, and their rows; none if the table isn't there."""
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in SERIES) + ", year int, month int, rows long")
    return read_candles(spark, path, columns=PARTITIONS).groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("rows"))


def content_hash(columns: list[str]):
    """Aggregate: a number that tells whether a set of rows is the same, whatever its order and files."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string")


def inspect_candles(candles: DataFrame) -> DataFrame:
    """One row: count, times, extremes, sums."""
    return candles.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp_utc").alias("first_time"),
        F.max("timestamp_utc").alias("last_time"),
        F.min("low").alias("min_low"),
        F.max("high").alias("max_high"),
        F.sum("volume").alias("volume"),
        F.sum("quote_volume").alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
    )


def inspect_timeframes(candles: DataFrame) -> DataFrame:
    """Per timeframe: the same, with complete bars and their percentage."""
    complete = F.sum(F.col("is_complete").cast("long"))
    return candles.groupBy("timeframe").agg(
        F.count(F.lit(1)).alias("rows"),
        complete.alias("complete_rows"),
        F.round(complete * 100.0 / F.count(F.lit(1)), 2).alias("complete_percent"),
        F.min("timestamp_utc").alias("first_time"),
        F.max("timestamp_utc").alias("last_time"),
        F.round(F.min("low"), 4).alias("min_low"),
        F.round(F.max("high"), 4).alias("max_high"),
        F.round(F.sum("volume"), 2).alias("volume"),
        F.round(F.sum("quote_volume"), 2).alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
    )


def partition_summary(df: DataFrame) -> DataFrame:
    """Rows and times per UTC month."""
    return _months(df.select("timestamp_utc")).groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp_utc").alias("first_time"), F.max("timestamp_utc").alias("last_time"))


def reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Months whose rows differ from the told ones (year, month, rows), on either side."""
    both = partition_summary(actual).select("year", "month", F.col("rows").alias("actual")).join(expected.select("year", "month", F.col("rows").alias("expected")), ["year", "month"], "full")
    return both.where(~F.col("actual").eqNullSafe(F.col("expected")))
