"""Bar indexes and row blocks, so that one long series is many tasks.

A series is cut in blocks of bars; each block also gets the last `halo` bars before it, windows run per block, and halo
rows are dropped afterwards.  The index of a bar in its series is exact and found without gathering the series: bars are
numbered within time buckets, and the counts of earlier buckets, one row per bucket, are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a time bucket, as a power of two: about 24 days.
BUCKET_SECONDS = 1 << 21


def index_bars(df: DataFrame, keys: tuple[str, ...], *, ts: str = "timestamp_utc", index: str = "_rn", bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Add the 0-based index of each bar in its series, in time order."""
    cut = F.floor(F.unix_seconds(F.col(ts)) / bucket_seconds)
    rows = df.withColumn("_bucket", cut)
    counts = df.select(*keys, cut.alias("_bucket")).groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(ts))
    return rows.withColumn("_r", own).join(offsets, [*keys, "_bucket"]).withColumn(index, F.col("_before") + F.col("_r") - 1).drop("_bucket", "_r", "_before")


def with_halo(df: DataFrame, block: int, halo: int, *, index: str = "_rn") -> DataFrame:
    """Add `_block`, and send the last `halo` bars of a block to the next as well."""
    if halo > block:
        raise ValueError(f"a halo of {halo} bars needs blocks as long, not {block}")
    own = F.floor(F.col(index) / block)
    near = F.col(index) % block >= block - halo
    return df.withColumn("_block", F.explode(F.when(near, F.array(own, own + 1)).otherwise(F.array(own))))


def without_halo(df: DataFrame, block: int, *, index: str = "_rn") -> DataFrame:
    return df.where(F.floor(F.col(index) / block) == F.col("_block"))


def previous(df: DataFrame, keys: tuple[str, ...], order: str, bucket, columns: tuple[str, ...], *, prefix: str = "_prev_") -> DataFrame:
    """Add the values that `columns` have in the row before, by `order` within the keys, without gathering a series.

    `bucket` must not fall as `order` rises.  Rows look back within their bucket; the first of a bucket looks at the last
    row of the bucket before, of which there is one row per bucket.
    """
    rows = df.withColumn("_bucket", bucket)
    edges = rows.groupBy(*keys, "_bucket").agg(F.max_by(F.struct(*columns), order).alias("_edge"))
    edges = edges.withColumn("_edge", F.lag("_edge").over(Window.partitionBy(*keys).orderBy("_bucket")))
    own = Window.partitionBy(*keys, "_bucket").orderBy(order)
    rows = rows.join(edges, [*keys, "_bucket"]).withColumn("_edge", F.coalesce(F.lag(F.struct(*columns)).over(own), "_edge"))
    return rows.withColumns({f"{prefix}{c}": F.col(f"_edge.{c}") for c in columns}).drop("_edge", "_bucket")
