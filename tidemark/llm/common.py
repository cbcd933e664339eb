"""Helpers that the corpus operators share: table access, staged tables, label splits, union-find and components."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest Arrow slice, in rows, that an operator works on at once.
SLICE_ROWS = 2048
#: Rows and bytes of an Arrow batch between the JVM and Python.
BATCH_ROWS, BATCH_BYTES = 2048, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where the session names none, one in the warehouse, which they share too."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-shared")
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, and lost executors cost no recomputation.

    The table stays as long as results may read it: until the application ends, or `release` is called.
    """
    path = new_path(df.sparkSession, name)
    _STAGED.append((df.sparkSession, path))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with batches bounded in rows and bytes, so that long texts don't meet in one batch of either process."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if int(conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) > BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def filtered(docs: DataFrame, keep: Callable[[], Callable[[list[str]], list[bool]]], text_col: str = "text") -> DataFrame:
    """The rows of `docs`, as they are, whose texts (null: empty) pass.  `keep` makes the test, once a task; rows go through Python once."""

    def run(batches):
        passes = keep()
        for batch in byte_slices(batches, text_col, 1 << 20):
            yield batch.filter(pa.array(passes([t or "" for t in column(batch, text_col).to_pylist()]), pa.bool_()))

    return arrow(docs, run, docs.schema)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table that is no longer read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_STAGED: list[tuple[SparkSession, str]] = []


@atexit.register
def release() -> None:
    """Delete all staged tables; results that still read them can't be computed any more."""
    while _STAGED:
        with contextlib.suppress(Exception):  # the session may be gone
            drop(*_STAGED.pop())


def remainder(key: Column, mod: int) -> Column:
    """crc32 of the key as text, modulo `mod`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


def slices(batches, rows: int = SLICE_ROWS):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(batches, name: str, size: int = 4 << 20):
    """Slices of about `size` bytes in the string column `name`, of one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column(batch, name)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def whole_groups(batches, keys: tuple[str, ...]):
    """From batches sorted by integer `keys`: tables of whole groups, and the bounds of the groups in each."""

    def bounds(t: pa.Table) -> np.ndarray:
        cols = [t.column(k).to_numpy() for k in keys]
        return np.nonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols]))[0] + 1

    rest = None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if len(cut := bounds(rest)):
            yield rest.slice(0, int(cut[-1])).combine_chunks(), np.concatenate([[0], cut])
            rest = rest.slice(int(cut[-1])).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])


def tile_pairs(rows: DataFrame, size: Column, salt: Column, hot: int) -> DataFrame:
    """Deal the rows of a group of `size` rows to pairs of salted tiles (ti, tj) of about `hot` rows.

    `half` is 2 where a tile meets itself, else 0 or 1 for the two sides; every pair of rows meets in just one tile pair.
    """
    tiles = F.ceil(size / F.lit(hot)).cast("int")
    mine = F.pmod(salt, F.col("_tiles")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("_tiles") - 1),
        lambda o: F.struct(F.least(o, F.col("_mine")).alias("ti"), F.greatest(o, F.col("_mine")).alias("tj"), F.when(o == F.col("_mine"), 2).when(F.col("_mine") < o, 0).otherwise(1).cast("int").alias("half")),
    )
    return rows.withColumn("_tiles", tiles).withColumn("_mine", mine).withColumn("_p", F.explode(pair)).select("*", "_p.ti", "_p.tj", "_p.half").drop("_tiles", "_mine", "_p")


#: A key with more than one in HEAVY of all rows is heavy, so there are fewer than HEAVY of them.
HEAVY = 1000


def spread_join(rows: DataFrame, facts: DataFrame, key: str, *, weight: str, total: int, spread: Column) -> DataFrame:
    """`rows` left-joined on `key` to `facts`, which has one row per key and in `weight` the rows of `rows` with that key.

    Facts of heavy keys, fewer than HEAVY, are broadcast, and rows that need no further facts (theirs are known, or their
    key is null) are dealt by `spread`, so no key's rows meet in one task.  `total` is the number of rows.
    """
    names = [c for c in facts.columns if c not in (key, weight)]
    heavy = facts.where(F.col(weight) * HEAVY > total).select(F.col(key).alias("_hk"), F.struct(*names).alias("_hv"))
    light = facts.where(F.col(weight) * HEAVY <= total).select(F.xxhash64(key).alias("_deal"), F.col(key).alias("_lk"), F.struct(*names).alias("_lv"))
    known = rows.join(F.broadcast(heavy), F.col(key) == F.col("_hk"), "left").withColumn("_deal", F.when(F.col("_hv").isNotNull() | F.col(key).isNull(), F.xxhash64(spread)).otherwise(F.xxhash64(key)))
    left, right = known.alias("l"), light.alias("r")
    met = left.join(right, (F.col("l._deal") == F.col("r._deal")) & (F.col(key) == F.col("_lk")) & F.col("_hv").isNull(), "left")
    return met.select(*[F.col(f"l.{c}") for c in rows.columns], *[F.coalesce(F.col(f"_hv.{c}"), F.col(f"_lv.{c}")).alias(c) for c in names])


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links left-right (min-label hooking with pointer jumping)."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            break
        left, right, low, high = left[open_], right[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links (src, dst: long) as (node, component), component being the smallest node.

    Alternating large-star and small-star steps; each round's links are a checkpointed table, so nothing about links or
    components reaches the driver but a count and a checksum.  Nodes without links do not appear.  The links of a hub are
    spread over tasks (see `spread_join`).
    Self-links, null ends and repeated links are ignored; an empty table gives an empty result.
    """

    def lowest(e: DataFrame, total: int) -> DataFrame:
        return spread_join(e, e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "u", weight="n", total=total, spread=F.col("v"))

    def measure(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct().checkpoint()
    seen = measure(now)
    for _ in range(max_rounds if seen[0] else 0):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = lowest(both, 2 * seen[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = lowest(large, seen[0])
        now = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
        if (then := measure(now)) == seen:
            break
        seen = then
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
