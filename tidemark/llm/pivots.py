"""Embedding near-duplicates through a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order of nearness.  Inverted lists hold the vectors by
the pivots they name; as two vectors that share at least `shared` pivots also share a set of just that many, lists are
kept per set of `shared` pivots, which is the count of shared pivots turned into a key.  Within a list every pair is
verified by its exact cosine.  A pair that meets in several lists counts in the one of its smallest shared pivots.
Every row is indexed; pivots come from a bounded sample.  Lists longer than `hot` are dealt to salted pairs of tiles.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow, column, components, forest, slices, spread_join, staged, tile_pairs, whole_groups

#: The pivots come from so many rows, those of the smallest hash, and are less alike than SPREAD.
SAMPLE, SPREAD = 8192, 0.7


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n unit vectors of the sample, in its order, no two of a cosine of SPREAD or more, so that no dense group holds several."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen = unit[:1]
    for v in unit[1:]:
        if len(chosen) >= n:
            break
        if (chosen @ v).max() < SPREAD:
            chosen = np.vstack([chosen, v])
    return chosen


def prefixes(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The `length` nearest pivots of each vector, nearest first."""
    near = vectors @ pivots.T
    top = np.argpartition(-near, length - 1, axis=1)[:, :length] if length < len(pivots) else np.tile(np.arange(len(pivots)), (len(vectors), 1))
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, axis=1), axis=1, kind="stable"), axis=1)


def valid(embedding: str):
    """Vectors that are not null or empty, hold no null and no non-finite component, and are not zero."""
    v = F.col(embedding)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.95, pivots: int | None = None, prefix: int = 7, shared: int = 2, hot: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors linked at a cosine (double precision) of `threshold` or more.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of unlike
    length; each is its own component.  Equal vectors collapse to one before the search and count as links of each other.
    `pivots` is the number of reference points; by default it grows with the root of the table, from 64 to 2048.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    element = vectors.schema[vector_col].dataType
    held = "<f4" if isinstance(getattr(element, "elementType", None), T.FloatType) else "<f8"  # lists hold what the table holds
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    kept = rows.where(valid("v") & F.col("vec_id").isNotNull())
    distinct = staged(kept.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors")
    sizes = {r["d"]: r["n"] for r in distinct.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(64).collect()}
    chosen = {}
    for d, n in sizes.items():
        sample = distinct.where(F.size("v") == d).orderBy(F.xxhash64("v"), "rep").limit(SAMPLE).select("v").collect()
        count = pivots or int(min(2048, max(64, 256 * (n / 50_000) ** 0.5)))
        chosen[d] = choose_pivots(np.array([r["v"] for r in sample], float), count)

    def index(batches):
        for batch in slices(batches):
            flat, sizes_ = column(batch, "v").flatten().to_numpy(), np.diff(column(batch, "v").offsets.to_numpy())
            ends = np.cumsum(sizes_)
            for d in np.unique(sizes_):
                at = np.nonzero(sizes_ == d)[0]
                x = flat[(ends[at] - d)[:, None] + np.arange(d)]
                refs = chosen.get(int(d))
                k = 1 if refs is None else min(prefix, len(refs))
                scaled = x / np.abs(x).max(axis=1, keepdims=True)
                near = np.zeros((len(at), 1), int) if refs is None else np.sort(prefixes(scaled / np.linalg.norm(scaled, axis=1, keepdims=True), refs, k), axis=1)
                sets = list(combinations(range(k), min(shared, k)))
                width = 1 + max(2048, *(len(c) for c in chosen.values()))
                key = np.concatenate([sum(near[:, p].astype(np.int64) * width ** (len(s) - 1 - i) for i, p in enumerate(s)) for s in sets])
                last = np.concatenate([near[:, s[-1]] for s in sets])
                take = np.tile(at, len(sets))
                named = pa.array([r.tobytes() for r in near.astype("<i2")], pa.binary()).take(pa.array(np.tile(np.arange(len(at)), len(sets))))
                own = pa.array([r.tobytes() for r in x.astype(held)], pa.binary()).take(pa.array(np.tile(np.arange(len(at)), len(sets))))
                cols = [pa.array(np.full(len(take), d), pa.int32()), pa.array(key), pa.array(last, pa.int32()), *(column(batch, c).take(pa.array(take)) for c in ("rep", "copies")), named, own]
                out = pa.RecordBatch.from_arrays(cols, names=["dim", "key", "last", "rep", "copies", "near", "vec"])
                yield from slices([out], 4096)

    listed = arrow(distinct, index, "dim int, key long, last int, rep long, copies long, near binary, vec binary")
    lengths = arrow(distinct, lambda b: (x.select(["dim", "key"]) for x in index(b)), "dim int, key long").groupBy("dim", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lengths = staged(lengths, "pivot-lists")
    met = listed.join(lengths, ["dim", "key"])
    cool = met.where(F.col("n") <= hot).select("*", F.lit(0).alias("ti"), F.lit(0).alias("tj"), F.lit(2).alias("half")).drop("n")
    warm = tile_pairs(met.where(F.col("n") > hot), F.col("n"), F.xxhash64("rep"), hot).drop("n")
    keys = ("dim", "key", "ti", "tj")

    def verify(batches):
        """kind 0: (vector, links found); kind 1: (vector, a vector it reaches)."""
        for t, at in whole_groups(batches, keys):
            reps, copies, half = (t.column(c).to_numpy() for c in ("rep", "copies", "half"))
            dims, last = t.column("dim").to_numpy(), t.column("last").to_numpy()
            near, vec = t.column("near").combine_chunks(), t.column("vec").combine_chunks()
            links, edges = np.zeros(len(reps), np.int64), [(reps[:0], reps[:0])]
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                if hi - lo < 2:
                    continue
                x = np.frombuffer(b"".join(vec[lo:hi].to_pylist()), held).astype(float).reshape(-1, dims[lo])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                p = np.frombuffer(b"".join(near[lo:hi].to_pylist()), "<i2").reshape(hi - lo, -1)
                alone = half[lo] == 2
                left, right = (np.arange(hi - lo),) * 2 if alone else (np.nonzero(half[lo:hi] == 0)[0], np.nonzero(half[lo:hi] == 1)[0])
                root = np.arange(hi - lo)
                for s in range(0, len(left), 512):
                    a, b = np.nonzero(x[left[s : s + 512]] @ x[right].T >= threshold)
                    a, b = left[s : s + 512][a], right[b]
                    a, b = (a[a < b], b[a < b]) if alone else (a, b)
                    own = np.zeros(len(a), bool)
                    for c in range(0, len(a), 100_000):
                        q = p[a[c : c + 100_000]]
                        both = (q[:, :, None] == p[b[c : c + 100_000]][:, None, :]).any(axis=2)
                        own[c : c + 100_000] = (both & (q <= last[lo])).sum(axis=1) == min(shared, p.shape[1])
                    a, b = a[own], b[own]
                    links[lo:hi] += np.bincount(a, copies[lo:hi][b], hi - lo).astype(np.int64) + np.bincount(b, copies[lo:hi][a], hi - lo).astype(np.int64)
                    if len(a):
                        root = forest(hi - lo, np.concatenate([np.arange(hi - lo), a]), np.concatenate([root, b]))
                linked = np.nonzero(root != np.arange(hi - lo))[0]
                if len(linked):
                    edges.append((reps[lo:hi][linked], reps[lo:hi][root[linked]]))
            some, which = np.unique(reps, return_inverse=True)
            sums = np.bincount(which, links, len(some)).astype(np.int64)
            a, b = (np.concatenate(x) for x in zip(*edges))
            a, b = np.unique(np.stack([a, b]), axis=1) if len(a) else (a, b)
            kind = np.concatenate([np.zeros(int((sums > 0).sum()), np.int32), np.ones(len(a), np.int32)])
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([some[sums > 0], a])), pa.array(np.concatenate([sums[sums > 0], b]))], names=["kind", "a", "b"])

    found = staged(arrow(cool.unionByName(warm).repartition(parts, *keys).sortWithinPartitions(*keys), verify, "kind int, a long, b long"), "vector-links")
    near = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("near"))
    root = components(found.where("kind = 1").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    classes = distinct.join(near, "rep", "left").join(root.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select("v", "copies", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    every = rows.withColumn("ok", valid("v") & F.col("vec_id").isNotNull()).withColumn("v", F.when(F.col("ok"), F.col("v")))
    return spread_join(every, classes, "v", weight="copies", total=rows.count(), spread=F.col("vec_id")).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
