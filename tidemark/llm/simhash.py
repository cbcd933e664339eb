"""SimHash near-duplicates by tiled exact comparison.

Each text becomes a 64-bit fingerprint of its word shingles.  Distinct fingerprints are compared exactly, tile against
tile, with numpy exclusive-or and bit counts; a tile holds fingerprints of close population counts, and a pair of tiles
whose population counts differ beyond the radius is skipped.

Which tiles meet at all follows from the same bit counts taken on parts of the word.  Two fingerprints within `radius`
bits agree on at least one of radius + 1 parts, because the part-wise bit counts of their difference sum to at most
`radius`: only tiles that hold the same value of some part are paired, so work does not grow with the square of the
corpus.  A part value that more than `hot` fingerprints share is split again by the parts of its remaining bits, and what
stays hot after that is spread over salted tile pairs.  No pair within the radius is lost, and none is capped or sampled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, byte_slices, column, components, forest, spread_join, staged, tile_pairs, whole_groups

BITS = 64


def fingerprint(text: str, *, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text; see `fingerprints`."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))] if len(words) >= shingle else [b" ".join(words)]
    count, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(grams), 65536):
        h = np.fromiter((digest(g, seed) for g in grams[at : at + 65536]), np.uint64)
        count += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, tie, fp): the fingerprint of each whole text as a signed long; `tie` is a hash of the text.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles of `shingle` words are joined by a
    space, repeats count; a text of fewer words is one shingle.  A null, empty or blank text gives fingerprint zero.
    """

    def run(batches):
        for batch in byte_slices(batches, "text"):
            fps = np.array([fingerprint(t or "", shingle=shingle, seed=seed) for t in column(batch, "text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "tie"), pa.array(fps, pa.int64())], names=["doc_id", "tie", "fp"])

    return arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), tie(text_col).alias("tie"), F.col(text_col).alias("text")), run, "doc_id long, tie long, fp long")


def tie(text_col: str = "text") -> Column:
    """What tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _parts(width: int, n: int) -> list[tuple[int, int]]:
    """(shift, width) of n nearly equal parts of the lowest `width` bits."""
    cuts = [round(i * width / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _tile_links(fps: np.ndarray, other: np.ndarray | None, radius: int, tile: int = 512):
    """Index pairs within `radius` bits, inside `fps` or between `fps` and `other`, by tiles sorted by population count."""

    def tiles(x):
        order = np.argsort(np.bitwise_count(x), kind="stable")
        pop = np.bitwise_count(x)[order].astype(int)
        return [(order[i : i + tile], pop[i], pop[min(i + tile, len(x)) - 1]) for i in range(0, len(x), tile)]

    rows, same = tiles(fps), other is None
    cols = rows if same else tiles(other)
    far = fps if same else other
    for i, (r, r_low, r_high) in enumerate(rows):
        for c, c_low, c_high in cols[i:] if same else cols:
            if c_low - r_high > radius or r_low - c_high > radius:
                continue
            a, b = np.nonzero(np.bitwise_count(fps[r][:, None] ^ far[c][None, :]) <= radius)
            yield r[a], c[b]


def _spanning(fps: np.ndarray, half: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the fingerprints of one group: each linked one and the first it reaches."""
    alone = half[0] == 2
    left, right = (np.arange(len(fps)),) * 2 if alone else (np.nonzero(half == 0)[0], np.nonzero(half == 1)[0])
    root, found, pending = np.arange(len(fps)), [], 0

    def fold():
        return forest(len(fps), *(np.concatenate(x) for x in zip((np.arange(len(fps)), root), *found)))

    for a, b in _tile_links(fps[left], None if alone else fps[right], radius):
        found.append((left[a], right[b]))
        pending += len(a)
        if pending > 4_000_000:  # a dense group stays in memory
            root, found, pending = fold(), [], 0
    root = fold()
    linked = np.nonzero(root != np.arange(len(fps)))[0]
    return fps[linked].view(np.int64), fps[root[linked]].view(np.int64)


def links(distinct: DataFrame, *, radius: int = 3, hot: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all fingerprints within `radius` bits.

    Links are a spanning forest per group of tiles, never all pairs.  An empty table gives no links.
    """
    first = _parts(BITS, radius + 1)
    value = lambda shift, width: F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1))
    keyed = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), value(s, w).alias("val")) for i, (s, w) in enumerate(first)])).alias("k")).select("fp", "k.part", "k.val")
    sizes = staged(keyed.groupBy("part", "val").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-sizes")
    cool = keyed.join(sizes.where(F.col("n") <= hot), ["part", "val"]).select("fp", "part", "val", F.lit(0).alias("sub"), F.lit(0).cast("long").alias("rest"), F.lit(0).alias("ti"), F.lit(0).alias("tj"), F.lit(2).cast("int").alias("half"))
    # A hot part value is split by the parts of the remaining bits: they too agree on one of radius + 1 parts.
    outside = F.lit(None)
    for i, (s, w) in enumerate(first):
        low = F.col("fp").bitwiseAND(F.lit((1 << s) - 1))
        high = F.shiftrightunsigned(F.col("fp"), s + w) if s + w < BITS else F.lit(0).cast("long")
        outside = F.when(F.col("part") == i, F.shiftleft(high, s).bitwiseOR(low)).otherwise(outside)
    second = _parts(BITS - BITS // (radius + 1), radius + 1)
    warm = keyed.join(sizes.where(F.col("n") > hot).drop("n"), ["part", "val"]).withColumn("out", outside)
    warm = warm.select("fp", "part", "val", F.explode(F.array(*[F.struct(F.lit(i + 1).alias("sub"), F.shiftrightunsigned(F.col("out"), s).bitwiseAND(F.lit((1 << w) - 1)).alias("rest")) for i, (s, w) in enumerate(second)])).alias("k")).select("fp", "part", "val", "k.sub", "k.rest")
    again = staged(warm.groupBy("part", "val", "sub", "rest").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-hot-sizes")
    # What is still hot is dealt to salted pairs of tiles.
    warm = tile_pairs(warm.join(again, ["part", "val", "sub", "rest"]), F.col("n"), F.xxhash64("fp"), hot).drop("n")
    keys = ("part", "val", "sub", "rest", "ti", "tj")

    def compare(batches):
        for t, at in whole_groups(batches, keys):
            fps, half = t.column("fp").to_numpy().astype(np.int64).view(np.uint64), t.column("half").to_numpy()
            two = at[:-1][(np.diff(at) == 2) & (half[at[:-1]] == 2)]  # most groups: one comparison
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
            found = [(fps[two].view(np.int64), fps[two + 1].view(np.int64))]
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                if hi - lo > 2 or hi - lo == 2 and half[lo] != 2:
                    found.append(_spanning(fps[lo:hi], half[lo:hi], radius))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names=["a", "b"])

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = cool.unionByName(warm).repartition(n, *keys).sortWithinPartitions(*keys)
    return arrow(grouped, compare, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, radius: int = 3, hot: int = 4096) -> DataFrame:
    """doc_id, fingerprint (hex), component_id, kept, tie: documents whose fingerprints link at `radius` or fewer bits.

    component_id is the smallest doc_id reachable.  Null and empty texts have fingerprint zero and link like any other.
    Of each component one row is kept: that of the smallest doc_id, of several with that id the one of the smallest hash
    of its text (`tie`); rows that repeat both each come back as kept.  Rows whose doc_id is null link with nothing, have a
    null component and are kept.  Copies collapse to one fingerprint before anything is compared; links are between
    fingerprints, so rows of one doc_id with unlike texts don't tie their components together.
    """
    found = staged(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed), "simhash")
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tie"))
    groups = staged(found.groupBy("fp").agg(F.min(named).alias("first"), F.count("doc_id").alias("named"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    root = staged(components(links(groups.where("named > 0").select("fp"), radius=radius, hot=hot).toDF("src", "dst")), "simhash-components")
    linked = groups.join(root, groups["fp"] == root["node"]).select("fp", "first", "component", "n")
    heads = linked.groupBy("component").agg(F.min("first").alias("head"), F.count(F.lit(1)).alias("n"))
    joined = spread_join(linked.select("fp", "component", F.col("n").alias("rows")), heads, "component", weight="n", total=root.count(), spread=F.col("fp"))
    classes = groups.select("fp", "first", "n").join(joined.select(F.col("fp").alias("_fp"), "head"), F.col("fp") == F.col("_fp"), "left").select("fp", "n", F.coalesce("head", "first").alias("head"))
    every = spread_join(found, classes, "fp", weight="n", total=found.count(), spread=F.coalesce("doc_id", "tie"))
    known = F.col("doc_id").isNotNull()
    return every.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(known, F.col("head.doc_id")).alias("component_id"),
        (~known | (F.struct("doc_id", "tie") == F.col("head"))).alias("kept"),
        "tie",
    )
