"""Mixing sources to target weights by Pfair scheduling, with DataFrame and SQL functions only.

A source of weight w gets blocks of documents; its block j may run from slot floor(j / w), its release, to before slot
ceil((j + 1) / w), its deadline.  Earliest deadline first among released blocks fills one slot after another, so each
source is always less than one block away from its share of the slots so far.  Weights are exact: whole units of a sum of
about 2^44.  The schedule has one step per block, in a fold over one row; blocks grow with the table, so that there are no
more than `blocks` of them, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The sum of all weights, about; one more than the largest number of sources; deadlines from which all are alike.
ONE, SOURCES, LATE = 1 << 44, 1 << 17, 1 << 42
#: Blocks of a schedule, but for the last ones of sources, which need not be full.
BLOCKS = 1 << 16

#: Sources whose next jobs are kept together: a step looks at one number per group, and into the groups where something changes.
GROUP = 64

_NEVER = "9223372036854775807L"
_NO_SLOTS = "cast(array() as array<struct<i: int, block: bigint, slot: bigint>>)"


def _let(name: str, value: str, body: str) -> str:
    """A name for a value, by the finish of an empty fold, which unlike `transform` does not copy what it gives."""
    return f"aggregate(cast(array() as array<int>), {value}, (a, x) -> a, {name} -> {body})"


def _best(rel: str, due: str, now: str) -> str:
    return f"array_min(zip_with({due}, {rel}, (d, r) -> if(r <= {now}, d, {_NEVER})))"


def _wake(rel: str, now: str) -> str:
    return f"array_min(transform({rel}, r -> if(r > {now}, r, {_NEVER})))"


def _put(items: str, at: str, value: str) -> str:
    return f"concat(slice({items}, 1, {at}), array({value}), slice({items}, {at} + 2, size({items})))"


def _due(j: str, i: str) -> str:
    return f"least((({j} + 1) * whole + us[{i}] - 1) div us[{i}], {LATE}L) * {SOURCES} + {i}"


def _lets(body: str, *named: tuple[str, str]) -> str:
    for name, value in reversed(named):
        body = _let(name, value, body)
    return body


# The state: t, the last slot; per group the earliest deadline among released jobs (best) and the next release (wake); per
# group and source release (rel), deadline (due) and number (k) of the next job.
_STEP = _lets(
    f"named_struct('t', now, 'best', {_put('b', 'g', _best('r1', 'd1', 'now'))}, 'wake', {_put('w', 'g', _wake('r1', 'now'))}, 'rel', {_put('y.rel', 'g', 'r1')}, 'due', {_put('y.due', 'g', 'd1')}, 'k', {_put('y.k', 'g', _put('y.k[g]', 'at', 'j'))}, 'out', concat(y.out, array(named_struct('i', p, 'block', j - 1, 'slot', now))))",
    ("now", f"if(array_min(y.best) < {_NEVER}, y.t + 1, greatest(y.t + 1, array_min(y.wake)))"),
    ("b", f"transform(y.best, (x, i) -> if(y.wake[i] <= now, {_best('y.rel[i]', 'y.due[i]', 'now')}, x))"),
    ("w", f"transform(y.wake, (x, i) -> if(x <= now, {_wake('y.rel[i]', 'now')}, x))"),
    ("p", f"cast(array_min(b) % {SOURCES} as int)"),
    ("g", f"p div {GROUP}"),
    ("at", f"p % {GROUP}"),
    ("j", "y.k[g][at] + 1"),
    ("r1", _put("y.rel[g]", "at", f"if(j < nb[p], (j * whole) div us[p], {_NEVER})")),
    ("d1", _put("y.due[g]", "at", f"if(j < nb[p], {_due('j', 'p')}, {_NEVER})")),
)
_PARTS = f"transform(sequence(0, (size(us) - 1) div {GROUP}), o -> sequence(o * {GROUP}, least(size(us), (o + 1) * {GROUP}) - 1))"
_REL, _DUE = (f"transform({_PARTS}, ids -> transform(ids, i -> if(nb[i] > 0, {x}, {_NEVER})))" for x in ("0L", _due("0", "i")))
_START = f"'t', -1L, 'best', transform({_DUE}, x -> array_min(x)), 'wake', transform({_PARTS}, x -> {_NEVER}), 'rel', {_REL}, 'due', {_DUE}, 'k', transform({_PARTS}, ids -> transform(ids, i -> 0L))"
_STATE = ", ".join(f"'{c}', %s.{c}" for c in ("t", "best", "wake", "rel", "due", "k"))
#: Steps in runs of 256, so that the slots found so far are seldom copied.
_FOLD = f"""aggregate(sequence(0L, (total - 1) div 256), named_struct({_START}, 'out', {_NO_SLOTS}),
    (z, c) -> {_let('r', f"aggregate(sequence(c * 256, least(total, c * 256 + 256) - 1), named_struct({_STATE % (('z',) * 6)}, 'out', {_NO_SLOTS}), (y, s) -> {_STEP})", f"named_struct({_STATE % (('r',) * 6)}, 'out', concat(z.out, r.out))")},
    z -> z.out)"""


def schedule(sources: DataFrame) -> DataFrame:
    """source, units, whole, block, release, deadline, slot of every block, from (source, weight, blocks).

    The target of a source is units / whole.  Sources of no positive finite weight get no slot.  Of equal deadlines the
    source that sorts first goes first.  When a source runs out, or has no blocks, its slots stay empty and the others go
    on.  More than 131,071 sources raise an error.  Work and memory are bounded by blocks and sources, not by documents.
    """
    fair = sources.where((F.col("weight") > 0) & (F.col("weight") < float("inf")))
    row = fair.agg(F.array_sort(F.collect_list(F.struct("source", F.col("weight").cast("double").alias("weight"), F.col("blocks").cast("long").alias("blocks")))).alias("s"))
    row = row.withColumn("s", F.expr(f"if(size(s) < {SOURCES}, s, raise_error('too many sources'))")).withColumn("sum", F.expr("aggregate(s, 0D, (a, x) -> a + x.weight)"))
    row = row.withColumn("us", F.expr(f"transform(s, x -> greatest(1L, cast(round(x.weight * {ONE}D / sum) as bigint)))")).withColumn("nb", F.expr("transform(s, x -> x.blocks)"))
    row = row.withColumn("whole", F.expr("aggregate(us, 0L, (a, x) -> a + x)")).withColumn("total", F.expr("aggregate(nb, 0L, (a, x) -> a + x)")).where("total > 0")
    slots = row.select("s", "us", "whole", F.explode(F.expr(_FOLD)).alias("x")).select(F.expr("s[x.i].source").alias("source"), F.expr("us[x.i]").alias("units"), "whole", "x.block", "x.slot")
    return slots.select("source", "units", "whole", "block", F.expr("(block * whole) div units").alias("release"), F.expr("((block + 1) * whole + units - 1) div units").alias("deadline"), "slot")


def mix(docs: DataFrame, weights: Mapping[str, float] | DataFrame | None = None, *, block: int = 64, blocks: int = BLOCKS, power: float = 0.5, id_col: str = "doc_id", source_col: str = "source", carry: bool = False, rows_per_bucket: int = 50_000) -> DataFrame:
    """Every document once, with its place in the mixture: doc_id, source, block, place, release, deadline, slot.

    Read in the order of (slot, place), the documents are interleaved to the target weights (default: each source's count
    to the given power).  A block has `block` documents, or more if there would be over `blocks` blocks.  Within a source
    the order is that of md5(doc_id), then doc_id, then a hash of the text.  Rows of null doc_id are ordered by a hash of
    all their columns.  A null source counts as the empty name.  Sources without a positive weight have null release,
    deadline and slot, and come last.  With `carry` all columns of `docs` come back in one struct column `row`.  Rows that
    repeat each have a place of their own.  An empty table gives an empty mixture.

    No source is gathered in one task: documents are numbered per source and hash bucket, and the buckets' offsets added.
    """
    spark = docs.sparkSession
    rows, named = docs.agg(F.count(F.lit(1)), F.count(id_col)).first()
    digits = next(d for d in range(1, 9) if d == 8 or rows <= rows_per_bucket * 16**d)
    block = max(block, -(-rows // blocks))
    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    hashed = F.md5(F.col(id_col).cast("string").cast("binary"))
    if named < rows:  # no one bucket for all rows without an id
        hashed = F.coalesce(hashed, F.md5(F.xxhash64(*docs.columns).cast("string").cast("binary")))
    tie = F.xxhash64("text") if "text" in docs.columns and carry else F.lit(0).cast("long")
    keyed = docs.select(F.col(id_col).alias("doc_id"), name.alias("source"), hashed.alias("_h"), F.substring(hashed, 1, digits).alias("_b"), tie.alias("_t"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    counts = docs.select(name.alias("source"), F.substring(hashed, 1, digits).alias("_b")).groupBy("source", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    sources = counts.groupBy("source").agg(F.sum("_n").alias("_n"))
    if weights is None:
        sources = sources.withColumn("weight", F.sqrt("_n") if power == 0.5 else F.pow(F.col("_n").cast("double"), F.lit(power)))
    else:
        told = spark.createDataFrame([(str(k), float(v)) for k, v in weights.items()], "source string, weight double") if isinstance(weights, Mapping) else weights
        sources = sources.join(told.select(F.coalesce("source", F.lit("")).alias("source"), "weight"), "source", "full")
    timed = schedule(sources.select("source", "weight", F.expr(f"(coalesce(_n, 0L) + {block - 1}) div {block}").alias("blocks")))
    order = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "_t")
    placed = keyed.withColumn("_r", F.row_number().over(order)).join(offsets, ["source", "_b"]).withColumn("_i", F.col("_before") + F.col("_r") - 1)
    placed = placed.withColumn("block", F.expr(f"_i div {block}")).withColumn("place", F.col("_i") % block)
    # Bounded: as many rows as blocks, and one per source.
    out = placed.join(F.broadcast(timed.select("source", "block", "release", "deadline", "slot")), ["source", "block"], "left")
    return out.select("doc_id", "source", "block", "place", "release", "deadline", "slot", *(["row"] if carry else []))
