"""Exact top-k inner-product search by best-first search of an M-tree.

Components become integers floor(scale * x), so scores are exact.  With a padding component that gives all vectors one norm
R, and none for queries, |q - x|^2 = |q|^2 + R^2 - 2 q.x: nearest in this metric is highest in score.

The top of the tree are routing objects from a bounded sample; each vector goes to the nearest, and what a routing object
has is cut in blocks.  Each block is a subtree of pages with covering radii and parent distances, built once and staged.  A
query first searches the block of its nearest routing object, which gives it a k-th distance; with that it goes on to those
blocks only whose lower bound d(q, o) - r does not exceed it.  In a block every query takes its own best-first way: a page
is left out once its bound exceeds the query's k-th distance, a page's distance is not computed where
|d(q, parent) - d(o, parent)| - r already does, nor a vector's where its stored parent distance does.  Bounds carry a slack
for rounding, and ties are kept, so results equal a full scan.  Vectors too long for exact doubles stay out of the tree and
are compared one by one in whole numbers.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, column, slices, staged

#: Vectors in a leaf page and entries in an inner page; relative slack of bounds; squared length from which doubles aren't exact.
PAGE, FANOUT, SLACK, LONG = 512, 8, 1e-9, 2.0**52
#: Routing objects at the top at most, and the rows that they come from: those of the smallest hash.
ROUTES, SAMPLE = 512, 8192
#: Bytes of vectors in a block; queries that search a block at once.
BLOCK_BYTES, QUERIES = 2 << 20, 1024
#: The most bytes that centres of blocks may have to be sent to all tasks.
BROADCAST = 32 << 20


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T), 0))


def padded(x: np.ndarray, norm2: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0))[:, None]])


def spread_out(pool: np.ndarray, ways: int) -> np.ndarray:
    """Indexes of up to `ways` rows of the pool, each the farthest from those before."""
    picked, gap = [0], distances(pool, pool[:1])[:, 0]
    while len(picked) < ways and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(pool, pool[picked[-1:]])[:, 0])
    return np.array(picked)


class MTree:
    """Vectors (integers held as doubles) of one block; `norm2` is the squared norm that padding gives to all, `centre` the parent's object."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, norm2: float | None = None, page: int = PAGE, fanout: int = FANOUT):
        self.norm2 = float((x * x).sum(axis=1).max(initial=0)) if norm2 is None else norm2
        self.page, self.fanout = page, fanout
        # Per node: routing object, covering radius, distance to the parent's object, children, and its rows from `lo` to `hi`.
        self.centre, self.radius, self.up, self.inner, self.lo, self.hi = [], [], [], [], [], []
        self._full, self._order, self._near = padded(x, self.norm2), [], []
        if len(ids):
            self._node(np.arange(len(ids)), 0, None)
        order = np.array(self._order, int)
        self.ids, self.x, self.near = ids[order], x[order], np.array(self._near)
        self.centre, self.radius, self.up = np.array(self.centre).reshape(len(self.radius), -1), np.array(self.radius), np.array(self.up)
        del self._full, self._order, self._near

    def _node(self, rows: np.ndarray, centre: int, parent: np.ndarray | None) -> int:
        at, own = len(self.radius), self._full[[centre]]
        near = distances(self._full[rows], own)[:, 0]
        self.centre.append(own[0])
        self.radius.append(float(near.max()))
        self.up.append(0.0 if parent is None else float(distances(own, parent)[0, 0]))
        self.inner.append(np.zeros(0, int))
        self.lo.append(len(self._order))
        self.hi.append(0)
        if len(rows) <= self.page:
            self._order += rows.tolist()
            self._near += near.tolist()
        else:
            # Routing objects: farthest first from a spread of candidates; then each row goes to the nearest.
            ways = min(self.fanout, -(-len(rows) // self.page) * 2)
            pool = rows[np.linspace(0, len(rows) - 1, min(len(rows), 32 * ways)).astype(int)]
            picked = pool[spread_out(self._full[pool], ways)]
            to = distances(self._full[rows], self._full[picked]).argmin(axis=1)
            groups = [(int(p), rows[to == i]) for i, p in enumerate(picked) if (to == i).any()]
            if max(len(g) for _, g in groups) > 0.9 * len(rows):  # copies, or one dense group: cut by size
                groups = [(int(g[0]), g) for g in np.array_split(rows, ways) if len(g)]
            self.inner[at] = np.array([self._node(g, c, own) for c, g in groups])
        self.hi[at] = len(self._order)
        return at

    def search(self, q_ids: np.ndarray, q: np.ndarray, k: int, kth: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Highest k scores of each query and their ids (-inf and the largest id fill up), ties to the smaller id, its own id left out, and the distances that it took.

        Only what may lie within a query's distance `kth` has to be found.  Every query takes its own best page in turn;
        queries that take the same page at a time share a matrix product.
        """
        best, names = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        took = np.zeros(len(q), np.int64)
        if not len(self.radius) or not len(q):
            return best, names, took
        q2 = (q * q).sum(axis=1)
        full, slack = np.hstack([q, np.zeros((len(q), 1))]), SLACK * (np.sqrt(q2) + np.sqrt(self.norm2) + 1)
        kth = np.full(len(q), np.inf) if kth is None else kth + 2 * slack

        def scan(leaf: int, of: np.ndarray, d: np.ndarray):
            lo, hi = self.lo[leaf], self.hi[leaf]
            may = (np.abs(d[:, None] - self.near[None, lo:hi]) <= kth[of][:, None]).any(axis=0)
            x, own = (self.x[lo:hi], self.ids[lo:hi]) if may.all() else (self.x[lo:hi][may], self.ids[lo:hi][may])
            took[of] += len(own)
            if not len(own):
                return
            score = q[of] @ x.T
            hit = (score >= best[of, -1][:, None]) & (own[None, :] != q_ids[of][:, None])
            for i in np.nonzero(hit.any(axis=1))[0]:
                c, j = np.nonzero(hit[i])[0], of[i]
                if len(c) > k:  # only what reaches the k-th best of these
                    c = c[score[i, c] >= np.partition(score[i, c], len(c) - k)[len(c) - k]]
                s, n = np.concatenate([best[j], score[i, c]]), np.concatenate([names[j], own[c]])
                first = np.lexsort((n, -s))[:k]
                best[j], names[j] = s[first], n[first]
                if best[j, -1] > -np.inf:
                    kth[j] = min(kth[j], np.sqrt(max(q2[j] + self.norm2 - 2 * best[j, -1], 0)) + 2 * slack[j])

        # Every query's open pages: lower bound, and distance to the routing object.
        bound, apart = np.full((len(q), len(self.radius)), np.inf), np.zeros((len(q), len(self.radius)))
        apart[:, 0] = distances(full, self.centre[:1])[:, 0]
        bound[:, 0] = np.maximum(apart[:, 0] - self.radius[0], 0)
        took += 1
        live = np.arange(len(q))
        while len(live):
            take = bound[live].argmin(axis=1)
            low = bound[live, take]
            open_ = (low <= kth[live]) & np.isfinite(low)
            live, take = live[open_], take[open_]
            order = np.argsort(take, kind="stable")
            for group in np.split(order, np.nonzero(np.diff(take[order]))[0] + 1) if len(order) else []:
                of, node = live[group], int(take[group[0]])
                bound[of, node] = np.inf
                below = self.inner[node]
                if not len(below):
                    scan(node, of, apart[of, node])
                    continue
                maybe = np.abs(apart[of, node][:, None] - self.up[below][None, :]) - self.radius[below][None, :] <= kth[of][:, None]
                some = maybe.any(axis=0)
                below, maybe = below[some], maybe[:, some]
                if len(below):
                    d = distances(full[of], self.centre[below])
                    took[of] += len(below)
                    apart[np.ix_(of, below)] = d
                    bound[np.ix_(of, below)] = np.where(maybe, np.maximum(d - self.radius[below][None, :], 0), np.inf)
        return best, names, took


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles: 64-bit where all fit, else Python's integers."""
    if np.abs(q).max() * np.abs(x).max() * x.shape[1] < 2.0**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    if not (np.isfinite(q).all() and np.isfinite(x).all()):
        raise ValueError("components are too large for exact scores")
    whole = [np.array([[int(v) for v in row] for row in m.tolist()], object) for m in (q, x)]
    return whole[0] @ whole[1].T


def highest(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """(-score, id) of each query's k best of `x`, best first, its own id left out."""
    out, step = [], max(1, (1 << 20) // max(1, len(x)))
    for s in range(0, len(q) if len(x) else 0, step):
        for own, row in zip(q_ids[s : s + step], products(q[s : s + step], x)):
            there = np.nonzero(ids != own)[0]
            score = row[there]
            if len(there) > k:
                c = score >= np.sort(score)[len(there) - k]
                there, score = there[c], score[c]
            out.append(sorted((-int(v), int(i)) for v, i in zip(score, ids[there]))[:k])
    return out or [[] for _ in q_ids]


def exact(candidates: DataFrame, asked: DataFrame, k: int, block: int, query_block: int) -> DataFrame:
    """query_id, vec_id, score: every candidate of a query's length scored in whole numbers, the best k per block."""
    n, m = candidates.count(), asked.count()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-m // query_block))
    deal = lambda df, name, ways: df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(ways)).cast("int"))
    spread = lambda df, name, ways: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    left = spread(deal(candidates, "b", blocks), "qb", query_blocks).groupBy("dim", "b", "qb")
    right = spread(deal(asked, "qb", query_blocks), "b", blocks).groupBy("dim", "b", "qb")

    def search(c: pa.Table, q: pa.Table) -> pa.Table:
        (ids, x), (q_ids, y) = _matrix(c), _matrix(q)
        found = [(int(i), n, -v) for i, row in zip(q_ids, highest(q_ids, y, ids, x, k)) for v, n in row] if len(ids) and len(q_ids) else []
        if any(not -(2**63) <= v < 2**63 for _, _, v in found):
            raise ValueError("components are too large for exact scores")
        return pa.table({name: pa.array([f[c] for f in found], pa.int64()) for c, name in enumerate(("query_id", "vec_id", "score"))})

    return left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score long")


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = t.column("id").to_numpy()
    flat = t.column("v").combine_chunks().flatten().to_numpy() if t.num_rows else np.zeros(0)
    return ids, flat.reshape(t.num_rows, -1) if t.num_rows else np.zeros((0, 1))


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 20, scale: float = 64.0, block_bytes: int = BLOCK_BYTES, query_block: int = QUERIES, routes: int = ROUTES, id_col: str = "vec_id", vector_col: str = "embedding", computed: bool = False) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products among all rows but its own.

    Ties go to the smaller vec_id; a query of fewer than k candidates gets them all.  Vectors that are null, empty or hold
    null or non-finite components take no part, nor do rows of a null id; a zero vector scores 0.  Only vectors of a
    query's own length are its candidates.  Rows that repeat an id are candidates each, and a repeated query row counts
    once.  Scores are exact whatever the components; one among a query's best that no 64-bit integer holds raises an error.
    With `computed` the result is query_id, distances: how many distances and scores each query's search of the tree took.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        whole = lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale)  # noqa: E731  (beyond, doubles are whole)
        bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        good = v.where(F.coalesce(F.col("id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad), F.lit(False))).select("id", F.size("v").alias("dim"), F.transform("v", whole).alias("v"))
        return good.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))

    rows, asked = staged(usable(vectors), "search-rows"), staged(usable(queries).dropDuplicates(["id"]), "search-queries")
    near, near_asked = rows.where(F.col("norm2") < LONG), asked.where(F.col("norm2") < LONG)
    # One row per length of vectors, the most frequent 64; vectors of rarer lengths have one routing object a length.
    sizes = {r["dim"]: (r["n"], r["top"]) for r in near.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top")).orderBy(F.desc("n"), "dim").limit(64).collect()}
    tops: dict[int, np.ndarray] = {}
    for d, (n, top) in sizes.items():
        sample = near.where(F.col("dim") == d).orderBy(F.xxhash64("id"), "id").limit(min(SAMPLE, max(64, (64 << 20) // (8 * d)))).select("v").collect()
        x = padded(np.array([r["v"] for r in sample], float), top)
        tops[d] = x[spread_out(x, min(routes, max(1, -(-n * d * 8 // block_bytes))))]

    def routed(df: DataFrame, pads: bool) -> DataFrame:
        """With the nearest routing object; queries have no padding."""

        def route(batches):
            for batch in slices(batches):
                dims, flat = column(batch, "dim").to_numpy(), column(batch, "v").flatten().to_numpy()
                ends, norm = np.cumsum(dims), column(batch, "norm2").to_numpy()
                out = np.zeros(len(dims), np.int32)
                for d in np.unique(dims):
                    at = np.nonzero(dims == d)[0]
                    if (refs := tops.get(int(d))) is not None:
                        x = flat[(ends[at] - d)[:, None] + np.arange(d)]
                        pad = np.sqrt(np.maximum(sizes[int(d)][1] - norm[at], 0)) * pads
                        out[at] = distances(np.hstack([x, pad[:, None]]), refs).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([column(batch, c) for c in ("id", "dim", "v", "norm2")] + [pa.array(out)], names=["id", "dim", "v", "norm2", "route"])

        return arrow(df, route, "id long, dim int, v array<double>, norm2 double, route int")

    placed = staged(routed(near, True), "search-routed")
    per = F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("dim") * 8 / block_bytes)).cast("int")
    cuts = placed.groupBy("dim", "route").agg(F.count(F.lit(1)).alias("n")).select("dim", "route", per.alias("cuts"))
    dealt = placed.join(F.broadcast(cuts), ["dim", "route"]).withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))  # as many rows as routing objects
    norms = {d: top for d, (_, top) in sizes.items()}

    def build(t: pa.Table) -> pa.Table:
        ids, x = _matrix(t)
        order = np.argsort(ids, kind="stable")
        d = x.shape[1]
        tree = MTree(ids[order], x[order], norms.get(d))
        first = lambda c: pa.array([t.column(c)[0].as_py()], pa.int32())
        return pa.table({"dim": first("dim"), "route": first("route"), "cut": first("cut"), "radius": pa.array([float(tree.radius[0])]), "centre": pa.array([tree.centre[0].tolist()], pa.list_(pa.float64())), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = staged(dealt.select("id", "dim", "v", "route", "cut").groupBy("dim", "route", "cut").applyInArrow(build, "dim int, route int, cut int, radius double, centre array<double>, tree binary"), "search-trees")

    def search(c: pa.Table, q: pa.Table) -> pa.Table:
        if not c.num_rows or not q.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score", "took")})
        tree, (q_ids, y) = pickle.loads(c.column("tree")[0].as_py()), _matrix(q)
        kth = np.array([np.inf if x is None else x for x in q.column("kth").to_pylist()])
        best, names, took = tree.search(q_ids, y, k, kth)
        there = best > -np.inf
        none = pa.nulls(len(q_ids), pa.int64())
        columns = (np.repeat(q_ids, there.sum(axis=1)), q_ids), (names[there], none), (best[there].astype(np.int64), none), (pa.nulls(int(there.sum()), pa.int64()), took)
        return pa.table({n: pa.chunked_array([pa.array(x, pa.int64()) for x in parts]) for n, parts in zip(("query_id", "vec_id", "score", "took"), columns)})

    def visit(pairs: DataFrame, name: str) -> DataFrame:
        """What the pairs (id, dim, v, kth, route, cut) of query and block give; a block goes to as many tasks as it has sets of queries."""
        counted = pairs.groupBy("dim", "route", "cut").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("sets"))
        right = pairs.join(counted, ["dim", "route", "cut"]).withColumn("set", F.pmod(F.xxhash64("id"), F.col("sets")).cast("int"))
        left = trees.join(counted, ["dim", "route", "cut"]).withColumn("set", F.explode(F.sequence(F.lit(0), F.col("sets") - 1)))
        by = ("dim", "route", "cut", "set")
        return staged(left.select(*by, "tree").groupBy(*by).cogroup(right.select(*by, "id", "v", "kth").groupBy(*by)).applyInArrow(search, "query_id long, vec_id long, score long, took long"), name)

    homes = staged(routed(near_asked, False), "search-homes")
    blocks = staged(trees.select("dim", "route", "cut", "radius", "centre"), "search-blocks")
    first = visit(homes.withColumn("kth", F.lit(None).cast("double")).join(blocks.select("dim", "route", "cut"), ["dim", "route"]), "search-first")
    ranked = "row_number() over (partition by query_id order by score desc, vec_id)"
    kth = first.where("vec_id is not null").withColumn("r", F.expr(ranked)).where(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth_score"))
    # The bound of each block against each query: one distance per block, of which there are few.
    gap = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with("v", F.slice("centre", F.lit(1), F.size("v")), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x) + F.pow(F.element_at("centre", -1), F.lit(2))))
    top = F.element_at(F.create_map(*[F.lit(x) for d, t in norms.items() for x in (d, t)]), F.col("dim")) if norms else F.lit(0.0)
    limit = F.sqrt(F.greatest(F.lit(0.0), F.col("norm2") + F.coalesce(top, F.lit(0.0)) - 2 * F.col("kth_score"))) * (1 + 1e-9) + 1e-6
    asking = homes.withColumnRenamed("route", "home").join(kth, "id", "left").withColumn("kth", F.when(F.col("kth_score").isNotNull() & (F.col("dim").isin(*norms) if norms else F.lit(False)), limit))
    size = blocks.agg(F.coalesce(F.sum(F.col("dim") * 8 + 64), F.lit(0))).first()[0]
    if size <= BROADCAST:
        met = asking.join(F.broadcast(blocks), "dim")  # its size was just checked
    else:  # a part of the blocks to a task
        parts = -(-size // BROADCAST)
        met = asking.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(blocks.withColumn("part", F.pmod(F.xxhash64("route", "cut"), F.lit(parts)).cast("int")), ["dim", "part"])
    onward = met.where((F.col("route") != F.col("home")) & (F.col("kth").isNull() | (gap - F.col("radius") <= F.col("kth"))))
    second = visit(onward.select("id", "dim", "v", "kth", "route", "cut"), "search-second")
    found = first.unionByName(second)
    if computed:
        return found.groupBy("query_id").agg(F.sum("took").alias("distances"))
    found = found.where("vec_id is not null").select("query_id", "vec_id", "score")
    far, far_asked = rows.where(F.col("norm2") >= LONG), asked.where(F.col("norm2") >= LONG)
    if not far.isEmpty():
        found = found.unionByName(exact(far.drop("norm2"), near_asked.drop("norm2"), k, 4096, 4096))
    if not far_asked.isEmpty():
        found = found.unionByName(exact(rows.drop("norm2"), far_asked.drop("norm2"), k, 4096, 4096))
    return found.withColumn("rank", F.expr(ranked).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
