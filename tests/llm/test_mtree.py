import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mtree


def brute(rows, queries, k=20):
    good = {}
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v):
            good[i] = np.floor(64 * np.array(v, float)).astype(int)
    out = []
    for q in queries:
        if q in good:
            scored = sorted((-int(good[q] @ x), i) for i, x in good.items() if i != q and len(x) == len(good[q]))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("id", "v", "b", "qb", "score", "dim")})
    return sorted(tuple(r) for r in mtree.top_k(df, df.where("vec_id % 20 = 0"), **options).collect())


def sample(n, dim=16, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dim))
    x = centres[r.integers(0, 12, n)] * 0.3 + r.normal(size=(n, dim)) * 0.1
    x[:30] = x[0]  # ties
    return [(int(i), [float(np.float32(y)) for y in v]) for i, v in zip(r.permutation(3 * n)[:n], x)]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 12_800, "query_block": 7}, {"block_bytes": 6400, "routes": 3}])
def test_equals_full_scan(spark, options):
    rows = sample(900)
    assert run(spark, rows, **options) == brute(rows, [i for i, _ in rows if i % 20 == 0])


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(20, [1.0, 2.0]), (40, None), (60, [nan, 1.0]), (1, [1.0, None]), (2, [0.0, 0.0]), (3, [-1.0, -1.0]), (4, [1.0, 2.0, 3.0]), (80, [1.0, 2.0]), (100, [])]
    assert run(spark, rows) == brute(rows, [20, 40, 60, 80, 100])
    assert run(spark, []) == []
    with pytest.raises(Exception, match="too large"):
        run(spark, [(20, [1e30, 1.0]), (1, [1e30, 1.0])])


def test_long_vectors_are_exact(spark):
    rows = sample(200, dim=4) + [(1001, [1.5e6, 0.0, 0.0, 1.0]), (1020, [-3e6, 2e6, 0.5, 0.0]), (1040, [4e7, 1.0, 0.0, 3e6]), (1003, [2.0**24, -(2.0**20), 1.0, 0.0]), (1060, [0.25, 0.5, 0.0, 0.0])]
    assert run(spark, rows) == brute(rows, [i for i, _ in rows if i % 20 == 0])
    assert run(spark, rows, block_bytes=640, query_block=3) == brute(rows, [i for i, _ in rows if i % 20 == 0])
    x = np.array([[2.0**60, 3.0], [2.0**61, -5.0]])
    assert mtree.products(x, x).tolist() == [[2**120 + 9, 2**121 - 15], [2**121 - 15, 2**122 + 25]]


def test_pages_are_skipped(spark):
    """Clustered vectors, many queries: fewer than a tenth of all pairs are computed, in one tree and over blocks."""
    r = np.random.default_rng(0)
    x = np.repeat(r.normal(size=(40, 8)) * 5, 100, axis=0) + r.normal(size=(4000, 8)) * 0.05
    whole = np.floor(64 * x)
    tree = mtree.MTree(np.arange(4000), whole, page=32)
    asked = np.arange(0, 4000, 40)
    assert tree.search(asked, whole[asked], 5)[2].sum() < 0.1 * 100 * 4000
    rows = [(i, [float(v) for v in y]) for i, y in enumerate(x.astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    told = mtree.top_k(df, df.where("vec_id % 20 = 0"), k=5, block_bytes=64 << 6, computed=True).collect()
    assert len(told) == 200 and sum(t["distances"] for t in told) < 0.5 * 200 * 4000
    assert run(spark, rows, k=5, block_bytes=64 << 6) == brute(rows, range(0, 4000, 20), 5)


def test_radii_and_parent_distances_hold():
    r = np.random.default_rng(1)
    tree = mtree.MTree(np.arange(3000), np.floor(64 * r.normal(size=(3000, 6))))

    def rows(node):
        return list(range(tree.lo[node], tree.hi[node]))

    assert sorted(tree.ids) == list(range(3000)) and rows(0) == list(range(3000)) and len(tree.inner[0])
    full = mtree.padded(tree.x, tree.norm2)
    for node in range(len(tree.radius)):
        d = np.linalg.norm(full[rows(node)] - tree.centre[node], axis=1)
        assert d.max() <= tree.radius[node] + 1e-6
        for c in tree.inner[node]:
            assert abs(np.linalg.norm(tree.centre[c] - tree.centre[node]) - tree.up[c]) < 1e-6
