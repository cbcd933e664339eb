
import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import pivots


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (links[i], find(i), find(i) == i) for i, _ in rows}


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({c: F.lit("clash") for c in ("v", "rep", "key", "dim", "near", "copies")})


def noisy(r, v, cos):
    z = r.normal(size=len(v))
    z -= z @ v * v
    return cos * v + np.sqrt(1 - cos * cos) * z / np.linalg.norm(z)


def sample(n=300, dim=32, seed=1):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        v = r.normal(size=dim)
        v /= np.linalg.norm(v)
        out.append(v)
        if r.random() < 0.3:
            out += [noisy(r, v, r.uniform(0.965, 0.999)) for _ in range(r.integers(1, 4))]
        if r.random() < 0.1:
            out += [v] * 3
    hot = r.normal(size=dim)
    hot /= np.linalg.norm(hot)
    out += [noisy(r, hot, 0.99) * 3 for _ in range(80)]
    order = r.permutation(len(out))
    return [(int(i) * 3 + 1, [float(np.float32(x)) for x in out[k]]) for i, k in enumerate(order)]


def test_equals_brute_force_also_with_tiny_tiles(spark):
    rows = sample()
    want = brute(rows)
    for hot in (2048, 16):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pivots.near_duplicates(table(spark, rows), hot=hot, prefix=8).collect()}
        assert sum(w[0] for w in want.values()) > 5000
        found = sum(g[0] for g in got.values()) / sum(w[0] for w in want.values())
        assert found > 0.995 and all(g[0] <= want[i][0] for i, g in got.items())
        assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.99


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1e30, 1e-30])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pivots.near_duplicates(table(spark, rows)).collect()}
    assert got == brute(rows) and got[1] == (3, 1, True) and got[11][1] == 1 and got[10] == (0, 10, True)
    twice = pivots.near_duplicates(table(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])])).collect()
    assert sorted(((r["vec_id"], r["n_links"]) for r in twice), key=str) == [(1, 1), (1, 1), (None, 0)]
    assert pivots.near_duplicates(table(spark, [])).count() == 0


def test_pivots_are_spread():
    r = np.random.default_rng(0)
    base = r.normal(size=16)
    sample_ = np.concatenate([base + r.normal(size=(500, 16)) * 0.01, r.normal(size=(200, 16))])
    chosen = pivots.choose_pivots(sample_, 50)
    g = chosen @ chosen.T - np.eye(len(chosen))
    assert g.max() < pivots.SPREAD and len(chosen) > 10


def test_prefix_order():
    p = np.eye(4)
    assert pivots.prefixes(np.array([[0.1, 0.9, 0.5, 0.2]]), p, 3).tolist() == [[1, 2, 3]]
