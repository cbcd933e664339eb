import random

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from tidemark.llm import common
from tidemark.llm.common import components, forest


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
def test_forest(edges):
    want = brute(edges)
    a, b = (np.array([e[k] for e in edges], int) for k in (0, 1))
    assert forest(31, a, b).tolist() == [want.get(i, i) for i in range(31)]


def test_components_of_paths_stars_and_noise(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 180)] + [(500, 501 + i) for i in range(60)] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(90)] + [(7, 7), (9, 8), (8, 9)]
    df = spark.createDataFrame(edges + [(None, 3), (4, None)], "src long, dst long")
    assert {x["node"]: x["component"] for x in components(df).collect()} == brute(edges) | {}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_spread_join_equals_a_left_join(spark):
    """Heavy keys, null keys and keys without facts."""
    from pyspark.sql import functions as F

    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "key long, id long")
    facts = df.where("key is not null and key <> 8").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = common.spread_join(df, facts, "key", weight="n", total=5000, spread=F.col("id"))
    top = {k: max(i for x, i in rows if x == k) for k, _ in rows if k is not None and k != 8}
    assert sorted(tuple(r) for r in got.where("key is not null").collect()) == sorted((k, i, top.get(k)) for k, i in rows if k is not None)
    assert got.where("key is null and top is null").count() == sum(k is None for k, _ in rows)
