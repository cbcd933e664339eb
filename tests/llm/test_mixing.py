import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def rows(spark, counts):
    data = [(i * 7 + k, s) for k, (s, n) in enumerate(counts.items()) for i in range(n)]
    return spark.createDataFrame([(i, d[0], d[1], "t") for i, d in enumerate(data)], "n long, other long, source string, text string").select(F.col("n").alias("doc_id"), "source", "text")


def plan(spark, weights, blocks):
    named = [(k, float(w), blocks[k] if isinstance(blocks, dict) else blocks) for k, w in weights.items()]
    return mixing.schedule(spark.createDataFrame(named, "source string, weight double, blocks long")).orderBy("slot").collect()


def test_schedule_deviates_by_less_than_a_block_from_its_target(spark):
    weights = {"a": 0.5, "b": 1 / 3, "c": 0.157, "d": 0.0096667}
    total = sum(weights.values())
    blocks = {k: round(400 * w / total) + 1 for k, w in weights.items()}
    slots = plan(spark, weights, blocks)
    whole = [r for r in slots if r["slot"] < 400]
    assert [r["slot"] for r in whole] == list(range(400))
    seen = Counter()
    for t, r in enumerate(whole):
        assert r["release"] <= t < r["deadline"] and r["block"] == seen[r["source"]]
        seen[r["source"]] += 1
        for s, w in weights.items():
            assert abs(seen[s] - (t + 1) * w / total) < 1


def test_many_skewed_sources_checked_in_sql(spark):
    """No source is a block or more from its exact target before or after any of its slots, in a schedule without holes."""
    weights = [(f"s{i:03d}", (i + 1.0) ** -0.6) for i in range(300)]
    total, n = sum(w for _, w in weights), 3000
    df = spark.createDataFrame([(s, w, int(n * w / total) + 1) for s, w in weights], "source string, weight double, blocks long")
    mixing.schedule(df).createOrReplaceTempView("planned")
    df.createOrReplaceTempView("targets")
    spark.sql("select *, weight / sum(weight) over () as share from targets").createOrReplaceTempView("shares")
    off, slots, top = spark.sql(f"""select max(greatest(abs(block + 1 - share * (slot + 1)), abs(block - share * slot))), count(distinct slot), max(slot)
        from planned join shares using (source) where slot < {n}""").first()
    assert off < 1 and slots == n and top == n - 1


def simulate(units, blocks):
    units = {s: round(mixing.ONE * u / sum(units.values())) for s, u in units.items()}
    p, done, t, want = sum(units.values()), Counter(), 0, []
    while sum(done.values()) < sum(blocks.values()):
        free = [(-(-(done[s] + 1) * p // u), s) for s, u in units.items() if done[s] < blocks[s] and done[s] * p // u <= t]
        if free:
            want.append((t, min(free)[1]))
            done[want[-1][1]] += 1
        t += 1
    return want


@pytest.mark.parametrize("units,blocks", [
    ({"a": 7, "b": 5, "c": 3, "d": 1, "e": 1}, {"a": 14, "b": 10, "c": 6, "d": 2, "e": 2}),
    ({"a": 7, "b": 5, "c": 3, "d": 1, "e": 1}, {"a": 1, "b": 9, "c": 0, "d": 3, "e": 2}),  # some run out, one has none
    ({c: 1 for c in "tiesallthesame"}, {c: 3 for c in "tiesallthesame"}),
    ({f"{i:03d}": 1 + i % 9 for i in range(150)}, {f"{i:03d}": 1 + i % 4 for i in range(150)}),  # several groups
])
def test_schedule_equals_a_plain_simulation(spark, units, blocks):
    assert [(r["slot"], r["source"]) for r in plan(spark, units, blocks)] == simulate(units, blocks)


def test_no_weights_and_too_many_sources(spark):
    nan = float("nan")
    assert plan(spark, {"a": 0.0, "b": -1.0, "c": nan, "d": float("inf")}, 3) == [] and plan(spark, {"a": 1.0}, 0) == []
    assert [r["slot"] for r in plan(spark, {"a": 2.0}, 3)] == [0, 1, 2]
    many = spark.range(mixing.SOURCES).select(F.col("id").cast("string").alias("source"), F.lit(1.0).alias("weight"), F.lit(1).alias("blocks"))
    with pytest.raises(Exception, match="too many sources"):
        mixing.schedule(many).count()


def test_mixture_is_whole_and_in_order(spark):
    docs = rows(spark, {"a": 900, "b": 130, "c": 40, None: 20, "z": 1})
    got = mixing.mix(docs, block=8, rows_per_bucket=100).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1091))
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["slot"], r["place"])):
        by[r["source"]].append((r["block"], r["place"]))
        assert r["release"] <= r["slot"] < r["deadline"]
    assert {s: len(v) for s, v in by.items()} == {"a": 900, "b": 130, "c": 40, "": 20, "z": 1}
    for v in by.values():
        assert v == [(i // 8, i % 8) for i in range(len(v))]
    assert len({(r["slot"], r["place"]) for r in got}) == len(got)


def test_weights_and_leftovers(spark):
    docs = rows(spark, {"a": 30, "b": 30, "c": 5})
    got = mixing.mix(docs, {"a": 3, "b": 1, "absent": 4}, block=1, carry=True).collect()
    assert len(got) == 65 and {r["source"] for r in got if r["slot"] is None} == {"c"}
    first = [r["source"] for r in sorted((r for r in got if r["slot"] is not None), key=lambda r: r["slot"])][:16]
    assert math.isclose(first.count("a") / max(1, first.count("b")), 3, rel_tol=0.5)
    assert got[0]["row"]["text"] == "t"


def test_empty_and_repeated(spark):
    assert mixing.mix(rows(spark, {"a": 3}).limit(0)).count() == 0
    twice = rows(spark, {"a": 3}).unionByName(rows(spark, {"a": 3})).unionByName(rows(spark, {"a": 1}).withColumn("doc_id", F.lit(None).cast("long")))
    got = mixing.mix(twice, block=2).collect()
    assert len(got) == 7 and len({(r["block"], r["place"]) for r in got}) == 7


def test_main_path_is_native(spark):
    plan = mixing.mix(rows(spark, {"a": 3, "b": 2}))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_clashing_columns_and_odd_rows(make):
    docs = make([(i, None if i % 5 == 0 else "text" * i, "en", None if i % 7 == 0 else f"s{i % 3}") for i in range(60)] + [(None, "x" * 100_000, None, "s1")])
    got = mixing.mix(docs, block=4, carry=True).collect()
    assert len(got) == 61 and all(r["row"]["fp"] == "clash" and r["row"]["doc_id"] == r["doc_id"] for r in got)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)


def test_blocks_grow_so_that_there_are_few(spark):
    got = mixing.mix(rows(spark, {"a": 500, "b": 100}), block=1, blocks=20).collect()
    assert max(r["place"] for r in got) == 29 and len({(r["source"], r["block"]) for r in got}) == 17 + 4


def test_rows_without_ids_are_spread(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.col("id").cast("string").alias("text"))
    got = mixing.mix(docs, block=10, rows_per_bucket=100).collect()
    assert sorted((r["block"], r["place"]) for r in got) == [(i // 10, i % 10) for i in range(3000)]
