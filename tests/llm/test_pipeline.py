import hashlib
import importlib
import os
import subprocess
import sys

import numpy as np
import public_tokenizers as P

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


def test_pipeline_equals_a_plain_version(spark):
    """Stage by stage in plain Python: models are the operators' own, decisions and everything else are worked out anew."""
    import corpus_pipeline as pipeline
    from test_simhash import brute_components, brute_fingerprint
    from tidemark.llm import language, toxicity
    from tidemark.llm.common import remainder, table
    from pyspark.sql import functions as F

    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    rows = {r["doc_id"]: r for r in docs.collect()}
    lexicon = toxicity.fit(docs, labels.where(remainder(F.col("doc_id"), 4) != 2))
    kept = {i: r for i, r in rows.items() if lexicon.score(r["text"] or "") < 0.3}
    assert 0 < len(kept) < len(rows)
    model = language.fit(spark.createDataFrame(list(kept.values()), docs.schema).where(remainder(F.col("doc_id"), 4) != 2))
    told = dict(zip(kept, zip(*model.predict([r["text"] for r in kept.values()]))))
    sure = lambda p: (p * len(model.langs) - 1) / (len(model.langs) - 1)
    kept = {i: r for i, r in kept.items() if told[i][0] != "und" and sure(told[i][1]) >= pipeline.LANGUAGE_FLOOR}
    groups = brute_components([brute_fingerprint(r["text"]) for r in kept.values()], list(kept))
    kept = {i: r for i, r in kept.items() if groups[i] == i}
    order = plain_mixture({i: r["source"] or "" for i, r in kept.items()})
    coder = tiktoken_coder()
    want = {}
    for i, r in kept.items():
        ids = np.array(coder.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        want[i] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest(), order[i])
    got = {r["doc_id"]: tuple(r)[1:] for r in pipeline.run(spark, DATA).collect()}
    assert got == want


def tiktoken_coder():
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=load_tiktoken_bpe(str(P.path("byte_bpe_multi_50k.tiktoken"))), special_tokens={})


def plain_mixture(sources):
    """Place of each document: earliest deadline first by exact fractions of the roots, blocks of 64 in the order of md5."""
    by = {}
    for i, s in sources.items():
        by.setdefault(s, []).append(i)
    for ids in by.values():
        ids.sort(key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    units = {s: round(2**44 * len(ids) ** 0.5 / sum(len(x) ** 0.5 for _, x in sorted(by.items()))) for s, ids in by.items()}
    whole, done, t, order = sum(units.values()), dict.fromkeys(by, 0), 0, []
    while len(order) < len(sources):
        free = [(-(-(done[s] + 1) * whole // u), s) for s, u in units.items() if done[s] * 64 < len(by[s]) and done[s] * whole // u <= t]
        if free:
            s = min(free)[1]
            order += by[s][64 * done[s] : 64 * done[s] + 64]
            done[s] += 1
        t += 1
    return {i: k for k, i in enumerate(order)}


def test_stages_return_the_columns_of_documents(spark, make):
    import corpus_pipeline as pipeline

    rows = [(i, f"some plain words number {i} of the text {i * i}", "en", f"s{i % 3}") for i in range(40)] + [(None, "no id at all here", "en", None), (5, None, None, None)]
    for extra in (False, True):
        docs = make(rows, extra=extra)
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, DATA)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert stage(spark, docs.limit(0), DATA).count() == 0
        assert pipeline.tokens(spark, docs, DATA).count() == 42


def test_near_copies_keep_one_of_each_group_and_all_that_differ(spark, make, words):
    import corpus_pipeline as pipeline

    rows = [(2, words(1, 80)), (5, words(1, 80)), (5, words(2, 90)), (7, words(3, 70)), (7, words(4, 60)), (8, words(5, 60)), (8, words(5, 60)), (None, words(1, 80)), (None, words(1, 80))]
    got = [(r["doc_id"], r["text"]) for r in pipeline.near_copies(spark, make(rows), DATA).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted([rows[0], *rows[2:6], *rows[7:]], key=key)


def test_languages_keep_letters_where_none_is_learned(spark, make):
    import corpus_pipeline as pipeline

    rows = [(i, f"plain words {i}", None) for i in range(5)] + [(9, "123 ...", None), (10, None, None), (11, "", None)]
    assert sorted(r["doc_id"] for r in pipeline.languages(spark, make(rows), DATA).collect()) == list(range(5))


def test_mixture_stage_writes_in_order(spark, make, tmp_path):
    import corpus_pipeline as pipeline
    from tidemark.llm import mixing

    docs = make([(i, "t", "en", "ab"[i % 5 == 0]) for i in range(500)], extra=False)
    pipeline.mixture(spark, docs, DATA).write.parquet(str(tmp_path / "out"))
    got = [r["doc_id"] for f in sorted((tmp_path / "out").glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
    want = [r["doc_id"] for r in mixing.mix(docs).orderBy("slot", "place").collect()]
    assert got == want


def test_queries_are_named_and_optional():
    entry = importlib.import_module("__spark_entry__")
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert {"op1_mixing", "op7_top_k"} <= set(entry.oracle_sql())
    code = "import sys; sys.modules['tidemark.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q if n[2:3].isdigit()) and 'pipeline' not in q; print('fine')"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.stdout.strip() == "fine", done.stderr


def test_operators_have_no_randomness(spark, make):
    from tidemark.llm import simhash

    rows = [(i, "the same words again and again " + "abc"[i % 3] * 3) for i in range(30)]
    a, b = (sorted(map(tuple, simhash.near_duplicates(make(rows).repartition(n)).collect())) for n in (1, 7))
    assert a == b and np.unique([r[2] for r in a]).size >= 1
