import random
import re

import numpy as np
import xxhash

from tidemark.llm import simhash


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    out = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams) > len(grams):
            out |= 1 << bit
    return out


def brute_components(fps, ids, radius=3):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return {i: find(i) for i in ids}


def check(rows, got):
    fps = [brute_fingerprint(t) for _, t in rows]
    want = brute_components(fps, [i for i, _ in rows])
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"], r["kept"]) for r in got} == {i: (f"{f:016x}", want[i], want[i] == i) for (i, _), f in zip(rows, fps)}
    return want


def test_equals_brute_force(make, words):
    r, rows = random.Random(2), []
    for k in range(60):
        text = words(k, r.randint(1, 400))
        rows.append(text)
        for _ in range(r.choice([0, 0, 1, 3])):
            w = text.split()
            w[r.randrange(len(w))] = "Edit"
            rows.append(" ".join(w))
        if k % 9 == 0:
            rows += [text.upper(), text]
    rows += [None, "", "  \n\t ", "One", "one", "a b", "A  B", "x" * 5000, "é ü \x1c z", words(77, 30000)]
    rows = [(1000 - i, t) for i, t in enumerate(rows)]
    want = check(rows, simhash.near_duplicates(make(rows)).collect())
    assert len(set(want.values())) < len(rows)


def test_hot_groups_split_and_lose_nothing(spark):
    """Fingerprints that all share three parts, with tiles of 8: the split and the salted tiles must find every link."""
    r = random.Random(4)
    fps = sorted({r.getrandbits(14) for _ in range(300)} | {(r.getrandbits(6) << 40) | 5 for _ in range(40)} | {r.getrandbits(64) for _ in range(50)})
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = simhash.links(df, radius=3, hot=8).collect()
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    assert all((a ^ b).bit_count() <= 64 for a, b in found)
    at = {s: i for i, s in enumerate(signed)}
    from tidemark.llm.common import forest

    got = forest(len(fps), np.array([at[x["a"]] for x in found]), np.array([at[x["b"]] for x in found]))
    want = brute_components(fps, list(range(len(fps))))
    assert got.tolist() == [want[i] for i in range(len(fps))]


def test_null_ids_repeats_and_empty(make):
    rows = [(None, "same text here now"), (3, "same text here now"), (3, "same text here now"), (2, "another one of these")]
    got = simhash.near_duplicates(make(rows)).collect()
    assert len(got) == 4 and {r["component_id"] for r in got if r["doc_id"] == 3} == {3}
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    assert simhash.near_duplicates(make([])).count() == 0


def test_rows_of_one_id_with_unlike_texts_are_rows_of_their_own(make, words):
    rows = [(2, words(1, 80)), (5, words(1, 80)), (5, words(2, 90)), (7, words(3, 70)), (7, words(4, 60)), (9, words(4, 60))]
    got = simhash.near_duplicates(make(rows)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(2, 2, True), (5, 2, False), (5, 5, True), (7, 7, True), (7, 7, True), (9, 7, False)]
