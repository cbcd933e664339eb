import random

import numpy as np
import pytest

from tidemark.llm import language, quality, toxicity
from tidemark.llm.common import table

DATA = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    y = np.array(y)
    return (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    got = quality.classify(docs, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    y = [r["quality"] for r in got]
    assert len(got) > 300 and auc([r["score"] for r in got], y) > 0.99 and np.mean([r["predicted"] == r["quality"] for r in got]) > 0.97


def test_language_on_held_out_rows(spark):
    docs = table(spark, DATA, "documents")
    got = language.classify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 1000 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def labelled(make, spark, n=400):
    r = random.Random(1)
    vocabulary = ["".join(r.choice("aeioubdfglmnprst") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(vocabulary) for _ in range(r.randint(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            w[3] = "zorkel" + r.choice(["ia", "on", "um", "ar"])
            w[8] = r.choice(["blimfot", "blimfot.", "BLIMFOT"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_words_and_stems(make, spark):
    docs, labels = labelled(make, spark)
    lexicon = toxicity.fit(docs, labels)
    assert any(e.startswith("zorke") and e.endswith("*") for e in lexicon.entries) and "blimfot" in lexicon.entries
    got = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.99
    assert lexicon.score("zorkelxyz b1imf0t and so on") > 0.5 > lexicon.score("quite another text")


def test_toxic_matching():
    lex = toxicity.Lexicon(toxicity.BASE | toxicity.MILD)
    for text in ("you IDIOT", "1d10t!", "id!ot", "ѕtupіd", "$tupid,", "ｌｏｓｅｒ", "i d i o t", "s.t.u.p.i.d", "İdiot", "idiot!!"):
        assert lex.matches(text) or lex.density(text) > 0, text
    for text in ("a trash can", "garbage collection", "the clown fish", "a pond scum", "closers", "idiotic", "trashy", "", "path"):
        assert lex.density(text) == 0, text
    assert lex.matches("trash can trash")[0][0] == 10
    assert lex.score("idiot " * 3 + "word " * 50) > lex.score("idiot " + "word " * 50) > lex.score("idiot " + "word " * 5000)
    assert len(toxicity.fold("İ1ﬁ①x")) == len("İ1ﬁ①x")


def test_copies_teach_once(make, spark):
    docs, labels = labelled(make, spark)
    copied = make([(1000 + i, "unique phrasing of copied abuse qwertyuiop zxcvbnmasd") for i in range(200)])
    lexicon = toxicity.fit(docs.unionByName(copied), labels.unionByName(spark.createDataFrame([(1000 + i, 1, 1) for i in range(200)], labels.schema)))
    assert "qwertyuiop" not in lexicon.entries


EDGES = [(1, None), (2, ""), (3, "   "), (4, "1234 !!"), (5, "x" * 200_000), (6, "word " * 30_000), (7, "퟿\u0000 é"), (None, "text without an id"), (8, "ok then"), (8, "ok then")]


def test_edges(make, spark):
    docs = make(EDGES)
    labels = spark.createDataFrame([(8, 1, 0), (8, 1, 0), (2, 0, 1), (None, 1, 1), (5, None, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for got in (quality.classify(docs, labels).collect(), toxicity.classify(docs, labels).collect()):
        assert len(got) == len(EDGES) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
        assert len({(r["score"], r["predicted"]) for r in got if r["doc_id"] == 8}) == 1
    got = language.classify(docs).collect()
    assert len(got) == len(EDGES) and {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 4)} == {"und"}


@pytest.mark.parametrize("run", [lambda d, l: quality.classify(d, l), lambda d, l: toxicity.classify(d, l), lambda d, l: language.classify(d)])
def test_empty_tables(make, spark, run):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert run(make([]), labels).count() == 0
    assert run(make([(1, "some text", None)]), labels).count() == 1


def fitted(texts, langs, **options):
    found = [(s, lang) for t, lang in zip(texts, langs) for s in language.pick(t, 4)]
    return language.Classifier([f[0] for f in found], [f[1] for f in found], **options)


def test_every_language_is_learned(make):
    r, rows = random.Random(2), []
    for c in range(70):
        vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)]
        rows += [(len(rows) + i, " ".join(r.choice(vocabulary) for _ in range(60)), f"l{c:02}") for i in range(8 if c < 64 else 6)]
    docs = make(rows)
    model = language.fit(docs)
    assert model.langs == [f"l{c:02}" for c in range(70)]
    told = {x["doc_id"]: x["lang_pred"] for x in language.identify(docs, model).collect()}
    assert all(told[i] == lang for i, _, lang in rows)


def test_folded_weights_are_the_kernel():
    texts = ["the cat and the dog went out", "der hund und die katze gehen", "el perro y el gato salen", "the house", "das haus ist", "la casa es"] * 4
    langs = ["en", "de", "es"] * 8
    model = fitted(texts, langs, landmarks=9)
    data, seg, docs = language.segments(["the dog and das haus"])
    ((_, x, letters),) = language.presence(data, seg, len(docs))
    assert x.sum() <= len({data[i : i + n].tobytes() + bytes([n]) for n in (1, 2, 3) for i in range(len(data))}) and letters.sum() == 16
    kernel = (x @ model.landmarks.T) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    assert np.allclose(model.scores(["the dog and das haus"]), kernel @ model.coefficients + model.offset, atol=1e-4)
    assert model.predict(["the cat"])[0] == ["en"] and model.predict([None, "12 !"])[0] == ["und", "und"]


def test_picked_segments_spread_over_the_text():
    text = "".join(chr(97 + i // 600) * 600 for i in range(0, 600 * 20, 600))
    got = language.pick(text, 4)
    assert len(got) == 4 and got[0][:1] == b"a" and got[-1].strip()[-1:] == b"t" and language.pick("12 34", 4) == []


def test_discriminant_is_the_log_density_difference():
    r = np.random.default_rng(0)
    x = [r.normal(size=(400, 4)) @ np.diag([1, 2, 1, 1]), r.normal(size=(300, 4)) + 1.5]
    m = quality.Discriminant(np.array([400.0, 300.0]), np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), shrinkage=0.0, floor=0.0, sharpness=1.0)

    def density(v, c):
        mean, total = x[c].mean(0), np.cov(np.concatenate(x).T, bias=True)
        n = len(x[c])
        cov = n / (n + 4) * np.cov(x[c].T, bias=True) + 4 / (n + 4) * total
        return -0.5 * (np.log(np.linalg.det(cov)) + (v - mean) @ np.linalg.inv(cov) @ (v - mean)) + np.log((n + 1) / 702)

    v = r.normal(size=4)
    assert abs(m.score(v[None])[0] - 1 / (1 + np.exp(density(v, 0) - density(v, 1)))) < 1e-9


def naive_matches(lexicon, text):
    """Every entry at every place, without an automaton."""
    folded, solid = toxicity.fold(text), lambda i: bool(toxicity._SOLID.match(toxicity.fold(text), i))
    begins = lambda i: not i or not text[i - 1].isalnum() or solid(i)
    ends = lambda i, e: e == len(text) or not text[e].isalnum() or solid(i)
    found, spared = {}, []
    for i in range(len(text)):
        for phrase in lexicon.exceptions:
            if folded.startswith(toxicity.fold(phrase), i) and begins(i) and ends(i, i + len(phrase)):
                spared.append((i, i + len(phrase)))
        for entry, weight in lexicon.entries.items():
            word = entry.rstrip("*")
            if folded.startswith(word, i) and begins(i) and (entry.endswith("*") or ends(i, i + len(word))) and (i not in found or weight > found[i][1]):
                found[i] = (i + len(word), weight)
    return [(s, e, w) for s, (e, w) in sorted(found.items()) if not any(a <= s and e <= b for a, b in spared)]


def test_matches_equal_a_naive_scan():
    lexicon = toxicity.Lexicon(toxicity.BASE | toxicity.MILD | {"idio*": 2.0, "tras*": 1.5, toxicity.fold("дурак"): 2.5, "笨蛋": 2.0, "e": 0.5})
    r = random.Random(4)
    parts = ["idiot", "IDIOTIC", "1d1ot", "trash", " trash can", "trashy", "дурак", "Дураки", "你是笨蛋吧", "笨蛋", "e", "garbage collector", " ", " ", ", ", "x", "9", "é", "sore loser", "\n"]
    for _ in range(400):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert lexicon.matches(text) == naive_matches(lexicon, text), text


def test_labels_overrule_the_general_list():
    assert "shit" not in toxicity.choose([("shit", 10, 5000)], 100, 10_000) and toxicity.choose([("shit", 0, 2)], 100, 10_000)["shit"] == 3.0
    assert not toxicity.MILD.keys() & toxicity.choose([], 100, 10_000).keys()
    lexicon = toxicity.Lexicon(toxicity.choose([("zorp", 60, 0)], 100, 10_000))
    for text in ("The council collects garbage and trash on Mondays.", "The clown performed at the fair.", "the losers of the match shook hands with the winners"):
        assert lexicon.score(text) < 0.3, text


@pytest.mark.parametrize("word", ["ужасник", "κακοποιός", "废物", "zorpic"])
def test_words_of_any_script_are_learned(make, spark, word):
    r, vocabulary = random.Random(1), ["мирный", "λόγος", "平和", "garden", "river", "stone", "cloud", "meadow"]
    plain = lambda i: " ".join(r.choice(vocabulary) for _ in range(30)) + f" {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"
    rows = [(i, plain(i) + (f" {word} " + plain(i) if i % 2 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit(make(rows), labels)
    assert lexicon.score(plain(1) + " " + word) > 0.5 > lexicon.score(plain(2))


def test_kernel_equals_plain_sets_of_grams():
    """The whole score from sets of byte n-grams, landmarks taken as texts, without presence matrices."""
    texts = ["the cat and the dog went out", "der hund und die katze gehen", "el perro y el gato salen", "the house", "das haus ist", "la casa es"]
    model = fitted(texts, ["en", "de", "es"] * 2, landmarks=6)

    def grams(text):
        data = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()) + b"  "
        return {(n, data[i : i + n]) for n in (1, 2, 3) for i in range(len(data) - n + 1)}

    cell = lambda g: int(language.cells(np.frombuffer(g[1], np.uint8), g[0])[0])
    sets = [{cell(g) for g in grams(t)} for t in texts]
    kept = [{int(i) for i in np.nonzero(row)[0]} for row in model.landmarks]
    assert sorted(map(sorted, kept)) == sorted(map(sorted, sets))
    assert all(len({cell(g) for g in grams(t)}) == len(grams(t)) for t in texts)  # no two grams of a text share a cell
    new = {cell(g) for g in grams("the dog and das haus")}
    kernel = np.array([len(new & s) / np.sqrt(len(new) * len(s)) for s in kept])
    assert np.allclose(model.scores(["the dog and das haus"])[0], kernel @ model.coefficients + model.offset, atol=1e-4)
