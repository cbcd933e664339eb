"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded character by character (case, look-alike letters, digits and signs that stand for letters), so places in
the folded text are places in the text.  Entries are whole words or word beginnings, with weights; a match counts where a
word begins (and, for whole words, ends) in the text as written, and where no exception phrase covers it.  The sum of
weights is normalised by length, and a logistic curve turns it into a score.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, byte_slices, column, filtered, remainder, slices, staged

#: General insults and their weights before anything is learned, and words that are insults only at times: labels decide
#: about these where there are labels, and they count little where there are none.
BASE = {w: 3.0 for w in "idiot idiots moron morons imbecile dumbass bastard bastards asshole assholes bitch bitches shit shitty fuck fucker fucking whore slut retard retarded scumbag subhuman".split()}
MILD = {w: 1.0 for w in "stupid loser losers scum trash garbage pathetic worthless disgusting clown clowns crap degenerate vermin".split()}
#: Phrases in which an entry says nothing toxic.
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "trash pickup", "garbage collection", "garbage collector", "garbage truck", "garbage can", "clown fish", "clown car", "circus clown", "pathetic fallacy", "idiot proof", "pond scum", "soap scum", "sore loser")
#: Bounds of the fitted sample and of the lexicon: labelled rows a class, entries; rows that a learned entry needs, and share of the toxic rows.
TOXIC_ROWS, CLEAN_ROWS, ENTRIES, SUPPORT, SHARE = 8_000, 16_000, 4_096, 5, 0.015
#: The largest rate of clean rows, as a part of the rate of toxic rows, at which an entry is learned.
RATE = 0.02
STEMS = (4, 5, 6, 7)

_LOOK = {
    "a": "@4àáâãäåāăąαаɑ", "b": "8ßвь", "c": "çćĉċčсϲ¢", "d": "ďđԁ", "e": "3èéêëēĕėęěеεє€", "f": "ƒ", "g": "9ĝğġģɡ", "h": "ĥħһн", "i": "1!ìíîïĩīĭįıіι¡", "j": "ĵј", "k": "ķκк", "l": "ĺļľŀłӏ",
    "m": "мм", "n": "ñńņňŉŋηп", "o": "0òóôõöøōŏőοоσ", "p": "рρ", "q": "ԛ", "r": "ŕŗřг", "s": "5$śŝşšѕ", "t": "7+ţťŧтτ", "u": "ùúûüũūŭůűųυ", "v": "ѵν", "w": "ŵωԝ", "x": "×хχ", "y": "ýÿŷуү", "z": "2źżžᴢ",
}
_FOLD = {ord(c): a for a, cs in _LOOK.items() for c in cs}
_FOLD |= {ord(c.upper()): a for a, cs in _LOOK.items() for c in cs if len(c.upper()) == 1 and not c.upper().isascii()}
_FOLD |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)} | {0x41 + i: chr(97 + i) for i in range(26)}
_LETTERS = re.compile(r"[^\W\d_]+")
#: Characters of scripts that put no space between words: words there are runs of two and of three characters.
_SOLID = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]+")
_SPREAD = re.compile(r"(?<!\w)(?:\w[ .\-_*]){2,}\w(?!\w)")


class _Fold(dict):
    """Characters outside the table fold to the one base letter of their decomposition, if they have one, else stay."""

    def __missing__(self, code: int) -> str:
        base = unicodedata.normalize("NFKD", chr(code))[0].lower() if code > 127 else chr(code)
        self[code] = _FOLD.get(ord(base), base) if len(base) == 1 else chr(code)
        return self[code]


_TABLE = _Fold(_FOLD)


def fold(text: str) -> str:
    """The text in folded characters, of the same length."""
    return text.translate(_TABLE)


def words(text: str) -> list[str]:
    """Words of letters of any script as the lexicon spells them: accents folded; digits and signs are left out, not folded."""
    folded = fold("".join(c if c.isalpha() else " " for c in text))
    found = _LETTERS.findall(_SOLID.sub(" ", folded))
    for run in _SOLID.findall(folded):
        found += [run] if len(run) < 3 else [run[i : i + n] for n in (2, 3) for i in range(len(run) - n + 1)]
    return found


def signature(text: str) -> int:
    """The smallest hash of the text's runs of three words: near copies mostly share it, other texts hardly ever."""
    found = words(text)
    runs = set(zip(found, found[1:], found[2:])) or {tuple(found)}
    return min(xxhash.xxh64_intdigest(" ".join(r)) >> 1 for r in runs)


class Lexicon:
    """Entries `word` or `stem*` with weights, exception phrases, and the logistic curve of the score."""

    def __init__(self, entries: Mapping[str, float], exceptions: Iterable[str] = EXCEPTIONS, *, slope: float = 4.0, intercept: float = -3.0):
        self.entries, self.exceptions, self.slope, self.intercept = dict(entries), tuple(exceptions), slope, intercept
        self.machine = ahocorasick.Automaton()
        shown: dict[str, list] = {}
        for entry, weight in self.entries.items():
            shown.setdefault(entry.rstrip("*"), []).append((not entry.endswith("*"), float(weight)))
        for phrase in self.exceptions:
            shown.setdefault(fold(phrase), []).append((True, None))
        for text, kinds in shown.items():
            self.machine.add_word(text, (len(text), tuple(kinds)))
        if shown:
            self.machine.make_automaton()

    def maker(self):
        """A function that makes this lexicon again where it is called; automata don't travel."""
        cls, entries, exceptions, curve = type(self), self.entries, self.exceptions, {"slope": self.slope, "intercept": self.intercept}
        return lambda: cls(entries, exceptions, **curve)

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of what counts; of matches that begin alike the heaviest counts."""
        if not len(self.machine):
            return []
        folded, found, spared = fold(text), {}, []
        for last, (size, kinds) in self.machine.iter(folded):
            start, end = last + 1 - size, last + 1
            solid = _SOLID.match(folded, start)
            if start and text[start - 1].isalnum() and not solid:
                continue
            whole = solid or end == len(text) or not text[end].isalnum()
            for entire, weight in kinds:
                if entire and not whole:
                    continue
                if weight is None:
                    spared.append((start, end))
                elif start not in found or weight > found[start][1]:
                    found[start] = (end, weight)
        return [(s, e, w) for s, (e, w) in sorted(found.items()) if not any(a <= s and e <= b for a, b in spared)]

    def density(self, text: str) -> float:
        """Sum of weights per hundred words, with half a hundred words more, so that one word is no text of pure abuse."""
        total = sum(w for _, _, w in self.matches(text))
        if spread := _SPREAD.findall(text):  # letters set apart by signs
            total += sum(w for s in spread for _, _, w in self.matches(re.sub(r"[ .\-_*]", "", s)))
        return 100.0 * total / (len(text.split()) + 50)

    def score(self, text: str) -> float:
        return 1.0 / (1.0 + float(np.exp(-(self.slope * np.log1p(self.density(text)) + self.intercept))))


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of a logistic regression of y on x, classes weighted alike, by Newton steps."""
    design = np.stack([x, np.ones(len(x))], axis=1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    b = np.array([4.0, -3.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        grad = design.T @ (weight * (p - y)) + ridge * (b - [4.0, -3.0])
        hess = design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(b[0], 0.5)), float(b[1])


def enough(toxic: int, clean: int, support: int = SUPPORT, share: float = SHARE) -> float:
    """Toxic rows that an entry needs: `support`, and `share` of all, or as many as one of a million entries would hardly have by chance."""
    chance = np.log(1e8) / np.log((toxic + clean) / toxic)
    return max(support, min(share * toxic, chance))


def choose(counts: list[tuple[str, int, int]], toxic: int, clean: int, *, support: int = SUPPORT, share: float = SHARE, entries: int = ENTRIES, base: Mapping[str, float] = BASE) -> dict[str, float]:
    """Entries with weights from (word or stem*, toxic rows, clean rows): log odds, where an entry is rare in clean rows.

    An entry needs `enough` toxic rows.  Of a stem and what it begins, the longest that stands for nearly all rows is kept;
    what a kept stem covers is left out.  A word of `base` that `support` rows have is as good as the labels say.
    """
    need, good = enough(toxic, clean, support, share), {}
    base = {e: w for e, w in base.items() if sum(x for k, t, c in counts if k == e for x in (t, c)) < support}
    for entry, t, c in counts:
        odds = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
        if t >= need and c * toxic <= RATE * t * clean and odds >= 2.0:
            good[entry] = (t, float(min(odds, 6.0)))
    longer: dict[str, int] = {}
    for entry, (t, _) in good.items():
        word = entry.rstrip("*")
        for n in STEMS:
            if n < len(word) or n == len(word) and not entry.endswith("*"):
                longer[word[:n] + "*"] = max(t, longer.get(word[:n] + "*", 0))
    stems = {e for e, (t, _) in good.items() if e.endswith("*") and longer.get(e, 0) < 0.9 * t}
    best = {}
    for entry, (_, odds) in good.items():
        word = entry.rstrip("*")
        covered = any(word[:n] + "*" in stems for n in STEMS if n < len(word) or n == len(word) and not entry.endswith("*"))
        if not covered and (entry in stems or not entry.endswith("*")):
            best[entry] = odds
    learned = dict(sorted(best.items(), key=lambda kv: (-good[kv[0]][0] * kv[1], kv[0]))[:entries])
    return {**base, **learned}


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, support: int = SUPPORT, exceptions: Iterable[str] = EXCEPTIONS, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """Learn weights from at most `toxic_rows` and `clean_rows` labelled documents, those of the smallest id hash.

    Counts are per entry over the rows' whole texts; the driver sees only entries that pass the support.  Without labels
    of both classes the base lexicon stands.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label_col).cast("int").alias("y"))
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic_rows), (0, clean_rows))]
    rows = picked[0].unionByName(picked[1])
    taught = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null").join(F.broadcast(rows), "doc_id")

    def mark(batches):
        for batch in slices(batches, 64):
            yield pa.RecordBatch.from_arrays([column(batch, c) for c in ("doc_id", "text", "y")] + [pa.array([signature(t) for t in column(batch, "text").to_pylist()], pa.int64())], names=["doc_id", "text", "y", "sig"])

    # Copies and near copies teach once: of rows of one signature the smallest doc_id stays.
    kind = {c.name: c.dataType.simpleString() for c in docs.schema}[id_col]
    marked = arrow(taught.select("doc_id", "text", "y"), mark, f"doc_id {kind}, text string, y int, sig long")
    taught = staged(marked.groupBy("y", "sig").agg(F.min_by("text", "doc_id").alias("text")).select("text", "y"), "taught")

    sizes = {r["y"]: r["n"] for r in taught.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon(BASE | MILD, exceptions)

    def count(batches):
        tally: dict[str, list[int]] = {}

        def flush():
            keys = list(tally)
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([tally[k][1] for k in keys], pa.int64()), pa.array([tally[k][0] for k in keys], pa.int64())], names=["entry", "t", "c"])
            tally.clear()
            return out

        for batch in slices(batches, 64):
            for text, y in zip(column(batch, "text").to_pylist(), column(batch, "y").to_pylist()):
                seen = set(words(text))
                seen |= {w[:k] + "*" for w in seen for k in STEMS if len(w) >= k}
                for w in seen:
                    tally.setdefault(w, [0, 0])[y] += 1
            if len(tally) > 200_000:
                yield flush()
        yield flush()

    counted = arrow(taught, count, "entry string, t long, c long").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    rare = (F.col("t") >= enough(toxic, clean, support)) & (F.col("c") * toxic <= F.col("t") * (RATE * clean))
    told = F.col("entry").isin(*BASE)
    counts = {r["entry"]: (r["t"], r["c"]) for r in counted.where(rare | told).orderBy(F.desc(told), F.desc("t"), "entry").limit(16 * ENTRIES).collect()}
    draft = Lexicon(choose([(e, t, c) for e, (t, c) in counts.items()], toxic, clean, support=support), exceptions)

    def densities(batches):
        for batch in slices(batches, 256):
            yield pa.RecordBatch.from_arrays([pa.array([float(np.log1p(draft.density(t))) for t in column(batch, "text").to_pylist()], pa.float64()), column(batch, "y")], names=["x", "y"])

    seen = arrow(taught, densities, "x double, y int").groupBy(F.round("x", 2).alias("x"), "y").agg(F.count(F.lit(1)).alias("n")).orderBy("x", "y").collect()  # as many as the densities' hundredths
    x, y = (np.repeat([r[k] for r in seen], [r["n"] for r in seen]) for k in ("x", "y"))
    slope, intercept = _calibrate(x.astype(float), y.astype(float))
    return Lexicon(draft.entries, exceptions, slope=slope, intercept=intercept)


def score(docs: DataFrame, lexicon: Lexicon, *, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted for every whole text (null: as empty)."""
    kinds = {c.name: c.dataType.simpleString() for c in docs.schema}
    make = lexicon.maker()

    def run(batches):
        own = make()
        for batch in byte_slices(batches, "text"):
            got = [own.score(t or "") for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(got, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return arrow(rows, run, f"doc_id {kinds[id_col]}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, lexicon: Lexicon, *, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, as they are, whose whole texts score under `threshold` (null: as empty)."""
    make = lexicon.maker()

    def keep():
        own = make()
        return lambda texts: [own.score(t) < threshold for t in texts]

    return filtered(docs, keep, text_col)


def classify(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held_fold: int = 2, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of rows with crc32(doc_id) % folds = held_fold teach nothing.

    Labels other than 0 and 1 are ignored, of several for a document the largest counts.  A null text scores as an empty
    one; rows that repeat come back each, with equal scores; rows of null id are scored but teach nothing; an empty table
    gives an empty result.
    """
    lexicon = fit(docs, labels.where(remainder(F.col("doc_id"), folds) != held_fold), **options)
    scored = score(docs, lexicon, threshold=threshold)
    return scored.select("doc_id", (remainder(F.col("doc_id"), folds) == held_fold).alias("held_out"), "score", "predicted")
