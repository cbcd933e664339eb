"""Language identification by string kernels.

Texts are cut into segments.  The kernel of two segments is the number of byte n-grams (n = 1..3, the blended spectrum)
that are present in both, over the root of the product of their own numbers; n-grams meet in hashed cells.  A Nyström
feature map over landmark segments carries one-versus-rest kernel ridge regression.  A segment's scores are
K(x, landmarks) @ coefficients; as K is itself a product of presence matrices, the landmarks are multiplied into the
coefficients once, and scoring is one matrix product per batch of segments.  A text's scores are the means over its
segments, weighted by their letters, so the whole text decides.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, byte_slices, column, filtered, remainder, slices

#: Bytes of a segment; hashed cells of n-grams; segments scored at once.
SEGMENT, CELLS, BATCH = 512, 1 << 14, 128
#: Bounds of the fitted sample: documents a language, segments a document, landmarks (at least one a language); documents
#: in all, of which each language has at least FEW.  Languages aren't bounded.
PER_LANGUAGE, PER_DOCUMENT, LANDMARKS, DOCUMENTS, FEW = 300, 4, 256, 19_200, 8
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_KEEP = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
_IS_LETTER = np.array([b >= 192 or 97 <= b <= 122 for b in range(256)])


def segments(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, segment of each byte, document of each segment); bytes but letters are spaces."""
    raw = [t.lower().encode("utf-8", "surrogatepass") + b"  " for t in texts]
    sizes = np.array([len(r) for r in raw])
    data = _KEEP[np.frombuffer(b"".join(raw), np.uint8)]
    per = (sizes + SEGMENT - 1) // SEGMENT
    starts = np.cumsum(sizes) - sizes
    first = np.cumsum(per) - per
    at = np.arange(len(data)) - np.repeat(starts, sizes)
    return data, np.repeat(first, sizes) + at // SEGMENT, np.repeat(np.arange(len(texts)), per)


def cells(data: np.ndarray, n: int) -> np.ndarray:
    """The hashed cell of the n-gram that starts at each byte."""
    x = np.concatenate([data, np.full(2, 32, np.uint8)]).astype(np.uint32)
    gram = x[: len(data)]
    for i in range(1, n):
        gram = gram | x[i : i + len(data)] << np.uint32(8 * i)
    return (((gram + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.intp)


def presence(data: np.ndarray, seg: np.ndarray, count: int):
    """Per batch of segments: (first segment, presence matrix, letters of each segment); n-grams lie within a segment."""
    grams = [cells(data, n) for n in (1, 2, 3)]
    for n in (2, 3):
        over = np.nonzero(seg[n - 1 :] != seg[: len(seg) - n + 1])[0]
        over = np.concatenate([over, np.arange(max(0, len(seg) - n + 1), len(seg))])
        grams[n - 1][over] = grams[0][over]
    letters = np.bincount(seg, _IS_LETTER[data], count)
    x = np.zeros((BATCH, CELLS), np.float32)
    flat = x.reshape(-1)
    for s in range(0, count, BATCH):
        e = min(s + BATCH, count)
        lo, hi = np.searchsorted(seg, [s, e])
        x[: e - s] = 0
        base = (seg[lo:hi] - s) * CELLS
        for g in grams:
            flat[base + g[lo:hi]] = 1
        yield s, x[: e - s], letters[s:e]


def pick(text: str, n: int) -> list[bytes]:
    """At most n segments, spread over the whole text, of those with a fair number of letters."""
    data, seg, docs = segments([text])
    letters = np.bincount(seg, _IS_LETTER[data], len(docs))
    rows = np.nonzero(letters >= max(1, min(40, letters.max())))[0]
    rows = rows[np.unique(np.linspace(0, len(rows) - 1, min(n, len(rows))).astype(int))] if len(rows) else rows
    return [data[slice(*np.searchsorted(seg, [r, r + 1]))].tobytes() for r in rows.tolist()]


class Classifier:
    """Fitted scores: one column of cell weights per language."""

    def __init__(self, samples: list[bytes], langs: list[str], *, landmarks: int = LANDMARKS, ridge: float = 1e-2, seed: int = 7):
        """Fit on segments (as `pick` gives them) and their languages."""
        self.langs = sorted(set(langs))
        self.sharpness = 6.0
        if not samples:
            self.weights = np.zeros((CELLS, 0), np.float32)
            return
        rng = np.random.default_rng(seed)
        seg = np.repeat(np.arange(len(samples)), [len(s) for s in samples])
        data = np.frombuffer(b"".join(samples), np.uint8)
        at = {v: c for c, v in enumerate(self.langs)}
        y = np.array([at[v] for v in langs])
        share = -(-landmarks // len(self.langs))
        own = np.split(np.argsort(y, kind="stable"), np.cumsum(np.bincount(y))[:-1])
        marks = np.concatenate([rng.permutation(rows)[:share] for rows in own])
        chosen = np.zeros(len(samples), bool)
        chosen[marks] = True

        def scaled():  # a batch of segments at a time: the whole matrix would not fit a small driver
            for s, m, _ in presence(data, seg, len(samples)):
                yield s, m / np.sqrt(np.maximum(m.sum(axis=1, keepdims=True), 1))

        l = np.concatenate([m[chosen[s : s + len(m)]] for s, m in scaled()])
        value, vector = np.linalg.eigh((l @ l.T).astype(np.float64))
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])
        # Features and targets exist for a batch at a time, so that the driver holds squares of the landmarks only.
        count = np.bincount(y, minlength=len(self.langs))
        weight = (len(y) / count / len(self.langs))[y]  # languages count alike
        centre = 2 * np.bincount(y, weight, len(self.langs)) / weight.sum() - 1
        mean = sum((m @ l.T).astype(np.float64).sum(axis=0) for _, m in scaled()) @ root / len(y)
        gram, aim = np.zeros((root.shape[1], root.shape[1])), np.zeros((root.shape[1], len(self.langs)))
        for s, m in scaled():
            phi = (m @ l.T).astype(np.float64) @ root - mean
            g = phi * weight[s : s + len(m), None]
            gram += g.T @ phi
            aim += g.T @ (np.where(y[s : s + len(m), None] == np.arange(len(self.langs)), 1.0, -1.0) - centre)
        beta = np.linalg.solve(gram + ridge * len(y) * np.eye(len(gram)), aim)
        self.landmarks, self.coefficients = l, root @ beta
        self.weights = (l.T @ self.coefficients).astype(np.float32)
        self.offset = (centre - mean @ beta).astype(np.float32)

    def __getstate__(self) -> dict:
        """What scoring needs; the landmarks stay behind."""
        return {k: v for k, v in self.__dict__.items() if k not in ("landmarks", "coefficients")}

    def scores(self, texts: list[str]) -> np.ndarray:
        """Mean score per text and language."""
        total, size = np.zeros((len(texts), len(self.langs))), np.full(len(texts), 1e-9)
        data, seg, docs = segments(texts)
        for s, x, letters in presence(data, seg, len(docs)):
            doc = docs[s : s + len(x)]
            own = np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
            f = (x @ self.weights) / own + self.offset
            np.add.at(total, doc, f * letters[:, None])
            np.add.at(size, doc, letters)
        return total / size[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        plain = [t or "" for t in texts]
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        f = self.sharpness * self.scores(plain)
        p = np.exp(f - f.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        seen = [bool(_LETTER.search(t)) for t in plain]
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best.tolist(), seen)], [float(p[i, b]) if s else 0.0 for i, (b, s) in enumerate(zip(best.tolist(), seen))]


def fit(docs: DataFrame, *, per_language: int = PER_LANGUAGE, per_document: int = PER_DOCUMENT, documents: int = DOCUMENTS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> Classifier:
    """Fit on segments of the `per_language` documents of the smallest id hash of each language, whatever their number.

    Where languages are so many that this is more than `documents` in all, each has an equal share, at least FEW.
    `per_document` segments are spread over each whole text; equal ones count once.  Rows of null id, text or lang teach
    nothing; without any, every text is `und`.
    """
    named = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    lang = F.col(lang_col).alias("lang")
    counted = named.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()
    per_language = min(per_language, max(FEW, documents // max(1, len(counted))))
    # Smallest hashes first means: below a bound that some four times as many rows pass, so that few rows of a language
    # meet in a task however many it has.
    kind = named.select(lang).schema["lang"].dataType.simpleString()
    bounds = docs.sparkSession.createDataFrame([(r["lang"], min(2**63 - 1, int(2**63 * 4 * per_language / r["n"]))) for r in counted], f"lang {kind}, bound long")
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    ids = named.select(F.col(id_col).alias("doc_id"), lang).join(F.broadcast(bounds), "lang").where(hashed <= F.col("bound")).select("doc_id", "lang").dropDuplicates(["doc_id"])
    order = Window.partitionBy("lang").orderBy(hashed, "doc_id")
    ids = ids.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language).select("doc_id")
    rows = named.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).join(F.broadcast(ids), "doc_id")

    def picked(batches):
        for batch in slices(batches, 64):
            found = [(s, lang, t) for t, lang in zip(column(batch, "text").to_pylist(), column(batch, "lang").to_pylist()) for s in pick(t, per_document)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())], names=["segment", "lang"])

    found = arrow(rows, picked, "segment binary, lang string").distinct().collect()  # at most per_document x per_language x languages, the latter two `documents` or FEW a language
    found.sort(key=lambda r: (r["lang"], bytes(r["segment"])))
    return Classifier([bytes(r["segment"]) for r in found], [r["lang"] for r in found], **options)


def identify(docs: DataFrame, model: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) of every whole text; `und` and 0 where a text is null or has no letter."""
    kind = {c.name: c.dataType.simpleString() for c in docs.schema}[id_col]

    def run(batches):
        for batch in byte_slices(batches, "text", 1 << 20):
            langs, scores = model.predict(column(batch, "text").to_pylist())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, lang_pred string, score double")


def accepted(docs: DataFrame, model: Classifier, *, floor: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, as they are, with letters in their texts and a language told with a confidence of `floor` or more.

    Confidence is how far the score lies above that of a guess, as a part of how far it could: 0 where all languages
    score alike, 1 where one is sure, whatever their number.  A model without languages accepts all texts with letters.
    """
    count = len(model.langs)

    def keep():
        def passes(texts):
            if count < 2:
                return [bool(_LETTER.search(t)) for t in texts]
            return [lang != UNKNOWN and (score * count - 1) / (count - 1) >= floor for lang, score in zip(*model.predict(texts))]

        return passes

    return filtered(docs, keep, text_col)


def classify(docs: DataFrame, *, folds: int = 4, held_fold: int = 2, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; rows with crc32(doc_id) % folds = held_fold teach nothing.

    Null, empty and letterless texts are `und` with score 0; long texts count whole.  Rows that repeat come back each, with
    equal results; rows of null id are told but teach nothing; an empty table gives an empty result.  Ties go to the
    language that sorts first.
    """
    held = remainder(F.col("doc_id"), folds) == held_fold
    return identify(docs, fit(docs.where(~held), **options)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
