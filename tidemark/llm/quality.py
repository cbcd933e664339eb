"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Statistics of whole texts are transformed towards normality.  Each class has its mean and a shrinkage covariance; the
score comes from the difference of the classes' Mahalanobis log-densities, with the Cholesky factors worked out once.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, column, remainder, slices, staged

NAMES = ("words", "word_bytes", "word_spread", "distinct", "repeats", "commonest", "upper", "digits", "marks", "symbols", "bars", "exclaims", "stops", "lines", "distinct_lines", "caps_words", "two_words")
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "marks": b",;:'\"()-", "symbols": b"#$%&*@^~+=<>/\\{}[]_", "bars": b"|", "exclaims": b"!?", "stops": b"."}
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _set in enumerate(_CLASSES.values()):
    _TABLE[list(_set), _i] = 1
_TWO_BYTE_CAPS = re.compile(r"[À-ÖØ-Þ]")


def statistics(text: str) -> np.ndarray:
    """Transformed statistics of one whole text; an empty text has its own, finite ones."""
    raw = text.encode("utf-8", "surrogatepass")
    words, rows = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size = len(words), max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts @ _TABLE / size
    share[0] += len(_TWO_BYTE_CAPS.findall(text)) / size
    if n:
        lengths = np.fromiter(map(len, words), float, n)
        tally: dict[bytes, int] = {}
        for w in words:
            tally[w] = tally.get(w, 0) + 1
        repeats = sum(map(bytes.__eq__, words, words[1:])) / n
        pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
        forms = [lengths.mean(), lengths.std(), len(tally) / n, repeats, max(tally.values()) / n]
        caps = sum(map(bytes.isupper, words)) / n
    else:
        forms, caps, pairs = [0.0] * 5, 0.0, 1.0
    values = [math.log1p(n), math.log1p(forms[0]), math.log1p(forms[1]), forms[2], math.sqrt(forms[3]), math.sqrt(forms[4])]
    values += np.sqrt(share).tolist()
    values += [math.log1p(len(rows)), len(set(rows)) / max(1, len(rows)), math.sqrt(caps), pairs]
    return np.array(values)


class Discriminant:
    """Two normal densities with shrunk covariances."""

    def __init__(self, counts, sums, squares, *, shrinkage: float = 0.1, floor: float = 1e-4, sharpness: float = 0.25):
        """counts (2), sums (2, d) and sums of outer products (2, d, d) of the transformed statistics by class."""
        d = sums.shape[1]
        self.prior = np.log((counts + 1) / (counts.sum() + 2))
        self.mean, self.factor, self.log_det, self.sharpness = np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), sharpness
        total = squares.sum(axis=0) / max(1, counts.sum()) - np.outer(m := sums.sum(axis=0) / max(1, counts.sum()), m)
        for c in (0, 1):
            n = max(1.0, counts[c])
            self.mean[c] = sums[c] / n
            own = squares[c] / n - np.outer(self.mean[c], self.mean[c])
            weight = n / (n + d)  # few rows lean on what all rows say
            cov = weight * own + (1 - weight) * total
            cov = (1 - shrinkage) * cov + shrinkage * np.diag(np.diag(cov)) + np.eye(d) * (floor + shrinkage * np.trace(total) / d * 0.05)
            self.factor[c] = np.linalg.inv(np.linalg.cholesky(cov))
            self.log_det[c] = -2 * np.log(np.diag(self.factor[c])).sum()
        self.known = bool(counts.min() > 0)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, higher: class 1 likelier; the share of class 1 if a class was never seen."""
        if not self.known:
            return np.full(len(x), float(np.exp(self.prior[1])))
        log = [self.prior[c] - 0.5 * (self.log_det[c] + (((x - self.mean[c]) @ self.factor[c].T) ** 2).sum(axis=1)) for c in (0, 1)]
        return 1 / (1 + np.exp(np.clip(-self.sharpness * (log[1] - log[0]), -500, 500)))


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, x (array of the transformed statistics); null counts as empty."""

    def run(batches):
        for batch in slices(batches, 512):
            x = np.array([statistics(t or "") for t in column(batch, "text").to_pylist()]).reshape(-1, len(NAMES))
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(NAMES)), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), values], names=["doc_id", "x"])

    return arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, x array<double>")


def fit(measured: DataFrame, labels: DataFrame, *, label_col: str = "quality", **options) -> Discriminant:
    """Class moments over all labelled rows of `measured` (doc_id, x); partial sums meet per class before the driver sees them."""
    d = len(NAMES)
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label_col).cast("int").alias("y"))

    def moments(batches):
        n, s, q = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in slices(batches):
            x, y = column(batch, "x").flatten().to_numpy().reshape(-1, d), column(batch, "y").to_numpy()
            for c in (0, 1):
                own = x[y == c]
                n[c] += len(own)
                s[c] += own.sum(axis=0)
                q[c] += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([np.concatenate([[n[c]], s[c], q[c].ravel()]) for c in (0, 1)], pa.list_(pa.float64()))], names=["y", "m"])

    parts = arrow(measured.join(known, "doc_id").select("x", "y"), moments, "y int, m array<double>")
    sums = parts.select("y", F.posexplode("m").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v"))
    total = np.zeros((2, 1 + d + d * d))
    for row in sums.collect():
        total[row["y"], row["i"]] = row["v"]
    return Discriminant(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d), **options)


def classify(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", threshold: float = 0.3, folds: int = 5, held_fold: int = 0, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; rows with crc32(doc_id) % folds = held_fold teach nothing.

    Labels other than 0 and 1 are ignored, of several for a document the largest counts; without labels of both classes
    every score is the share of label 1.  A null text scores as an empty one; rows that repeat come back each, with equal
    scores; rows of null id are scored but teach nothing; an empty table gives an empty result.
    """
    measured = staged(measure(docs, id_col=id_col, text_col=text_col), "statistics")
    taught = labels.where(remainder(F.col("doc_id"), folds) != held_fold)
    model = fit(measured, taught, label_col=label_col, **options)

    def run(batches):
        for batch in slices(batches):
            score = model.score(column(batch, "x").flatten().to_numpy().reshape(-1, len(NAMES)))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = arrow(measured, run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), folds) == held_fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
