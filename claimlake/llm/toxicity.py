"""Operator 4: toxicity severity by cumulative-link ordinal regression.

Severity grades 0 < 1 < ... < K-1 come from an integer label column. One weight
vector over hashed word features is shared by all K-1 ordered thresholds:
P(grade > k) = sigmoid(w.x - theta_k), theta_0 < theta_1 < ... The output is the
expected severity, the sum over k of P(grade > k), and the likeliest grade side
of each threshold. The given ``labels`` know only toxic 0/1, so K is 2 there;
the fit takes any number of grades.

The fit uses a bounded sample: the SAMPLE_DOCS labelled documents with the
smallest hash of their id. Scoring covers every whole text. A document's
feature values are 1 for each distinct hashed word, so a few words in a long
text keep their weight.

Defined cases: null or wordless text has no features and gets the base rate of
the thresholds; labels that are null, or of unknown documents, are ignored; with
no labels or one grade only, severity is 0.0 and nothing is flagged; very long texts
are scored whole; repeated rows each get a result, and for the fit an id counts once,
with its highest grade (of several texts, the one whose features come first); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bounds of the fit and the size of the feature space.
SAMPLE_DOCS, BITS, MAX_GRADES = 8000, 18, 16
EPOCHS, RATE, L2 = 40, 3.0, 1e-5
#: A document is flagged where P(grade >= 1) is over this.
FLAG = 0.5

SCHEMA = "doc_id long, severity double, grade int, toxic_prob double, flagged boolean"


def features(text: bytes | None) -> np.ndarray:
    """Sorted distinct feature numbers of a text's words."""
    import zlib

    words = set((text or b"").translate(common.PLAIN_WORDS).split())
    return np.unique(np.fromiter((zlib.crc32(w) & ((1 << BITS) - 1) for w in words), dtype=np.int64, count=len(words)))


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


class Model:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray) -> None:
        self.weights, self.thresholds = weights, thresholds

    def over(self, xs: list[np.ndarray]) -> np.ndarray:
        """P(grade > k) for each row and threshold."""
        z = np.array([self.weights[x].sum() for x in xs])
        return _sigmoid(z[:, None] - self.thresholds[None, :])


def train(xs: list[np.ndarray], grades: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> Model:
    """Adagrad on the cumulative binary losses of all thresholds; deterministic."""
    top = int(grades.max()) if len(grades) else 0
    if top < 1 or len(np.unique(grades)) < 2:
        return Model(np.zeros(1 << BITS, dtype=np.float64), np.zeros(0))
    above = (grades[:, None] > np.arange(top)[None, :]).astype(np.float64)
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    theta = np.log((1 - share) / share)
    w, seen_w, seen_t = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6), np.full(top, 1e-6)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for block in np.array_split(order.permutation(len(xs)), max(1, len(xs) // 64)):
            lengths = [len(xs[i]) for i in block]
            flat = np.concatenate([xs[i] for i in block]) if sum(lengths) else np.zeros(0, dtype=np.int64)
            row = np.repeat(np.arange(len(block)), lengths)
            z = np.bincount(row, weights=w[flat], minlength=len(block))
            gap = _sigmoid(z[:, None] - theta[None, :]) - above[block]
            cols, inverse = np.unique(flat, return_inverse=True)
            g = np.bincount(inverse, weights=gap.sum(axis=1)[row], minlength=len(cols)) / len(block) + L2 * w[cols]
            seen_w[cols] += g * g
            w[cols] -= 0.1 * RATE * g / np.sqrt(seen_w[cols])
            gt = -gap.mean(axis=0)
            seen_t += gt * gt
            theta = np.sort(theta - 0.1 * RATE * gt / np.sqrt(seen_t))
    return Model(w, theta)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model; the driver gets the feature numbers of at most ``sample_docs`` documents."""
    graded = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("_grade"))
        .where(F.col("doc_id").isNotNull() & F.col("_grade").between(0, MAX_GRADES - 1))
        .groupBy("doc_id").agg(F.max("_grade").alias("_grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = [features(t.as_py()).astype(np.int32).tobytes() for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["_grade"], pa.array(xs, pa.binary())], names=["doc_id", "g", "x"])

    # The sample has a fixed bound (ids and grades of sample_docs rows), so it may be broadcast.
    picked = docs.select("doc_id", F.encode("text", "UTF-8").alias("_text")).join(F.broadcast(graded), "doc_id")
    found = picked.select("doc_id", "_grade", "_text").mapInArrow(run, "doc_id long, g int, x binary")
    # One row for each id, however many rows repeat it.
    rows = sorted((r["doc_id"], r["g"], bytes(r["x"])) for r in found.groupBy("doc_id", "g").agg(F.min("x").alias("x")).collect())
    return train([np.frombuffer(x, dtype=np.int32).astype(np.int64) for _, _, x in rows], np.array([g for _, g, _ in rows], dtype=np.int64))


def score(docs: DataFrame, model: Model, flag: float = FLAG) -> DataFrame:
    """doc_id, expected severity, likeliest grade, P(grade >= 1), flagged for every row."""
    common.bounded_batches(docs.sparkSession)
    weights, theta = model.weights.astype(np.float32), model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Model(weights.astype(np.float64), theta)
        for batch in batches:
            over = kept.over([features(t.as_py()) for t in batch["_text"]]) if len(batch) else np.zeros((0, len(theta)))
            first = over[:, 0] if len(theta) else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(over.sum(axis=1)), pa.array((over > 0.5).sum(axis=1).astype(np.int32)), pa.array(first), pa.array(first > flag)],
                names=["doc_id", "severity", "grade", "toxic_prob", "flagged"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("_text")).mapInArrow(run, SCHEMA)


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
