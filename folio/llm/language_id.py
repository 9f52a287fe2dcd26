"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; their 1- to 3-grams of code points are hashed into FEATURES buckets. Inverse
document frequencies are counted over every row that may be learned from. The weights are fitted by
follow-the-regularised-leader (per-coordinate rates, elastic net: L1 keeps them sparse, L2 small) on at
most SAMPLE_ROWS labelled rows of at most SAMPLE_CHARS characters together, taken in the order of a hash
of the row, at least LEAST_ROWS of each language; a fifth of the sample is left out and sets the temperature of the probabilities.

Defined cases: a null text, or one without a letter, is `und` with score 0; so is every text if nothing
can be learned from. With one known language, every other text is of that language with score 1. Rows
with a null label are not learned from. Repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import batches_of, fold, labelled_sample, small_batches, table, texts

FEATURES = 1 << 14
LENGTHS = (1, 2, 3)
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 6_000_000
#: Rows of each language that are in the sample at least, if there are so many.
LEAST_ROWS = 40
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Code points of a text that are counted at a time.
BLOCK = 1 << 20


def counts(text: str) -> np.ndarray:
    """Occurrences of each bucket, over the whole text with a space at both ends; long texts in blocks."""
    out = np.zeros(FEATURES, np.float32)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    for at in range(0, len(points), BLOCK):
        for n in LENGTHS:
            block = points[at : at + BLOCK + n - 1].astype(np.uint64)
            if len(block) < n:
                continue
            h = np.full(len(block) - n + 1, n, np.uint64)
            for i in range(n):
                h = (h + block[i : len(block) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
            out += np.bincount((h & np.uint64(FEATURES - 1)).astype(np.int64), minlength=FEATURES)
    return out


def weighed(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of rows of counts: sublinear frequencies, unit length."""
    x = np.log1p(rows) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader, proximal form: z and n hold all that was seen, weights follow from them."""

    def __init__(self, features: int, classes: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.z, self.n = np.zeros((features, classes), np.float64), np.zeros((features, classes), np.float64)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, x: np.ndarray, y: np.ndarray) -> None:
        """One step on a batch: rows of features and one-hot labels."""
        rows = np.flatnonzero(x.any(axis=0))
        w = self.weights(rows)
        g = x[:, rows].T @ (_softmax(x[:, rows] @ w) - y) / len(x)
        sigma = (np.sqrt(self.n[rows] + g * g) - np.sqrt(self.n[rows])) / self.alpha
        self.z[rows] += g - sigma * w
        self.n[rows] += g * g


def temperature_of(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden section over its logarithm."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()
    low, high, r = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Texts, and for each bucket the texts that hold it. FEATURES counters for each task reach the driver's sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for _, all_ in texts(batches, "text"):
            for t in all_:
                if t:
                    total += counts(t) > 0
                    n += 1
        yield batches_of({"bucket": pa.int32(), "n": pa.int64()})(np.arange(-1, FEATURES), np.concatenate([[n], total]))

    found = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # FEATURES + 1 rows
    out = np.zeros(FEATURES + 1, np.int64)
    for r in found:
        out[r.bucket + 1] = r.n
    return int(out[0]), out[1:]


def fit(docs: DataFrame, epochs: int = 3) -> dict:
    """The model from docs (doc_id, text, lang), all of which may be learned from."""
    small_batches(docs.sparkSession)
    rows = labelled_sample(docs, "lang", SAMPLE_ROWS, SAMPLE_CHARS, LEAST_ROWS)
    classes = sorted({y for _, y in rows})
    if not classes:
        return {"classes": []}
    n, df = document_frequencies(docs)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    y = np.array([classes.index(c) for _, c in rows])
    x = weighed(np.stack([counts(t) for t, _ in rows]), idf)
    held = np.arange(len(y)) % 5 == 4
    learner, one_hot, order = Ftrl(FEATURES, len(classes)), np.eye(len(classes), dtype=np.float32), np.flatnonzero(~held)
    for epoch in range(epochs):
        for at in np.array_split(np.random.default_rng(epoch).permutation(order), max(1, len(order) // 32)):
            learner.learn(x[at], one_hot[y[at]])
    w = learner.weights().astype(np.float32)
    used = np.flatnonzero(w.any(axis=1))
    return {"classes": classes, "idf": idf, "used": used, "weights": w[used], "temperature": temperature_of(x[held] @ w, y[held])}


def predictions(model: dict, all_: list[str]) -> tuple[list[str], list[float]]:
    known = np.array([bool(LETTER.search(t)) for t in all_], bool)
    langs, scores = [UNKNOWN] * len(all_), [0.0] * len(all_)
    at = np.flatnonzero(known)
    if not model["classes"]:
        return langs, scores
    for part in np.array_split(at, max(1, len(at) // 64)):
        if len(part):
            x = weighed(np.stack([counts(all_[i]) for i in part]), model["idf"])
            p = _softmax((x[:, model["used"]] @ model["weights"]).astype(np.float64) / model["temperature"])
            for i, best, score in zip(part, p.argmax(axis=1), p.max(axis=1), strict=True):
                langs[i], scores[i] = model["classes"][best], float(score)
    return langs, scores


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score of each row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    # At most FEATURES * (classes + 1) numbers.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"doc_id": pa.int64(), "lang_pred": pa.string(), "score": pa.float64()})
        for batch, all_ in texts(batches, "text"):
            yield make(batch.column("doc_id"), *predictions(shared.value, all_))

    return docs.selectExpr("CAST(doc_id AS long) doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where((fold(4) != 2) & F.col("lang").isNotNull()).select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")
