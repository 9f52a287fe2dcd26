"""Quality classifier: a byte-level convolutional network in numpy.

FILTERS learned filters of WIDTH bytes slide over the whole document. Their rectified responses are
max-pooled over overlapping chunks (two halves of HALF positions each, a chunk starts at every half); the
mean and the maximum over all chunks of a document are combined by a logistic layer. A filter is a table
of weights for each place and byte, so that a response is a sum of WIDTH look-ups.

It is fitted with Adam on at most SAMPLE_ROWS labelled rows of at most SAMPLE_CHARS characters together;
scoring runs over every row and every byte, long texts in blocks of BLOCK bytes.

Defined cases: a null text is empty and is scored like an empty document; rows without a label are
scored but not learned from; without labels of both kinds every score is the share of label 1 (1 if there
is none); repeated rows each get their row; an empty table gives an empty result; other columns are
ignored or, in accepted(), kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.common import fold, labelled_sample, small_batches, table, texts, unused

FILTERS, WIDTH, HALF = 12, 6, 32
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 4_000_000
EPOCHS, BATCH, RATE = 10, 24, 0.02
ACCEPT = 0.3
#: Bytes of a text that are scored at a time; a multiple of HALF.
BLOCK = 1 << 16


def halves(data: bytes) -> tuple[np.ndarray, int]:
    """The bytes with padding: a whole number of halves and WIDTH - 1 more; and the number of halves."""
    n = max(1, -(-len(data) // HALF))
    out = np.zeros(n * HALF + WIDTH - 1, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out, n


def chunk_means_and_maxima(pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks from the halves of one document, their mean and their maximum."""
    chunks = np.maximum(pooled[:-1], pooled[1:]) if len(pooled) > 1 else pooled
    return chunks, chunks.mean(axis=0), chunks.max(axis=0)


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "filters": r.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
            "bias": np.full(FILTERS, -0.3, np.float32),
            "out": r.normal(0, 0.3, 2 * FILTERS).astype(np.float32),
            "shift": np.zeros(1, np.float32),
        }
        self.constant: float | None = None
        self._pairs: list[np.ndarray] | None = None

    def responses(self, x: np.ndarray, n: int) -> np.ndarray:
        """Rectified responses at n positions."""
        if self._pairs is None:  # while it is fitted
            f = self.p["filters"]
            return np.maximum(sum((f[j][x[j : j + n]] for j in range(WIDTH)), self.p["bias"]), 0)
        words = x[:-1].astype(np.uint16) | (x[1:].astype(np.uint16) << 8)
        total = self._pairs[0][words[:n]]
        for k in range(1, WIDTH // 2):
            total += self._pairs[k][words[2 * k : 2 * k + n]]
        return np.maximum(total, 0, out=total)

    def freeze(self) -> None:
        """Adds up the weights of two bytes side by side, so that scoring looks up half as often."""
        f = self.p["filters"]
        self._pairs = [np.ascontiguousarray((f[2 * k][None, :, :] + f[2 * k + 1][:, None, :]).reshape(65536, FILTERS)) for k in range(WIDTH // 2)]
        self._pairs[0] += self.p["bias"]

    def pooled(self, data: bytes) -> np.ndarray:
        """Maxima of the halves of a document."""
        x, n = halves(data)
        out = np.empty((n, FILTERS), np.float32)
        for at in range(0, n * HALF, BLOCK):
            m = min(BLOCK, n * HALF - at)
            out[at // HALF : (at + m) // HALF] = self.responses(x[at : at + m + WIDTH - 1], m).reshape(-1, HALF, FILTERS).max(axis=1)
        return out

    def score(self, data: bytes) -> float:
        if self.constant is not None:
            return self.constant
        _, mean, top = chunk_means_and_maxima(self.pooled(data))
        z = float(np.concatenate([mean, top]) @ self.p["out"] + self.p["shift"][0])
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    def gradients(self, batch: list[tuple[bytes, int]]) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over whole documents; only the positions that won a pool pass anything on."""
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        places, filters, amounts = [], [], []
        for data, y in batch:
            x, n = halves(data)
            r = self.responses(x, n * HALF).reshape(n, HALF, FILTERS)
            where, pooled = r.argmax(axis=1), r.max(axis=1)
            chunks, mean, top = chunk_means_and_maxima(pooled)
            features = np.concatenate([mean, top])
            z = float(features @ self.p["out"] + self.p["shift"][0])
            d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(batch)
            g["out"] += d * features
            g["shift"] += d
            to_chunks = np.tile(d * self.p["out"][:FILTERS] / len(chunks), (len(chunks), 1))
            to_chunks[chunks.argmax(axis=0), np.arange(FILTERS)] += d * self.p["out"][FILTERS:]
            to_halves = np.zeros((n, FILTERS), np.float32)
            if n > 1:
                first = pooled[:-1] >= pooled[1:]
                to_halves[:-1] += to_chunks * first
                to_halves[1:] += to_chunks * ~first
            else:
                to_halves += to_chunks
            half, f = np.nonzero(to_halves * (pooled > 0))
            amounts.append(to_halves[half, f])
            filters.append(f)
            places.append(x[(half * HALF + where[half, f])[:, None] + np.arange(WIDTH)])
        f, amount, window = np.concatenate(filters), np.concatenate(amounts), np.concatenate(places)
        g["bias"] = np.bincount(f, amount, FILTERS).astype(np.float32)
        for j in range(WIDTH):
            g["filters"][j] = np.bincount(window[:, j].astype(np.int64) * FILTERS + f, amount, 256 * FILTERS).reshape(256, FILTERS)
        return g

    def fit(self, rows: list[tuple[bytes, int]], epochs: int = EPOCHS) -> Network:
        kinds = {y for _, y in rows}
        if len(kinds) < 2:
            self.constant = float(next(iter(kinds), 1))
            return self
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        step = 0
        for epoch in range(epochs):
            order = np.random.default_rng(epoch).permutation(len(rows))
            rate = RATE * (1 - epoch / epochs)
            for at in range(0, len(order), BATCH):
                step += 1
                for k, g in self.gradients([rows[i] for i in order[at : at + BATCH]]).items():
                    g = g + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """From the rows of docs (doc_id, text) that labels (doc_id, quality) has; of several labels of a document the least counts."""
    small_batches(docs.sparkSession)
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("__quality"))
    rows = labelled_sample(docs.select("doc_id", "text").join(known, "doc_id"), "__quality", SAMPLE_ROWS, SAMPLE_CHARS)
    return Network().fit([(t.encode(), int(y)) for t, y in rows])


def scored(docs: DataFrame, network: Network, name: str = "score") -> DataFrame:
    """docs with a column of this name, which docs must not have. The network is of fixed size; it is frozen in each Python worker."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if own.constant is None and own._pairs is None:
            own.freeze()
        for batch, all_ in texts(batches, "text"):
            values = pa.array([own.score(t.encode()) for t in all_], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame, least: float = ACCEPT) -> DataFrame:
    """The rows of docs that score least or more, with the columns of docs; the network learns from all labels."""
    name = unused(docs, "score")
    return scored(docs, fit(docs, labels), name).where(F.col(name) >= least).select(*docs.columns)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = fit(docs.where(fold(5) != 0), table(spark, sf_dir, "labels"))
    out = scored(docs, network)
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
