"""Embedding whitening by a two-pass covariance.

Entries become whole numbers, floor(scale * c) + shift. The first pass adds them exactly, which gives the mean; the
second adds outer products of centred rows, a NumPy product for each batch; partial results are merged by treeAggregate.
The covariance's eigenvectors come from LAPACK's solver for symmetric matrices, on the driver, from a
matrix whose size follows from the vectors' length alone. Projection and means are broadcast. A third pass measures
how far the covariance of the whitened rows is from the identity.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped, and an empty vector has no
component; a null vec_id is kept; repeated rows are fitted and returned each; vectors of different lengths are fitted apart;
an empty table gives an empty result; other columns are ignored. A component without variance (an eigenvalue of at most
1e-12 of the greatest, or all of them 0) has a null as its whitened value and takes no part in the identity's
error, which is 0 if there is no other. Entries beyond 2^60 are cut to that, deviations beyond a long to its greatest value.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import batches_of, small_batches, table

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
BATCH = 4096
MOST = (1 << 63) - 1
#: Share of the greatest eigenvalue up to which one counts as none.
NOTHING = 1e-12


def integers(vectors: np.ndarray, scale: int, shift: int) -> np.ndarray:
    return np.clip(np.floor(scale * vectors), -float(1 << 60), float(1 << 60)).astype(np.int64) + shift


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of the vectors of each length, and these as a matrix."""
    sizes, flat = pc.list_value_length(vectors).to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python's whole numbers."""
    few = len(x) * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < 1 << 62
    return (x.sum(axis=0) if few else x.astype(object).sum(axis=0)).astype(object)


@dataclass
class Mean:
    """The number of rows and the mean of each dimension as a whole number and a remainder over n."""

    n: int
    sums: np.ndarray

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], object)
        self.part = np.array([int(r) / self.n for r in self.rest], np.float64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sums of (n x - S)^2, exact up to the greatest long."""
        off = x - self.whole
        near = float(np.abs(off.astype(np.float64)).max(initial=0)) + 1
        if self.n * near < 2.0**62:
            d = off * self.n - self.rest.astype(np.int64)
            about = (d.astype(np.float64) ** 2).sum(axis=1)
            out = np.where(about < 9.2e18, (np.where(about[:, None] < 9.2e18, d, 0) ** 2).sum(axis=1), MOST)
            unsure = np.flatnonzero((about >= 9.2e18) & (about < 9.3e18))
        else:
            out, unsure = np.zeros(len(x), np.int64), np.arange(len(x))
        for i in unsure:
            out[i] = min(sum((int(a) * self.n - int(r)) ** 2 for a, r in zip(off[i], self.rest, strict=True)), MOST)
        return out


@dataclass
class Whitening:
    """What a length's vectors are whitened with: columns of projection are components over the root of their eigenvalue."""

    mean: Mean
    values: np.ndarray
    projection: np.ndarray
    explained: np.ndarray
    error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.mean.centred(x) @ self.projection


def merged(a: dict, b: dict) -> dict:
    """Numbers of rows and partial sums by length, added."""
    for d, (n, total) in b.items():
        a[d] = (a[d][0] + n, a[d][1] + total) if d in a else (n, total)
    return a


def gathered(rows: DataFrame, part: Callable[[int, np.ndarray], np.ndarray], scale: int, shift: int) -> dict[int, tuple[int, np.ndarray]]:
    """Number of rows and sum of part(length, whole numbers) over all rows, by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for at, x in matrices(batch.column("v")):
                if x.shape[1]:
                    merged(held, {x.shape[1]: (len(at), part(x.shape[1], integers(x, scale, shift)))})
        yield batches_of({"data": pa.binary()})([pickle.dumps(held)])

    parts = rows.select("v").mapInArrow(run, "data binary").rdd
    depth = 2 if parts.getNumPartitions() < 1000 else 3
    return parts.map(lambda r: pickle.loads(r.data)).treeAggregate({}, merged, merged, depth)


def fit(rows: DataFrame, components: int, scale: int, shift: int) -> dict[int, Whitening]:
    """For each length of vectors its whitening; rows: v, an array of finite doubles."""
    spark = rows.sparkSession
    means = {d: Mean(n, sums) for d, (n, sums) in gathered(rows, lambda _, x: exact_sum(x), scale, shift).items()}
    sent_means = spark.sparkContext.broadcast(means)  # as many numbers as dimensions

    def outer(d: int, x: np.ndarray) -> np.ndarray:
        c = sent_means.value[d].centred(x)
        return c.T @ c

    found = {}
    for d, (n, total) in gathered(rows, outer, scale, shift).items():
        v = (total + total.T) / (2 * n)
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            there = values > NOTHING * max(values[0], 0.0)
            projection = np.where(there, vectors / np.sqrt(np.where(there, values, 1.0)), np.nan)
        trace = float(np.trace(v))
        found[d] = Whitening(means[d], values, projection, np.maximum(values, 0.0) / trace if trace > 0 else np.zeros(len(values)))
    sent_found = spark.sparkContext.broadcast(found)

    def product(d: int, x: np.ndarray) -> np.ndarray:
        z = np.nan_to_num(sent_found.value[d].whitened(x))  # its rows are centred already
        return z.T @ z

    for d, (n, total) in gathered(rows, product, scale, shift).items():
        there = ~np.isnan(found[d].projection[0])
        found[d].error = float(np.abs(total / n - np.eye(len(total)))[np.ix_(there, there)].max(initial=0.0))
    return found


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row of vectors (vec_id, embedding) and component."""
    spark = vectors.sparkSession
    small_batches(spark, BATCH)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("embedding IS NOT NULL").where(finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    model = spark.sparkContext.broadcast(fit(rows, components, scale, shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"vec_id": pa.int64(), "component": pa.int32(), "n": pa.int64(), "deviation": pa.int64(), "whitened": pa.float64(), "explained": pa.float64(), "identity_error": pa.float64()})
        for batch in batches:
            for at, v in matrices(batch.column("v")):
                own = model.value.get(v.shape[1])
                if own is None:
                    continue
                x, k = integers(v, scale, shift), own.projection.shape[1]
                z = own.whitened(x).ravel()
                yield make(
                    batch.column("vec_id").take(pa.array(np.repeat(at, k))), np.tile(np.arange(1, k + 1, dtype=np.int32), len(at)), np.full(len(z), own.mean.n),
                    np.repeat(own.mean.deviations(x), k), pa.array(z, mask=np.isnan(z)), np.tile(own.explained, len(at)), np.full(len(z), own.error),
                )

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
