"""Exact top-k inner products by the threshold algorithm over sorted lists, one list for each dimension.

Candidates lie in blocks of about BLOCK vectors; each block has its lists, sorted once. Every query meets
every block. It reads its lists from the end that its component favours, in rounds; each round goes
on in the list that lowers the bound most for an entry, and reads about GROW times as much as the one before. What
a list shows for the first time is scored. The search of a block ends when the bound of what no list has shown is below
the k-th score, or when nothing is left unseen.

The bound: an unseen vector has, in each dimension, no more than the place that its list was read to, and no
more than the block's greatest length. The inner product under both limits is bounded by its Lagrange dual,
for a few multipliers; the least of these counts. As the k-th score, the k-th among the queries of the
query's own block serves from the start, as these are candidates too, so blocks share one lower limit.

Components are floor(scale * x), x as double; scores are exact integers; ties go to the smaller vec_id.
Defined cases: vectors that are null or hold null or non-finite components, and rows with a null vec_id,
take no part; vectors of different lengths are not compared; rows that repeat a query's vec_id are its
own and no candidates of it; equal query rows count once; an empty table gives an empty result; other
columns are ignored; components and scores beyond the range of a long are its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import batches_of, small_batches, table

BLOCK, QUERIES = 8192, 1024
#: Query blocks that meet a block of candidates in one task, at most.
TOGETHER = 32
K, SCALE, EVERY = 20, 64, 20
#: Entries that the first round reads, and how much more each later one does.
ENTRIES, GROW = 128, 4
#: Places of a list, as shares of it, at which a round may end; and multipliers of the dual bound, as shares of |q| / length.
PLACES = np.unique(np.concatenate([2.0 ** -np.arange(1, 9), np.arange(1, 17) / 16]))
MULTIPLIERS = 2.0 ** np.arange(-3, 4.5, 0.5)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class SortedLists:
    """A block of vectors with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.by_id = np.argsort(ids, kind="stable")
        self.sorted_ids = ids[self.by_id]
        n, dims = vectors.shape
        self.lists = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.top = float(np.abs(vectors.astype(np.float64)).max(initial=0)) * max(1, dims)
        self.length = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        # Whole numbers of such sums are exact in these types, which are faster.
        self.quick = {32: vectors.astype(np.float32) if self.top < 2**24 else None, 64: vectors.astype(np.float64) if self.top < 2**52 else None}
        self.ends = np.unique(np.minimum(n, np.maximum(1, np.ceil(PLACES * n))).astype(np.int64))
        # What an unseen vector can have at most, from either end, after so many entries: the last one that was read.
        ordered = np.take_along_axis(vectors, self.lists.T, axis=0).T.astype(np.float64)
        self.high, self.low = ordered[:, n - self.ends], ordered[:, self.ends - 1]
        self.most, self.least = ordered[:, -1], ordered[:, 0]

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        size = float(np.abs(q.astype(np.float64)).max(initial=0)) * self.top
        for bits, limit, kind in ((32, 2**24, np.float32), (64, 2**52, np.float64)):
            if size < limit and self.quick[bits] is not None:
                return np.rint(self.quick[bits].take(rows, axis=0) @ q.astype(kind)).astype(np.int64)
        if size < 2**62:
            return self.vectors[rows] @ q
        exact = self.vectors[rows].astype(object) @ q.astype(object)
        return np.array([min(max(x, LEAST), MOST) for x in exact], np.int64)

    def best(self, query_id: int, q: np.ndarray, k: int, floor: int = LEAST) -> tuple[np.ndarray, np.ndarray, int]:
        """ids and scores of the k best of the block, without rows of the query's id and what is below floor; and how many were scored."""
        n = len(self.ids)
        own = q != 0
        size, up = np.abs(q[own]).astype(np.float64), q[own] > 0
        which = np.flatnonzero(own)
        # Places and limits of the lists in use, turned so that all are read from their greatest values.
        limits = np.where(up[:, None], self.high[own], -self.low[own])
        now = np.where(up, self.most[own], -self.least[own])
        # share[m, d]: what dimension d adds to the bound under multiplier m, at most, if a component is `now` at most.
        norm = float(np.sqrt((size * size).sum()))
        m = MULTIPLIERS * max(norm, 1e-300) / max(self.length, 1e-9)
        part = lambda t: np.minimum(t, size / m[:, None])
        share = size * part(now) - m[:, None] / 2 * part(now) ** 2
        fixed = m / 2 * self.length**2
        at, lists = np.zeros(len(which), np.int64), np.arange(len(which))  # entries read
        seen = np.zeros(n, bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        mine = self.by_id[slice(*np.searchsorted(self.sorted_ids, [query_id, query_id + 1]))]
        seen[mine] = True
        others = unseen = n - len(mine)
        entries = ENTRIES
        while unseen:
            totals = fixed + share.sum(axis=1)
            tight = int(totals.argmin())
            bound = min(float(totals[tight]), float(size @ now))
            limit = max(floor, int(scores[-1])) if len(ids) == k else floor
            if bound + 1e-6 + 1e-9 * abs(bound) < limit:
                break
            if not len(which):  # every score is 0
                rows = np.arange(n)
            else:
                # Of the steps of about so many entries (or a list's rest) the one with the greatest fall of the bound for an entry.
                best = m[tight]
                places = np.minimum(np.searchsorted(self.ends, at + entries), len(self.ends) - 1)
                ahead = limits[lists, places]
                reach = np.minimum(ahead, size / best)
                fall = share[tight] - (size * reach - best / 2 * reach**2)
                d = int(np.where(at < n, fall / np.maximum(self.ends[places] - at, 1), -1.0).argmax())
                start, stop = at[d], self.ends[places[d]]
                one = self.lists[which[d]]
                rows = one[n - stop : n - start] if up[d] else one[start:stop]
                at[d], now[d] = stop, ahead[d]
                reach = np.minimum(now[d], size[d] / m)
                share[:, d] = size[d] * reach - m / 2 * reach**2
                entries *= GROW
            rows = rows[~seen[rows]]
            seen[rows] = True
            unseen -= len(rows)
            found = self.scores(rows, q)
            keep = found >= limit
            if np.count_nonzero(keep) > 4 * k:  # what is below the k-th of these cannot stay, so only the rest is sorted
                keep &= found >= np.partition(found, -k)[-k]
            ids, scores = np.concatenate([ids, self.ids[rows[keep]]]), np.concatenate([scores, found[keep]])
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
        return ids, scores, others - unseen


def floors(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """For each row the k-th score among the other rows, less than which no result of its search can be."""
    lists = SortedLists(ids, vectors)
    found = [lists.best(i, q, k)[1] for i, q in zip(ids, vectors, strict=True)]
    return np.array([s[-1] if len(s) == k else LEAST for s in found], np.int64)


def _packed(width: int, k: int):
    """Rows of a partition as blocks: ids and vectors as bytes, vectors of one length in a block; k: and their floors, if it is not 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"ids": pa.binary(), "vectors": pa.binary(), "dims": pa.int32(), "floors": pa.binary()})

        def block(ids, vectors, dims):
            ids, vectors = np.array(ids, np.int64), np.array(vectors, np.int64)
            low = floors(ids, vectors, k) if k else np.empty(0, np.int64)
            return make([ids.tobytes()], [vectors.tobytes()], [dims], [low.tobytes()])

        open_: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, vectors = open_.setdefault(len(v), ([], []))
                ids.append(i)
                vectors.append(v)
                if len(ids) >= width:
                    yield block(*open_.pop(len(v)), len(v))
        for dims, (ids, vectors) in open_.items():
            yield block(ids, vectors, dims)

    return run


def blocks(rows: DataFrame, width: int, n: int, k: int = 0) -> DataFrame:
    """block, ids, vectors, dims, floors. Rows are dealt round-robin, so copies and hot ids spread."""
    dealt = rows.repartition(max(1, -(-n // width)))
    return dealt.mapInArrow(_packed(width, k), "ids binary, vectors binary, dims int, floors binary").withColumn("block", F.xxhash64("ids", "vectors", "dims"))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"query_id": pa.int64(), "query_key": pa.int64(), "vec_id": pa.int64(), "score": pa.int64(), "scored": pa.int64()})
        last, lists = None, None
        for batch in batches:
            for r in batch.to_pylist():
                as_rows = lambda b, d=r["dims"]: np.frombuffer(b, np.int64).reshape(-1, d)
                if (r["ids"], r["vectors"], r["dims"]) != last:  # rows of a block follow each other, so its lists are sorted once
                    last = (r["ids"], r["vectors"], r["dims"])
                    lists = SortedLists(np.frombuffer(r["ids"], np.int64), as_rows(r["vectors"]))
                query_ids, queries, low = np.frombuffer(r["query_ids"], np.int64), as_rows(r["query_vectors"]), np.frombuffer(r["floors"], np.int64)
                found = [lists.best(i, q, k, f) for i, q, f in zip(query_ids, queries, low.tolist(), strict=True)]
                # A row without a vec_id says how much was scored, also where nothing was found.
                sizes = [len(ids) + 1 for ids, _, _ in found]
                keys = [xxhash.xxh64_intdigest(q.tobytes()) >> 1 for q in queries]  # tells rows of one vec_id apart
                yield make(
                    np.repeat(query_ids, sizes), np.repeat(np.array(keys, np.int64), sizes),
                    [x for ids, _, _ in found for x in (None, *ids.tolist())], [x for _, scores, _ in found for x in (None, *scores.tolist())],
                    [x for ids, _, done in found for x in (done, *[0] * len(ids))],
                )

    return run


def searched(vectors: DataFrame, every: int, k: int, scale: int) -> DataFrame:
    """query_id, query_key, vec_id, score, scored: the best of each block for each query, and how many vectors of it were scored."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite & (F.size("embedding") > 0))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct()
    n = rows.agg(F.count("*"), F.count_if(F.pmod("vec_id", F.lit(every)) == 0)).first()
    own, queries = blocks(rows, BLOCK, n[0]), blocks(asked, QUERIES, n[1], k)
    # Every query block goes to every block of candidates: this is the stated search of all rows, in blocks.
    # A task meets the blocks of one slot with at most about TOGETHER query blocks, whatever their number.
    slots, groups = max(1, -(-n[0] // BLOCK)), max(1, -(-n[1] // (QUERIES * TOGETHER)))
    dealt = lambda df, name, size: df.withColumn(name, F.pmod("block", F.lit(size)).cast("int"))
    each = lambda df, name, size: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    own = each(dealt(own, "slot", slots), "group", groups).select("slot", "group", "dims", "ids", "vectors")
    queries = queries.select("block", "dims", "floors", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"))
    queries = each(dealt(queries, "group", groups), "slot", slots).drop("block")
    pairs = own.join(queries.hint("merge"), ["slot", "group", "dims"]).select("dims", "ids", "vectors", "query_ids", "query_vectors", "floors")
    return pairs.mapInArrow(_search(k), "query_id long, query_key long, vec_id long, score long, scored long")


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score; queries are the rows of vectors (vec_id, embedding) whose vec_id is divisible by every."""
    small_batches(vectors.sparkSession, 16)
    found = searched(vectors, every, k, scale).where("vec_id IS NOT NULL")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def scored_share(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, query_key and scored: how many vectors its search scored, of all blocks."""
    small_batches(vectors.sparkSession, 16)
    return searched(vectors, every, k, scale).groupBy("query_id", "query_key").agg(F.sum("scored").alias("scored"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def oracle_op7() -> str:
    return """
    WITH e AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    x AS (SELECT r, vec_id, unnest(range(1, len(v) + 1)) AS d, unnest(v) AS c FROM e),
    s AS (SELECT q.vec_id AS query_id, c.r, c.vec_id, CAST(sum(q.c * c.c) AS BIGINT) AS score FROM x q JOIN x c ON q.d = c.d AND q.vec_id <> c.vec_id
        WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, c.r, c.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""
