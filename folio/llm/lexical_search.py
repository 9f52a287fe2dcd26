"""Ranked lexical search by a hierarchical max tree over document ranges for each term.

The index is a table of segments: a task that reads documents turns up to DOCS of them at a time into one row, which has
their ids and lengths and, for each of their terms, the places and counts of the documents that hold it. Building it
moves no text. Numbers that hold for the corpus (documents, lengths, documents with a term) are sums over these rows.

A search sends the items to the segments, in blocks. In a segment a term has a tree: its leaves are documents, with what the
term can add to a score there, and a node over FAN ranges has the greatest value among them. The bound of a
range of documents for an item is the weighted sum of its terms' nodes. The range with the highest bound is opened
first; a search ends when the highest bound is below the k-th best score, so ranges whose bound equals that score are
still opened, for ties. A task carries its k-th best score of an item from one segment to the next.

Terms are runs of letters and digits (ASCII) and of all that is not ASCII, A-Z lower-cased. Scores are whole numbers:
the sum over an item's distinct terms of w * ((10^9 tf) div (1000 tf + 8 m)), w = floor(1000 ln((2N + 2) / (2 df + 1))),
m = 10 + ((90 n N) div L).

Defined cases: a null or empty text, or one without a term, is no document and an item without a term finds nothing; rows
of documents that repeat are documents each; a null doc_id is found like others and comes last among equal scores; equal
item rows count once, items of one id and different texts are searched apart; empty tables give an empty result;
other columns are ignored. Very long texts are read whole, and a segment ends early when they fill it.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import batches_of, sent, small_batches, table, texts, written

FAN = 16
#: Documents of a segment, and (document, term) pairs after which it ends in any case.
DOCS, PAIRS = FAN**3, 2_000_000
#: Items of a block, about.
ITEMS = 1000
K = 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text as bytes of terms: A-Z in lower case, what separates terms as a space.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_SEGMENT = {"ids": pa.list_(pa.int64()), "lengths": pa.binary(), "terms": pa.list_(pa.string()), "counts": pa.list_(pa.int32()), "places": pa.binary(), "tfs": pa.binary(), "n_terms": pa.int64()}


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


class Building:
    """A segment that grows document by document."""

    def __init__(self):
        self.ids, self.lengths, self.numbers = [], [], defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.keys, self.tfs, self.pairs = [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = terms_of(text)
        if words:
            own, tfs = np.unique(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)), return_counts=True)
            self.keys.append(own * DOCS + len(self.ids))
            self.tfs.append(tfs)
            self.pairs += len(own)
            self.ids.append(doc_id)
            self.lengths.append(len(words))

    def full(self) -> bool:
        return len(self.ids) >= DOCS or self.pairs >= PAIRS

    def row(self) -> pa.RecordBatch:
        keys, tfs = np.concatenate(self.keys), np.concatenate(self.tfs)
        order = np.argsort(keys)
        keys, tfs = keys[order], tfs[order]
        lengths = np.array(self.lengths, np.int64)
        terms = [t.decode() for t in self.numbers]
        counts = np.bincount(keys // DOCS, minlength=len(terms)).astype(np.int32)
        return batches_of(_SEGMENT)([self.ids], [lengths.tobytes()], [terms], [counts], [(keys % DOCS).astype(np.uint16).tobytes()], [tfs.astype(np.uint32).tobytes()], [int(lengths.sum())])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = Building()
    for batch, all_ in texts(batches, "text"):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), all_, strict=True):
            now.add(doc_id, text)
            if now.full():
                yield now.row()
                now = Building()
    if now.ids:
        yield now.row()


def index(docs: DataFrame) -> DataFrame:
    """The segments of docs (doc_id, text), as a table in the shared folder."""
    small_batches(docs.sparkSession)
    rows = docs.selectExpr("CAST(doc_id AS long) doc_id", "text")
    schema = "ids array<long>, lengths binary, terms array<string>, counts array<int>, places binary, tfs binary, n_terms long"
    return written(rows.mapInArrow(_segments, schema), "search-index")


class Segment:
    """A segment whose terms get their trees when they are first asked for."""

    def __init__(self, row: dict, n: int, total: int):
        self.ids = row["ids"]
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.m8 = 8 * (10 + 90 * lengths * n // total)
        self.number = {t: i for i, t in enumerate(row["terms"])}
        self.ends = np.concatenate([[0], np.cumsum(row["counts"])])
        self.places, self.tfs = np.frombuffer(row["places"], np.uint16), np.frombuffer(row["tfs"], np.uint32)
        self.widths = [FAN]
        while self.widths[-1] < len(self.ids):
            self.widths.append(self.widths[-1] * FAN)
        self.trees: dict[str, list[np.ndarray] | None] = {}
        self.opened = 0

    def tree(self, term: str) -> list[np.ndarray] | None:
        """Levels from the root's children to the documents, or None if no document has the term."""
        if term not in self.trees:
            i = self.number.get(term)
            if i is None:
                self.trees[term] = None
            else:
                at, tf = self.places[self.ends[i] : self.ends[i + 1]], self.tfs[self.ends[i] : self.ends[i + 1]].astype(np.int64)
                level = np.zeros(self.widths[-1], np.int32)  # values are below 10^6
                level[at] = 1_000_000_000 * tf // (1000 * tf + self.m8[at])
                levels = [level]
                for _ in self.widths[1:]:
                    levels.append(levels[-1].reshape(-1, FAN).max(axis=1))
                self.trees[term] = levels[::-1]
        return self.trees[term]

    def search(self, asked: list[tuple[str, int]], k: int, best: list[tuple]) -> None:
        """Adds to best, the k best (-score, whether doc_id is null, doc_id) so far, what this segment has."""
        own = [(w, tree) for term, w in asked if (tree := self.tree(term))]
        if not own:
            return
        weights = np.array([w for w, _ in own], np.int64)
        levels = [np.stack([tree[0] for _, tree in own])] + [None] * (len(self.widths) - 1)
        floor = -best[-1][0] if len(best) == k else 1
        open_ = [(0, -1, 0)]  # the root: minus its bound, its level, its place
        while open_:
            bound, level, at = heapq.heappop(open_)
            if level >= 0 and -bound < floor:
                return
            self.opened += 1
            level += 1
            if levels[level] is None:
                levels[level] = np.stack([tree[level] for _, tree in own])
            sums = weights @ levels[level][:, at * FAN : (at + 1) * FAN]
            for i in np.flatnonzero(sums >= floor).tolist():
                place, value = at * FAN + i, int(sums[i])
                if level < len(levels) - 1:
                    heapq.heappush(open_, (-value, level, place))
                elif value >= floor:
                    doc_id = self.ids[place]
                    insort(best, (-value, doc_id is None, doc_id or 0))
                    if len(best) > k:
                        best.pop()
                    if len(best) == k:
                        floor = max(floor, -best[-1][0])


#: Items whose best documents a task holds at most; then it passes them on and begins anew.
HELD = 50_000


def _search(k: int, n: int, total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"item_id": pa.int64(), "item": pa.int64(), "doc_id": pa.int64(), "score": pa.int64()})
        best: dict[tuple, list[tuple]] = {}
        group, items = None, []

        def found() -> pa.RecordBatch:
            rows = [(*item, None if null else doc_id, -score) for item, own in best.items() for score, null, doc_id in own]
            best.clear()
            return make(*(list(x) for x in zip(*rows, strict=True))) if rows else make([], [], [], [])

        for batch in batches:
            for i in range(batch.num_rows):
                if (g := batch.column("group")[i].as_py()) != group:
                    group = g
                    items = [((x["item_id"], x["item"]), [(t["term"], t["w"]) for t in x["asked"]]) for x in batch.column("items")[i].as_py()]
                segment = Segment({c: batch.column(c)[i].as_py() for c in _SEGMENT if c != "n_terms"}, n, total)
                for item, asked in items:
                    segment.search(asked, k, best.setdefault(item, []))
                if len(best) > HELD:
                    yield found()
        yield found()

    return run


def item_terms(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0)))


def search(segments: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item of items (item_id, text) that score above 0."""
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item"), F.explode(item_terms(F.col("text"))).alias("term"))
    asked = written(own.distinct(), "search-items")
    totals = segments.agg(F.sum(F.size("ids").cast("long")), F.sum("n_terms")).first()
    n, total = totals[0] or 0, totals[1] or 0
    size = asked.agg(F.count("*"), F.count_distinct(F.struct("item_id", "item"))).first()
    # Documents with each term that is asked for: partial sums, then one row for each term.
    held = segments.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("t.terms", "t.counts")
    wanted = asked.select("term").distinct()
    df = held.join(sent(wanted, size[0]), F.col("terms") == F.col("term")).groupBy("term").agg(F.sum("counts").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = asked.join(df, "term").select("item_id", "item", "term", weight.alias("w")).where("w > 0")
    groups = max(1, -(-size[1] // ITEMS))
    each = weighted.groupBy("item_id", "item").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("asked"))
    blocks = each.groupBy(F.pmod(F.xxhash64("item_id", "item"), F.lit(groups)).cast("int").alias("group")).agg(F.collect_list(F.struct("item_id", "item", "asked")).alias("items"))
    # Every block of items goes to every segment: this is the stated search of all rows, in blocks.
    dealt = segments.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), *[c for c in _SEGMENT if c != "n_terms"])
    small_batches(segments.sparkSession, 4)  # a segment is a large row
    pairs = dealt.join(sent(blocks, size[0]), "group")
    found = pairs.mapInArrow(_search(k, n, total), "item_id long, item long, doc_id long, score long")
    order = Window.partitionBy("item_id", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def oracle_op11() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(text, '{upper}', '{lower}'), '{TERM}')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents WHERE text IS NOT NULL),
    d1 AS (SELECT r, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM d WHERE len(ws) > 0),
    c AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d1),
    i AS (SELECT DISTINCT item_id, text, unnest(list_distinct({words})) AS term FROM benchmark WHERE text IS NOT NULL),
    p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d1) WHERE term IN (SELECT term FROM i) GROUP BY 1, 2),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, nn),
    m AS (SELECT r, doc_id, 100 - 90 + ((90 * n * nn) // ll) AS m FROM d1, c),
    s AS (SELECT item_id, text, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM i JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""
