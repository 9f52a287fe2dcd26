"""Best-fit packing of documents into sequences of LIMIT tokens: patterns by non-negative least squares.

A document is its token ids and one end id. Longer ones are cut into pieces of LIMIT tokens, the first of
which takes the remainder. What is packed are lengths: their histogram has LIMIT bins at any input size.
Patterns of two to four documents are enumerated: every pair of lengths, alone and with the greatest lengths that
still fit. Their repeat counts are fitted to the histogram by non-negative least squares, first of the patterns
that fill a sequence, then also of those that leave some room, more in each of the steps. Counts are rounded
down, and the rest is packed best-fit, longest first, many equal lengths at a time. The outcome is a table of
intervals: pieces of a length, from one rank to another among their length, go to consecutive sequences at one
offset. Ranks are counted in each input partition and shifted by the counts of the partitions before it, so no
task sees all pieces.

Ids are those of `tokenizers` for the whole text. Its split never joins what is before a white space and
after it, or letters and the punctuation after them, so each piece between such borders is encoded by it once for each
worker and remembered; texts with an added token, or with a character that only one of the two libraries takes for white space, are encoded whole.

Defined cases: a null text is empty and is one end id; a null doc_id is kept; repeated rows are packed
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folio.llm.common import batches_of, sent, small_batches, table, texts, written

LIMIT = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Bytes of pieces and ids that a Python worker remembers; then it forgets them all.
REMEMBERED = 16 << 20
#: Letters of the first 256 code points, and signs that are neither letters, digits nor white space.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", re.escape(string.punctuation)
#: Letters before a sign or white space, signs before white space, another run without white space (letters and such
#: runs with the space before them), or what is left of a run of white space. No token reaches over such a border.
BETWEEN = re.compile(rf" ?[{LETTERS}]+(?=[\s{SIGNS}])|[{SIGNS}]+(?=\s|\Z)| ?\S+|\s+(?!\S)|\s+")

#: What Python takes for white space and the tokenizer's expression does not.
ODD = re.compile("[\x1c-\x1f]")


class Ids:
    """Token ids as bytes, four each, by the tokenizer in its default setting, without special tokens of its own."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks of an executor are parallel already
        with open(path, encoding="utf-8") as f:
            split = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        own = split.get("pre_tokenizer") or {}
        self.apart = split.get("normalizer") is None and own.get("type") == "ByteLevel" and own.get("use_regex", True) and not own.get("add_prefix_space", True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Bytes of each token: a token's characters stand for one byte each.
        self.bytes = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _learn(self, new: list[str]) -> None:
        """Encodes pieces in one call, each as a word of its own; where the ids of each end follows from their bytes."""
        if new:
            ids = np.array(self.tokenizer.encode_batch_fast([new], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum([len(part.encode()) for part in new])) + 1
            data, start = ids.tobytes(), 0
            for part, end in zip(new, (4 * ends).tolist(), strict=True):
                self.known[part] = data[start:end]
                start = end
            self.size += len(data) + sum(map(len, new))

    def _is_whole(self, text: str) -> bool:
        return not self.apart or any(t in text for t in self.added) or bool(ODD.search(text))

    def of(self, texts_: list[str]) -> list[bytes]:
        parts = [None if self._is_whole(t) else BETWEEN.findall(t) for t in texts_]
        if self.size > REMEMBERED:
            self.known, self.size = {}, 0
        self._learn(list(set().union(*filter(None, parts)).difference(self.known)))
        whole = iter(self.tokenizer.encode_batch_fast([t for t, p in zip(texts_, parts, strict=True) if p is None], add_special_tokens=False))
        return [array("I", next(whole).ids).tobytes() if p is None else b"".join(map(self.known.__getitem__, p)) for p in parts]


@lru_cache(maxsize=2)
def encoder(path: str) -> Ids:
    """One for each Python worker."""
    return Ids(path)


def ids_of(texts_: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text, and the end id."""
    end = np.array([END_ID], "<u4").tobytes()
    return [np.frombuffer(ids + end, "<u4") for ids in encoder(path).of(texts_)]


def cuts(n: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n if n <= limit else n % limit or limit
    return [(0, first)] + [(at, limit) for at in range(first, n, limit)]


def pieces(docs: DataFrame, path: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """A row for each piece; part and local: its input partition, and its rank there among pieces of its length."""
    small_batches(docs.sparkSession)
    types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "part": pa.int32(), "local": pa.int64()}
    types |= {"ids": pa.list_(pa.int64())} if with_ids else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, make, ranks = TaskContext.get().partitionId(), batches_of(types), [0] * (limit + 1)
        for batch, all_ in texts(batches, "text"):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of(all_, path), strict=True):
                for k, (start, n) in enumerate(cuts(len(ids), limit)):
                    own = ids[start : start + n]
                    row = (doc_id, k, start, n, zlib.crc32(own.tobytes()), part, ranks[n])
                    ranks[n] += 1
                    rows.append((*row, own.tolist()) if with_ids else row)
            if rows:
                yield make(*zip(*rows, strict=True))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long" + ", ids array<long>" * with_ids
    return docs.selectExpr("CAST(doc_id AS long) doc_id", "text").mapInArrow(run, schema)


#: Room that patterns may leave in each step of the fit, as divisors of the limit; 0 for none.
ROOM = (0, 512, 128, 32, 8)
#: A pattern that would lessen the squares by less than this many pieces is not taken up, and one of a smaller count goes.
HALF = 0.5
#: Patterns that one step takes up at most, and steps in all.
AT_ONCE, STEPS = 256, 400


def patterns_of(histogram: np.ndarray) -> np.ndarray:
    """Rows of four lengths that are there, longest first, 0 for none: each pair that fits, also with the greatest
    third length that still fits, and also with the greatest fourth. At most 1.5 times the square of the limit."""
    limit = len(histogram) - 1
    there = np.flatnonzero(histogram[:limit] * (np.arange(limit) > 0))
    fits = np.zeros(limit + 1, np.int64)
    fits[there] = there
    fits = np.maximum.accumulate(fits)
    a, b = (x.ravel() for x in np.meshgrid(there, there, indexing="ij"))
    a, b = (x[(b <= a) & (a + b <= limit)] for x in (a, b))
    c = fits[np.minimum(b, limit - a - b)]
    d = fits[np.minimum(c, limit - a - b - c)]
    none = np.zeros_like(a)
    return np.unique(np.concatenate([np.stack(x, axis=1) for x in ((a, b, none, none), (a, b, c, none), (a, b, c, d))]), axis=0)[::-1]


def fitted(histogram: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of patterns and their repeat counts x >= 0 that minimise |A x - histogram|, below the limit.

    Column p of A counts the lengths of pattern p. The active-set method: patterns with the steepest descent are
    taken up, those of different lengths at once, the squares are minimised over what is taken up, and on
    the way there what reaches 0 goes. It ends when no pattern would lessen the squares by HALF a piece.
    """
    limit = len(histogram) - 1
    wanted = histogram.astype(np.float64)
    wanted[[0, limit]] = 0
    room = limit - patterns.sum(axis=1)
    used, x = np.empty(0, np.int64), np.empty(0)
    a, gram = np.zeros((limit + 1, 0)), np.zeros((0, 0))
    steps = 0
    for divisor in ROOM:
        open_ = np.flatnonzero(room <= (limit // divisor if divisor else 0))
        single = False
        while steps < STEPS:
            steps += 1
            rest = wanted - a @ x
            rest[0] = 0
            descent = rest[patterns[open_]].sum(axis=1)
            descent[np.isin(open_, used, assume_unique=True)] = 0
            best = open_[np.argsort(-descent, kind="stable")[: min(16 * AT_ONCE, np.count_nonzero(descent > HALF))]]
            more, taken = [], np.zeros(limit + 1, bool)
            for p in best:
                own = patterns[p][patterns[p] > 0]
                if not taken[own].any():
                    taken[own] = True
                    more.append(p)
                if len(more) >= (1 if single else AT_ONCE):
                    break
            if not more:
                break
            new = np.zeros((limit + 1, len(more)))
            for k in range(patterns.shape[1]):
                np.add.at(new, (patterns[more, k], np.arange(len(more))), 1)
            new[0] = 0
            side = a.T @ new
            gram = np.block([[gram, side], [side.T, new.T @ new]])
            a, used, x = np.hstack([a, new]), np.concatenate([used, more]), np.concatenate([x, np.zeros(len(more))])
            before = float((rest**2).sum())
            while True:
                goal = np.linalg.solve(gram + 1e-7 * np.eye(len(used)), a.T @ wanted)
                low = goal <= 0
                if not low.any():
                    x = goal
                    break
                x = x + np.min(x[low] / np.maximum(x[low] - goal[low], 1e-300)) * (goal - x)
                stay = ~(low & (x <= HALF))
                a, used, x, gram = a[:, stay], used[stay], x[stay], gram[np.ix_(stay, stay)]
            if float(((wanted - a @ x) ** 2).sum()) < before * (1 - 1e-4):
                single = False
            elif single:
                break
            else:  # patterns that were taken up together undid each other
                single = True
    return used, x


class Plan:
    """Intervals (length, from rank, to rank, first sequence, offset); sequences, the number of them."""

    def __init__(self, histogram: np.ndarray, counts: list[tuple[tuple[int, ...], float]]):
        """histogram[n]: pieces of length n, its last bin is the limit; counts: patterns and how often each is used."""
        self.limit = len(histogram) - 1
        self.left = [int(x) for x in histogram]
        self.rank = [0] * (self.limit + 1)
        self.intervals: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.room: dict[int, list[tuple[int, int]]] = {}  # free tokens: runs of (first sequence, how many)
        self._by_patterns(counts)
        self._best_fit()

    def _put(self, length: int, n: int, sequence: int, offset: int) -> None:
        if n:
            self.intervals.append((length, self.rank[length], self.rank[length] + n, sequence, offset))
            self.rank[length] += n
            self.left[length] -= n

    def _by_patterns(self, counts: list[tuple[tuple[int, ...], float]]) -> None:
        for pattern, x in counts:
            n = min([int(x), *(self.left[m] // pattern.count(m) for m in pattern)])
            if n < 1:
                continue
            offset = 0
            for length in pattern:
                self._put(length, n, self.sequences, offset)
                offset += length
            if offset < self.limit:
                self.room.setdefault(self.limit - offset, []).append((self.sequences, n))
            self.sequences += n

    def _best_fit(self) -> None:
        """Longest first, each into the fullest sequence that takes it; equal lengths and equal sequences at a time."""
        room = self.room

        def fill(length: int, free: int, first: int, n: int) -> None:
            """Of n sequences with so many free tokens, fills as many as pieces are left for; the rest keep their room."""
            each = free // length
            full = min(n, self.left[length] // each)
            for k in range(each):
                self._put(length, full, first, self.limit - free + k * length)
            if full and free > each * length:
                room.setdefault(free - each * length, []).append((first, full))
            some = min(self.left[length], each) if full < n else 0
            for k in range(some):
                self._put(length, 1, first + full, self.limit - free + k * length)
            if some and free > some * length:
                room.setdefault(free - some * length, []).append((first + full, 1))
            if n > full + bool(some):
                room.setdefault(free, []).append((first + full + bool(some), n - full - bool(some)))

        for length in range(self.limit, 0, -1):
            while self.left[length]:
                best = min((free for free in room if free >= length), default=None)
                if best is None:
                    n = -(-self.left[length] // (self.limit // length))
                    first, self.sequences = self.sequences, self.sequences + n
                    fill(length, self.limit, first, n)
                else:
                    runs = room.pop(best)
                    for k, (first, n) in enumerate(runs):
                        if not self.left[length]:
                            room.setdefault(best, []).extend(runs[k:])
                            break
                        fill(length, best, first, n)


def plan_for(histogram: np.ndarray) -> Plan:
    """The fitted patterns, those with the longest lengths first, and best-fit for the rest."""
    histogram = np.asarray(histogram, np.int64)
    patterns = patterns_of(histogram)
    used, x = fitted(histogram, patterns)
    order = np.argsort(used)  # patterns are sorted, longest first
    return Plan(histogram, [(tuple(int(n) for n in patterns[used[i]] if n), float(x[i])) for i in order])


def pack(docs: DataFrame, path: str | None = None, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(VOCABULARY)
    rows = written(pieces(docs, path, limit, with_ids), "pack-pieces")
    counted = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counted.select("part", "length", F.coalesce(before, F.lit(0)).alias("shift"))
    histogram = np.zeros(limit + 1, np.int64)
    for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # limit rows
        histogram[r.length] = r.n
    plan = plan_for(histogram)
    # Their number follows from the numbers of patterns and lengths, whatever the input; its size is checked all the same.
    intervals = spark.createDataFrame(plan.intervals or [(0, 0, 0, 0, 0)], "length long, low long, high long, first long, offset long")
    ranked = rows.join(shifts, ["part", "length"]).withColumn("rank", F.col("local") + F.col("shift"))
    there = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(sent(intervals.withColumnRenamed("length", "_length"), len(plan.intervals)), (F.col("length") == F.col("_length")) & there)
    out = ["doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"]
    return placed.select(*out, *["ids"] * with_ids)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
