"""Exact deduplication by Grace hashing: hash tables that compare complete content, spilling what does not fit.

1. Each partition of the input streams through a table of bounded size; the first row of a text is its
   local leader. A hot text leaves one leader for each table, however many rows it has.
2. Leaders are dealt out by the hash of their text; where more than MANY have one hash, first by the hash and a
   salt, so that no task has all leaders of a hot text. In each task a table takes distinct texts up to its
   budget; rows that match are settled at once, the others go to FAN spill files by further bits of the
   hash, and each file is treated the same way, until what is left of it fits.
3. Groups of leaders give the row that stays, its group's size, and so each row's fate.

Spill files are the task's own scratch: they are removed with the task, and a lost executor's tasks read
their input again. Steps that several others use are tables in the shared folder.

Texts are equal if they are identical after lower-casing A-Z. Of equal rows the largest doc_id stays, of
rows with that doc_id the last. Defined cases: a null text is empty, and equal to an empty one; a null
doc_id is less than any other; repeated rows are one group with one row kept; an empty table gives an
empty result; extra columns are carried along untouched.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.common import batches_of, sent, small_batches, table, written

#: Bytes of distinct text that a table holds.
BUDGET = 32 << 20
#: Spill files of one step of partitioning.
FAN = 16
#: Leaders of one hash that go to one task; more are settled in SALTS groups first.
MANY, SALTS = 64, 64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(LOWER)


class ContentTable:
    """An open-addressing table from complete contents to a number, of at most `budget` bytes of content."""

    def __init__(self, budget: int = BUDGET):
        self.budget, self.bytes = budget, 0
        self.slots = np.full(1 << 10, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.values: list[int] = []

    def _slot(self, h: int, content: bytes | None) -> int:
        """The slot that holds the content, or the empty one where it belongs."""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if content is not None and self.hashes[entry] == h and self.contents[entry] == content:
                break
            at = (at + 1) & mask
        return at

    def find(self, h: int, content: bytes) -> int | None:
        entry = self.slots[self._slot(h, content)]
        return None if entry < 0 else self.values[entry]

    def add(self, h: int, content: bytes, value: int) -> bool:
        """Takes a content that is not there; False if it does not fit (the first always does)."""
        if self.contents and self.bytes + len(content) + 64 > self.budget:
            return False
        if 2 * len(self.contents) >= len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, np.int64)
            for entry, other in enumerate(self.hashes):
                self.slots[self._slot(other, None)] = entry
        self.slots[self._slot(h, content)] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.values.append(value)
        self.bytes += len(content) + 64
        return True


def grace(rows: Iterator[tuple[int, bytes, int]], budget: int = BUDGET, depth: int = 0) -> Iterator[tuple[int, int]]:
    """(value, value of the first row with that content) for each (hash, content, value)."""
    contents = ContentTable(budget)
    with ExitStack() as stack:
        files: list = []
        for h, content, value in rows:
            first = contents.find(h, content)
            if first is None and not files and contents.add(h, content, value):
                first = value
            if first is not None:
                yield value, first
                continue
            if not files:  # the table is full: all that it does not know is partitioned from now on
                folder = stack.enter_context(tempfile.TemporaryDirectory(prefix="grace-"))
                files = [stack.enter_context(open(os.path.join(folder, str(i)), "w+b")) for i in range(FAN)]
            # Each depth takes other bits; after 16 of them the hash is salted anew.
            bits = (h >> (4 * depth + 4)) if depth < 14 else xxhash.xxh64_intdigest(content, seed=depth)
            f = files[bits % FAN]
            f.write(struct.pack("<QQQ", h, value, len(content)))
            f.write(content)
        contents = None
        for f in files:
            f.seek(0)
            yield from grace(_spilled(f), budget, depth + 1)
            f.truncate(0)


def _spilled(f) -> Iterator[tuple[int, bytes, int]]:
    while head := f.read(24):
        h, value, n = struct.unpack("<QQQ", head)
        yield h, f.read(n), value


def _local(schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seen = TaskContext.get().partitionId() << 40, 0
        contents = ContentTable()
        for batch in batches:
            rid, gid, hashes, shas, lead = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                content = normalised(text)
                h = xxhash.xxh64_intdigest(content)
                row = base + seen
                seen += 1
                first = contents.find(h, content)
                if first is None:
                    if not contents.add(h, content, row):
                        contents = ContentTable()  # a text that comes again has a second leader, which step 2 joins to the first
                        contents.add(h, content, row)
                    first = row
                rid.append(row)
                gid.append(first)
                hashes.append(h - (1 << 64) if h >> 63 else h)
                shas.append(hashlib.sha256(content).hexdigest())
                lead.append(first == row)
            more = [pa.array(rid, pa.int64()), pa.array(gid, pa.int64()), pa.array(hashes, pa.int64()), pa.array(shas, pa.string()), pa.array(lead, pa.bool_())]
            names = [*batch.schema.names, *(f.name for f in schema.fields)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=names)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for gid, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                yield h & ((1 << 64) - 1), normalised(text), gid

    make = batches_of({"gid": pa.int64(), "root": pa.int64()})
    gids, roots = [], []
    for gid, root in grace(rows()):
        gids.append(gid)
        roots.append(root)
        if len(gids) >= 10_000:
            yield make(gids, roots)
            gids, roots = [], []
    yield make(gids, roots)


#: Columns that fates() adds beside row.
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def _settled(leaders: DataFrame) -> DataFrame:
    """gid and root of leaders (gid, h, text), those of one hash in few tasks or in one."""
    # Hashes of many leaders: at most one in MANY of all, and their numbers only.
    hot = written(leaders.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select(F.col("h").alias("hot")), "dedup-hot")
    n = hot.count()
    settle = lambda df: df.select("gid", "h", "text").mapInArrow(_settle, "gid long, root long")
    if not n:
        return written(settle(leaders.repartition("h")), "dedup-roots")
    marked = leaders.join(sent(hot, n), F.col("h") == F.col("hot"), "left")
    salted = marked.where("hot IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("gid"), F.lit(SALTS))).repartition("h", "salt")
    first = written(settle(salted), "dedup-first")
    heads = first.where("gid = root").select(F.col("gid").alias("head"))
    left = marked.where("hot IS NOT NULL").join(sent(heads, n * SALTS), F.col("gid") == F.col("head"), "left_semi")
    last = written(settle(marked.where("hot IS NULL").unionByName(left).repartition("h")), "dedup-roots")
    later = first.where("gid <> root").select(F.col("gid").alias("own"), F.col("root").alias("at"))
    return last.unionByName(later.join(last, F.col("at") == F.col("gid")).select(F.col("own").alias("gid"), "root"))


def fates(docs: DataFrame) -> DataFrame:
    """row (a struct of the columns of docs), and keep_id, group_size, kept and text_sha256 (of the normalised text)."""
    small_batches(docs.sparkSession)
    own = T.StructType(
        [T.StructField("rid", T.LongType()), T.StructField("gid", T.LongType()), T.StructField("h", T.LongType()), T.StructField("text_sha256", T.StringType()), T.StructField("lead", T.BooleanType())]
    )
    # The caller's row travels as one column, so that its names meet none of these; its text is beside it once.
    rest = [c for c in docs.columns if c != "text"]
    given = docs.select("doc_id", "text", F.struct(*rest).alias("rest"))
    rows = written(given.mapInArrow(_local(own), T.StructType(given.schema.fields + own.fields)), "dedup-rows")
    roots = _settled(rows.where("lead").select("gid", "h", "text"))
    local = rows.groupBy("gid").agg(F.max(F.struct("doc_id", "rid")).alias("last"), F.count("*").alias("n"))
    groups = local.join(roots, "gid").groupBy("root").agg(F.max("last").alias("last"), F.sum("n").alias("group_size"))
    each = roots.join(groups, "root").select("gid", F.col("last.doc_id").alias("keep_id"), F.col("last.rid").alias("keep"), "group_size")
    out = rows.join(each, "gid")
    row = F.struct(*[(F.col("text") if c == "text" else F.col("rest")[c]).alias(c) for c in docs.columns])
    return out.select(row.alias("row"), "keep_id", "group_size", (F.col("rid") == F.col("keep")).alias("kept"), "text_sha256")


def judged(docs: DataFrame) -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256; these replace columns that have their names."""
    return fates(docs.drop(*ADDED)).select("row.*", *ADDED)


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of docs."""
    return fates(docs).where("kept").select("row.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def oracle_op8() -> str:
    return """
    WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t"""
