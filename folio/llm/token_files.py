"""Token ids as flat files of unsigned integers with 64-bit document offsets, to be memory-mapped.

Documents are dealt to tasks by ranges of doc_id and sorted there. Each task encodes its texts and writes three files of
little-endian numbers: <name>.ids, the ids of all its documents without anything between (16 bits each if the
vocabulary allows, else 32); <name>.offsets, for each document the number of ids before it in the file, and the number of all at
the end (64 bits); <name>.docs, the doc_ids (64 bits, signed). A manifest has one row for each task that succeeded: where a
task ran twice, or lost its executor, only files that the manifest names count. Bases, the ids and documents in
the files before, are prefix sums over the manifest, which is a table beside the files. The folder is a path or URI that
pyarrow's file systems know, as tasks write files there that Spark has no writer for.

Defined cases: a null or empty text is one end id; a null doc_id comes first (the manifest counts them, and their place in .docs
is 0); rows of one doc_id are ordered by a hash of their text, repeated rows come each, and both may spread over
tasks; an empty table gives no file and an empty result; other columns are ignored. Texts are encoded whole.

Ids are those of `tokenizers` for the whole text. Its split never crosses white space, nor a border between letters
and other signs outside of contractions, so each piece between such borders is encoded once for each worker and remembered; texts
with an added token, or with characters for which this is not sure, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folio.llm.common import batches_of, shared_folder, small_batches, table, texts

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Pieces that a Python worker remembers; then it begins anew, and forgets those of before that do not come again meanwhile.
REMEMBERED = 500_000
#: The normalisers and the split for which white space and letters are borders.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
END_OF_WORD = "</w>"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters whose lower case, normal form and kind of white space are beyond doubt: the first 256 but for separators that
#: only Python takes for white space, and the micro sign.
SURE = re.compile("[\x00-\x1b\x20-\xb4\xb6-\xff]*")
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Texts whose pieces are looked up together.
SLICE = 32
LETTERS = "a-zªºß-öø-ÿ"
PIECES = re.compile(f"[{LETTERS}]+|[^{LETTERS}]+")


class Encoder:
    """Ids as bytes of one type, by the tokenizer in its default setting without special tokens of its own."""

    def __init__(self, path: str, end: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks of an executor are parallel already
        with open(path, encoding="utf-8") as f:
            own = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        split = (own.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.apart = (own.get("normalizer") or {}).get("normalizers") == NORMALIZERS and split[0].get("pattern") == {"Regex": SPLIT} and split[0].get("behavior") == "Removed"
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = id_type(path, end)
        vocabulary = self.tokenizer.get_vocab()
        self.apart = self.apart and own["model"].get("end_of_word_suffix") == END_OF_WORD
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END_OF_WORD)]] = True
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _encode(self, all_: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(all_, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Words of letters in one call: the last token of each is one that ends a word."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        ends = (np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize
        if len(ends) != len(words):
            return self._encode(words)
        data, ends = ids.tobytes(), ends.tolist()
        return [data[x:y] for x, y in zip([0, *ends], ends)]

    def _learn(self, new: list[str]) -> None:
        """Remembers pieces without white space; one without an apostrophe is put together from its runs of letters and of other signs."""
        again = [p for p in new if p in self.before]
        self.known.update({p: self.before[p] for p in again})
        new = set(new).difference(again)
        words = {p for p in new if p.isalpha()}
        parts = {p: [p] if "'" in p else PIECES.findall(p) for p in new.difference(words)}
        runs = {r for own in parts.values() for r in own}.difference(self.known)
        alone = [r for r in runs if not r.isalpha()]
        words = list(words.union(runs.difference(alone)))
        self.known.update(zip(words, self._encode_words(words), strict=True))
        self.known.update(zip(alone, self._encode(alone), strict=True))
        for p, own in parts.items():
            if len(own) > 1:
                self.known[p] = b"".join([self.known[r] for r in own])

    def _is_sure(self, text: str) -> bool:
        if not self.apart or any(a in text for a in self.added):
            return False
        return not any(c in text for c in SEPARATORS) if text.isascii() else SURE.fullmatch(text) is not None

    def of(self, texts_: list[str]) -> list[bytes]:
        sure = [self._is_sure(t) for t in texts_]
        whole = iter(self._encode([t for t, s in zip(texts_, sure, strict=True) if not s]))
        out = []
        for at in range(0, len(texts_), SLICE):
            parts = [t.lower().split() if s else [] for t, s in zip(texts_[at : at + SLICE], sure[at : at + SLICE], strict=True)]
            if len(self.known) > REMEMBERED:  # what is asked for again stays
                self.before, self.known = self.known, {}
            # The pieces of a few texts fit the processor's cache, all that is remembered does not.
            pieces = set().union(*parts)
            ids = dict(zip(pieces, map(self.known.get, pieces), strict=True))
            if new := [p for p, x in ids.items() if x is None]:
                self._learn(new)
                ids.update(zip(new, map(self.known.__getitem__, new), strict=True))
            out += [b"".join(map(ids.__getitem__, p)) if s else next(whole) for p, s in zip(parts, sure[at : at + SLICE], strict=True)]
        return out


@lru_cache(maxsize=4)
def id_type(path: str, end: int) -> str:
    """The type code of ids: H for 16 bits, I for 32."""
    return "H" if max(end, *Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else "I"


@lru_cache(maxsize=2)
def encoder(path: str, end: int) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, end)


def place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def opened(folder: str, name: str) -> pa.NativeFile:
    """A file of the folder: memory-mapped where the folder is mounted, else read by ranges."""
    fs, path = place(folder)
    return pa.memory_map(f"{path}/{name}") if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_file(f"{path}/{name}")


def numbers(file: pa.NativeFile, kind: str, start: int, n: int) -> np.ndarray:
    """n numbers of the file from place start on; a view of it if it is memory-mapped."""
    file.seek(start * np.dtype(kind).itemsize)
    return np.frombuffer(file.read_buffer(n * np.dtype(kind).itemsize), kind)


def _writing(folder: str, path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, last = TaskContext.get().partitionId(), encoder(path, end), array(id_type(path, end), [end]).tobytes()
        width, name, out, docs, n, nulls = len(last), f"{part:06d}-{uuid.uuid4().hex}", None, 0, 0, 0
        for batch, all_ in texts(batches, "text"):
            if not all_:
                continue
            if out is None:
                fs, at = place(folder)
                fs.create_dir(at, recursive=True)
                out = {kind: fs.open_output_stream(f"{at}/{name}.{kind}") for kind in ("ids", "offsets", "docs")}
                out["offsets"].write(np.zeros(1, "<u8").tobytes())
            ids = [x + last for x in own.of(all_)]
            ends = n + np.cumsum([len(x) // width for x in ids])
            out["ids"].write(b"".join(ids))
            out["offsets"].write(ends.astype("<u8").tobytes())
            doc_ids = batch.column("doc_id")
            out["docs"].write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            docs, n, nulls = docs + len(ids), int(ends[-1]), nulls + doc_ids.null_count
        if out is not None:
            for file in out.values():
                file.close()
            make = batches_of({"part": pa.int32(), "name": pa.string(), "docs": pa.int64(), "ids": pa.int64(), "nulls": pa.int64(), "width": pa.int32()})
            yield make([part], [name], [docs], [n], [nulls], [width])

    return run


def write(docs: DataFrame, folder: str, path: str | None = None, end: int = END_ID) -> DataFrame:
    """Writes the files of docs (doc_id, text) below folder, which all executors share, and returns the manifest."""
    spark = docs.sparkSession
    small_batches(spark)
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.selectExpr("CAST(doc_id AS long) doc_id", "text", "xxhash64(text) _h", "monotonically_increasing_id() _row")
    order = [F.asc_nulls_first("doc_id"), "_h", "_row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = "part int, name string, docs long, ids long, nulls long, width int"
    dealt.mapInArrow(_writing(folder, path, end), schema).write.parquet(f"{folder}/parts")
    parts = spark.read.schema(schema).parquet(f"{folder}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    bases = parts.select("*", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"), F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("doc_base"))
    bases.write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """part, name, docs, ids, nulls, width (bytes of an id), base and doc_base (ids and documents before) of files that were written."""
    return spark.read.schema("part int, name string, docs long, ids long, nulls long, width int, base long, doc_base long").parquet(f"{folder}/manifest")


class Reader:
    """The documents of one row of a manifest."""

    def __init__(self, folder: str, row):
        self.row, self.kind = row, f"<u{row['width']}"
        self._ids, self._offsets, self._docs = (opened(folder, f"{row['name']}.{kind}") for kind in ("ids", "offsets", "docs"))

    def offsets(self, at: int, n: int) -> np.ndarray:
        """Where the documents from the at-th on begin in the file, and where the last of the n ends."""
        return numbers(self._offsets, "<u8", at, n + 1).astype(np.int64)

    def docs(self, at: int, n: int) -> list[int | None]:
        return [None if at + i < self.row["nulls"] else x for i, x in enumerate(numbers(self._docs, "<i8", at, n).tolist())]

    def ids(self, start: int, n: int) -> np.ndarray:
        return numbers(self._ids, self.kind, start, n)


#: Documents whose offsets are read at a time.
AT_ONCE = 4096


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 (and ids) of each document, from the files."""
    rows = manifest(spark, folder)
    types = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()} | ({"ids": pa.list_(pa.int64())} if with_ids else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of(types)
        for row in (r for batch in batches for r in batch.to_pylist()):
            file = Reader(folder, row)
            for at in range(0, row["docs"], AT_ONCE):
                n = min(AT_ONCE, row["docs"] - at)
                ends = file.offsets(at, n)
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                crcs = [zlib.crc32(file.ids(a, b - a).astype("<u4").tobytes()) for a, b in spans]
                ids = [[file.ids(a, b - a).tolist() for a, b in spans]] if with_ids else []
                yield make(file.docs(at, n), row["base"] + ends[:-1], np.diff(ends), crcs, *ids)

    dealt = rows.repartition(max(1, rows.count()))  # a file is read where it falls
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


class TokenFiles:
    """All files of a folder as one run of ids, for training loops: any span of it, from memory-mapped files."""

    def __init__(self, folder: str, rows: list):
        """rows: those of the manifest."""
        self.rows = sorted(rows, key=lambda r: r["part"])
        self.files = [Reader(folder, r) for r in self.rows]
        self.bases = np.array([r["base"] for r in self.rows] + [self.rows[-1]["base"] + self.rows[-1]["ids"] if rows else 0], np.int64)
        self.doc_bases = np.array([r["doc_base"] for r in self.rows], np.int64)

    def __len__(self) -> int:
        return int(self.bases[-1])

    def span(self, start: int, n: int) -> np.ndarray:
        """n ids from place start on, over borders of files."""
        out, k = [], int(np.searchsorted(self.bases, start, "right")) - 1
        n = min(n, len(self) - start)
        while n > 0:
            at = start - int(self.bases[k])
            out.append(self.files[k].ids(at, min(n, self.rows[k]["ids"] - at)))
            start, n, k = start + len(out[-1]), n - len(out[-1]), k + 1
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def document(self, i: int) -> tuple[int | None, np.ndarray]:
        """doc_id and ids of the i-th document."""
        k = int(np.searchsorted(self.doc_bases, i, "right")) - 1
        at = i - int(self.doc_bases[k])
        start, end = self.files[k].offsets(at, 1).tolist()
        return self.files[k].docs(at, 1)[0], self.files[k].ids(start, end - start)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/folio-tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), folder)
    return read(spark, folder)
