"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has one valid encoding, and so one valid last token; the table of these
last tokens is all that is stored. A new byte needs the tokens that end there (an Aho-Corasick automaton
finds them) and, for each, whether it may follow the last token of the prefix before it. Appends extend
the table and are exact; after an edit the table is kept up to the edit and computed on from there, until
it agrees with the old one over the length of the longest token, from where on the rest is the same.

Defined cases: null is empty and gives no ids; repeated rows each get their row; an empty table gives an
empty result; other columns are ignored. Texts are encoded whole, each match of the split pattern separately.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from folio.llm.common import batches_of, small_batches, table, texts

#: Distinct pieces whose ids a Python worker remembers; then it forgets them all.
REMEMBERED = 300_000
RANKS = "byte_bpe_multi_50k.tiktoken"


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Tokens by rank, the pair that each was merged from, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._side: dict[tuple[int, int], bool] = {}

    def parts(self, i: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of token i joined; null for a single byte."""
        if i not in self._parts:
            token = self.tokens[i]
            pieces = [token[j : j + 1] for j in range(len(token))]
            while len(pieces) > 2:
                found = [(self.ranks.get(a + b, i), j) for j, (a, b) in enumerate(zip(pieces, pieces[1:], strict=False))]
                rank, j = min(found)
                if rank >= i:
                    break  # no merge leads to this token; any cut will do, as no text has it
                pieces[j : j + 2] = [pieces[j] + pieces[j + 1]]
            self._parts[i] = (self.ranks[pieces[0]], self.ranks[b"".join(pieces[1:])]) if len(pieces) == 2 else None
        return self._parts[i]

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether the encoding of the bytes of a and b is just a, b.

        It is not, if a merge across the border comes before the merges that built a and b. The merges
        next to the border are undone from the last one on; a merge across the border must not come
        earlier than the one that was undone.
        """
        known = self._side.get((a, b))
        if known is not None:
            return known
        left, right, before = a, b, len(self.ranks) + 1
        answer = True
        while True:
            across = self.ranks.get(self.tokens[left] + self.tokens[right])
            if across is not None and across < before:
                answer = False
                break
            inner_left, inner_right = self.parts(left), self.parts(right)
            if inner_left is None and inner_right is None:
                break
            if inner_right is None or (inner_left is not None and left > right):
                before, left = left, inner_left[1]
            else:
                before, right = right + 1, inner_right[0]
        if len(self._side) > 1_000_000:
            self._side.clear()
        self._side[a, b] = answer
        return answer


class PrefixTable:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = [-1]  # of the empty prefix
        self.append(data)

    def append(self, more: bytes) -> None:
        at = len(self.data)
        self.data += more
        self._fill(at, None)

    def _fill(self, at: int, stop) -> None:
        """Computes the prefixes longer than at. stop(end): whether to end after the prefix of that length."""
        v, last = self.vocabulary, self.last
        del last[at + 1 :]
        start = max(0, at - v.longest + 1)  # no token that ends after at begins before it
        side, known = v.side_by_side, v._side
        for end, (i, n) in v.automaton.iter(self.data[start:].decode("latin-1")):
            end += start + 1
            if end <= at or len(last) > end:
                continue  # known, or its token is found
            if len(last) < end:
                raise ValueError("a byte has no token")
            before = last[end - n]
            if before < 0 or known.get((before, i)) or ((before, i) not in known and side(before, i)):
                last.append(i)
                if stop and stop(end):
                    return

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces data[start:end]; the number of prefixes that were computed."""
        old, tail, shift = self.last, len(self.data) - end, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        same = 0
        border = start + len(new)

        def settled(at: int) -> bool:
            nonlocal same
            same = same + 1 if at > border and old[at - shift] == self.last[at] else 0
            return same >= self.vocabulary.longest

        self._fill(start, settled)
        done = len(self.last) - 1
        if done < len(self.data):
            self.last += old[done - shift + 1 :]
        assert len(self.last) == len(self.data) + 1, tail
        return done - start

    def ids(self) -> list[int]:
        out, at, tokens = [], len(self.data), self.vocabulary.tokens
        while at:
            out.append(self.last[at])
            at -= len(tokens[out[-1]])
        return out[::-1]


#: Letters, digits and white space of these characters are the same for the standard library's patterns.
PLAIN = re.compile("[^\x00-\x1b\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-ɏ]")
PLAIN_SPLIT = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\sA-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-ɏ]+|\s+(?!\S)|\s+")
SPLIT = regex.compile(public_tokenizers.PATTERN)


def pieces(text: str) -> list[str]:
    """The matches of the split pattern, in order; the standard library is faster where it splits alike."""
    return (SPLIT if PLAIN.search(text) else PLAIN_SPLIT).findall(text)


class Encoder:
    """Texts to ids and back."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(ranks_of(path))
        self.known: dict[str, tuple[int, ...]] = {}

    def piece(self, piece: str) -> tuple[int, ...]:
        found = self.known.get(piece)
        if found is None:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            found = (whole,) if whole is not None else tuple(PrefixTable(self.vocabulary, data).ids())
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        return [i for p in pieces(text) for i in self.piece(p)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, make = encoder(path), batches_of({"doc_id": pa.int64(), "ids": pa.list_(pa.int32())})
        for batch, all_ in texts(batches, "text"):
            yield make(batch.column("doc_id"), [e.encode(t) for t in all_])

    return run


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of each text."""
    small_batches(docs.sparkSession)
    return docs.selectExpr("CAST(doc_id AS long) doc_id", "text").mapInArrow(_encoded(path or public_tokenizers.path(RANKS)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and data (binary) of each row of ids."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, make = encoder(path), batches_of({"doc_id": pa.int64(), "data": pa.binary()})
        for batch in batches:
            yield make(batch.column("doc_id"), [e.decode(ids or []) for ids in batch.column("ids").to_pylist()])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


class Digests(dict):
    """piece: its ids as text and the bytes that they decode to."""

    def __init__(self, e: Encoder):
        super().__init__()
        self.encoder = e

    def __missing__(self, piece: str) -> tuple[str, bytes]:
        ids = self.encoder.piece(piece)
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = found = (",".join(map(str, ids)), self.encoder.decode(ids))
        return found


@lru_cache(maxsize=2)
def digests(path: str) -> Digests:
    e = Encoder(path)
    e.known = {}
    return Digests(e)


def _digested(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = digests(path)
        make = batches_of({"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()})
        for batch, all_ in texts(batches, "text"):
            counts, ids_sha, data_sha = [], [], []
            for text in all_:
                found = list(map(of.__getitem__, pieces(text)))
                joined = ",".join([x[0] for x in found])
                counts.append(joined.count(",") + 1 if joined else 0)
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                data_sha.append(hashlib.sha256(b"".join([x[1] for x in found])).hexdigest())
                of.encoder.known.clear()  # this table remembers the pieces
            yield make(batch.column("doc_id"), counts, ids_sha, data_sha)

    return run


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what encode() and decode() give, made piece by piece, so that ids need not leave the worker."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").selectExpr("CAST(doc_id AS long) doc_id", "text")
    return docs.mapInArrow(_digested(public_tokenizers.path(RANKS)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
