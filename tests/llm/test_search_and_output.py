"""Ranked lexical search, embedding whitening and token files."""

from __future__ import annotations

import math
import random
import re
import unicodedata
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from duck import compare
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folio.llm import lexical_search, token_files, whitening
from folio.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """rows of (doc_id, text), with more columns, some of which have names that an operator uses."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"ids": F.lit("x"), "term": F.lit(3), "part": F.lit("y"), "_h": F.lit(1), "score": F.lit(9)})


# Ranked lexical search


def naive_terms(text):
    return re.findall(lexical_search.TERM, (text or "").translate(LOWER))


def naive_ranking(docs, items, k):
    """Rows (item_id, rank, doc_id, score); docs and items are rows of id and text."""
    held = [(i, Counter(naive_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in set(items):
        found = []
        for doc_id, c, size in held:
            m = 10 + (90 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(naive_terms(text)) if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, r, doc_id, -score) for r, (score, _, doc_id) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def ranking(spark, docs, items, k):
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("z"))
    return sorted((tuple(r) for r in lexical_search.search(lexical_search.index(documents(spark, docs)), items, k).collect()), key=str)


def test_lexical_search_sql(spark):
    compare(spark, SF, lexical_search.op11_lexical_search, lexical_search.oracle_op11())


@pytest.mark.parametrize("group", [1000, 3])
def test_lexical_search_against_all_scores(spark, monkeypatch, group):
    monkeypatch.setattr(lexical_search, "ITEMS", group)
    rng = random.Random(group)
    words = [f"w{i}" for i in range(40)] + ["É", "日本", "Σσ", "x1", "A"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: "".join(rng.choice([" ", "-", "\n", "_"]) + w for w in rng.choices(words, weights, k=n))
    docs = [(i, text(rng.randint(0, 30))) for i in range(150)]
    docs += [(500 + i, docs[3][1]) for i in range(30)] + [(7, docs[7][1]), (None, docs[3][1]), (None, "w39 w38"), (800, None), (801, ""), (802, "-- !"), (803, "w1 " * 20_000)]
    items = [(i, text(rng.randint(1, 8))) for i in range(12)] + [(20, docs[3][1]), (20, "w1"), (20, "w1"), (21, None), (22, ""), (23, "nowhere"), (None, "w2 w2 W2")]
    assert ranking(spark, docs, items, 10) == naive_ranking(docs, items, 10)


def test_lexical_search_of_nothing(spark):
    assert ranking(spark, [], [(1, "a")], 10) == ranking(spark, [(1, "a")], [], 10) == ranking(spark, [(1, None)], [(1, "a")], 10) == []


def segment_of(docs):
    own = lexical_search.Building()
    for i, t in docs:
        own.add(i, t)
    row = own.row().to_pylist()[0]
    return lexical_search.Segment(row, len(docs), row["n_terms"])


@pytest.mark.parametrize("fan", [2, 4])
def test_deep_trees_against_all_scores(monkeypatch, fan):
    """Segments that share the best so far, as a task has them."""
    monkeypatch.setattr(lexical_search, "FAN", fan)
    monkeypatch.setattr(lexical_search, "DOCS", 64)
    rng = random.Random(fan)
    for _ in range(40):
        docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 6)))) for i in rng.sample(range(1000), 120)]
        n, total = len(docs), sum(len(t.split()) for _, t in docs)
        asked = [(t, rng.choice([1, 1, 5, 900])) for t in rng.sample("abcdefghz", 4)]
        best = []
        for at in (0, 60):
            own = lexical_search.Building()
            for i, t in docs[at : at + 60]:
                own.add(i, t)
            lexical_search.Segment(own.row().to_pylist()[0], n, total).search(asked, 7, best)
        m = {i: 10 + 90 * len(t.split()) * n // total for i, t in docs}
        scores = [(-sum(w * (10**9 * t.split().count(a) // (1000 * t.split().count(a) + 8 * m[i])) for a, w in asked), False, i) for i, t in docs]
        assert best == sorted(x for x in scores if x[0] < 0)[:7]


def test_bound_leaves_most_ranges_closed():
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices([f"w{j}" for j in range(3000)], k=60))) for i in range(4096)]
    segment = segment_of(docs)
    best = []
    segment.search([("w1", 900), ("w2", 800), ("w3", 700)], 10, best)
    assert len(best) == 10 and segment.opened < 273 // 2


def test_ranges_of_an_equal_bound_are_opened():
    """Documents of one score, the least ids last: all ranges tie with the k-th score."""
    docs = [(4096 - i, "a b") for i in range(4096)]
    best = []
    segment_of(docs).search([("a", 5)], 10, best)
    assert [x[2] for x in best] == list(range(1, 11))


# Embedding whitening


def naive_whitening(vectors):
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    deviation = [min(sum(int(d) ** 2 for d in row), (1 << 63) - 1) for row in (n * x - s)]
    c = np.array((n * x - s) / n, np.float64)
    v = c.T @ c / n
    return n, deviation, c, v


def whitened_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit("x"), "n": F.lit(2), "component": F.lit("q")})
    return whitening.whiten(df).collect()


def check_whitening(found, ids, vectors):
    n, deviation, c, v = naive_whitening(vectors)
    k = min(8, len(v))
    values = np.linalg.eigvalsh(v)[::-1]
    assert len(found) == k * len(ids)
    by = defaultdict(dict)
    for r in found:
        by[r.vec_id][r.component] = r
        assert r.n == n and abs(r.explained - values[r.component - 1] / np.trace(v)) <= 1e-9 * r.explained and 0 <= r.identity_error < 1e-9
    assert sorted(by) == sorted(ids)
    z = np.array([[by[i][j].whitened for j in range(1, k + 1)] for i in ids])
    assert [by[i][1].deviation for i in ids] == deviation
    assert np.abs(z.T @ z / n - np.eye(k)).max() < 1e-9
    # whitened = c @ u / sqrt(e), so V u = e u holds for what the rows say u is.
    u = np.linalg.lstsq(c, z, rcond=None)[0] * np.sqrt(values[:k])
    assert np.abs(v @ u - u * values[:k]).max() < 1e-6 * values[0] and np.abs(np.linalg.norm(u, axis=0) - 1).max() < 1e-9


def test_whitening_of_the_table(spark):
    rows = table(spark, SF, "embeddings").orderBy("vec_id").collect()
    check_whitening(whitening.op12_embedding_whitening(spark, SF).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_whitening_far_from_the_origin(spark):
    """Small differences upon a large offset, which sums of squares would lose."""
    rng = np.random.default_rng(5)
    vectors = (90_000 + rng.normal(size=(300, 9)) * np.array([5, 4, 3, 2, 1, 0.5, 0.2, 0.1, 0.05])).astype(np.float32)
    check_whitening(whitened_rows(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), list(range(300)), vectors)


def test_whitening_cases(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, math.nan, 2.0]), (103, [math.inf, 0.0, 0.0]), (104, [])]
    found = whitened_rows(spark, good + odd)
    check_whitening(found, [i for i, _ in good], [v for _, v in good])
    # Repeated rows, null ids and another length of vectors, where one dimension stands still.
    flat = [(i, [float(i), 1.0]) for i in range(200, 210)]
    found = whitened_rows(spark, [*good, good[0], (None, good[1][1]), *flat])
    assert sum(r.vec_id == 0 for r in found) == 6 and sum(r.vec_id is None for r in found) == 3
    of_flat = [r for r in found if r.vec_id is not None and r.vec_id >= 200]
    assert len(of_flat) == 20 and all((r.whitened is None) == (r.component == 2) and r.n == 10 and r.identity_error < 1e-9 for r in of_flat)
    assert whitened_rows(spark, []) == whitened_rows(spark, odd) == []
    alone = whitened_rows(spark, [(1, [2.0, 3.0])])
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in alone] == [(None, 0.0, 0, 0.0)] * 2
    far = whitened_rows(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0])])
    assert len(far) == 4 and all(r.deviation == (1 << 63) - 1 for r in far)


def test_deviations_near_the_end_of_a_long():
    own = whitening.Mean(1, np.array([0, 0], object))
    x = np.array([[3037000499, 0], [3037000500, 0], [2147483648, 2147483647], [5, 6]], np.int64)
    assert own.deviations(x).tolist() == [min(int(a) ** 2 + int(b) ** 2, (1 << 63) - 1) for a, b in x.tolist()]


# Token files


def folder_of(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/tokens-{uuid.uuid4().hex}"


def whole_ids(texts, name=token_files.VOCABULARY):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids + [token_files.END_ID] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check_files(spark, rows, found):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    ids = whole_ids([t for _, t in rows])
    expected = defaultdict(list)
    for (doc_id, _), own in zip(rows, ids, strict=True):
        expected[doc_id].append((len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    by, at = defaultdict(list), 0
    for r in sorted(found, key=lambda r: r.start):  # gapless, in the order of doc_id
        assert r.start == at
        at += r.n_tokens
        by[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert at == sum(map(len, ids)) and [i for i in by] == [i for i in expected]
    assert {i: sorted(x) for i, x in by.items()} == {i: sorted(x) for i, x in expected.items()}


def test_token_files_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    check_files(spark, rows, token_files.op13_token_files(spark, SF).collect())


CASES = [(5, "B a"), (3, None), (4, ""), (None, "null id"), (None, None), (9, "it's 'tis don't'll 12³ x_y"), (9, "Other text of 9"), (-2, "x" * 60_000), (12, "<|endoftext|> in a text"), (13, "Á Σας ΟΔΟΣ İ ǰ J̌ µm"), (14, "a\x1cb\x85c d\x0b"), (15, "日本語 текст 😀")]


def test_token_files_cases(spark):
    rows = CASES + [(20 + i // 3, f"Text number {i}, again.") for i in range(60)] + [(50, "hot copy")] * 200
    folder = folder_of(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one file
    held = token_files.write(documents(spark, rows).repartition(7), folder)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = token_files.read(spark, folder, with_ids=True).collect()
    check_files(spark, rows, found)
    files = token_files.TokenFiles(folder, held.collect())
    run = [x for r in sorted(found, key=lambda r: r.start) for x in r.ids]
    assert len(files.rows) > 1 and len(files) == len(run) and files.span(0, len(run) + 9).tolist() == run
    assert files.span(len(run) // 3, len(run) // 2).tolist() == run[len(run) // 3 :][: len(run) // 2] and files.span(len(run), 1).tolist() == []
    for i, r in enumerate(sorted(found, key=lambda r: r.start)):
        doc_id, ids = files.document(i)
        assert doc_id == r.doc_id and ids.tolist() == r.ids
    assert held.agg(F.sum("nulls")).first()[0] == 2 and {r.width for r in held.collect()} == {2}


def test_token_files_of_nothing_and_wide_ids(spark):
    folder = folder_of(spark)
    assert token_files.write(documents(spark, []), folder).count() == token_files.read(spark, folder).count() == 0
    assert len(token_files.TokenFiles(folder, [])) == 0
    folder = folder_of(spark)
    held = token_files.write(documents(spark, CASES), folder, public_tokenizers.path("byte_bpe_50k.json"), 70_000).collect()
    assert {r.width for r in held} == {4}
    ids = [i for r in sorted(token_files.read(spark, folder, with_ids=True).collect(), key=lambda r: r.start) for i in r.ids]
    by_id = sorted(((i, t or "") for i, t in CASES), key=lambda r: (r[0] is not None, r[0] or 0))
    assert Counter(ids) == Counter(x for own in whole_ids([t for _, t in by_id], "byte_bpe_50k.json") for x in [*own[:-1], 70_000])


def test_files_of_failed_attempts_do_not_count(spark):
    """A task's files are named anew for each attempt, and the manifest has those of the one that succeeded."""
    folder = folder_of(spark)
    token_files.write(documents(spark, CASES), folder)
    before = [tuple(r) for r in token_files.read(spark, folder).orderBy("start").collect()]
    fs, at = token_files.place(folder)
    with fs.open_output_stream(f"{at}/000000-lost.ids") as f:
        f.write(b"\x01\x02\x03")
    assert [tuple(r) for r in token_files.read(spark, folder).orderBy("start").collect()] == before


def test_remembered_pieces_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    rng = random.Random(8)
    signs = [*"abcXYZ", *"éÉßÀøªºµ÷×¹²½", *"019", *" \t\n\x0b\xa0\x85\x1c", *"'.,;-_!\"()", "'s", "'LL", "'Re", "Σ", "İ", "́", "中", "<|startoftext|>", "words", "And"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 25))) for _ in range(20_000)]
    own = token_files.Encoder(public_tokenizers.path(token_files.VOCABULARY), token_files.END_ID)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        assert [np.frombuffer(x, "<u2").tolist() for x in own.of(part)] == [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]
    assert all(unicodedata.is_normalized("NFC", chr(c).lower()) for c in range(256))
