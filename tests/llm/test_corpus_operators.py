"""Operators over many rows: exact and near copies, packing, search, conversations, URLs, and the pipeline."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from duck import compare
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folio.llm import chat_format, exact_dedup, jaccard_join, packing, quality_cnn, secret_scan, topk_search, url_filter
from folio.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """rows of (doc_id, text), with more columns, some of which have names that an operator uses."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"kept": F.lit("x"), "keep_id": F.lit(3), "label": F.lit("y"), "page": F.lit(1), "length": F.lit(9)})


# Exact copies


def test_dedup_sql(spark):
    compare(spark, SF, exact_dedup.op8_exact_dedup, exact_dedup.oracle_op8())


def test_dedup_cases(spark):
    rows = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (None, "a b"), (5, "É"), (6, "é"), (7, "x" * 300_000), (7, "X" * 300_000), (None, "z"), (None, "Z")]
    docs = documents(spark, rows)
    found = exact_dedup.judged(docs).collect()
    assert len(found) == len(rows)
    by = defaultdict(list)
    for r in found:
        assert r.text_sha256 == hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()
        by[r.text_sha256].append(r)
    for (i, t) in rows:
        group = by[hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()]
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert all(r.group_size == len(group) and r.keep_id == (max(ids) if ids else None) for r in group)
        assert sum(r.kept for r in group) == 1
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(by) and {r.kept for r in kept.collect()} == {"x"}
    assert exact_dedup.judged(documents(spark, [])).count() == 0


def test_dedup_of_a_hot_text_and_clashing_names(spark, monkeypatch):
    """A text with more leaders than one task takes is settled in groups first; no name of a column is special."""
    monkeypatch.setattr(exact_dedup, "MANY", 3)
    monkeypatch.setattr(exact_dedup, "SALTS", 2)
    rows = [(k, "Hot" if k % 3 else f"text {k % 40}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    docs = docs.withColumns({c: F.col("doc_id") + 1 for c in ("rid", "gid", "h", "lead", "rest", "row", "__rid", "__kept", "n", "hot", "salt", "kept")})
    stay = {}
    for k, t in rows:
        stay[t.lower()] = max(k, stay.get(t.lower(), -1))
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(stay.values())
    sizes = {(r.keep_id, r.group_size) for r in exact_dedup.judged(docs).collect()}
    assert sizes == {(k, sum(t.lower() == u.lower() for _, u in rows)) for t, k in stay.items()}


def test_grace_spills_and_compares_content(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    monkeypatch.setattr(exact_dedup.tempfile, "tempdir", str(tmp_path))
    r = random.Random(1)
    texts = [bytes([r.randrange(256) for _ in range(r.randint(0, 60))]) for _ in range(400)]
    rows = [(r.choice(texts)) for _ in range(4000)]
    for bits in (64, 2, 0):  # with few bits nearly all hashes are equal
        hashes = [int.from_bytes(hashlib.md5(t).digest()[:8], "little") & ((1 << bits) - 1) for t in rows]
        found = dict(exact_dedup.grace(((h, t, k) for k, (h, t) in enumerate(zip(hashes, rows, strict=True))), budget=3000))
        assert sorted(found) == list(range(4000))
        roots = defaultdict(set)
        for k, root in found.items():
            roots[rows[k]].add(root)
            assert rows[root] == rows[k]
        assert all(len(x) == 1 for x in roots.values())
    assert not os.listdir(tmp_path)


# Near copies


def naive_components(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                up[max(root(a), root(b))] = min(root(a), root(b))
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[root(k)].append(i)
    name = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    return [(i, len(sets[k]), name[root(k)] if sets[k] else i) for k, (i, _) in enumerate(rows)]


def near_copies(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "bb", "C", "dé", "e", "ff", "g1", "h"]) + str(r.randint(0, 40))
    rows, passage = [], [word() for _ in range(30)]
    for k in range(60):
        base = [word() for _ in range(r.choice([1, 3, 12, 40, 120]))]
        base = passage + base if k % 4 == 0 else base
        for _ in range(r.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 1, 3])):
                copy[r.randrange(len(copy))] = word()
            rows.append((len(rows), r.choice([" ", "\n", "\t "]).join(copy)))
    rows += [(None, rows[3][1]), (7, rows[7][1].upper()), (900, None), (901, ""), (902, "\x0b \r"), (903, "one"), (904, "ONE"), (905, "one two"), (None, "lonely words are here now and then")]
    return rows


@pytest.mark.parametrize(("n", "num", "page"), [(3, 90, 2000), (5, 80, 2000), (2, 60, 3)])
def test_components(spark, monkeypatch, n, num, page):
    monkeypatch.setattr(jaccard_join, "PAGE", page)
    rows = near_copies(n)
    found = jaccard_join.components(documents(spark, rows), n, num, 100).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, found), key=key) == sorted(naive_components(rows, n, num, 100), key=key)


def test_components_of_nothing(spark):
    assert jaccard_join.components(documents(spark, []), 3, 90, 100).count() == 0
    assert jaccard_join.components(documents(spark, [(1, None)]), 3, 90, 100).first().component_id == 1


def test_components_of_rows_without_ids(spark):
    """Many rows with a null or the same doc_id meet by their texts; long sets, over all pages, against all pairs."""
    r = random.Random(6)
    base = [f"w{r.randrange(10**6)}" for _ in range(5200)]
    rows = [(None, f"some words that go around {k % 7}") for k in range(40)] + [(5, f"a text of one id {k % 9} and more") for k in range(40)]
    for k in range(6):
        for n in (650, 5200):
            copy = base[:n]
            for _ in range(n // r.choice([20, 200, 2000])):
                copy[r.randrange(n)] = f"v{r.randrange(10**6)}"
            rows.append((100 + len(rows), " ".join(copy)))
    found = jaccard_join.components(documents(spark, rows), 3, 90, 100).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, found), key=key) == sorted(naive_components(rows, 3, 90, 100), key=key)


@pytest.mark.parametrize("page", [4, 11])
def test_components_of_long_sets_over_pages(spark, monkeypatch, page):
    """Sets of about 600 to 6,000 shingles in clusters of many pages, with finer counts, against all pairs."""
    monkeypatch.setattr(jaccard_join, "PAGE", page)
    r, rows = random.Random(page), []
    for n in (520, 640, 2000, 6000):
        base = [f"w{r.randrange(10**6)}" for _ in range(n)]
        for _ in range(14):
            copy = base[: n - r.choice([0, 0, n // 30])]
            for _ in range(len(copy) // r.choice([15, 45, 60, 70, 400])):
                copy[r.randrange(len(copy))] = f"v{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    r.shuffle(rows)
    found = jaccard_join.components(documents(spark, rows), 3, 90, 100).collect()
    assert sorted(map(tuple, found)) == sorted(naive_components(rows, 3, 90, 100))
    assert 4 < len({x.component_id for x in found}) < len(rows)


def test_representatives(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(5, text), (3, text + " more"), (9, "other"), (None, text), (12, None), (None, "quite alone here")]
    kept = jaccard_join.representatives(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect())[:3] == [(False, 3), (False, 9), (False, 12)]


def test_tree_misses_nothing():
    r = np.random.default_rng(0)
    least = jaccard_join.Similarity(80, 100)
    pool = r.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
    sets = []
    for _ in range(300):
        base = r.choice(pool, r.integers(1, 300))
        sets += [np.unique(base), np.unique(np.concatenate([base[r.random(len(base)) > 0.08], r.choice(pool, 3)]))]
    points, sizes = np.stack([jaccard_join.point(h) for h in sets]), np.array([len(h) for h in sets])
    small = [jaccard_join.from_small(jaccard_join.small_point(h)) for h in sets]
    assert all(s == len(h) and (p >= q).all() for (s, p), h, q in zip(small, sets, points, strict=True))
    tree, passed = jaccard_join.CountTree(points, sizes), 0
    for q in range(len(sets)):
        found = set(tree.search(points[q], sizes[q], least).tolist())
        passed += len(found)
        assert {k for k in range(len(sets)) if least.linked(sets[q], sets[k])} <= found
    assert passed < len(sets) ** 2 / 10


def test_counts_in_bytes_are_upper_bounds():
    for most in (0, 1, 254, 255, 256, 257, 510, 511, 512, 1020, 1021, 1024, 65_536):
        # Leading bits choose the group: the first of 128, and the first of 4,096.
        h = np.concatenate([np.arange(most, dtype=np.uint64), np.arange(600, dtype=np.uint64) << np.uint64(54)])
        for small, back, wanted in ((jaccard_join.small_point, jaccard_join.from_small, jaccard_join.point(h)), (jaccard_join.fine_point, jaccard_join.from_fine, np.bincount((h >> np.uint64(52)).astype(int), minlength=jaccard_join.FINE))):
            size, p = back(small(h))
            assert size == len(h) and (p >= wanted).all() and p.max() <= wanted.max() * 1.01 + 1, most


# Packing


def check_plan(histogram):
    plan = packing.plan_for(histogram)
    limit, ranks, sequences = len(histogram) - 1, defaultdict(set), defaultdict(list)
    for length, low, high, first, offset in plan.intervals:
        for k in range(low, high):
            assert k not in ranks[length]
            ranks[length].add(k)
            sequences[first + k - low].append((offset, length))
    assert all(ranks[n] == set(range(histogram[n])) for n in range(1, limit + 1))
    assert sorted(sequences) == list(range(plan.sequences))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    return plan


def test_packing_plans():
    r = np.random.default_rng(2)
    for limit, lengths in ((16, r.integers(1, 17, 500)), (64, np.minimum(64, r.geometric(0.08, 800))), (64, [40] * 30 + [24] * 10), (8, []), (100, [100] * 3), (64, r.integers(30, 65, 300))):
        histogram = np.bincount(np.array(lengths, int), minlength=limit + 1)
        plan = check_plan(histogram)
        tokens = int((histogram * np.arange(limit + 1)).sum())
        least = max(-(-tokens // limit), int(histogram[limit // 2 + 1 :].sum()))
        assert least <= plan.sequences <= least * 1.03 + 1
        assert plan.sequences <= packing.Plan(histogram, []).sequences


def test_patterns_beat_best_fit_alone():
    """Lengths of which best-fit wastes room: it pairs 50 with 35 and 30s, though 50, 30, 20 and 35, 35, 30 fill sequences."""
    histogram = np.zeros(101, np.int64)
    histogram[[50, 30, 20, 35]] = [4000, 4000 + 1000, 4000, 2000]
    plan, alone = check_plan(histogram), packing.Plan(histogram, [])
    least = -(-int((histogram * np.arange(101)).sum()) // 100)
    assert plan.sequences == least == 5000 and alone.sequences > 1.02 * least
    r = np.random.default_rng(8)
    histogram = np.bincount(np.clip(r.lognormal(5.5, 0.8, 400_000).astype(int), 1, 1024), minlength=1025)
    histogram[r.random(1025) < 0.4] = 0
    plan, alone = check_plan(histogram), packing.Plan(histogram, [])
    assert plan.sequences <= alone.sequences


def test_fit_is_converged():
    """No pattern that fills a sequence would lessen the squares by half a piece, and no count is negative."""
    r = np.random.default_rng(9)
    histogram = np.bincount(r.integers(1, 65, 5000), minlength=65)
    patterns = packing.patterns_of(histogram)
    used, x = packing.fitted(histogram, patterns)
    rest = histogram.astype(float)
    rest[[0, 64]] = 0
    for p, n in zip(patterns[used], x, strict=True):
        np.subtract.at(rest, p[p > 0], n)
    rest[[0, 64]] = 0
    others = np.setdiff1d(np.flatnonzero(patterns.sum(axis=1) == 64), used)
    assert (x > 0).all() and rest[patterns[others]].sum(axis=1).max() <= packing.HALF and {2, 3, 4} == {int((p > 0).sum()) for p in patterns}


def test_packing_query(spark):
    rows = [(1, None), (2, ""), (2, "again, again"), (None, "some text"), (5, "long words here " * 3000), (6, "<|endoftext|>")]
    docs = documents(spark, rows).union(documents(spark, [(100 + i, f"text number {i} " * (i % 50)) for i in range(200)]))
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packing.pack(docs, with_ids=True).collect()
    by, wanted = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length <= 1024
        by[r.doc_id].append((r.piece, r.start, tuple(r.ids)))
    for r in docs.collect():
        ids = [*tokens.encode(r.text or "", add_special_tokens=False).ids, 2]
        wanted[r.doc_id] += [(k, s, tuple(ids[s : s + n])) for k, (s, n) in enumerate(packing.cuts(len(ids)))]
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in wanted.items()}
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == list(np.cumsum([0] + [n for _, n in sorted(own)][:-1])) and sum(n for _, n in own) <= 1024
    assert packing.cuts(2050) == [(0, 2), (2, 1024), (1026, 1024)] and packing.cuts(1024) == [(0, 1024)] and packing.cuts(2048)[0] == (0, 1024)
    assert packing.pack(documents(spark, [])).count() == 0


@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "a", "word", "É", "don't", "'s", "12", "½", ".", "...", ",", "?!", ";)", "(", "<|", "<|endoftext|>", "😀", "\u0301", "\0"]), max_size=25))
@settings(max_examples=600, deadline=None)
def test_packing_ids_are_those_of_whole_texts(parts):
    path, text = public_tokenizers.path("byte_bpe_50k.json"), "".join(parts)
    assert packing.ids_of([text, "x"], path)[0].tolist() == [*whole_tokenizer(path).encode(text, add_special_tokens=False).ids, 2]


@lru_cache
def whole_tokenizer(path):
    return Tokenizer.from_file(path)


def test_packing_ids_of_the_added_token(spark, tmp_path):
    """The query and the pipeline's stage give the ids of `tokenizers` in its default setting."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    tokens, r = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(4)
    rows = [(0, "a<|endoftext|>b")] + [(k, "".join(r.choice(["<|endoftext|>", "<|", " ", "\n", "word", " don't", "é😀", "12"]) for _ in range(k))) for k in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    wanted = {k: zlib.crc32(np.array([*tokens.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for k, t in rows}
    assert tokens.encode(rows[0][1], add_special_tokens=False).ids == [64, 50256, 65]
    for found in (packing.op6_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, "")):
        assert {x.doc_id: x.ids_crc32 for x in found.collect()} == wanted


# Search


def test_search_sql(spark):
    compare(spark, SF, topk_search.op7_topk_search, topk_search.oracle_op7())


def test_search_cases(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 40)
    r, nan = random.Random(3), float("nan")
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for i in range(150)]
    odd = [(20, rows[20][1]), (40, [1.0, 0.0, 0.5]), (60, None), (None, [1.0, 1.0, 1.0]), (200, [1.0, nan, 0.0]), (220, [1.0, None, 0.0]), (240, [1.0, 2.0]), (260, []), (280, [float("inf"), 0.0, 0.0]), (7, rows[7][1]), (300, [0.0, 0.0, 0.0])]
    every = [x for x in rows if x[0] != 60] + odd
    df = spark.createDataFrame(every, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in every if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    wanted = []
    for i, q in {(i, tuple(v)) for i, v in good if i % 20 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))[:20]
        wanted += [(i, k, j, -s) for k, (s, j) in enumerate(scored, 1)]
    assert sorted(map(tuple, topk_search.top_k(df).collect())) == sorted(wanted)
    assert topk_search.top_k(df.limit(0)).count() == 0


def test_threshold_stops_early():
    r = np.random.default_rng(1)
    v = np.round(r.random((3000, 1)) ** 8 * 1000 * np.ones((1, 4)) + r.integers(0, 3, (3000, 4))).astype(np.int64)
    lists, scored = topk_search.SortedLists(np.arange(3000), v), []
    monitor = lists.scores
    lists.scores = lambda rows, q: scored.append(len(rows)) or monitor(rows, q)
    ids, scores, done = lists.best(-1, np.array([3, 1, 2, 1]), 5)
    full = v @ np.array([3, 1, 2, 1])
    order = np.lexsort((np.arange(3000), -full))[:5]
    assert (ids == order).all() and (scores == full[order]).all() and sum(scored) == done < 300


def test_threshold_bound_against_all_scores():
    """Lists of any shape, with floors and copies: the best of a block are those of all its scores."""
    r = np.random.default_rng(5)
    for dims, kind in ((1, 0), (2, 1), (7, 2), (32, 2), (16, 3)):
        v = [r.integers(-3, 4, (700, dims)), r.integers(0, 1000, (700, dims)), np.round(r.normal(0, 20, (700, dims))), np.round(r.normal(0, 1, (700, dims)) * 3.0 ** r.integers(0, 9, (700, 1)))][kind].astype(np.int64)
        v[100:130] = v[5]
        ids = r.integers(0, 600, 700)
        lists = topk_search.SortedLists(ids, v)
        for q in [*v[:12], *(v[100:110] * 2), np.zeros(dims, np.int64)]:
            full = v @ q
            others = np.flatnonzero(ids != ids[5])
            order = others[np.lexsort((ids[others], -full[others]))][:20]
            for floor in (topk_search.LEAST, int(full[order[9]])):
                found, scores, done = lists.best(int(ids[5]), q, 20, floor)
                keep = order[full[order] >= floor]
                assert scores.tolist() == full[keep].tolist() and found.tolist() == ids[keep].tolist() and done <= len(others)


def test_search_of_blocks_that_share_ids(spark, monkeypatch):
    """Blocks are told apart by their vectors and lengths, not by their ids; very large components stay in range."""
    monkeypatch.setattr(topk_search, "BLOCK", 2)
    sets = [
        [(20, [1.0, 2.0]), (21, [1.0, 1.0]), (20, [1.0, 2.0, 3.0]), (21, [1.0, 1.0, 1.0])],
        [(20, [8.0, 8.0]), (21, [1.0, 1.0]), (22, [2.0, 2.0]), (21, [18.0, 0.0]), (22, [16.0, 0.0]), (40, [1.0, 0.0]), (60, [0.0, 1.0])],
        [(20, [1e300, -1.0]), (21, [1e300, 0.0]), (22, [-1e300, 5.0]), (40, [1e18, 1e18])],
    ]
    for rows in sets:
        whole = [(i, [min(max(int(np.floor(64 * x)), topk_search.LEAST), topk_search.MOST) for x in v]) for i, v in rows]
        wanted = []
        for i, q in whole:
            if i % 20 == 0:
                scored = sorted((-min(max(sum(a * b for a, b in zip(q, v, strict=True)), topk_search.LEAST), topk_search.MOST), j) for j, v in whole if j != i and len(v) == len(q))
                wanted += [(i, k, j, -s) for k, (s, j) in enumerate(scored[:20], 1)]
        found = topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        assert sorted(map(tuple, found.collect())) == sorted(wanted)


# Conversations


def test_chat_sql(spark):
    compare(spark, SF, chat_format.op3_chat_formatting, chat_format.oracle_op3())


def test_chat_cases(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]\\<s>", "<<</SYS>>", "<|41|>", "[", "<", "é😀\n\r", "", None, "<", "[/INST", "\\[INST]", "<" * 1000 + "s>" * 1000]
    rows = [(1, k, r, t) for k, (r, t) in enumerate((r, t) for t in nasty for r in ("user", "assistant"))]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", "a"), (3, 0, "assistant", "x"), (4, 0, "user", "u"), (5, 0, "tool <é>", "t"), (5, 1, None, "n")]
    rows += [(None, None, "user", "b"), (None, 1, "assistant", "c"), (6, 1, "user", "z"), (6, 1, "user", "z"), (6, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    done = chat_format.format_conversations(df)
    back = {r.conv_id: r for r in chat_format.read_back(done).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    for c, own in by.items():
        own = [(r, x) for _, r, x in sorted(own)]
        assert [(t.role, t.text) for t in back[c].turns] == own
        assert back[c].loss == [x for r, x in own if r == "assistant"]
    found = {r.conv_id: r for r in done.collect()}
    assert {c: (r.valid, r.first_bad) for c, r in found.items()} == {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, 0), None: (True, None), 6: (False, 0)}
    for r in found.values():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert all(r.formatted[s.start : s.end] == s.text for s in r.segments)
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_of_many_turns(spark):
    """A conversation of 100,000 turns: places that are found turn by turn would take minutes here."""
    df = spark.range(100_000).selectExpr("1L conv_id", "id turn", "IF(id % 2 = 0, 'user', 'assistant') role", "concat('turn \\\\ <s> ', id) text")
    done = chat_format.format_conversations(df)
    back = chat_format.read_back(done)
    got = back.select(F.size("turns").alias("n"), F.size("loss").alias("k"), F.element_at("loss", -1).alias("last"), F.element_at("turns", 9).alias("ninth"), F.length("formatted").alias("size")).first()
    assert (got.n, got.k, got.last, got.ninth.text) == (100_000, 50_000, "turn \\ <s> 99999", "turn \\ <s> 8")
    ends = done.select(F.element_at("segments", -1).alias("s"), "valid").first()
    assert ends.s.end == got.size and ends.valid


# URLs

URLS = [
    "http://a.org/x", "https://Blog.EXAMPLE.org/es/1?q=/es/", "http://example.org/en/1x", "http://example.org/en/2", "http://shop.com/fr/9#a", "http://com/fr/", "http://shop.com/de/", "http://xcom/fr/",
    "http://a.net/p", "http://a.net/p", "http://a.org", "no scheme", "", None, "://", "http://U@H.com:80/de/x/../y", "http://é.org/ü?x#y", "x://y/z://w.org/",
]


def naive_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    host, best = host.translate(LOWER), (None, None)
    for verdict, rule in url_filter.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def test_url_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("x"))
    found = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = naive_rule(url)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), url
        assert found[i].verdict == verdict or (verdict is None and found[i].verdict in ("allow", "block"))
    assert url_filter.judge(df.limit(0)).count() == 0
    none = url_filter.judge(spark.createDataFrame([(1, "http://a.net/"), (1, None)], "page_id long, url string")).collect()
    assert [(r.verdict, r.score) for r in none] == [("allow", 0.0)] * 2


def test_url_scores_against_a_direct_model(spark):
    urls = [(h, p, label) for label, hs in (("allow", ["a.org", "bb.org"]), ("block", ["spam.com", "ads.com"])) for h in hs for p in ("/x", "/yy", "/z1")]
    rows = spark.createDataFrame(urls + [("new.org", "/x", None), ("", "", None)], "host string, path string, label string")
    found = {(r.host, r.path): r.score for r in url_filter.scores(rows, url_filter.model(rows.where("label IS NOT NULL"))).collect()}
    k_max, counts = url_filter.ORDER, defaultdict(lambda: defaultdict(int))
    pad = lambda h, p: "\x01" * k_max + h + p + "\x02"
    for h, p, label in urls:
        s = pad(h, p)
        for i in range(k_max, len(s)):
            for k in range(k_max + 1):
                counts[label, s[i - k : i]][s[i]] += 1

    def log_p(label, s):
        total = 0.0
        for i in range(k_max, len(s)):
            prob = url_filter.UNIFORM
            for k in range(k_max + 1):
                own = counts.get((label, s[i - k : i]), {})
                n, kinds = sum(own.values()), len(own)
                prob = (own.get(s[i], 0) + kinds * prob) / (n + kinds) if n else prob
            total += np.log(prob)
        return total

    for (h, p), score in found.items():
        s = pad(h, p)
        wanted = (log_p("allow", s) - log_p("block", s)) / (len(h + p) + 1) if h + p else 0.0
        assert score == pytest.approx(wanted, abs=2e-3), (h, p)
    assert found["new.org", "/x"] > 0


def direct_scores(urls):
    """Scores of (text, label), by a direct model of the labelled ones."""
    k_max, counts = url_filter.ORDER, defaultdict(lambda: defaultdict(int))
    pad = lambda t: "\x01" * k_max + t + "\x02"
    for t, label in urls:
        s = pad(t)
        for i in range(k_max, len(s)):
            for k in range(k_max + 1):
                counts[label, s[i - k : i]][s[i]] += 1

    def log_p(label, s):
        total = 0.0
        for i in range(k_max, len(s)):
            prob = url_filter.UNIFORM
            for k in range(k_max + 1):
                own = counts.get((label, s[i - k : i]), {})
                n, kinds = sum(own.values()), len(own)
                prob = (own.get(s[i], 0) + kinds * prob) / (n + kinds) if n else prob
            total += np.log(prob)
        return total

    return {t: (log_p("allow", pad(t)) - log_p("block", pad(t))) / (len(t) + 1) for t, _ in urls}


def test_url_models_grow_with_the_urls(spark):
    """About 100,000 distinct grams: a table of fixed size would mix them."""
    r = random.Random(8)
    word = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    letters = {"allow": "abcdefghijklmnopqrstuvwxyzABCDé", "block": "stuvwxyzABCDEFGHIJKLMNOPQ0123😀", None: "abcdefgtuvwxyzABCDGHIJKLMé😀"}
    urls = [(word("abc", 3), "/" + word(letters[label], 40), label) for label in letters for _ in range(500)]
    rows = spark.createDataFrame(urls, "host string, path string, label string")
    found = {r.host + r.path: r.score for r in url_filter.scores(rows, url_filter.model(rows.where("label IS NOT NULL"))).collect()}
    wanted = direct_scores([(h + p, label) for h, p, label in urls])
    assert found.keys() == wanted.keys() and max(abs(found[t] - wanted[t]) for t in wanted) < 1e-7


def test_url_models_read_the_whole_url(spark):
    ruled = [f"http://{h}/p{k}?{q}#{f}" for h, q, f in (("a.org", "page=2", "top"), ("shop.com/de", "bet=win", "spam")) for k in range(40)]
    free = ["http://a.net/p?page=2#top", "http://a.net/p?bet=win#top", "http://a.net/p?bet=win#spam", "a.net/p?page=2", "a.net/p?bet=win", "page=2#top", "bet=win#spam"]
    urls = ruled + free + ["", None]
    found = [r.score for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()][len(ruled) :]
    assert len(set(found[: len(free)])) == len(free) and found[len(free) :] == [0.0, 0.0]
    assert found[0] > found[1] > found[2] and found[3] > found[4] and found[5] > 0 > found[6]


def test_url_threshold(spark):
    rows = [(0.5, "allow")] * 9 + [(-0.1, "allow")] + [(-1.0, "block")] * 10
    edge = url_filter.threshold(spark.createDataFrame(rows, "score double, label string")).first().edge
    assert -1.0 < edge <= -0.1


# The pipeline


def test_pipeline_against_its_parts(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = table(spark, SF, "documents")
    network = quality_cnn.fit(docs, table(spark, SF, "labels"))
    network.freeze()
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows = [x for x in rows if network.score(x[1].encode()) >= quality_cnn.ACCEPT]
    last = {}
    for i, t in rows:
        last[t.translate(LOWER)] = max(i, last.get(t.translate(LOWER), i))
    rows = [(i, t) for i, t in rows if last[t.translate(LOWER)] == i]
    rows = [x for x, (i, _, c) in zip(rows, naive_components(rows, 5, 80, 100), strict=True) if i == c]
    wanted = {}
    for i, t in rows:
        out, at = "", 0
        spans = sorted((m.start(), m.end()) for r in secret_scan.RULES for m in re.finditer(r.pattern, t) if len(m[r.value]) >= r.least)
        for a, b in spans:
            out += t[at:a] + "[secret]" if a >= at else ""
            at = max(at, b)
        ids = np.array([*whole_tokenizer(public_tokenizers.path("byte_bpe_50k.json")).encode(out + t[at:], add_special_tokens=False).ids, 2], "<u4")
        for k, (s, n) in enumerate(packing.cuts(len(ids))):
            wanted[i, k] = (s, n, zlib.crc32(ids[s : s + n].tobytes()))
    found = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == wanted and len(found) == len(wanted)
