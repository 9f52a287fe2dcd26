"""Fuzzy matches through the index against all pairs, and ranks without one task."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folio.operators import correct, shared


def naive_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def naive_score(a: str, b: str) -> float:
    return max(0.0, (1 - (naive_distance(a, b) + abs(len(a) - len(b))) / max(1, min(len(a), len(b)))) * 100)


def words(rng: random.Random, n: int) -> list[str]:
    syllables = ["an", "ber", "co", "di", "el", "fra", "gus", "ha", "is", "jo", "ka", "li", "mar", "na", "o", "pe", "ri", "sa", "to", "u"]
    return ["".join(rng.choices(syllables, k=rng.randint(1, 6))) for _ in range(n)]


def changed(rng: random.Random, word: str) -> str:
    letters = list(word)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(letters) + 1)
        letters[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "a", "e"])
    return "".join(letters)


@pytest.fixture(scope="module")
def matched(spark):
    """Tokens, names (name, weight, idx) and every score over 0."""
    rng = random.Random(21)
    own = sorted(set(words(rng, 700)) | {"josé", "o'neil", "x" * 30, "y" * 21, "ab", "a"})
    names = sorted(((n, rng.randint(1, 5)) for n in own), key=lambda x: (-x[1], x[0]))
    names = [(n, w, i) for i, (n, w) in enumerate(names)]
    tokens = sorted({changed(rng, n) for n in own[:250]} | set(words(rng, 60)) | {"x" * 28, "y" * 20, "jose", "zzzz", "q", "", "b"})
    scores = {t: [(naive_score(t, n), w, i, n) for n, w, i in names] for t in tokens if t}
    frames = spark.createDataFrame([(t,) for t in tokens] + [(None,), (tokens[5],)], "token string"), spark.createDataFrame(names, "name string, weight int, idx int")
    return frames, scores


@pytest.mark.parametrize(("k", "parts"), [(5, 1_000_000), (2, 200)])
def test_top_matches_are_those_of_all_pairs(matched, monkeypatch, k, parts):
    monkeypatch.setattr(correct, "BROADCAST_ROWS", parts)
    (tokens, names), scores = matched
    found = sorted((r.token, r["rank"], r.name, round(r.score, 6)) for r in correct.top_matches(tokens, names, k).collect())
    wanted = [(t, j, n, round(s, 6)) for t, own in scores.items() for j, (s, _, _, n) in enumerate(sorted(own, key=lambda x: (-round(x[0], 9), x[2]))[:k], 1)]
    assert found == sorted(wanted)


@pytest.mark.parametrize(("rising", "least"), [(False, 0.0), (True, 0.0), (False, 60.0)])
def test_best_names_are_those_of_all_pairs(matched, rising, least):
    (tokens, names), scores = matched
    found = {r.token: r.best for r in correct.best_names(tokens, names, rising, least).collect()}
    wanted = {}
    for t, own in scores.items():
        score, _, _, best = max(own, key=lambda x: (round(x[0], 9), -x[1] if rising else x[1], -x[2]))
        wanted[t] = best if score >= max(least, 1e-9) else (t if least else names.where("idx = 0").first().name)
    assert found == wanted


def test_matches_are_all_scores_over_0(matched):
    (tokens, names), scores = matched
    found = {(r.token, r.name): round(r.score, 6) for r in correct.matches(tokens.distinct(), names).collect()}
    assert found == {(t, n): round(s, 6) for t, own in scores.items() for s, _, _, n in own if s > 1e-9}


def test_few_candidates_are_compared(spark, matched):
    """Pairs that the index makes, and pairs that get past the letters, against all pairs."""
    (tokens, names), scores = matched
    tokens = tokens.where("length(token) > 0").distinct()
    every = len(scores) * names.count()
    close = correct.near(tokens, names)
    assert close.count() < every / 20
    pairs = {(r.token, r.name) for r in close.collect()}
    assert all((t, n) in pairs for t, own in scores.items() if len(t) <= correct.LONGEST for _, _, _, n in own if naive_distance(t, n) <= correct.EDITS)
    # Of names that must score at least 50, the lengths and letters leave few, and lose none.
    some = tokens.select("token", F.lit(50.0).alias("floor"))
    found = {(r.token, r.name) for r in correct.far(some, names).collect()}
    assert found == {(t, n) for t, own in scores.items() for s, _, _, n in own if s >= 50}
    least = tokens.crossJoin(names).select("token", "name", correct._at_least(correct._letters(F.col("token")), correct._letters(F.col("name"))).alias("least"))
    bounds = least.collect()
    assert all(r.least <= naive_distance(r.token, r.name) for r in random.Random(3).sample(bounds, 3000))
    assert sum(r.least + abs(len(r.token) - len(r.name)) <= min(len(r.token), len(r.name)) / 2 for r in bounds) < every / 4


def test_index_is_not_sent_to_all_executors(spark, matched):
    """A few bytes of words make an index of many rows: it may not be built in the driver."""
    (tokens, names), _ = matched
    some = shared.written(tokens.where("length(token) > 0").distinct(), "t"), shared.written(names, "n")
    close = correct.near(*some)
    assert close.count() > 0
    close.collect()
    plan = close._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_no_names_and_no_tokens(spark):
    tokens = spark.createDataFrame([("abc",)], "token string")
    names = spark.createDataFrame([], "name string, weight int, idx int")
    assert correct.top_matches(tokens, names).count() == 0
    assert [tuple(r) for r in correct.best_names(tokens, names, True).collect()] == [("abc", "abc")]
    some = spark.createDataFrame([("abc", 1, 0)], "name string, weight int, idx int")
    none = tokens.where("false")
    assert correct.top_matches(none, some).count() == correct.best_names(none, some, False).count() == correct.matches(none, some).count() == 0


def test_ranks(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1, 1, 1, 2, 5, None]), f"n{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "w int, name string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = shared.ranked(df, [F.desc("w"), F.asc("name")], "idx", 10)
    found = sorted((r.idx, r.w, r.name) for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    parts = shared.placed(df, [F.desc("w"), F.asc("name")], "t").groupBy("_part").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wanted = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1]))
    assert found == [(i, *r) for i, r in enumerate(wanted, 10)]
    assert "Window" not in plan and len(parts) > 1
    assert shared.ranked(df.where("false"), [F.asc("name")]).count() == 0


def test_corpus_without_a_window(spark):
    df = spark.createDataFrame([("1950", "al", 3), ("1950", "bo", 3), ("1950", "cy", 9), ("1970", "di", 1)], "decade string, name string, weight long")
    got = correct.corpus(df, 1955, False)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(r.name, r.idx) for r in got.orderBy("idx").collect()] == [("cy", 0), ("al", 1), ("bo", 2)]


def test_tables_can_be_released(spark):
    path = shared.written(spark.range(3), "x").inputFiles()[0].rpartition("/")[0]
    assert shared.released(spark) >= 1 and not shared.delete(spark, path) and shared.released(spark) == 0


def test_all_pairs_are_dealt_over_cells(spark, matched):
    """Names of few bytes make long work: they are held in parts, and the number of tasks does not follow the bytes."""
    (tokens, names), _ = matched
    pairs = correct.matches(tokens.distinct(), names)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("REPARTITION_BY_NUM") == 2
    for t, n in ((0, 0), (1, 1), (100, 500_000), (100_000, 250_000), (1_000_000, 1_000_000)):
        own, parts = correct._grid(t, n, 12)
        assert own * parts >= 48 and t * n / (own * parts) <= correct.CELL and n / parts <= correct.BROADCAST_ROWS


def test_floors_keep_pairs_few(spark, matched):
    """What the index leaves open has a floor before it meets all names, so its pairs do not grow with the names."""
    (tokens, names), scores = matched
    for k in (1, 5):
        found = correct.contenders(tokens, names, k).groupBy("token").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect()
        best = {t: sorted((s for s, *_ in own), reverse=True) for t, own in scores.items()}
        assert all(r.n >= min(k, sum(s > 1e-9 for s in best[r.token])) for r in found)
    open_ = tokens.where("length(token) > 0").distinct().select("token", F.lit(0.0).alias("floor"))
    for k in (1, 5):
        floors = {r.token: r.floor for r in correct.raised(open_, names, k).collect()}
        assert set(floors) == set(scores) and sum(f > 0 for f in floors.values()) > len(floors) / 2
        assert all(f <= max(0.0, sorted((s for s, *_ in scores[t]), reverse=True)[k - 1]) + 1e-6 for t, f in floors.items())


def test_closest_returns_the_best_and_their_ties_alone(spark, matched, monkeypatch):
    """What the index leaves open: each token brings few rows back, in cells of any size, and none of the k best is lost."""
    (_, names), scores = matched
    odd = [("ŁÓDŹ" * 3, None, 9000), ("łódź" * 3, 7, 9001), ("z" * 150, 1, 9002), (None, 1, 9003), ("", 1, 9004)]
    names = names.unionByName(spark.createDataFrame(odd, names.schema))
    more = {"łódź" * 2 + "łÓdz": odd[1][0], "z" * 149: odd[2][0]}
    tokens = spark.createDataFrame([(t, 0.0) for t in [*scores, *more]], "token string, floor double")
    for k, step in ((1, 1 << 20), (5, 500)):
        monkeypatch.setattr(correct, "BOUNDS", step)
        monkeypatch.setattr(correct, "PAIRS", step)
        raised = correct.raised(tokens, names, k)
        found = {}
        for r in correct.closest(raised, names, k).collect():
            assert r.score == pytest.approx(naive_score(r.token, r.name)) and r.score > 0
            found.setdefault(r.token, set()).add(r.name)
        for t, own in scores.items():
            over = sorted((s for s, *_ in own if s > 1e-9), reverse=True)
            least = over[min(k, len(over)) - 1] if over else 101
            assert found.get(t, set()) >= {n for s, _, _, n in own if s >= least - 1e-9}
        assert all(name in found[t] for t, name in more.items())
        assert sum(map(len, found.values())) < len(scores) * names.count() / 10


def test_distances_as_far_as_they_are_asked_for():
    rng = random.Random(5)
    for n, m in ((1, 1), (1, 4), (5, 2), (8, 8), (9, 7), (7, 10)):
        a, b = (["".join(rng.choices("abc", k=size)) for _ in range(60)] for size in (n, m))
        codes = [correct._codes(pa.chunked_array([x]), len(x[0])) for x in (a, b)]
        for most in range(abs(n - m), 10):
            for x, y, got in zip(a, b, correct._distances(*codes, most)):
                wanted = naive_distance(x, y)
                assert got == wanted if wanted <= most else got > most


def test_no_words_are_sent_to_all_executors(matched):
    """Best names of any number of tokens: only the corpus's first names, of a fixed number, are broadcast."""
    (tokens, names), _ = matched
    for k in (1, 5):
        found = correct.contenders(tokens, names, k)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "Broadcast" not in plan


def test_cells_stay_small_as_tokens_and_names_grow(spark):
    """A few hundred tokens and many names: a task's pairs are bounded, and no length of names makes a task much longer than the others."""
    for t, n in ((690, 619_000), (2_000, 3_000_000), (20_000, 1_000_000)):
        own, parts = correct._grid(t, n, 12)
        assert t * n / (own * parts) <= 10_000_000
    own, parts = correct._grid(690, 619_000, 6)
    lengths = {6: 0.1, 7: 0.1, 8: 0.3, 9: 0.2, 10: 0.2, 11: 0.1}
    cells = [(n, p, g, share) for n, share in lengths.items() for p in range(parts) for g in range(own)]
    tasks = spark.createDataFrame(cells, "n int, p int, g int, share double").withColumn("task", F.pmod(F.hash("n", "p", "g"), F.lit(own * parts)))
    load = sorted(r.load for r in tasks.groupBy("task").agg(F.sum("share").alias("load")).collect())
    assert load[-1] / (own * parts) * 690 * 619_000 < 30_000_000
