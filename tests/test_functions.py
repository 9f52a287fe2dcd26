from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from folio.functions import text as fn
from folio.operators import correct

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"


def column(spark, values, f):
    """f over a column of values, in their order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_spaces(spark):
    values = [None, "", "  a  b "] + [f"{s}x{s}{s}y" for s in SPACES]
    assert column(spark, values, fn.normalize_space) == [re.sub(r"\s+", " ", v or "").strip() for v in values]


def test_chunks(spark):
    assert column(spark, ["Mr. Smith, Jane  Doe.", ".,", None], fn.chunks) == [["Mr", "Smith", "Jane Doe"], [], []]


def naive_split(text: str) -> str:
    """A direct model: words of letters, a capital after the first opens a new word."""

    def word(m):
        w = m[0]
        if len(w) < 6 or w.isupper():
            return w
        out, now = [], w[0]
        for c in w[1:]:
            if c.isupper() and now not in ("Mc", "Mac", "O"):
                out.append(now)
                now = c
            else:
                now += c
        return " ".join([*out, now])

    return re.sub("[A-Za-z]+", word, text)


@pytest.mark.parametrize(("given", "wanted"), [("JakeSmith", "Jake Smith"), ("JohnMcDonald", "John McDonald"), ("MacDonaldSmith", "MacDonald Smith"), ("ODonnell", "ODonnell"), ("EarlC", "EarlC"), ("DWIGHTFARRIS", "DWIGHTFARRIS"), ("DwightFARRIS", "Dwight F A R R I S")])
def test_joined_capitals(spark, given, wanted):
    assert column(spark, [given], fn.split_joined_capitals) == [wanted]


def test_joined_capitals_at_random(spark):
    r = random.Random(5)
    values = ["".join(r.choice(["Mc", "Mac", "O", "a", "b", "C", "D", " ", "-", "é", "efg"]) for _ in range(r.randint(0, 12))) for _ in range(400)]
    assert column(spark, values, fn.split_joined_capitals) == [naive_split(v) for v in values]


def test_title_beyond_ascii(spark):
    words = ["ßach", "straße", "élan", "ÉTÉ", "o'neill", "señor-ÑU", "àb1cd", "ﬁn", "ŉa", "", "12a", "ΣΑΣ"]
    found = spark.createDataFrame([(w,) for w in words], "w string").select("w", fn.title(F.col("w")).alias("t")).collect()
    assert {r.w: r.t for r in found if r.w not in ("ŉa", "ΣΑΣ")} == {w: w.title() for w in words if w not in ("ŉa", "ΣΑΣ")}


def test_title_of_a_long_token(spark):
    """The work is in proportion to the length: a growing copy for each letter would take minutes here."""
    long = "abC-é " * 60_000
    assert column(spark, [long, "", None], fn.title) == [long.title(), "", None]


def test_title_and_upper(spark):
    values = ["O'NEIL", "it's", "3rd", "keller'si iga", "ABC", "aBC", "É", "", "12"]
    assert column(spark, values, fn.title) == [v.title() for v in values]
    assert column(spark, values, fn.is_upper) == [v.isupper() for v in values]


def test_clean_name(spark):
    values = ["(BETTY WOODS)", "John F Kennedy", "Room 12", "KELLER'SI IGA", " . ", None, "Jo ²x"]
    assert column(spark, values, fn.clean_name) == ["Betty Woods", None, None, "Keller'Si Iga", None, None, None]
    assert column(spark, ["The Team"], lambda c: fn.clean_name(c, ("Team",))) == [None]


def test_similarity(spark):
    df = spark.createDataFrame([("smth", "smith"), ("abc", "abc"), ("j", "john"), (None, "a")], "a string, b string")
    assert [round(r[0], 6) for r in df.select(fn.similarity(F.col("a"), F.col("b"))).collect()] == [50.0, 100.0, 0.0, 0.0]
    assert df.select(fn.similarity(F.col("a"), F.col("b"), 60.0)).first()[0] == 0.0


def test_pages_and_stamps(spark):
    row = spark.sql("SELECT 7 AS n, TIMESTAMP '2020-01-02 03:04:05' AS t").select(fn.page_stem(F.col("n")), fn.utc_stamp(F.col("t"))).first()
    assert tuple(row) == ("page0007", "2020-01-02T03:04:05Z")
    assert fn.scale_of(144) == 2


def test_split_name(spark):
    values = ["john smith jr", "Smith, III", "  ", "anna  maria LEE"]
    found = [(r["given"], r["last"], r["suffix"]) for r in column(spark, values, correct.split_name)]
    assert found == [(["John"], "Smith", "Jr"), ([], "Smith", "Iii"), ([], "", ""), (["Anna", "Maria"], "Lee", "")]


def lev(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_best_names_against_all_pairs(spark):
    r = random.Random(3)
    names = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 8))) for _ in range(60)})
    weights = {n: r.randint(1, 5) for n in names}
    tokens = sorted({"".join(r.choice("abcd") for _ in range(r.randint(1, 8))) for _ in range(60)})
    for rising in (False, True):
        rows = [("1980", n, w) for n, w in weights.items()]
        corpus = correct.corpus(spark.createDataFrame(rows, "decade string, name string, weight long"), 1984, rising)
        order = sorted(names, key=lambda n: (weights[n] if rising else -weights[n], n))
        score = lambda t, n: max(0.0, (1 - (lev(t, n) + abs(len(t) - len(n))) / max(1, min(len(t), len(n)))) * 100)
        wanted = {t: max(order, key=lambda n: (score(t, n), -weights[n] if rising else weights[n])) for t in tokens}
        found = correct.best_names(spark.createDataFrame([(t,) for t in tokens], "token string"), corpus, rising)
        assert {r.token: r.best for r in found.collect()} == wanted


def test_correctors(spark, tmp_path):
    names = spark.createDataFrame([("  A   B ",)], "name string")
    assert correct.NoOpCorrector().correct(names).first().corrected == "A B"
    assert not correct.corrector(spark, False, "x", "y", 1980).enabled
    assert not correct.corrector(spark, True, str(tmp_path / "none.json"), "y", 1980).enabled
    (tmp_path / "f.json").write_text('{"1980": {"john": 9, "mary": 5}}')
    (tmp_path / "l.json").write_text('{"1950": {"smith": 1, "lee": 2}}')
    c = correct.corrector(spark, True, str(tmp_path / "f.json"), str(tmp_path / "l.json"), 1984)
    assert c.enabled
    given = ["jhon smth jr", "Mary 99 Lee", "J. Lee", "", "99"]
    found = c.correct(spark.createDataFrame([(n,) for n in given], "name string"))
    assert {r.name: r.corrected for r in found.collect()} == {"jhon smth jr": "John Smith, Jr", "Mary 99 Lee": "Mary Lee", "J. Lee": "John Lee", "": "", "99": "99"}


def test_clean_name_computes_each_step_once(spark):
    assert spark.range(1).select(fn.clean_name(F.lit("a b")).alias("n"))._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 1
    r = random.Random(8)
    values = ["".join(r.choice(["ab", "C", "DE", " ", "\t", "\u3000", ".", "(", ")", "é", "1"]) for _ in range(r.randint(0, 9))) for _ in range(400)]

    def naive(v):
        s = " ".join(v.split()).strip(fn.EDGES)
        own = (s.title() if s.isupper() else s).split()
        return " ".join(own) if own and not any(len(t) < 2 or "1" in t for t in own) else None

    assert column(spark, values, fn.clean_name) == [naive(v) for v in values]
    assert column(spark, values, fn.chunks) == [[c for c in (" ".join(p.split()) for p in re.split("[.,]+", v)) if c] for v in values]
