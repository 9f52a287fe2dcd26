"""Name correction against name corpora of a decade: (name, weight, idx) tables, best first.

Similarity is 100 (1 - (distance + difference of lengths) / shorter length), so a name that differs from a token of length n by
more than e edits scores at most 100 (1 - (e + 1) / n). Matching uses this bound in steps, each for the tokens that the
one before has left open: equal names; names that share a string left after up to EDITS deletions on both sides; and, for tokens
whose k-th best score is not above the bound then, names of the lengths that can still reach that score, of which only those
are compared whose letters allow it. That last step looks at all pairs of such lengths, but by a few operations on arrays of numbers;
it first meets the names of a token's own length, whose k-th best score is the floor for all others.

Defined cases: null and empty tokens match nothing; a token like no name gets what the functions say; a corpus may be empty;
repeated tokens are one; names that repeat in a corpus are rows each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions.text import SUFFIXES, corpus_key, normalize_space, similarity, title
from folio.operators.names import Recognizer, first_person
from folio.operators.shared import ranked, written

#: Names of a part of a corpus at most, which a task holds at once; none are sent to all executors.
BROADCAST_ROWS = 200_000
#: Pairs of a cell of the grid in which tokens meet names, cells for each core, and how many lengths of names a token asks for.
CELL, WAVES, COPIES = 10_000_000, 4, 8
#: Pairs of such a cell where only the best are asked for; bounds and pairs that a task holds at once; names of the least bound that a token begins with.
BOUNDS_CELL, BOUNDS, PAIRS, FIRST = 1_000_000_000, 4_000_000, 100_000, 64
#: Deletions by which names are found in the index, and the longest tokens that are looked up there.
EDITS, LONGEST = 2, 20


def pick_decade(year: Column, decades: Column) -> Column:
    """The year's decade if the sorted array has it; the first if it is earlier; else the last."""
    decade = (F.floor(year / 10) * 10).cast("int")
    return F.when(F.array_contains(decades, decade), decade).when(decade < F.array_min(decades), F.array_min(decades)).otherwise(F.array_max(decades))


def corpus(names: DataFrame, year: int, rising: bool) -> DataFrame:
    """name, weight, idx of the decade that fits the year; names: decade, name, weight. rising: a small weight is best."""
    names = written(names.select("decade", "name", "weight"), "names")
    decades = names.agg(F.array_sort(F.collect_set(F.col("decade").cast("int"))).alias("all"))
    chosen = decades.select(pick_decade(F.lit(year), F.col("all")).alias("d"))
    own = names.join(F.broadcast(chosen), F.col("decade").cast("int") == F.col("d")).select("name", "weight")
    rows = ranked(own, [F.asc("weight") if rising else F.desc("weight"), F.asc("name")])
    return rows.withColumn("idx", F.col("idx").cast("int"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """decade, name, weight of a JSON file {decade: {name: weight}}."""
    text = spark.read.text(path, wholetext=True)
    by_decade = F.from_json("value", "map<string,map<string,bigint>>")
    rows = text.select(F.explode(by_decade).alias("decade", "names"))
    return rows.select("decade", F.explode("names").alias("name", "weight"))


def _letters(text: Column) -> Column:
    """Bits of the characters that text has, and of those that it has twice, in 31 classes each."""
    bit = lambda c, by: F.call_function("shiftleft", F.lit(1).cast("long"), (F.ascii(c) % 31 + by).cast("int"))
    add = lambda m, c: m.bitwiseOR(F.when(m.bitwiseAND(bit(c, 0)) == 0, bit(c, 0)).otherwise(bit(c, 31)))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("long"), add)


def _at_least(a: Column, b: Column) -> Column:
    """Edits that texts with such letters differ by, at least: what one has and the other has not."""
    return F.greatest(F.bit_count(a.bitwiseAND(F.bitwise_not(b))), F.bit_count(b.bitwiseAND(F.bitwise_not(a))))


def deletions(text: Column, edits: int) -> Column:
    """The distinct strings that are left after up to so many deletions."""
    less = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, 1, i - 1), F.substr(x, i + 1)))
    levels = [F.array(text)]
    for _ in range(edits):
        longer = F.filter(levels[-1], lambda x: F.length(x) > 0)
        levels.append(F.array_distinct(F.flatten(F.transform(longer, less))))
    return F.array_distinct(F.concat(*levels))


def _bound(size: Column, edits: int) -> Column:
    """What a name that takes more edits than this scores at most with a token of this length."""
    return (1 - F.lit(edits + 1) / size) * 100


def _spread(words: DataFrame) -> DataFrame:
    """Words on as many tasks as the cluster runs at once: each makes far more work than its bytes tell Spark."""
    return words.repartition(words.sparkSession.sparkContext.defaultParallelism)


def near(tokens: DataFrame, names: DataFrame, edits: int = EDITS) -> DataFrame:
    """token and the columns of names: every pair that takes up to so many edits, and some more; tokens up to LONGEST.

    The index has many rows for each word, which Spark does not see before it runs, so neither side may be sent to all executors.
    """
    left = _spread(tokens).where(F.length("token") <= LONGEST).withColumn("_own", _letters(F.col("token")))
    left = left.select("token", "_own", F.explode(deletions(F.col("token"), edits)).alias("_key"))
    right = _spread(names).where(F.length("name") <= LONGEST + edits).withColumn("_letters", _letters(F.col("name")))
    right = right.select(*names.columns, "_letters", F.explode(deletions(F.col("name"), edits)).alias("_key"))
    pairs = left.join(right.hint("merge"), "_key").where(F.abs(F.length("token") - F.length("name")) <= edits)
    return pairs.where(_at_least(F.col("_own"), F.col("_letters")) <= edits).select("token", *names.columns).distinct()


def _reachable(size: Column, score: Column) -> Column:
    """Lengths of names that can have this score with a token of this length, as the distance is no less than the difference."""
    room = 1 - score / 100
    least = F.floor(size - size * room / (2 + room) - 1e-9)  # a shorter name divides by its own length
    return F.sequence(F.greatest(least, F.lit(1)).cast("int"), F.ceil(size + size * room / 2 + 1e-9).cast("int"))


def _grid(tokens: int, names: int, cores: int, cell: int = CELL) -> tuple[int, int]:
    """Into how many parts tokens and names are dealt: at least WAVES cells for each core, of so many pairs at most, with few copied rows."""
    cells = max(WAVES * cores, -(-tokens * names // cell))
    own = min(cells, max(1, round((COPIES * tokens * cells / max(1, names)) ** 0.5)))
    return own, max(-(-cells // own), -(-names // BROADCAST_ROWS))


def _dealt(tokens: DataFrame, names: DataFrame, lengths: Column, cell: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Tokens and names on a grid of cells, and the keys on which they meet: a length of names that the token asks for, and the parts of both."""
    own, parts = _grid(tokens.count(), names.count(), tokens.sparkSession.sparkContext.defaultParallelism, cell)
    dealt = lambda word, n: F.pmod(F.xxhash64(word), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = names.where("length(name) > 0").withColumns({"_size": F.length("name"), "_letters": _letters(F.col("name")), "_part": dealt("name", parts)}).withColumn("_group", every(own))
    asked = tokens.withColumns({"_own": _letters(F.col("token")), "_n": F.length("token"), "_group": dealt("token", own)})
    asked = asked.withColumn("_size", F.explode(lengths)).withColumn("_part", every(parts))
    # A number of partitions that is asked for is not made smaller for the few bytes that these rows have.
    keys = ["_size", "_part", "_group"]
    return asked.repartition(own * parts, *keys), held.repartition(own * parts, *keys), keys


def far(tokens: DataFrame, names: DataFrame) -> DataFrame:
    """token, the columns of names, score: every pair with a score over 0 and no less than floor; tokens: token, floor.

    Each part of the tokens meets each part of the names in a cell, which has one task for the names of a length: its names are
    held, its tokens pass. Pairs of the right lengths meet; the letters of both bound the distance before it is computed.
    """
    asked, held, keys = _dealt(tokens, names, _reachable(F.length("token"), F.col("floor")), CELL)
    pairs = asked.join(held.hint("shuffle_hash"), keys)
    apart, shorter = F.abs(F.col("_n") - F.col("_size")), F.least("_n", "_size")
    # Edits that the floor allows, and those that the letters ask for. The distance is computed where the first are no fewer, and
    # only as far as they go.
    allowed = F.floor(shorter * (1 - F.col("floor") / 100) + 1e-9).cast("int") - apart
    least = F.greatest(_at_least(F.col("_own"), F.col("_letters")), apart)
    found = pairs.withColumns({"_apart": apart, "_shorter": shorter, "_allowed": allowed}).where(least <= F.col("_allowed"))
    found = found.withColumn("_distance", F.expr("levenshtein(token, name, _allowed)")).where("_distance >= 0")
    found = found.withColumn("score", (1 - (F.col("_distance") + F.col("_apart")) / F.col("_shorter")) * 100)
    return found.select("token", *names.columns, "score").where("score > 0")


def matches(tokens: DataFrame, names: DataFrame) -> DataFrame:
    """token, name, weight, idx, score of all pairs with a score over 0; tokens: distinct token."""
    asked = written(tokens.where("length(token) > 0").select("token", F.lit(0.0).alias("floor")), "asked")
    return far(asked, written(names.select("name", "weight", "idx"), "corpus"))


def _kth(scored: DataFrame, k: int) -> DataFrame:
    """token and floor, its k-th best score, of those that have so many."""
    if k == 1:
        return scored.groupBy("token").agg(F.max("score").alias("floor"))
    order = Window.partitionBy("token").orderBy(F.desc("score"))
    return scored.select("token", "score", F.row_number().over(order).alias("_r")).where(F.col("_r") == k).select("token", F.col("score").alias("floor"))


def _codes(words: pa.ChunkedArray, size: int) -> np.ndarray:
    """The code points of words of one length: a row for each place."""
    codes = np.array(words.to_pylist(), f"U{size}").view(np.uint32).reshape(-1, size).T
    return np.ascontiguousarray(codes, np.uint8 if codes.size and codes.max() < 256 else np.uint32)


def _distances(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Edit distances of the pairs of columns of a and b as far as most; what is more may be any number over most."""
    n, m, kind = len(a), len(b), np.uint8 if len(a) + len(b) < 120 else np.int32
    # A path of so many edits is never farther from the diagonal.
    reach, none = max(n - m, m - n, (most + abs(n - m)) // 2), np.full(a.shape[1], n + m + 1, kind)
    row = [np.full(a.shape[1], j, kind) if j <= reach else none for j in range(m + 1)]
    for i in range(n):
        low = max(0, i - reach)
        before, row[low] = row[low], np.full(a.shape[1], i + 1, kind) if low == 0 and i < reach else none
        for j in range(low, min(m, i + reach + 1)):
            here = np.minimum(row[j], row[j + 1])
            here += 1
            before, row[j + 1] = row[j + 1], np.minimum(here, before + (a[i] != b[j]), out=here)
    return row[m]


def _nearest(k: int):
    """Of tokens and the names of one length: the pairs of each token's k best names, and all that tie with the k-th, that reach its floor."""

    def compared(own, names, text, n, apart, allowed):
        """Rows of tokens (all of length n) and of names, and distances."""
        mine, letters = own["_own"].to_numpy().view(np.uint64), names["_letters"].to_numpy().view(np.uint64)
        asked, bits, ones = _codes(own["token"], n), np.bitwise_count(mine), np.bitwise_count(letters)
        if asked.dtype != text.dtype:
            asked, text = asked.astype(np.uint32), text.astype(np.uint32)
        gaps = {b: np.abs(ones.astype(np.int16) - b).astype(np.uint8) for b in set(bits.tolist())}

        def measured(rows, at, most):
            for i in range(0, len(rows), PAIRS):
                r, c = rows[i : i + PAIRS], at[i : i + PAIRS]
                yield _distances(asked.take(r, 1), text.take(c, 1), int(most[r].max()))

        width = n + len(text) + 1
        step = max(1, BOUNDS // max(1, len(letters)))
        for start in range(0, len(mine), step):
            most, ends = allowed.copy(), range(start, min(start + step, len(mine)))
            # Twice the edits that the letters ask for: the sum of what each has alone, and the difference of both numbers.
            bounds = [np.bitwise_count(mine[t] ^ letters) + gaps[bits[t].item()] for t in ends]
            level = [next(x for x in range(most[t] + 1) if x == most[t] or np.count_nonzero(b <= 2 * x) >= max(FIRST, k)) for t, b in zip(ends, bounds)]
            parts, counts = [], np.zeros((len(ends), width), np.int64)
            for again in (False, True):
                at = [np.flatnonzero((b > 2 * x) & (b <= 2 * most[t]) if again else b <= 2 * x) for t, b, x in zip(ends, bounds, level)]
                rows, at = np.repeat(np.arange(ends.start, ends.stop), [len(x) for x in at]), np.concatenate(at)
                found = np.concatenate([np.empty(0, np.uint8), *measured(rows, at, most)])
                good = found <= most[rows]
                parts.append((rows[good], at[good], found[good].astype(np.int64)))
                rows, _, found = parts[-1]
                counts += np.bincount((rows - start) * width + found, minlength=counts.size).reshape(counts.shape)
                # The k-th least distance, where there are so many.
                most[start : ends.stop] = np.minimum(most[start : ends.stop], (counts.cumsum(1) < k).sum(1))
            rows, at, found = (np.concatenate(x) for x in zip(*parts))
            good = found <= most[rows]
            yield rows[good], at[good], found[good]

    def cell(tokens: pa.Table, names: pa.Table) -> pa.Table:
        out = []
        if len(tokens) and len(names):
            size = names["_size"][0].as_py()
            text, lengths = _codes(names["name"], size), tokens["_n"].to_numpy()
            for n in set(lengths.tolist()):
                own, apart, shorter = tokens.filter(pa.array(lengths == n)), abs(n - size), min(n, size)
                # Edits that the floor allows; with as many as the shorter length the score is 0.
                allowed = np.minimum(np.floor(shorter * (1 - own["floor"].to_numpy() / 100) + 1e-9), shorter - 1).astype(np.int64) - apart
                own, allowed = own.filter(pa.array(allowed >= apart)), allowed[allowed >= apart]
                for rows, at, found in compared(own, names, text, n, apart, allowed) if len(own) else ():
                    score = (1 - (found + apart) / shorter) * 100
                    held = names.select([c for c in names.column_names if not c.startswith("_")]).take(pa.array(at))
                    out.append(held.add_column(0, "token", own["token"].take(pa.array(rows))).append_column("score", pa.array(score)))
        if out:
            return pa.concat_tables(out)
        empty = names.select([c for c in names.column_names if not c.startswith("_")]).slice(0, 0)
        return empty.add_column(0, "token", pa.array([], pa.string())).append_column("score", pa.array([], pa.float64()))

    return cell


def closest(tokens: DataFrame, names: DataFrame, k: int, lengths: Column | None = None) -> DataFrame:
    """token, the columns of names, score: at least each token's k best names of those lengths (all that reach its floor), and all that tie
    with the k-th, as far as they score over 0 and no less than floor; tokens: token, floor.

    The cells of far(), but a token has few rows for each: the letters of all pairs of a cell are compared as arrays, then the distances of
    the likeliest names, whose k-th limits how many more are computed.
    """
    asked, held, keys = _dealt(tokens, names, _reachable(F.length("token"), F.col("floor")) if lengths is None else lengths, BOUNDS_CELL)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in names.schema]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_nearest(k), ", ".join(["token string", *kinds, "score double"]))


def raised(tokens: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """token and floor with higher floors: the k-th best score of the names of a token's own length is one that k of all names reach.

    Only the bound comes from those names; closest() then meets all that can reach it, which are few.
    """
    best = _kth(closest(tokens, names, k, F.array(F.length("token"))), k).withColumnRenamed("floor", "_more")
    both = tokens.join(best.hint("merge"), "token", "left")
    return written(both.select("token", F.greatest("floor", F.coalesce("_more", F.lit(0.0))).alias("floor")), "floors")


def contenders(tokens: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """token, name, weight, idx, score: for each token at least its k best names that score over 0, and all that tie with the k-th.

    Tokens and names take few bytes for their number, so no join may send them to all executors, which would pass them through the driver.
    """
    names = names.select("name", "weight", "idx")
    tokens = written(tokens.where("length(token) > 0").select("token").distinct(), "tokens")
    found = []
    if k == 1:  # a name that equals its token has the highest score, which no other has
        same = tokens.join(names.hint("merge"), tokens.token == names.name).select("token", *names.columns, F.lit(100.0).alias("score"))
        found.append(written(same, "equal"))
        tokens = written(tokens.join(found[-1].select("token").distinct().hint("merge"), "token", "left_anti"), "tokens")
    if not tokens.isEmpty():
        close = written(near(tokens, names).withColumn("score", similarity(F.col("token"), F.col("name"))), "near").where("score > 0")
        # The k-th best score of each token, if it has so many; the rest of its names score no more than the bound.
        both = tokens.join(_kth(close, k).hint("merge"), "token", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
        bound = F.when(F.length("token") <= LONGEST, _bound(F.length("token"), EDITS)).otherwise(F.lit(100.0))
        settled = (F.col("floor") > bound) | (bound <= 0)
        both = written(both.withColumn("settled", settled), "settled")
        found.append(close.join(both.where("settled").select("token").hint("merge"), "token"))
        open_ = both.where("NOT settled").select("token", "floor")
        if not open_.isEmpty():
            held = written(names, "corpus")
            found.append(closest(raised(open_, held, k), held, k))
    if not found:
        return tokens.join(names, F.lit(False)).withColumn("score", F.lit(0.0))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def top_matches(tokens: DataFrame, names: DataFrame, k: int = 5) -> DataFrame:
    """The k best names of each token with rank 1 to k: highest score, then the corpus's own order; scores may be 0."""
    order = Window.partitionBy("token").orderBy(F.desc("score"), "idx")
    found = contenders(tokens, names, k)
    # What scores 0 comes in the corpus's order, so of such names only the first k + k can be among the best, as at most k score more.
    first = names.where(F.col("idx") < 2 * k).select("name", "weight", "idx")
    rest = tokens.where("length(token) > 0").distinct().crossJoin(F.broadcast(first)).withColumn("score", similarity(F.col("token"), F.col("name"))).where("score = 0")
    both = found.unionByName(rest.select("token", "name", "weight", "idx", "score"))
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_names(tokens: DataFrame, names: DataFrame, rising: bool, min_score: float = 0.0) -> DataFrame:
    """token and best: highest score, then weight, then corpus order. A token like no name gets the corpus's
    first, as every name then scores 0; with min_score over 0, or an empty corpus, it stays as it is."""
    prior = -F.col("weight") if rising else F.col("weight")
    found = contenders(tokens, names, 1).where(F.col("score") >= min_score)
    best = found.groupBy("token").agg(F.max_by("name", F.struct("score", prior.alias("w"), (-F.col("idx")).alias("i"))).alias("best"))
    out = tokens.where("length(token) > 0").distinct().join(best.hint("merge"), "token", "left")
    if min_score > 0:
        return out.withColumn("best", F.coalesce("best", "token"))
    head = names.where("idx = 0").agg(F.first("name").alias("head"))
    return out.withColumn("_head", head.scalar()).select("token", F.coalesce("best", "_head", "token").alias("best"))


def _words(text: Column) -> Column:
    return F.filter(F.split(normalize_space(text), " "), lambda w: w != "")


def base_and_suffix(text: Column) -> Column:
    """struct(base, suffix) of a name in title case: what is before a comma, or a last word that is one of SUFFIXES, and that."""
    base = title(normalize_space(text))
    all_ = _words(base)
    last = F.get(F.reverse(all_), F.lit(0))
    comma, ends = F.instr(base, ",") > 0, F.coalesce(F.lower(F.rtrim(last, F.lit("."))).isin(*SUFFIXES), F.lit(False))
    short = F.array_join(F.slice(all_, 1, F.greatest(F.size(all_) - 1, F.lit(0))), " ")
    own = F.when(comma, F.substring_index(base, ",", 1)).when(ends, short).otherwise(base)
    suffix = F.when(comma, F.trim(F.regexp_extract(base, r"(?s)^[^,]*,(.*)$", 1))).when(ends, last).otherwise("")
    return F.struct(own.alias("base"), suffix.alias("suffix"))


def given_and_last(name: Column) -> Column:
    """struct(given array, last): the words of a name but the last, and the last."""
    own = _words(name)
    return F.struct(F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0))).alias("given"), F.coalesce(F.get(F.reverse(own), F.lit(0)), F.lit("")).alias("last"))


def split_name(text: Column) -> Column:
    """struct(given array, last, suffix) of a name in title case."""
    parts = base_and_suffix(text)
    own = given_and_last(parts["base"])
    return F.struct(own["given"].alias("given"), own["last"].alias("last"), parts["suffix"].alias("suffix"))


class NoOpCorrector:
    enabled = False

    def correct(self, names: DataFrame) -> DataFrame:
        return names.select("name", normalize_space(F.col("name")).alias("corrected"))


class NameCorrector:
    """Given names by (similarity, frequency), the last name by (similarity, rank).

    recognizer: reads the name without its suffix; the first person that it finds there is split, else all of it.
    """

    enabled = True

    def __init__(self, first: DataFrame, last: DataFrame, min_score: float = 0.0, recognizer: Recognizer | None = None):
        self.first, self.last, self.min_score, self.recognizer = first, last, min_score, recognizer

    def split(self, names: DataFrame) -> DataFrame:
        """name and p (given array, last, suffix) of each distinct name, which the recogniser reads once."""
        parts = names.select("name").distinct().withColumn("_b", base_and_suffix(F.col("name")))
        parts = parts.select("name", F.col("_b.suffix").alias("suffix"), first_person(F.col("_b.base"), self.recognizer).alias("_who"))
        own = parts.withColumn("_p", given_and_last(F.col("_who")))
        return own.select("name", F.struct("_p.given", "_p.last", "suffix").alias("p"))

    def correct(self, names: DataFrame) -> DataFrame:
        """name and corrected for each distinct name; distinct tokens are matched once."""
        parts = written(self.split(names), "name-parts")
        given = parts.select("name", F.posexplode("p.given").alias("pos", "raw")).withColumn("token", corpus_key(F.col("raw"))).where("token <> ''")
        firsts = best_names(given.select("token").distinct(), self.first, False, self.min_score)
        given = given.join(firsts, "token").groupBy("name").agg(F.sort_array(F.collect_list(F.struct("pos", title(F.col("best")).alias("t")))).alias("g"))
        lasts = parts.select("name", F.col("p.last").alias("raw"), F.col("p.suffix").alias("suffix")).withColumn("token", corpus_key(F.col("raw")))
        best = best_names(lasts.select("token").distinct(), self.last, True, self.min_score)
        out = lasts.join(best, "token", "left").join(given, "name", "left")
        last = title(F.coalesce("best", "raw"))
        firsts_ = F.coalesce(F.array_join(F.transform("g", lambda x: x["t"]), " "), F.lit(""))
        whole = F.trim(F.concat_ws(" ", F.when(firsts_ != "", firsts_), last))
        whole = F.when(F.col("suffix") != "", F.concat(whole, F.lit(", "), title(F.col("suffix")))).otherwise(whole)
        raw = normalize_space(F.col("name"))
        return out.select("name", F.when((raw == "") | (whole == ""), raw).otherwise(whole).alias("corrected"))


def corrector(spark: SparkSession, enabled: bool, first_path: str, last_path: str, year: int, recognizer: Recognizer | None = None) -> NoOpCorrector | NameCorrector:
    """A corrector if it is enabled and both corpora can be read; else one that only normalises."""
    if not enabled:
        return NoOpCorrector()
    try:
        first, last = corpus(read_corpus(spark, first_path), year, False), corpus(read_corpus(spark, last_path), year, True)
        if not (first.limit(1).count() and last.limit(1).count()):
            return NoOpCorrector()
    except Exception as e:  # whatever keeps the corpora from being read
        print(f"name correction is off: {type(e).__name__}")
        return NoOpCorrector()
    return NameCorrector(first, last, recognizer=recognizer)
