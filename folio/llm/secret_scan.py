"""Secret scan over a trigram inverted index. Native Spark SQL.

A rule's regular expression is turned into a Boolean query over trigrams that every match must contain
(lower-cased). The index is keyed by trigram: a posting list for each trigram of these queries and each
segment of about SEGMENT documents, so that no list grows with the input. In each segment the lists are
intersected and united as the queries say, which leaves a rule's candidates. Only these are verified, with
the regular expression over the whole text. A rule without mandatory trigrams scans every text.

Places follow from the lengths of the matches and of what lies between them, by running sums over a document's rows
of matches; spans are in code points, end exclusive, leftmost and non-overlapping for each kind. Texts are not
shuffled while candidates or spans are few enough to be sent to every executor; beyond that they are joined by key.

Defined cases: a null text is empty and has no span; a null doc_id is kept; repeated rows each get their
row; an empty table gives an empty result; columns other than doc_id and text are kept by redact(), whatever
their names, and ignored by scan(). Rows are told apart by doc_id and a 64-bit hash of the text.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _parser as sre  # the standard library's parser; only its tree is used

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import sent, table, unused, written


@dataclass(frozen=True)
class Rule:
    """value: the group whose length must reach least."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1


#: The three base rules of the query. A run of hex digits has one match, so its length is in the pattern.
BASE = [
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
]
#: Formats of widely used credentials.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE + MORE

#: Strings that are followed at most while a pattern's literal parts are multiplied out.
MOST = 64


def trigram_query(pattern: str):
    """The Boolean query: a trigram, ('and', parts), ('or', parts), or True if nothing is mandatory."""

    def both(kind: str, parts: list):
        stop = kind == "or"  # True absorbs an or and vanishes in an and
        if stop and (True in parts or not parts):
            return True
        parts = list(dict.fromkeys(p for p in parts if p is not True))
        return True if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))

    def of(strings: list[str]):
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
        least = [s for s in dict.fromkeys(sets) if not any(t < s for t in sets)]  # a larger set adds nothing to an or
        return both("or", [both("and", sorted(s) or [True]) for s in least])

    def walk(items) -> tuple[list[str] | None, object]:
        """Exact strings of a sequence, if few, and what it demands."""
        exact, run, demands = True, [""], []
        for op, arg in items:
            name, own, demand = str(op), None, True
            if name == "LITERAL":
                own = [chr(arg).lower()]
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                own = sorted({chr(a).lower() for _, a in arg})
            elif name == "SUBPATTERN":
                own, demand = walk(arg[3])
            elif name == "BRANCH":
                found = [walk(b) for b in arg[1]]
                demand = both("or", [d if e is None else of(e) for e, d in found])
                own = None if any(e is None for e, _ in found) else [s for e, _ in found for s in e]
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, high, inner = arg
                inner_exact, inner_demand = walk(inner)
                if inner_exact is not None and int(high) <= 1:
                    own = [*inner_exact, ""] if low == 0 else inner_exact
                elif low > 0:
                    demand = inner_demand if inner_exact is None else of(inner_exact)
            if own is not None and len(run) * len(own) <= MOST:
                run = [a + b for a, b in product(run, own)]
                continue
            exact = False
            demands += [of(run), demand if own is None else of(own)]
            run = [""]
        return (run, of(run)) if exact else (None, both("and", [*demands, of(run)]))

    strings, demand = walk(sre.parse(pattern))
    return demand if strings is None else of(strings)


def trigrams_of(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


#: Documents of a segment, about, and characters of a block that redaction cuts a text into.
SEGMENT, BLOCK = 4096, 4096


def selected(query, lists: Column) -> Column:
    """The keys that satisfy a query, from a segment's posting lists (a map from trigram to keys)."""
    if isinstance(query, str):
        return F.coalesce(F.try_element_at(lists, F.lit(query)), F.array().cast("array<struct<doc_id:string,h:bigint>>"))
    out = None
    for part in query[1]:
        own = selected(part, lists)
        out = own if out is None else F.array_intersect(out, own) if query[0] == "and" else F.array_union(out, own)
    return out


def postings(docs: DataFrame, grams: list[str], segments: int) -> DataFrame:
    """The inverted index, for these trigrams: segment, gram, keys (doc_id, h) of the documents that contain it (lower-cased)."""
    low = docs.select("doc_id", "h", F.lower("text").alias("low"))
    # A trigram costs one substring search; the rest of the text's trigrams belong to no query.
    has = F.filter(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]), lambda g: g.isNotNull())
    each = low.select(F.pmod(F.xxhash64("doc_id", "h"), F.lit(segments)).alias("segment"), F.explode(has).alias("gram"), F.struct(F.col("doc_id").cast("string").alias("doc_id"), "h").alias("key"))
    return each.groupBy("segment", "gram").agg(F.collect_set("key").alias("keys"))


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """key and the kinds of the rules whose query the document (doc_id, h, text) satisfies, of rules that have one."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {k: q for k, q in queries.items() if q is not True}
    if not queries:
        none = docs.select(F.struct(F.col("doc_id").cast("string").alias("doc_id"), "h").alias("key"), F.array().cast("array<string>").alias("kinds"))
        return none.where("false")
    grams = sorted(set().union(*map(trigrams_of, queries.values())))
    index = postings(docs, grams, max(1, -(-docs.count() // SEGMENT)))
    segments = index.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("lists"))
    found = F.array(*[F.struct(F.lit(k).alias("kind"), selected(q, F.col("lists")).alias("keys")) for k, q in queries.items()])
    each = segments.select(F.explode(found).alias("f")).select("f.kind", F.explode("f.keys").alias("key"))
    return each.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, h and text of each row; null texts are empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))


def _hits(rule: Rule) -> Column:
    """gap (characters since the last match), n (its own), ok (long enough) of each match, in order."""
    between, hits = F.split("text", rule.pattern, -1), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    # The pattern finds in a match by itself what it found there in the text.
    long = lambda h: F.length(F.regexp_extract(h, rule.pattern, rule.value) if rule.value else h) >= rule.least
    return F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda b, h: F.struct(F.length(b).alias("gap"), F.length(h).alias("n"), long(h).alias("ok")))


def spans(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id, h, order, start, end: a row for each span of each distinct (doc_id, text) of docs."""
    keyed = _keyed(docs)
    found = written(candidates(keyed, rules), "scan-candidates")
    key = F.struct(F.col("doc_id").cast("string").alias("doc_id"), "h")
    open_ = keyed.withColumn("_key", key).join(sent(found, found.count()), F.col("_key") == F.col("key"))
    matches = []
    for rows, indexed in ((open_, True), (keyed, False)):
        own = [(k, r) for k, r in enumerate(rules) if (trigram_query(r.pattern) is not True) == indexed]
        if not own:
            continue
        wanted = lambda r, i=indexed: F.array_contains("kinds", r.kind) if i else F.col("text").rlike(r.pattern)
        each = F.array(*[F.struct(F.lit(k).alias("order"), F.when(wanted(r), _hits(r)).alias("hits")) for k, r in own])
        rows = rows.select("doc_id", "h", F.explode(each).alias("e")).select("doc_id", "h", "e.order", F.posexplode("e.hits").alias("i", "x"))
        matches.append(rows.select("doc_id", "h", "order", "i", "x.gap", "x.n", "x.ok"))
    all_ = matches[0]
    for other in matches[1:]:
        all_ = all_.unionByName(other)
    # Repeated rows have the same matches. Running sums give the places: linear in the matches of a text.
    so_far = Window.partitionBy("doc_id", "h", "order").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    all_ = all_.dropDuplicates(["doc_id", "h", "order", "i"]).withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far).cast("int"))
    return all_.where("ok").select("doc_id", "h", "order", (F.col("end") - F.col("n")).alias("start"), "end")


def _to_rows(rows: DataFrame, of: DataFrame, n: int) -> DataFrame:
    """rows, which have doc_id and h, with the columns of `of`, which has one row for a key; sent if it is of few rows."""
    right = of.withColumnsRenamed({"doc_id": "_doc_id", "h": "_h"})
    return rows.join(sent(right, n), F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h") == F.col("_h")), "left").drop("_doc_id", "_h")


def listed(spans_: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans_, one), ",")


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id and spans (array of start, order, end, kind; by start, then the order of rules), one row for each row of docs."""
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("order") + 1)
    each = spans(docs, rules).withColumn("s", F.struct("start", "order", "end", kind.alias("kind")))
    held = each.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    out = _to_rows(_keyed(docs).select("doc_id", "h"), held.hint("merge"), 1 << 62)
    return out.select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")).alias("spans"))


def redact(docs: DataFrame, rules: list[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """docs with each secret (overlapping spans count as one) replaced by mark; n_chars, if there, follows the text."""
    order = Window.partitionBy("doc_id", "h").orderBy("start", "order")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    each = spans(docs, rules).withColumn("first", (F.coalesce(before, F.lit(0)) <= F.col("start")).cast("int"))
    each = each.withColumn("part", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = each.groupBy("doc_id", "h", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    held = parts.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("parts"))
    held = written(held, "scan-parts")
    # The caller's row travels as one column, so that its names meet none of these.
    row, text = unused(docs, "row"), F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"), F.struct(*docs.columns).alias(row))
    joined = _to_rows(rows, held, held.count())
    # A text is cut into blocks, so that a part costs what it and a block are long, wherever it lies.
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def between(cut: Column, start: Column, end: Column) -> Column:
        """The characters from start to before end."""
        first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
        own = F.array_join(F.slice(cut, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
        return F.when(end > start, F.substring(own, start - first * BLOCK + 1, end - start)).otherwise("")

    ends = F.concat(F.array(F.lit(0)), F.transform("parts", lambda p: p["end"]))
    starts = F.concat(F.transform("parts", lambda p: p["start"]), F.array(F.length("text")))
    # The blocks and the bounds are variables of a lambda, which are computed once for a text.
    once = F.array(F.struct(blocks.alias("cut"), F.arrays_zip(ends.alias("a"), starts.alias("b")).alias("open")))
    clean = F.get(F.transform(once, lambda v: F.array_join(F.transform(v["open"], lambda x: between(v["cut"], x["a"], x["b"])), mark)), F.lit(0))
    clean = F.when(F.col("parts").isNotNull(), clean).otherwise(F.col("text"))
    own = {c: F.col(row)[c] for c in docs.columns} | {"text": clean}
    out = joined.select(*[own[c].alias(c) for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["order"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def oracle_op4() -> str:
    parts = []
    for order, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
        SELECT id, {order} AS ord, '{r.kind}' AS kind, len(values_[i]) >= {r.least} AS ok,
            list_sum([length(x) FOR x IN gaps[1:i]]) + list_sum([length(x) FOR x IN hits[1:i]]) AS end_, length(hits[i]) AS n
        FROM (SELECT id, gaps, hits, values_, unnest(range(1, len(hits) + 1)) AS i FROM (
            SELECT id, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}', 0) AS hits,
                regexp_extract_all(text, '{p}', {r.value}) AS values_ FROM d WHERE regexp_matches(text, '{p}')))""")
    item = "kind || ':' || (end_ - n) || ':' || end_"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
    s AS (SELECT id, ord, kind, CAST(end_ AS BIGINT) AS end_, n FROM ({' UNION ALL '.join(parts)}) WHERE ok)
    SELECT d.doc_id, {counts},
        sha256(coalesce(string_agg({item}, ',' ORDER BY end_ - n, ord) FILTER (ord < {len(BASE)}), '')) AS base_sha256,
        coalesce(string_agg({item}, ',' ORDER BY end_ - n, ord), '') AS spans
    FROM d LEFT JOIN s ON d.id = s.id GROUP BY d.id, d.doc_id"""
