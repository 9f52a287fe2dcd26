"""URL filter: allow/block rules, and a character language-model ratio where no rule fits. Native Spark SQL.

Two smoothed variable-order Markov models are counted, one over the URLs that a rule allows and one over
those that a rule blocks: orders 0 to ORDER, each interpolated with the next shorter context
(Witten-Bell: the weight of the shorter context is distinct followers / (occurrences + distinct
followers)). A URL without a rule is allowed if its log-likelihood difference, divided by its length,
reaches a threshold that is calibrated on labelled URLs which the counting left out (a quarter).

The counts are exact: a table of every gram of ORDER + 1 characters, which grows with the labelled URLs and
holds the shorter grams as their suffixes. Probabilities are computed once for each distinct gram that is to be
scored, by joins on grams, order by order, and then joined to the places of the URLs.

Host and path are for the rules only; the models count and score the whole URL (null: empty). Which URLs the
counting leaves out goes by host and path, so that URLs that differ in their query only are on the same side.

Defined cases: a null URL or one without '://' has empty host and path and matches no rule; a null or empty URL
scores 0; without labelled URLs of both kinds the threshold is 0; a score equal to the threshold is allowed.
Repeated rows each get their verdict. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import table, written

#: The rules of the query, as (verdict, host and path prefix).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
ORDER = 4
START, END = "\x01", "\x02"
#: Calibration: scores from -SPAN to SPAN (nats per character) in BINS bins.
SPAN, BINS = 8.0, 512
#: Probability of a character in an empty context that the model never saw.
UNIFORM = 1.0 / 256
#: What the models read unless told otherwise (judge() has them read the URL), and parts of a nat in which log ratios are added up.
TEXT = "concat(host, path)"
UNITS = 1e10


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """host: after the first '://' up to / ? # or the end, A-Z lower-cased; path: then up to ? # or the end."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    pages = pages.withColumn("_rest", rest)
    host = F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumns(
        {"host": F.coalesce(host, F.lit("")), "path": F.coalesce(F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1), F.lit(""))}
    ).drop("_rest")


def rule_of(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict (null without one)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(text: str) -> Column:
    """The grams of ORDER + 1 characters, one for each character and the end: the last character follows the others."""
    padded = f"concat('{START * ORDER}', {text}, '{END}')"
    return F.expr(f"transform(sequence(1, length({text}) + 1), i -> substring({padded}, i, {ORDER + 1}))")


def model(labelled: DataFrame, text: str = TEXT) -> DataFrame:
    """gram, allow, block: how often each gram of ORDER + 1 characters is in the texts of each label.

    labelled has label (allow, block) and the columns of text, the SQL of what the models read.
    """
    grams = labelled.select("label", F.explode(_grams(text)).alias("gram"))
    return grams.groupBy("gram").agg(*[F.count_if(F.col("label") == label).alias(label) for label in ("allow", "block")])


def ratios(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """gram, ratio: log P(last character | the others, allow) - log P(.. | block) of each of the distinct grams.

    Every join is of distinct grams, so that no key has more rows than there are characters.
    """
    labels, lower = ("allow", "block"), None
    for k in range(ORDER + 1):
        suffix = F.substring("gram", ORDER + 1 - k, k + 1)
        level = counts.groupBy(suffix.alias("g")).agg(*[F.sum(x).alias(x) for x in labels])
        sums = [a for x in labels for a in (F.sum(x).alias(f"total_{x}"), F.count_if(F.col(x) > 0).alias(f"kinds_{x}"))]
        contexts = level.groupBy(F.substring("g", 1, k).alias("context")).agg(*sums)
        found = grams.select(suffix.alias("g")).distinct().join(level, "g", "left")
        found = found.withColumn("context", F.substring("g", 1, k)).join(contexts, "context", "left").withColumn("shorter", F.substring("g", 2, k))
        found = found.join(lower, "shorter") if lower is not None else found.withColumns({f"lower_{x}": F.lit(UNIFORM) for x in labels})
        each = {}
        for x in labels:
            n, total, kinds = F.coalesce(x, F.lit(0)), F.col(f"total_{x}"), F.col(f"kinds_{x}")
            each[x] = F.when(total > 0, (n + kinds * F.col(f"lower_{x}")) / (total + kinds)).otherwise(F.col(f"lower_{x}"))
        lower = found.select(F.col("g").alias("shorter"), *[p.alias(f"lower_{x}") for x, p in each.items()])
    return lower.select(F.col("shorter").alias("gram"), (F.log("lower_allow") - F.log("lower_block")).alias("ratio"))


def scores(urls: DataFrame, counts: DataFrame, text: str = TEXT) -> DataFrame:
    """host, path, label, text and score of every distinct URL.

    score: (log P(text | allow) - log P(text | block)) / length, in nats per character.
    """
    urls = urls.select("host", "path", "label", F.expr(text).alias("text")).distinct()
    urls = written(urls.withColumn("uid", F.monotonically_increasing_id()), "url-texts")
    at = urls.select("uid", F.explode(_grams("text")).alias("gram"))
    grams = written(at.select("gram").distinct(), "url-grams")
    at = at.hint("merge").join(ratios(grams, counts), "gram")  # beginnings of URLs are hot: AQE splits sort-merge joins
    # Whole numbers make the sum independent of the order of rows.
    total = at.groupBy("uid").agg((F.sum(F.round(F.col("ratio") * UNITS).cast("long")) / UNITS).alias("total"))
    mean = F.round(F.col("total") / (F.length("text") + 1), 9)
    return urls.join(total, "uid").select("host", "path", "label", "text", F.when(F.col("text") == "", F.lit(0.0)).otherwise(mean).alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row: the edge of the grid at which the two error rates of labelled scores have the least sum."""
    bin_of = F.least(F.greatest(F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    counts = scored.groupBy(bin_of.alias("bin")).agg(F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("b"))
    grid = scored.sparkSession.range(BINS).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").fillna(0, ["a", "b"])
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS rows
    all_ = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    grid = grid.select(
        ((F.col("bin") / BINS) * 2 * SPAN - SPAN).alias("edge"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("b").over(below), F.lit(0)).alias("caught"),
        F.sum("a").over(all_).alias("na"), F.sum("b").over(all_).alias("nb"),
    )
    errors = F.col("lost") / F.col("na") + 1 - F.col("caught") / F.col("nb")
    best = grid.where("na > 0 AND nb > 0").agg(F.min(F.struct(F.round(errors, 9).alias("e"), F.abs("edge").alias("far"), "edge")).alias("best"))
    return best.select(F.coalesce("best.edge", F.lit(0.0)).alias("edge"))


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score, threshold of every row of pages (page_id, url)."""
    urls = with_host_and_path(pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")))
    rule, verdict = rule_of(rules)
    urls = urls.withColumns({"rule": rule, "label": verdict})
    held = F.pmod(F.xxhash64(F.lit("calibration"), "host", "path"), F.lit(4)) == 0
    labelled = urls.where("label IS NOT NULL")
    counts = written(model(labelled.where(~held), "url"), "url-model")
    scored = written(scores(urls, counts, "url"), "url-scores").withColumn("held", held)  # one pass serves calibration and verdicts
    edge = threshold(scored.where("held AND label IS NOT NULL"))
    by_model = F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")
    judged = urls.join(scored.select(F.col("text").alias("url"), "score"), "url", "left").withColumn("threshold", edge.scalar())
    return judged.select("page_id", "host", "path", "rule", F.coalesce("label", by_model).alias("verdict"), "score", "threshold")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
