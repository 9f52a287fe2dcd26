"""The registered queries of the pipeline's operators, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions import text as fn
from folio.operators import correct, names, ocr, sections, shared
from folio.sources import adapters

YEAR = 1980
QUERIES = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shared.spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.from_documents(_table(spark, sf_dir, "documents"))


def _joined(array: str):
    return F.array_join(F.transform(array, lambda x: x.cast("string")), "|")


# SQL that several oracles share.
def _norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{fn.SPACE}+', ' ', 'g'))"


_BLOCKS = """lines_ AS (SELECT doc_id AS book, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
    blocks AS (SELECT book, CAST((i - 1) // 20 + 1 AS INTEGER) AS page, CAST(i - 1 AS INTEGER) AS pos, CAST((i - 1) % 20 + 1 AS DOUBLE) AS y,
        CASE WHEN length(l[i]) <= 40 THEN 'header' ELSE 'text' END AS label, l[i] AS content FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM lines_))"""
_MARKERS = f"""markers AS (SELECT book, CAST(row_number() OVER (PARTITION BY book ORDER BY page, y, pos) AS INTEGER) AS marker, page, y, pos, header
        FROM (SELECT *, {_norm("content")} AS header FROM blocks WHERE lower(label) IN ('header', 'paragraph_title'))
        WHERE header <> '' AND NOT regexp_matches(lower(header), 'starter|player|captain'))"""
_TEXTS = f"""texts AS (SELECT book, page, y, pos, {_norm("content")} AS text FROM blocks
        WHERE lower(label) NOT IN ('header', 'paragraph_title', 'footer', 'image') AND {_norm("content")} <> '')"""
_ASSIGNED = """assigned AS (SELECT book, marker, page, y, pos, text FROM (
        SELECT book, page, y, pos, kind, text, last_value(marker IGNORE NULLS) OVER (PARTITION BY book ORDER BY page, y, kind, pos ROWS UNBOUNDED PRECEDING) AS marker
        FROM (SELECT book, page, y, pos, 0 AS kind, marker, NULL AS text FROM markers UNION ALL SELECT book, page, y, pos, 1, NULL, text FROM texts))
        WHERE kind = 1 AND marker IS NOT NULL)"""
_ALL = f"WITH {_BLOCKS}, {_MARKERS}, {_TEXTS}, {_ASSIGNED}"
_WORDS = "words AS (SELECT doc_id, pos - 1 AS pos, w AS word FROM (SELECT doc_id, unnest(s) AS w, unnest(range(1, len(s) + 1)) AS pos FROM (SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS s FROM documents WHERE text IS NOT NULL)) WHERE w <> '')"
_CORPUS = """capital AS (SELECT lower(word) AS name, count(*) AS n FROM words WHERE regexp_full_match(word, '[A-Z][a-z]+') GROUP BY 1),
    first_ AS (SELECT name, n AS weight, row_number() OVER (ORDER BY n DESC, name) - 1 AS idx FROM capital),
    last_ AS (SELECT name, row_number() OVER (ORDER BY n DESC, name) AS weight, row_number() OVER (ORDER BY n DESC, name) - 1 AS idx FROM capital)"""


@query(f"WITH {_BLOCKS} SELECT book, page, pos, y, label, content FROM blocks")
def blocks_from_documents(spark, sf_dir):
    return _blocks(spark, sf_dir)


@query(f"WITH {_BLOCKS} SELECT book, label, count(*) AS n FROM blocks GROUP BY 1, 2")
def label_counts(spark, sf_dir):
    return ocr.label_counts(_blocks(spark, sf_dir))


@query(f"WITH {_BLOCKS} SELECT book, count(DISTINCT page) AS pages, count(*) AS blocks, count(*) FILTER (label = 'header') AS headers FROM blocks GROUP BY 1")
def page_totals(spark, sf_dir):
    # Distinct pages first, so that both counts are plain sums.
    pages = _blocks(spark, sf_dir).groupBy("book", "page").agg(F.count("*").alias("n"), F.count_if(F.col("label") == "header").alias("h"))
    return pages.groupBy("book").agg(F.count("*").alias("pages"), F.sum("n").alias("blocks"), F.sum("h").alias("headers"))


@query(f"WITH {_BLOCKS} SELECT book, page, pos, content FROM blocks WHERE label = 'header'")
def headers_index(spark, sf_dir):
    return ocr.headers_index(_blocks(spark, sf_dir))


@query(f"WITH {_BLOCKS}, {_MARKERS} SELECT book, marker, page, y, pos, header FROM markers")
def header_markers(spark, sf_dir):
    return sections.markers(_blocks(spark, sf_dir))


@query(f"WITH {_BLOCKS}, {_TEXTS} SELECT book, page, y, pos, text FROM texts")
def text_blocks(spark, sf_dir):
    return sections.text_rows(_blocks(spark, sf_dir))


@query(f"SELECT doc_id, {_norm('text')} AS text FROM documents")
def normalize_space(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", fn.normalize_space(F.col("text")).alias("text"))


@query(f"""SELECT doc_id, array_to_string([l[i] FOR i IN range(1, len(l) + 1) IF {_norm("l[i]")} <> ''], '|') AS texts,
    array_to_string([i FOR i IN range(1, len(l)) IF {_norm("l[i]")} <> ''], '|') AS scores FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)""")
def clean_parallel_arrays(spark, sf_dir):
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("rec_texts"))
    # One score less than there are texts.
    scores = F.slice(F.transform("rec_texts", lambda _, i: i + 1), 1, F.greatest(F.size("rec_texts") - 1, F.lit(0)))
    clean = ocr.clean_arrays(lines.withColumn("rec_scores", scores))
    return clean.select("doc_id", F.array_join("rec_texts", "|").alias("texts"), _joined("rec_scores").alias("scores"))


_CHUNKS = f"""c AS (SELECT doc_id, [{_norm("x")} FOR x IN string_split_regex({_norm("text")}, '[.,]+') IF {_norm("x")} <> ''] AS c FROM documents),
    chunks AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS idx, c[i] AS chunk FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM c))"""


@query(f"WITH {_CHUNKS} SELECT doc_id, idx, chunk FROM chunks")
def candidate_chunks(spark, sf_dir):
    return names.candidates(_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def _pairs(spark, sf_dir) -> DataFrame:
    """Distinct words made of two ASCII words that follow each other, both with a capital."""
    own = adapters.words_of(F.col("text"))
    after = lambda w: F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0)))
    # Both words are in the same text, so no text is shuffled and no rows are sorted; the last word meets nothing.
    texts = _table(spark, sf_dir, "documents").select(own.alias("own"))
    both = texts.select(F.explode(F.arrays_zip(F.col("own").alias("word"), after(F.col("own")).alias("after"))).alias("p")).select("p.word", "p.after")
    both = both.where(F.col("word").rlike("^[A-Za-z]+$") & F.col("after").rlike("^[A-Za-z]+$"))
    return both.select(F.concat(F.initcap("word"), F.initcap("after")).alias("word")).distinct()


_CAP = "upper({0}[1]) || lower({0}[2:])"
_FOLD = """list_reduce([{'d': '', 'n': x} FOR x IN string_split(word, '')], lambda a, x: CASE WHEN lower(x.n) <> x.n AND a.n NOT IN ('Mc', 'Mac', 'O')
    THEN {'d': a.d || a.n || ' ', 'n': x.n} ELSE {'d': a.d, 'n': a.n || x.n} END)"""


@query(f"""WITH {_WORDS}, pairs AS (SELECT DISTINCT {_CAP.format("word")} || {_CAP.format("after")} AS word
        FROM (SELECT word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM words)
        WHERE regexp_full_match(word, '[A-Za-z]+') AND regexp_full_match(after, '[A-Za-z]+'))
    SELECT word, CASE WHEN length(word) < 6 OR (upper(word) = word AND lower(word) <> word) THEN word ELSE f.d || f.n END AS split FROM (SELECT word, {_FOLD} AS f FROM pairs)""")
def split_joined_caps(spark, sf_dir):
    return _pairs(spark, sf_dir).select("word", fn.split_joined_capitals(F.col("word")).alias("split"))


def _distinct_words(spark, sf_dir) -> DataFrame:
    return adapters.words(_table(spark, sf_dir, "documents")).select("word").distinct()


_DISTINCT = f"WITH {_WORDS}, w AS (SELECT DISTINCT word FROM words)"


@query(f"""{_DISTINCT} SELECT word, f.o AS title FROM (SELECT word, list_reduce([{{'o': CASE WHEN x = 'ß' THEN 'Ss' ELSE upper(x) END, 'p': upper(x) <> lower(x), 'c': x}} FOR x IN string_split(word, '')],
        lambda a, x: {{'o': a.o || CASE WHEN a.p THEN lower(x.c) WHEN x.c = 'ß' THEN 'Ss' ELSE upper(x.c) END, 'p': x.p, 'c': x.c}}) AS f FROM w)""")
def python_title(spark, sf_dir):
    return _distinct_words(spark, sf_dir).select("word", fn.title(F.col("word")).alias("title"))


@query(f"{_DISTINCT} SELECT word, upper(word) = word AND lower(word) <> word AS is_upper FROM w")
def isupper_flag(spark, sf_dir):
    return _distinct_words(spark, sf_dir).select("word", fn.is_upper(F.col("word")).alias("is_upper"))


_TITLE_CHUNK = """list_reduce([{'o': upper(x), 'p': upper(x) <> lower(x), 'c': x} FOR x IN string_split(s, '')],
        lambda a, x: {'o': a.o || CASE WHEN a.p THEN lower(x.c) ELSE upper(x.c) END, 'p': x.p, 'c': x.c}).o"""


@query(f"""WITH {_CHUNKS}, s AS (SELECT DISTINCT chunk, trim(chunk, '.,;:()[]{{}}') AS s FROM chunks ),
    t AS (SELECT chunk, {_norm("CASE WHEN s <> '' AND upper(s) = s AND lower(s) <> s THEN " + _TITLE_CHUNK + " ELSE s END")} AS t FROM s)
    SELECT chunk, CASE WHEN t <> '' AND len([x FOR x IN string_split(t, ' ') IF length(x) < 2 OR regexp_matches(x, '[0-9]')]) = 0 THEN t END AS name FROM t""")
def name_post_filter(spark, sf_dir):
    found = names.candidates(_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    found = found.select("chunk").distinct()
    return found.select("chunk", fn.clean_name(F.col("chunk")).alias("name"))


@query(f"{_ALL} SELECT book, marker, page, y, pos, text FROM assigned")
def section_assign_asof(spark, sf_dir):
    return sections.assigned(_blocks(spark, sf_dir))


_ALONE = """alone AS (SELECT book FROM texts WHERE book NOT IN (SELECT book FROM markers) GROUP BY book)"""
_SECTIONS = f"""{_ALL}, {_ALONE},
    held AS (SELECT book, marker, string_agg(text, '|' ORDER BY page, y, pos) AS texts, count(*) AS n, list_sort(list(DISTINCT page)) AS pages FROM assigned GROUP BY 1, 2),
    sections AS (SELECT m.book, m.marker, header, coalesce(h.pages, [m.page]) AS pages, coalesce(texts, '') AS texts, coalesce(n, 0) AS n FROM markers m LEFT JOIN held h USING (book, marker)
        UNION ALL SELECT book, 0, '(no headers found)', (SELECT list_sort(list(DISTINCT page)) FROM blocks b WHERE b.book = t.book), string_agg(text, '|' ORDER BY page, y, pos), count(*)
        FROM texts t WHERE book IN (SELECT book FROM alone) GROUP BY book)"""


@query(f"{_SECTIONS} SELECT book, CAST(marker AS INTEGER) AS marker, header, list_min(pages) AS start_page, list_max(pages) AS end_page, array_to_string(pages, '|') AS pages, n AS n_texts, texts FROM sections")
def section_summary(spark, sf_dir):
    found = sections.sections(_blocks(spark, sf_dir))
    return found.select("book", "marker", "header", "start_page", "end_page", _joined("pages").alias("pages"), F.size("texts").cast("long").alias("n_texts"), F.array_join("texts", "|").alias("texts"))


@query(f"""WITH {_BLOCKS}, {_MARKERS} SELECT book, marker, page, y, lead(page) OVER w AS next_page, lead(y) OVER w AS next_y FROM markers WINDOW w AS (PARTITION BY book ORDER BY marker)""")
def section_bounds_lead(spark, sf_dir):
    return sections.bounds(sections.markers(_blocks(spark, sf_dir))).select("book", "marker", "page", "y", "next_page", "next_y")


_ZERO = _BLOCKS.replace("(i - 1) % 20 + 1", "(i - 1) % 20")


@query(f"""WITH {_ZERO}, {_MARKERS}, {_TEXTS}, b AS (SELECT *, lead(page) OVER w AS np, lead(y) OVER w AS ny FROM markers WINDOW w AS (PARTITION BY book ORDER BY marker))
    SELECT t.book, b.marker, t.page, t.y, t.pos, t.text FROM texts t JOIN b ON t.book = b.book AND (t.page > b.page OR (t.page = b.page AND t.y >= b.y))
        AND (b.np IS NULL OR t.page < b.np OR (t.page = b.np AND t.y < b.ny) OR (b.page = b.np AND b.ny = 0 AND t.page = b.page))""")
def sections_zero_bound(spark, sf_dir):
    return sections.assigned(_blocks(spark, sf_dir).withColumn("y", F.col("y") - 1), strict_zero_bounds=True)


@query(f"{_SECTIONS} SELECT book, header, array_to_string(pages, '|') AS pages, texts FROM sections WHERE marker = 0")
def no_header_fallback(spark, sf_dir):
    return sections.without_headers(_blocks(spark, sf_dir)).select("book", "header", _joined("pages").alias("pages"), F.array_join("texts", "|").alias("texts"))


@query(f"{_SECTIONS} SELECT book, count(*) AS sections_count FROM sections GROUP BY book")
def sections_count(spark, sf_dir):
    return ocr.sections_count(sections.sections(_blocks(spark, sf_dir)))


def _json_pages(spark, sf_dir) -> DataFrame:
    """book, page, value: the blocks as the JSON text of a page each."""
    blocks = _blocks(spark, sf_dir).groupBy("book", "page").agg(F.sort_array(F.collect_list(F.struct("pos", "label", "content", "y"))).alias("all"))
    one = lambda b: F.struct(b["label"].alias("block_label"), b["content"].alias("block_content"), F.array(F.lit(0.0), b["y"], F.lit(1.0), b["y"] + 1).alias("block_bbox"))
    return blocks.select("book", "page", F.to_json(F.struct(F.transform("all", one).alias("parsing_res_list"))).alias("value"))


@query(f"WITH {_BLOCKS} SELECT book, page, CAST(pos % 20 AS INTEGER) AS pos, y, label, content, y + 1 AS bottom FROM blocks")
def ocr_blocks(spark, sf_dir):
    found = ocr.blocks(ocr.parsed(_json_pages(spark, sf_dir)))
    return found.select("book", "page", "pos", "y", "label", "content", F.get("bbox", F.lit(3)).alias("bottom"))


@query(f"""WITH {_BLOCKS}, n AS (SELECT book, label, count(*) AS n FROM blocks GROUP BY 1, 2)
    SELECT book, book || '.pdf' AS file_name, (SELECT count(DISTINCT page) FROM blocks b WHERE b.book = n.book) AS total_pages, string_agg(label || ':' || n, '|' ORDER BY label) AS counts FROM n GROUP BY book""")
def meta_bundle(spark, sf_dir):
    pages = ocr.parsed(_json_pages(spark, sf_dir))
    counts = F.array_sort(F.transform(F.map_entries("counts_by_block_label"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))))
    return ocr.meta(pages, ocr.blocks(pages)).select("book", "file_name", "total_pages", F.array_join(counts, "|").alias("counts"))


def _raw_pages(spark, sf_dir) -> DataFrame:
    """book, page, value: lines as parallel arrays, one score less than texts, and as blocks, beside a key that nothing names."""
    held = _blocks(spark, sf_dir).groupBy("book", "page").agg(F.sort_array(F.collect_list(F.struct("pos", "label", "content"))).alias("all"))
    scores = F.slice(F.transform("all", lambda b: b["pos"]), 1, F.size("all") - 1)
    one = lambda b: F.struct(b["label"].alias("block_label"), b["content"].alias("block_content"))
    page = F.struct(F.transform("all", lambda b: b["content"]).alias("rec_texts"), scores.alias("rec_scores"), F.transform("all", one).alias("parsing_res_list"), F.struct("book").alias("extra"))
    return held.select("book", "page", F.to_json(page).alias("value"))


def _strings(path: str):
    return F.coalesce(F.array_join(F.try_variant_get("v", path, "array<string>"), "|"), F.lit(""))


_FILLED = f"{_norm('content')} <> ''"


@query(f"""WITH {_BLOCKS}, m AS (SELECT *, max(pos) OVER (PARTITION BY book, page) AS last FROM blocks)
    SELECT book, page, coalesce(string_agg(content, '|' ORDER BY pos) FILTER ({_FILLED}), '') AS texts, coalesce(string_agg(pos, '|' ORDER BY pos) FILTER ({_FILLED} AND pos < last), '') AS scores,
        page AS page_number, string_agg(label || ':' || page, '|' ORDER BY pos) AS tagged, book AS extra FROM m GROUP BY book, page""")
def clean_pages(spark, sf_dir):
    pages = ocr.compiled(_raw_pages(spark, sf_dir))
    blocks = F.try_variant_get("v", "$.parsing_res_list", "array<struct<block_label: string, page_number: string>>")
    tagged = F.array_join(F.transform(blocks, lambda b: F.concat_ws(":", b["block_label"], b["page_number"])), "|")
    number, extra = F.try_variant_get("v", "$.page_number", "int"), F.try_variant_get("v", "$.extra.book", "long")
    return pages.select("book", "page", _strings("$.rec_texts").alias("texts"), _strings("$.rec_scores").alias("scores"), number.alias("page_number"), tagged.alias("tagged"), extra.alias("extra"))


@query(f"""WITH {_BLOCKS}, e AS (SELECT book, CAST(unnest(range(1, max(page) + 2)) AS INTEGER) AS page FROM blocks GROUP BY book),
    t AS (SELECT book, page, count(*) FILTER ({_FILLED}) AS n FROM blocks GROUP BY 1, 2 HAVING bool_or(label = 'header'))
    SELECT e.book, e.page, e.page AS page_number, CASE WHEN t.page IS NULL THEN e.page - 1 END AS page_index, n AS n_texts FROM e LEFT JOIN t ON e.book = t.book AND e.page = t.page""")
def compiled_pages(spark, sf_dir):
    """Pages without a header are taken as pages that are not there; one more is expected than a book has."""
    blocks = _blocks(spark, sf_dir)
    there = blocks.groupBy("book", "page").agg(F.max(F.col("label") == "header").alias("has")).where("has").drop("has")
    books = blocks.groupBy("book").agg((F.max("page") + 1).alias("page_count"))
    pages = ocr.compiled(_raw_pages(spark, sf_dir).join(there, ["book", "page"], "left_semi"), books)
    get = lambda name, kind: F.try_variant_get("v", f"$.{name}", kind)
    return pages.select("book", "page", get("page_number", "int").alias("page_number"), get("page_index", "int").alias("page_index"), F.size(get("rec_texts", "array<variant>")).cast("long").alias("n_texts")).withColumn(
        "n_texts", F.when(F.col("page_index").isNull(), F.col("n_texts"))
    )


@query(f"WITH {_BLOCKS} SELECT book, CAST(count(*) FILTER ({_FILLED}) AS BIGINT) AS n FROM blocks GROUP BY book")
def texts_clean(spark, sf_dir):
    return ocr.texts_clean(ocr.compiled(_raw_pages(spark, sf_dir)))


def _page_files(spark, sf_dir) -> DataFrame:
    """Documents as files for the pages of a book for each source, many for one page."""
    docs = _table(spark, sf_dir, "documents")
    number = F.when(F.col("doc_id") % 11 > 0, (F.col("doc_id") % 101).cast("int"))
    name = F.concat(F.lit("page"), F.lpad((F.col("doc_id") % 101).cast("string"), 4, "0"), F.when(number.isNull(), F.lit("x")).otherwise(""), F.lit(".json"))
    return docs.select(F.col("source").alias("book"), number.alias("page"), F.to_json(F.struct("text", "lang")).alias("value"), name.alias("name"), F.timestamp_seconds("n_chars").alias("modified"), "doc_id")


_PAGE_FILES = """files AS (SELECT source AS book, CASE WHEN doc_id % 11 > 0 THEN CAST(doc_id % 101 AS INTEGER) END AS page, n_chars, text, doc_id,
    'page' || lpad(CAST(doc_id % 101 AS VARCHAR), 4, '0') || CASE WHEN doc_id % 11 > 0 THEN '' ELSE 'x' END || '.json' AS name FROM documents)"""


@query(f"WITH {_PAGE_FILES} SELECT book, page, count(*) AS copies, max(n_chars) AS modified, min(name) AS name FROM files WHERE page IS NOT NULL GROUP BY 1, 2")
def unique_pages(spark, sf_dir):
    return ocr.unique_pages(_page_files(spark, sf_dir)).select("book", "page", "copies", F.unix_seconds("modified").alias("modified"), "name")


@query(f"""WITH {_PAGE_FILES}, one AS (SELECT book, page, name, count(*) AS copies FROM files WHERE page IS NOT NULL GROUP BY 1, 2, 3)
    SELECT book, 'duplicate' AS kind, page, name, copies AS n FROM one WHERE copies > 1 UNION ALL SELECT book, 'odd name', NULL, name, 1 FROM files WHERE page IS NULL
    UNION ALL SELECT book, 'beyond', page, name, 1 FROM one WHERE page NOT BETWEEN 1 AND 90 UNION ALL SELECT book, 'count', NULL, NULL, count(*) FILTER (page BETWEEN 1 AND 90) FROM one GROUP BY book HAVING count(*) FILTER (page BETWEEN 1 AND 90) <> 90""")
def page_mismatches(spark, sf_dir):
    pages = _page_files(spark, sf_dir)
    return ocr.mismatches(pages, pages.select("book").distinct().withColumn("page_count", F.lit(90)))


@query(ORACLES["section_assign_asof"])
def section_assign_ranges(spark, sf_dir):
    """The same by ranges, as for books that are too large for a task."""
    return sections.assigned(_blocks(spark, sf_dir), giant=10)


def _section_names(spark, sf_dir) -> DataFrame:
    return names.section_names(sections.filled(_blocks(spark, sf_dir))).where("marker > 0")


_NAMES = f"""{_ALL}, nc AS (SELECT book, marker, unnest(string_split_regex(text, '[.,]+')) AS c FROM assigned),
    names AS (SELECT DISTINCT book, marker, unnest(regexp_extract_all({_norm("c")}, '[A-Z][a-z]+(?: [A-Z][a-z]+)+')) AS name FROM nc)"""


@query(f"""{_NAMES} SELECT m.book, m.marker, m.header, m.page, count(name) AS n_names, coalesce(string_agg(name, '|' ORDER BY name), '') AS names
    FROM markers m LEFT JOIN names n ON m.book = n.book AND m.marker = n.marker GROUP BY 1, 2, 3, 4""")
def section_names(spark, sf_dir):
    found = _section_names(spark, sf_dir)
    return found.select("book", "marker", "header", "page", F.size("names").cast("long").alias("n_names"), F.array_join("names", "|").alias("names"))


@query(f"{_NAMES} SELECT book, marker, CAST(rank AS INTEGER) AS rank, name FROM (SELECT *, row_number() OVER (PARTITION BY book, marker ORDER BY length(name) DESC, name) AS rank FROM names) WHERE rank <= 5")
def names_per_section_topk(spark, sf_dir):
    each = _section_names(spark, sf_dir).select("book", "marker", F.explode("names").alias("name"))
    order = Window.partitionBy("book", "marker").orderBy(F.desc(F.length("name")), "name")
    return each.withColumn("rank", F.row_number().over(order)).where("rank <= 5").select("book", "marker", "rank", "name")


_CONVERSATIONS = """lines_ AS (SELECT conv_id AS book, turn, role, string_split(text, chr(10)) AS l FROM conversations WHERE text IS NOT NULL),
    blocks AS (SELECT book, CAST(turn + 1 AS INTEGER) AS page, CAST(i - 1 AS INTEGER) AS pos, CAST(i AS DOUBLE) AS y,
        CASE WHEN role = 'user' AND i = 1 THEN 'header' ELSE 'text' END AS label, l[i] AS content FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM lines_))"""


@query(f"WITH {_CONVERSATIONS}, {_MARKERS}, {_TEXTS}, {_ASSIGNED} SELECT book, marker, count(*) AS n, min(page) AS start_page, max(page) AS end_page FROM assigned GROUP BY 1, 2")
def conversation_sections(spark, sf_dir):
    rows = sections.assigned(adapters.from_conversations(_table(spark, sf_dir, "conversations")))
    return rows.groupBy("book", "marker").agg(F.count("*").alias("n"), F.min("page").alias("start_page"), F.max("page").alias("end_page"))


_ELEMENT = "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in adapters.TAGS)


@query(f"""WITH e AS (SELECT page_id AS book, regexp_extract_all(regexp_replace(html, '(?s)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g'), '(?s){_ELEMENT}') AS e FROM pages),
    x AS (SELECT book, i, e[i] AS el FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM e))
    SELECT book, CAST(i - 1 AS INTEGER) AS pos, CASE regexp_extract(el, '^<([a-z0-9]+)', 1) {" ".join(f"WHEN '{t}' THEN '{n}'" for t, n in adapters.TAGS.items())} END AS label,
        regexp_replace(el, '(?s)<[^>]*>', '', 'g') AS content FROM x""")
def html_block_labels(spark, sf_dir):
    return adapters.from_pages(_table(spark, sf_dir, "pages")).select("book", "pos", "label", "content")


def _capital(spark, sf_dir) -> DataFrame:
    words = adapters.words(_table(spark, sf_dir, "documents")).where(F.col("word").rlike("^[A-Z][a-z]+$"))
    return words.groupBy(F.lower("word").alias("name")).agg(F.count("*").alias("n"))


def _first(spark, sf_dir) -> DataFrame:
    return correct.corpus(_capital(spark, sf_dir).select(F.lit("1980").alias("decade"), "name", F.col("n").alias("weight")), YEAR, False)


def _last(spark, sf_dir) -> DataFrame:
    by_rank = shared.ranked(_capital(spark, sf_dir), [F.desc("n"), F.asc("name")], "weight", 1)
    return correct.corpus(by_rank.select(F.lit("1980").alias("decade"), "name", "weight"), YEAR, True)


@query(f"WITH {_WORDS}, {_CORPUS} SELECT name, weight, idx FROM first_")
def corpus_first(spark, sf_dir):
    return _first(spark, sf_dir)


@query(f"WITH {_WORDS}, {_CORPUS} SELECT name, weight, idx FROM last_")
def corpus_last(spark, sf_dir):
    return _last(spark, sf_dir)


@query("""SELECT year, CAST(CASE WHEN list_contains(d, year // 10 * 10) THEN year // 10 * 10 WHEN year // 10 * 10 < list_min(d) THEN list_min(d) ELSE list_max(d) END AS INTEGER) AS decade
    FROM (SELECT unnest([1943, 1950, 1965, 1974, 1999]) AS year, [1950, 1970] AS d)""")
def pick_decade(spark, sf_dir):
    years = spark.sql("SELECT year FROM VALUES (1943), (1950), (1965), (1974), (1999) AS v(year)")
    return years.select("year", correct.pick_decade(F.col("year"), F.array(F.lit(1950), F.lit(1970))).alias("decade"))


def _tokens(spark, sf_dir) -> DataFrame:
    """Distinct keys of the words of all names."""
    each = _section_names(spark, sf_dir).select(F.explode("names").alias("name"))
    return each.select(F.explode(F.split("name", " ")).alias("t")).select(fn.corpus_key(F.col("t")).alias("token")).distinct()


_TOKENS = f"""{_NAMES}, {_WORDS}, {_CORPUS}, tokens AS (SELECT DISTINCT lower(t) AS token FROM (SELECT unnest(string_split(name, ' ')) AS t FROM names)),
    scored AS (SELECT token, name, idx, greatest(0.0, (1 - (levenshtein(token, name) + abs(length(token) - length(name))) / greatest(1, least(length(token), length(name)))) * 100) AS score,
        f.weight AS frequency FROM tokens, first_ f)"""


@query(f"{_TOKENS} SELECT token, name, round(score, 6) AS score FROM scored WHERE score > 0")
def similarity_matrix(spark, sf_dir):
    return correct.matches(_tokens(spark, sf_dir), _first(spark, sf_dir)).select("token", "name", F.round("score", 6).alias("score"))


@query(f"{_TOKENS} SELECT token, CAST(rank AS INTEGER) AS rank, name, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY score DESC, idx) AS rank FROM scored) WHERE rank <= 5")
def fuzzy_topk(spark, sf_dir):
    return correct.top_matches(_tokens(spark, sf_dir), _first(spark, sf_dir)).select("token", "rank", "name", F.round("score", 6).alias("score"))


_BEST = "SELECT token, arg_max(name, (score, frequency, -idx)) AS best FROM scored GROUP BY 1"


@query(f"{_TOKENS} {_BEST}")
def correct_first(spark, sf_dir):
    return correct.best_names(_tokens(spark, sf_dir), _first(spark, sf_dir), False)


@query(f"{_TOKENS} SELECT token, arg_max(name, (score, -idx)) AS best FROM scored GROUP BY 1")
def correct_last(spark, sf_dir):
    return correct.best_names(_tokens(spark, sf_dir), _last(spark, sf_dir), True)


@query(f"""{_TOKENS}, best AS ({_BEST}),
    parts AS (SELECT name, i, lower(s[i]) AS token FROM (SELECT name, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT DISTINCT name, string_split(name, ' ') AS s FROM names)))
    SELECT name, string_agg(upper(best[1]) || best[2:], ' ' ORDER BY i) AS corrected FROM parts JOIN best USING (token) GROUP BY name""")
def correct_full_name(spark, sf_dir):
    """The corpus of last names is that of first names with ranks for counts, so both choose alike."""
    each = _section_names(spark, sf_dir).select(F.explode("names").alias("name")).distinct()
    return correct.NameCorrector(_first(spark, sf_dir), _last(spark, sf_dir)).correct(each)


def _rare(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Capitalised words that come once, as tokens, and a corpus of those that come again."""
    all_ = shared.written(_capital(spark, sf_dir), "capital")
    own = all_.where("n > 1").select(F.lit("1980").alias("decade"), "name", F.col("n").alias("weight"))
    return all_.where("n = 1").select(F.col("name").alias("token")), correct.corpus(own, YEAR, False)


_RARE = f"""WITH {_WORDS}, {_CORPUS}, tokens AS (SELECT name AS token FROM capital WHERE n = 1), own AS (SELECT name, n AS frequency, row_number() OVER (ORDER BY n DESC, name) - 1 AS idx FROM capital WHERE n > 1),
    scored AS (SELECT token, name, idx, frequency, greatest(0.0, (1 - (levenshtein(token, name) + abs(length(token) - length(name))) / greatest(1, least(length(token), length(name)))) * 100) AS score FROM tokens, own)"""


@query(f"{_RARE} SELECT token, CAST(rank AS INTEGER) AS rank, name, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY score DESC, idx) AS rank FROM scored) WHERE rank <= 5")
def fuzzy_topk_rare(spark, sf_dir):
    """The same for thousands of tokens, none of which is in the corpus."""
    return correct.top_matches(*_rare(spark, sf_dir)).select("token", "rank", "name", F.round("score", 6).alias("score"))


@query(f"{_RARE} {_BEST}")
def correct_rare(spark, sf_dir):
    return correct.best_names(*_rare(spark, sf_dir), False)


@query(f"SELECT DISTINCT name, {_norm('name')} AS corrected FROM (SELECT unnest(string_split(text, chr(10))) AS name FROM documents WHERE text IS NOT NULL)")
def noop_corrector(spark, sf_dir):
    lines = _table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.explode(F.split("text", "\n")).alias("name")).distinct()
    return correct.NoOpCorrector().correct(lines)


@query(f"WITH {_BLOCKS} SELECT DISTINCT book, page, 'page' || lpad(CAST(page AS VARCHAR), 4, '0') AS stem FROM blocks")
def page_stem(spark, sf_dir):
    return _blocks(spark, sf_dir).select("book", "page").distinct().select("book", "page", fn.page_stem(F.col("page")).alias("stem"))


@query(f"WITH {_BLOCKS}, e AS (SELECT book, CAST(unnest(range(1, max(page) + 2)) AS INTEGER) AS page FROM blocks GROUP BY book) SELECT e.book, e.page FROM e ANTI JOIN (SELECT * FROM blocks WHERE label = 'header') h ON e.book = h.book AND e.page = h.page")
def missing_pages(spark, sf_dir):
    """Pages without a header, taken as pages that are not there yet; one more is expected than a book has."""
    blocks = _blocks(spark, sf_dir)
    books = blocks.groupBy("book").agg((F.max("page") + 1).alias("page_count"))
    return ocr.missing(blocks.where("label = 'header'").select("book", "page"), books)
