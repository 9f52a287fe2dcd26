"""Pages of OCR output as VARIANT: identity, cleaning, tagging, blocks and summaries.

Defined cases: a page whose text is no JSON counts as one that is not there; a page that is JSON but no object is kept as it
is and has no blocks; keys that nothing here names stay; a null book is a book; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import normalize_space, utc_stamp

#: The text array of each layout and the arrays that run beside it.
FAMILIES = {"rec_texts": ("rec_scores", "rec_polys", "rec_boxes"), "texts": ("scores", "polys", "boxes")}


def kept(texts: Column) -> Column:
    """For each text whether it is there and not blank."""
    return F.transform(texts, lambda t: normalize_space(t) != "")


def filtered(values: Column, mask: Column) -> Column:
    """The values whose place in the mask is true; what lies past the mask goes."""
    return F.filter(values, lambda _, i: F.coalesce(F.get(mask, i), F.lit(False)))


def clean_arrays(pages: DataFrame) -> DataFrame:
    """Filters each family of parallel arrays by its texts; a family without texts stays as it is."""
    found = [(t, o) for t, o in FAMILIES.items() if t in pages.columns]
    # The masks are columns of their own, so that no array is filtered by an array that is already filtered.
    masked = pages.withColumns({f"_keep_{t}": kept(F.col(t)) for t, _ in found})
    mask_of = {name: t for t, others in found for name in (t, *others)}
    own = lambda c: F.when(F.col(f"_keep_{mask_of[c]}").isNull(), F.col(c)).otherwise(filtered(F.col(c), F.col(f"_keep_{mask_of[c]}")))
    return masked.select(*[own(c).alias(c) if c in mask_of else F.col(c) for c in pages.columns])


def unique_pages(pages: DataFrame) -> DataFrame:
    """One row for each book and page, with copies, the number of rows that there were: the one that was modified last, then
    by name, then by value, so that every order and partitioning of the rows gives the same. pages: book, page, value, name, modified."""
    rank = F.struct("modified", "name", F.coalesce("value", F.lit("")).alias("value"))
    best = F.max_by(F.struct("value", "name", "modified"), rank)
    held = pages.where("page IS NOT NULL").groupBy("book", "page").agg(best.alias("_b"), F.count("*").alias("copies"))
    return held.select("book", "page", "_b.value", "_b.name", "_b.modified", "copies")


def mismatches(pages: DataFrame, books: DataFrame) -> DataFrame:
    """book, kind, page, name, n of what is odd about pages (book, page, value, name, modified) of books (book, page_count):

    duplicate: a page with n rows; odd name: a file that names no page; no json: a page whose text is none; beyond: a page that
    the book has not; count: n pages that are there, where this is not page_count; unknown book: n pages of a book that is not in books.
    """
    row = lambda df, kind, page, name, n: df.select("book", F.lit(kind).alias("kind"), page.cast("int").alias("page"), name.cast("string").alias("name"), n.cast("long").alias("n"))
    none, one = F.lit(None), F.lit(1)
    single = unique_pages(pages)
    there = single.join(books, "book")
    counts = books.join(there.where("page BETWEEN 1 AND page_count").groupBy("book").agg(F.count("*").alias("_n")), "book", "left")
    found = [
        row(single.where("copies > 1"), "duplicate", F.col("page"), F.col("name"), F.col("copies")),
        row(pages.where("page IS NULL"), "odd name", none, F.col("name"), one),
        row(single.where(F.try_parse_json("value").isNull()), "no json", F.col("page"), F.col("name"), one),
        row(there.where("page NOT BETWEEN 1 AND page_count"), "beyond", F.col("page"), F.col("name"), one),
        row(counts.where("coalesce(_n, 0) <> page_count"), "count", none, none, F.coalesce("_n", F.lit(0))),
        row(single.join(books, "book", "left_anti").groupBy("book").agg(F.count("*").alias("_n")), "unknown book", none, none, F.col("_n")),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _object(v: Column) -> Column:
    """The keys and values of an object; null if it is none."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def cleaned(pages: DataFrame) -> DataFrame:
    """pages (v, ...) with the parallel arrays of each object filtered by its texts, as clean_arrays() does; all other keys stay.

    What is no text is not blank, whatever it is; null is. A family whose texts are no array stays as it is, and so does a
    key of it that is no array.
    """
    texts = lambda name: F.transform(F.try_variant_get("v", f"$.{name}", "array<variant>"), lambda t: t.cast("string"))
    # The masks are columns of their own, so that each is made once and from what the page had.
    masked = pages.withColumns({f"_keep_{t}": kept(texts(t)) for t in FAMILIES} | {"_keys": _object(F.col("v"))})
    mask_of = {name: t for t, others in FAMILIES.items() for name in (t, *others)}

    def own(key: Column, value: Column) -> Column:
        less = [F.when((key == name) & F.col(f"_keep_{t}").isNotNull() & _array(value).isNotNull(), F.to_variant_object(filtered(_array(value), F.col(f"_keep_{t}")))) for name, t in mask_of.items()]
        return F.coalesce(*less, value)

    v = F.when(F.col("_keys").isNotNull(), F.to_variant_object(F.transform_values("_keys", own))).otherwise(F.col("v"))
    return masked.withColumn("v", v).select(*pages.columns)


def _with(keys: Column, name: str, value: Column) -> Column:
    """An object of these keys and values, with one more or another value for one."""
    return F.to_variant_object(F.map_concat(F.map_filter(keys, lambda k, _: k != name), F.create_map(F.lit(name), value.cast("variant"))))


def numbered(pages: DataFrame) -> DataFrame:
    """pages (page, v, ...) where objects have their page_number, and so has each object in their parsing_res_list."""
    page, keys = F.col("page").cast("int"), _object(F.col("v"))
    tag = lambda b: F.coalesce(_with(_object(b), "page_number", page), b)
    inner = lambda k, x: F.when((k == "parsing_res_list") & _array(x).isNotNull(), F.to_variant_object(F.transform(_array(x), tag))).otherwise(x)
    v = F.when(keys.isNotNull(), _with(F.transform_values(keys, inner), "page_number", page)).otherwise(F.col("v"))
    return pages.withColumn("v", v)


def compiled(pages: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """book, page, v: pages (book, page, value) parsed, cleaned and numbered; what is not there has its index from 0 only.

    books (book, page_count): then every page of these is there, and no other.
    """
    every = pages.select("book", F.col("page").cast("int").alias("page"), "value")
    read = parsed(complete(every, books) if books is not None else every)
    absent = F.to_variant_object(F.struct((F.col("page") - 1).alias("page_index")))
    return numbered(cleaned(read.select("book", "page", F.coalesce("v", absent).alias("v"))))


def parsed(pages: DataFrame) -> DataFrame:
    """pages (book, page, value JSON text) with v, a VARIANT; null where the text is no JSON."""
    return pages.withColumn("v", F.try_parse_json("value"))


def complete(pages: DataFrame, books: DataFrame) -> DataFrame:
    """A row for each page from 1 to page_count of books (book, page_count); missing ones have a null value."""
    every = books.select("book", F.explode(F.sequence(F.lit(1), F.col("page_count").cast("int"))).alias("page"))
    return every.join(pages, ["book", "page"], "left")


def missing(pages: DataFrame, books: DataFrame) -> DataFrame:
    """book and page of what is not there yet."""
    every = books.select("book", F.explode(F.sequence(F.lit(1), F.col("page_count").cast("int"))).alias("page"))
    return every.join(pages.select("book", "page"), ["book", "page"], "left_anti")


def finished(pages: DataFrame, books: DataFrame) -> DataFrame:
    """book of the books of which every page is there: a stage is skipped for these."""
    return books.join(missing(pages, books).select("book").distinct(), "book", "left_anti").select("book")


def blocks(pages: DataFrame) -> DataFrame:
    """book, page, pos, y, label, content, bbox of parsed pages.

    The layout blocks count if there are any, else the items, whose label is text. A content that is no
    string is empty, a height that is no number is -1, a box that is no array of numbers is null, what is no object is
    left out.
    """
    array = lambda name: F.expr(f"try_variant_get(v, '$.{name}', 'array<variant>')")
    layout, items = array("parsing_res_list"), array("items")
    has = F.coalesce(F.size(layout), F.lit(0)) > 0
    rows = pages.select("book", "page", has.alias("layout"), F.posexplode(F.when(has, layout).otherwise(items)).alias("pos", "b"))
    rows = rows.where(F.expr("schema_of_variant(b) LIKE 'OBJECT%'"))
    string = lambda name: f"CASE WHEN schema_of_variant(try_variant_get(b, '$.{name}', 'variant')) = 'STRING' THEN try_variant_get(b, '$.{name}', 'string') ELSE '' END"
    return rows.selectExpr(
        "book", "CAST(page AS int) page", "CAST(pos AS int) pos",
        "coalesce(CASE WHEN layout THEN try_variant_get(b, '$.block_bbox[1]', 'double') ELSE try_variant_get(b, '$.bbox[1]', 'double') END, -1D) y",
        "CASE WHEN layout THEN coalesce(try_variant_get(b, '$.block_label', 'string'), 'None') ELSE 'text' END label",
        f"CASE WHEN layout THEN {string('block_content')} ELSE {string('text')} END content",
        "CASE WHEN layout THEN try_variant_get(b, '$.block_bbox', 'array<double>') ELSE try_variant_get(b, '$.bbox', 'array<double>') END bbox",
    )


def label_counts(found: DataFrame) -> DataFrame:
    """book, label and n."""
    return found.groupBy("book", F.coalesce("label", F.lit("None")).alias("label")).agg(F.count("*").alias("n"))


def meta(pages: DataFrame, found: DataFrame, settings: dict[str, object] | None = None, at: Column | None = None) -> DataFrame:
    """book, file_name, total_pages, counts_by_block_label (a map), pipeline_settings (a map) and generated_utc (of at, or of now)."""
    counts = label_counts(found).groupBy("book").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("counts_by_block_label"))
    totals = pages.groupBy("book").agg(F.count("*").alias("total_pages"))
    none = F.expr("map_from_arrays(CAST(array() AS array<string>), CAST(array() AS array<bigint>))")
    held = totals.join(counts, "book", "left").withColumn("counts_by_block_label", F.coalesce("counts_by_block_label", none))
    given = [x for k, v in (settings or {}).items() for x in (F.lit(k), F.lit(str(v)))]
    added = F.create_map(*given) if given else F.expr("map_from_arrays(CAST(array() AS array<string>), CAST(array() AS array<string>))")
    stamp = utc_stamp(F.current_timestamp() if at is None else at)
    return held.select("book", F.concat("book", F.lit(".pdf")).alias("file_name"), "total_pages", "counts_by_block_label", added.alias("pipeline_settings"), stamp.alias("generated_utc"))


def sections_count(found: DataFrame) -> DataFrame:
    """book and sections_count, the number of its sections."""
    return found.groupBy("book").agg(F.count("*").alias("sections_count"))


def headers_index(found: DataFrame) -> DataFrame:
    """Blocks labelled exactly header, in document order: book, page, pos, content, and bbox if the blocks have it."""
    return found.where("label = 'header'").select("book", "page", "pos", F.coalesce("content", F.lit("")).alias("content"), *["bbox"] * ("bbox" in found.columns))


def texts_clean(pages: DataFrame) -> DataFrame:
    """book and n: texts of all pages; rec_texts counts where the key is there, whatever it holds."""
    n = F.expr(
        "CASE WHEN variant_get(v, '$.rec_texts') IS NOT NULL THEN coalesce(size(try_variant_get(v, '$.rec_texts', 'array<variant>')), 0) "
        "ELSE coalesce(size(try_variant_get(v, '$.texts', 'array<variant>')), 0) END"
    )
    return pages.groupBy("book").agg(F.sum(F.greatest(n, F.lit(0))).cast("long").alias("n"))
