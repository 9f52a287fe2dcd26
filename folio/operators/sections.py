"""Sections: text blocks between one header and the next, in the order of page and height.

All of it comes from one scan of the blocks and one window by book (filled); books of more than GIANT blocks are sorted by
ranges instead, and each range takes over the number of markers before it, so that no book is a single task.

Defined cases: a null label counts as "None" and so as text; a null content is blank; a null book is a book, and rows of a
null page or height come first; rows that repeat are rows each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import normalize_space
from folio.operators.shared import placed, written

#: Labels of headers, labels that are not running text, and words that disqualify a header.
HEADERS = ("header", "paragraph_title")
NOT_TEXT = (*HEADERS, "footer", "image")
IGNORED = ("starter", "player", "captain")
NO_HEADERS = "(no headers found)"
#: Blocks of a book beyond which it is spread over tasks.
GIANT = 2_000_000
#: Kinds of rows: a header that counts, running text, what only shows that its page is there.
MARKER, TEXT, OTHER = 0, 1, 2


def _label() -> Column:
    return F.lower(F.coalesce("label", F.lit("None")))


def _kind(text: Column) -> Column:
    usable = (text != "") & ~F.lower(text).rlike("|".join(IGNORED))
    return F.when(_label().isin(*HEADERS) & usable, MARKER).when(~_label().isin(*NOT_TEXT) & (text != ""), TEXT).otherwise(OTHER)


def tagged(blocks: DataFrame, book_pages: DataFrame | None = None) -> DataFrame:
    """book, page, y, pos, kind, text of all blocks, with a row of kind OTHER for each of book_pages (book, page)."""
    rows = blocks.withColumn("_text", normalize_space(F.col("content")))
    rows = rows.withColumn("_kind", _kind(F.col("_text")))
    rows = rows.select("book", "page", "y", "pos", F.col("_kind").alias("kind"), F.when(F.col("_kind") != OTHER, F.col("_text")).alias("text"))
    if book_pages is None:
        return rows
    none = lambda name: F.lit(None).cast(rows.schema[name].dataType).alias(name)
    pages = book_pages.select("book", F.col("page").cast("int").alias("page"), none("y"), none("pos"), F.lit(OTHER).alias("kind"), none("text"))
    return rows.unionByName(pages)


def giants(blocks: DataFrame, most: int) -> DataFrame:
    """book of the books of more than so many blocks."""
    return blocks.groupBy("book").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("book")


def _in_books(rows: DataFrame) -> DataFrame:
    """rows with marker, how many markers of the book come up to here, and headed, whether it has any: a window by book."""
    order = Window.partitionBy("book").orderBy("page", "y", "kind", "pos").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("marker", F.count_if(F.col("kind") == MARKER).over(order).cast("int"))
    return found.withColumn("headed", F.max(F.col("kind") == MARKER).over(Window.partitionBy("book")))


def _in_ranges(rows: DataFrame) -> DataFrame:
    """The same in two levels: markers are counted in each range of the sorted rows, and ranges take over what was before them."""
    sorted_ = placed(rows, [F.col(c) for c in ("book", "page", "y", "kind", "pos")], "sections")
    here = Window.partitionBy("book", "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    local = sorted_.withColumn("_own", F.count_if(F.col("kind") == MARKER).over(here))
    sums = sorted_.groupBy("book", "_part").agg(F.count_if(F.col("kind") == MARKER).alias("_n"))  # a row for each range of a book
    before = Window.partitionBy("book").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("book").alias("_book"), F.col("_part").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), (F.sum("_n").over(Window.partitionBy("book")) > 0).alias("headed")
    )
    out = local.join(bases, F.col("book").eqNullSafe(F.col("_book")) & (F.col("_part") == F.col("_at")))
    return out.select(*rows.columns, (F.col("_own") + F.col("_base")).cast("int").alias("marker"), "headed")


def filled(blocks: DataFrame, book_pages: DataFrame | None = None, giant: int | None = None, strict_zero_bounds: bool = False) -> DataFrame:
    """book, page, y, pos, kind, text, marker (the last one at or before the row, from 1; 0 before the first), headed (the book has one)."""
    rows = tagged(blocks, book_pages)
    in_books = lambda own: _open_in_books(_in_books(own)) if strict_zero_bounds else _in_books(own)
    large = written(giants(blocks, GIANT if giant is None else giant), "giants")  # at most a row for each GIANT blocks
    if large.isEmpty():
        return in_books(rows)
    large = F.broadcast(large.withColumnRenamed("book", "_book"))
    same = F.col("book").eqNullSafe(F.col("_book"))
    ranges = _in_ranges(rows.join(large, same, "left_semi"))
    return in_books(rows.join(large, same, "left_anti")).unionByName(ranges.unionByName(_open(ranges)) if strict_zero_bounds else ranges)


def markers(blocks: DataFrame) -> DataFrame:
    """book, marker (from 1), page, y, pos, header: blocks with a header's label and a usable text."""
    rows = tagged(blocks).where(F.col("kind") == MARKER)
    order = Window.partitionBy("book").orderBy("page", "y", "pos")
    return rows.select("book", F.row_number().over(order).alias("marker"), "page", "y", "pos", F.col("text").alias("header"))


def text_rows(blocks: DataFrame) -> DataFrame:
    """book, page, y, pos, text: blocks of running text that are not blank."""
    return tagged(blocks).where(F.col("kind") == TEXT).select("book", "page", "y", "pos", "text")


def bounds(found: DataFrame) -> DataFrame:
    """markers with the place of the next one."""
    order = Window.partitionBy("book").orderBy("marker")
    return found.withColumns({"next_page": F.lead("page").over(order), "next_y": F.lead("y").over(order)})


def _open(rows: DataFrame) -> DataFrame:
    """Text rows of what a next marker at height 0 of the same page does not end, under the marker before it."""
    heads = rows.where(F.col("kind") == MARKER).select("book", "marker", "page", "y")
    ends = bounds(heads).where("next_page = page AND next_y = 0")
    ends = ends.select(F.col("book").alias("_book"), F.col("page").alias("_page"), F.col("y").alias("_y"), F.col("marker").alias("_marker"))
    texts = rows.where(F.col("kind") == TEXT)
    again = texts.join(ends, F.col("book").eqNullSafe(F.col("_book")) & (F.col("page") == F.col("_page"))).where("y >= _y AND marker <> _marker")
    return again.withColumn("marker", F.col("_marker")).select(*rows.columns)


def _open_in_books(rows: DataFrame) -> DataFrame:
    """rows and what _open() adds to them, from one pass: a window by page, for which rows of a book lie and are sorted already.

    A marker before one at height 0 of its page is at height 0 or less, so only such markers of a page are collected.
    """
    low = F.when((F.col("kind") == MARKER) & (F.col("y") <= 0), F.struct("marker", "y"))
    found = rows.withColumn("_low", F.sort_array(F.collect_list(low).over(Window.partitionBy("book", "page"))))
    next_ = F.slice("_low", 2, F.greatest(F.size("_low") - 1, F.lit(0)))
    ends = F.zip_with("_low", next_, lambda m, n: F.when((n["y"] == 0) & (F.col("y") >= m["y"]) & (m["marker"] != F.col("marker")), m["marker"]))
    again = F.when((F.col("kind") == TEXT) & F.col("page").isNotNull() & (F.size("_low") > 1), F.filter(ends, lambda m: m.isNotNull()))
    every = F.concat(F.array("marker"), F.coalesce(again, F.array().cast("array<int>")))
    return found.withColumn("marker", F.explode(every)).select(*rows.columns)


def rows_of(blocks: DataFrame, strict_zero_bounds: bool = False, book_pages: DataFrame | None = None, giant: int | None = None) -> DataFrame:
    """filled(); strict_zero_bounds adds, to sections that a marker at height 0 of their page does not end, the rest of that page."""
    return filled(blocks, book_pages, giant, strict_zero_bounds)


def assigned(blocks: DataFrame, strict_zero_bounds: bool = False, giant: int | None = None) -> DataFrame:
    """book, marker, page, y, pos, text: each text row under the last marker at or before it; rows before the first have none."""
    rows = rows_of(blocks, strict_zero_bounds, None, giant)
    return rows.where((F.col("kind") == TEXT) & (F.col("marker") > 0)).select("book", "marker", "page", "y", "pos", "text")


def sections_of(rows: DataFrame, **more: Column) -> DataFrame:
    """The sections of filled rows (rows_of), with more aggregates of each; a book without a marker is one section of all its texts."""
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    texts = F.transform(F.sort_array(F.collect_list(of(TEXT, F.struct("page", "y", "pos", "text")))), lambda r: r["text"])
    own = rows.where((F.col("marker") > 0) | ~F.col("headed"))
    held = own.groupBy("book", "marker").agg(
        F.max(of(MARKER, F.col("text"))).alias("header"), F.max(of(MARKER, F.col("page"))).alias("_own"), texts.alias("texts"), F.count_if(F.col("kind") == TEXT).alias("_texts"),
        F.array_sort(F.collect_set(of(TEXT, F.col("page")))).alias("_of_texts"), F.array_sort(F.collect_set(F.when(~F.col("headed"), F.col("page")))).alias("_all"), *[v.alias(k) for k, v in more.items()],
    )
    held = held.where((F.col("marker") > 0) | (F.col("_texts") > 0))
    pages = F.when(F.col("marker") == 0, F.col("_all")).when(F.size("_of_texts") > 0, F.col("_of_texts")).otherwise(F.array("_own"))
    held = held.withColumns({"pages": pages, "header": F.when(F.col("marker") == 0, F.lit(NO_HEADERS)).otherwise(F.col("header"))})
    return held.select("book", "marker", "header", F.array_min("pages").alias("start_page"), F.array_max("pages").alias("end_page"), "pages", "texts", *more)


def sections(blocks: DataFrame, strict_zero_bounds: bool = False, book_pages: DataFrame | None = None, giant: int | None = None) -> DataFrame:
    """book, marker, header, start_page, end_page, pages, texts; books without a marker have one section (marker 0) of all texts.

    book_pages: book and page of every page, also of those without a block; without it the pages of the blocks count.
    """
    return sections_of(rows_of(blocks, strict_zero_bounds, book_pages, giant))


def without_headers(blocks: DataFrame, book_pages: DataFrame | None = None) -> DataFrame:
    """book, marker 0, header, pages (all of the book, blank ones too), texts of books that have text but no marker."""
    return sections(blocks, False, book_pages).where("marker = 0").select("book", "marker", "header", "pages", "texts")
