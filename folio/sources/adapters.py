"""Tables as layout blocks: book, page, pos, y, label, content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 20
HEADER_LENGTH = 40


def _lines(rows: DataFrame, text: str = "text") -> DataFrame:
    return rows.select("*", F.posexplode(F.split(F.col(text), "\n")).alias("pos", "content"))


def _block(label: Column, page: Column, y: Column) -> list[Column]:
    return [F.col("book").cast("long").alias("book"), page.cast("int").alias("page"), F.col("pos").cast("int").alias("pos"), y.cast("double").alias("y"), label.alias("label"), F.col("content")]


def from_documents(docs: DataFrame) -> DataFrame:
    """Lines of a text on pages of LINES lines; short lines are headers."""
    rows = _lines(docs.select(F.col("doc_id").alias("book"), "text"))
    label = F.when(F.length("content") <= HEADER_LENGTH, "header").otherwise("text")
    return rows.select(*_block(label, F.floor(F.col("pos") / LINES) + 1, F.col("pos") % LINES + 1))


def from_conversations(turns: DataFrame) -> DataFrame:
    """A turn is a page; the first line of a user's turn is a header."""
    rows = _lines(turns.select(F.col("conv_id").alias("book"), "turn", "role", "text"))
    label = F.when((F.col("role") == "user") & (F.col("pos") == 0), "header").otherwise("text")
    return rows.select(*_block(label, F.col("turn") + 1, F.col("pos") + 1))


#: Elements in the order of their labels.
TAGS = {"h1": "header", "title": "paragraph_title", "p": "text", "footer": "footer"}


def from_pages(pages: DataFrame) -> DataFrame:
    """Elements of a page in document order, without the tags inside them; scripts, styles and comments are left out."""
    bare = F.regexp_replace("html", r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")
    found = F.regexp_extract_all(bare, F.lit("(?s)" + "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in TAGS)), F.lit(0))
    rows = pages.select(F.col("page_id").alias("book"), F.posexplode(found).alias("pos", "element"))
    tag = F.regexp_extract("element", r"^<([a-z0-9]+)", 1)
    rows = rows.withColumn("content", F.regexp_replace("element", r"(?s)<[^>]*>", ""))
    label = F.coalesce(*[F.when(tag == t, F.lit(name)) for t, name in TAGS.items()])
    return rows.select(*_block(label, F.lit(1), F.col("pos") + 1))


def words_of(text: Column) -> Column:
    """The words between spaces of a text, line breaks counting as spaces."""
    return F.filter(F.split(F.translate(text, "\n", " "), " "), lambda w: w != "")


def words(docs: DataFrame) -> DataFrame:
    """doc_id, pos and word between spaces of each text, line breaks counting as spaces."""
    split = F.split(F.translate("text", "\n", " "), " ")
    return docs.select("doc_id", F.posexplode(split).alias("pos", "word")).where("word <> ''")
