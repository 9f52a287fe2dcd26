"""What a stage has done, by book and page, so that a run goes on where an earlier one ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import ocr
from folio.operators.shared import written
from folio.sources.ingest import PAGE_FILE
from folio.sources.sinks import exists, to_tables

SCHEMA = "page int, sum long, stage string, book string"


def page_sums(pages: DataFrame) -> DataFrame:
    """book, page, sum of pages (book, page, value): the sum tells whether a page has changed."""
    return pages.select(F.col("book").cast("string").alias("book"), F.col("page").cast("int").alias("page"), F.xxhash64(F.coalesce("value", F.lit("")), F.col("value").isNull()).alias("sum"))


class Manifest:
    """A table of (stage, book, page, sum). A book's rows of a stage are replaced as a whole, after its outputs are written: a run
    that is killed in between does the book again, with the same result. Books of the earlier state stay as they are."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def done(self, stage: str) -> DataFrame:
        """book, page, sum of what the stage has done."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], "book string, page int, sum long")
        return self.spark.read.schema(SCHEMA).parquet(self.path).where(F.col("stage") == stage).select("book", "page", "sum")

    def open(self, stage: str, expected: DataFrame) -> DataFrame:
        """book of those with a page in expected (book, page, sum) that is not done, or is done as it was before, or with a page too many."""
        done, keys = self.done(stage), ["book", "page", "sum"]
        new = expected.join(done, keys, "left_anti").select("book")
        gone = done.join(expected.select("book").distinct(), "book", "left_semi").join(expected, keys, "left_anti").select("book")
        return written(new.union(gone).distinct(), "open-books")

    def commit(self, stage: str, done: DataFrame) -> None:
        to_tables(done.select("book", "page", "sum", F.lit(stage).alias("stage")), self.path, ["stage", "book"])


def save_pages(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Adds pages (book, page, value, name, modified) to the table of pages, which has one row for each book and page by the rule
    of ocr.unique_pages, whatever came first; returns the books' rows as they are now. Other books are not read."""
    new = pages.select("book", "page", "value", "name", "modified")
    if exists(spark, path):
        held = spark.read.schema(f"{PAGE_FILE}, copies long").parquet(path).drop("copies")
        new = new.unionByName(held.join(new.select("book").distinct(), "book", "left_semi"))
    merged = written(ocr.unique_pages(new), "saved-pages")
    to_tables(merged, path)
    return merged
