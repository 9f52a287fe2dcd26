"""The same plans over files that keep arriving. There is no event time in the data, so there are no watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving_pages(spark: SparkSession, path: str) -> DataFrame:
    """book, page, value of page files as they appear under path, for ocr.parsed and ocr.blocks."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    rows = files.option("pathGlobFilter", "page*.json").option("recursiveFileLookup", "true").load(path)
    return rows.select(
        F.regexp_extract("path", r"([^/]+)/[^/]*$", 1).alias("book"),
        F.regexp_extract("path", r"page(\d+)\.json$", 1).cast("int").alias("page"),
        F.decode("content", "UTF-8").alias("value"),
    )
