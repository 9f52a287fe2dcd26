"""Where results go: Parquet tables by book, pretty JSON, and one JSON file for each book."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def to_tables(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replaces the partitions of the books in df, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(by or ["book"])).parquet(path)


def as_json(df: DataFrame, by: list[str]) -> DataFrame:
    """by and value: the other columns as pretty JSON; nulls are written."""
    rest = F.struct(*[c for c in df.columns if c not in by])
    return df.select(*by, F.to_json(rest, {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))


def to_json_files(df: DataFrame, path: str) -> None:
    """One JSON object for each row, in a folder for each book."""
    as_json(df, ["book"]).write.mode("overwrite").partitionBy("book").text(path)


@F.pandas_udf(StringType())
def _indented(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """JSON text as it stands in an array of an object: two spaces a level, from the second level on."""
    for part in parts:
        yield part.map(lambda t: "    " + json.dumps(json.loads(t), ensure_ascii=False, indent=2).replace("\n", "\n    "))


def bundle_lines(pages: DataFrame, meta: DataFrame, headers: DataFrame) -> DataFrame:
    """book, place, value: pieces of one JSON text for each book, in the order of place: an object of meta, headers_index and pages.

    pages: book, page, v; meta: book and its fields; headers: book, page, pos and their fields. A piece is a page at most.
    """
    at = lambda part, page, pos: F.struct(F.lit(part).alias("part"), page.cast("int").alias("page"), pos.cast("int").alias("pos")).alias("place")
    json_of = lambda df: F.to_json(F.struct(*[c for c in df.columns if c not in ("book", "pos")]), {"ignoreNullFields": "false"})
    zero = F.lit(0)
    rows = meta.select("book", at(1, zero, zero), json_of(meta).alias("json"))
    rows = rows.unionByName(headers.select("book", at(2, F.col("page"), F.col("pos")), json_of(headers).alias("json")))
    rows = rows.unionByName(pages.select("book", at(3, F.col("page"), zero), F.to_json("v").alias("json")))
    order = Window.partitionBy("book").orderBy("place")
    rows = rows.withColumns({"_before": F.lag("place.part").over(order), "_after": F.lead("place.part").over(order)})
    part, text = F.col("place.part"), _indented(F.col("json"))
    more = F.when(part.eqNullSafe(F.col("_after")), F.lit(",")).otherwise("")
    # What comes before the first piece of a part, with the parts before it that have none.
    none = lambda names: F.lit("".join(f'  "{n}": [],\n' for n in names))
    opens = {1: F.lit('{\n  "meta": '), 2: F.lit('  "headers_index": [\n'), 3: F.concat(F.when(F.col("_before") == 1, none(["headers_index"])).otherwise(""), F.lit('  "pages": [\n'))}
    head = F.when(part.eqNullSafe(F.col("_before")), F.lit(""))
    for k, opening in opens.items():
        head = head.when(part == k, opening)
    own = F.when(part == 1, F.concat(F.replace(F.ltrim(text), F.lit("\n    "), F.lit("\n  ")), F.lit(","))).otherwise(F.concat(text, more))
    last = F.col("_after").isNull()
    none_left = F.when(part == 1, F.lit('\n  "headers_index": [],\n  "pages": []')).when(part == 2, F.lit('\n  ],\n  "pages": []')).otherwise(F.lit("\n  ]"))
    tail = F.when(last, F.concat(none_left, F.lit("\n}"))).when((part == 2) & (F.col("_after") == 3), F.lit("\n  ],")).otherwise("")
    return rows.select("book", "place", F.concat(head, own, tail).alias("value"))


def to_bundles(pages: DataFrame, meta: DataFrame, headers: DataFrame, path: str) -> None:
    """One JSON file for each book, in a folder of its own. A task writes a book's pieces as they come, sorted; none holds them all."""
    lines = bundle_lines(pages, meta, headers)
    dealt = lines.repartition("book").sortWithinPartitions("book", "place")
    dealt.select("book", "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("book").text(path)
