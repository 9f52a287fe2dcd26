"""Tables that operators write in the folder that driver and executors share, and ranks over them."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths of the tables that this driver has written.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where all is one process, it may be unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: executors need a folder that they share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage is cut, and lost executors lose nothing of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/folio-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> bool:
    """Deletes a folder of any file system that Spark knows; whether it was there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def released(spark: SparkSession) -> int:
    """Deletes the tables that written() has made in this driver, when no result is read any more; their number."""
    gone = 0
    while _written:
        gone += delete(spark, _written.pop())
    return gone


def spread(df: DataFrame) -> DataFrame:
    """df dealt to as many tasks as the cluster runs at once, if it has fewer partitions: a few files that take long to work on."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def placed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df as a table, with _part and _row: sorted by ranges of the order, the range and the place of a row in it."""
    row = F.monotonically_increasing_id()  # the number of the task, shifted, and the place in it
    rows = written(df.sort(*order).withColumn("_row", row), name)
    return rows.withColumns({"_part": F.shiftright("_row", 33).cast("int"), "_row": F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))})


def ranked(df: DataFrame, order: list[Column], name: str = "idx", start: int = 0) -> DataFrame:
    """df with its rank in the order, which no single task sees.

    Rows are sorted by ranges and written; the rows of each range are counted, and a row's rank is its place in its range
    and the sum of the counts before. Rows that the order does not tell apart get ranks in any order.
    """
    rows = placed(df, order, "ranked")
    counts = rows.groupBy("_part").count().collect()  # a row for each task
    counts.sort(key=lambda r: r["_part"])
    bases = itertools.accumulate((r["count"] for r in counts), initial=start)
    table = df.sparkSession.createDataFrame([(r["_part"], b) for r, b in zip(counts, bases)], "_part int, _base long")
    return rows.join(F.broadcast(table), "_part").withColumn(name, F.col("_base") + F.col("_row")).select(*df.columns, name)
