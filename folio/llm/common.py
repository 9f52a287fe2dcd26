"""What the operators of this subpackage share: table access, shared work folders, byte limits."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows in an Arrow batch. Texts can be long, so batches are small; a batch is all that a
#: streaming operator holds of its partition.
BATCH_ROWS = 256
BATCH_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of few rows and bytes, so that a Python worker never holds many long texts. A setting of the
    session, as plans run later than they are made."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. In local mode, where all is one process, it may be unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: executors need a folder that they share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage is cut and lost executors lose nothing of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/folio-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each that are sent to every executor at most.
SENT_ROWS = 1_000_000


def sent(df: DataFrame, rows: int) -> DataFrame:
    """df, of so many narrow rows, for a join: sent to every executor if it is small, else sorted and merged."""
    return F.broadcast(df) if rows <= SENT_ROWS else df.hint("merge")


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def labelled_sample(rows: DataFrame, label: str, most_rows: int, most_chars: int, least: int = 0) -> list[tuple[str, object]]:
    """At most most_rows (text, label) of rows (doc_id, text, label), of at most most_chars characters together.

    Each label has its share of the rows, but `least` of them if it has so many (together they may exceed most_rows then).

    In the order of a hash of the row; texts that alone take a twentieth of the characters, or are empty,
    are not learned from. The hash thins the rows before they are sorted, so that the driver receives
    about twice what it keeps.
    """
    key = F.xxhash64("doc_id", "text")
    rows = rows.where(F.col(label).isNotNull() & F.length("text").between(1, most_chars // 20))
    if least == 0:
        share = min(1.0, 2 * most_rows / max(1, rows.count()))
        thin = rows.where(F.pmod(key, F.lit(1 << 30)) < int(share * (1 << 30)))
        found = thin.orderBy(key, label).select("text", label).limit(most_rows)
    else:
        counts = rows.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"))  # as many rows as there are labels
        share = F.lit(most_rows) / F.sum("_n").over(Window.partitionBy())
        quota = counts.withColumn("_quota", F.greatest(F.ceil(F.col("_n") * share), F.lit(least)))
        thin = rows.join(quota, F.col(label) == F.col("_label"))
        thin = thin.where(F.pmod(key, F.lit(1 << 30)) < F.least(F.lit(1.0), 2 * F.col("_quota") / F.col("_n")) * (1 << 30))
        place = F.row_number().over(Window.partitionBy(label).orderBy(key))  # of twice the quota
        found = thin.withColumn("_place", place).where("_place <= _quota").orderBy(key, label).select("text", label)
    out, chars = [], 0
    for text, y in found.collect():
        chars += len(text)
        if chars > most_chars:
            break
        out.append((text, y))
    return out


def fold(divisor: int) -> Column:
    """crc32 of doc_id as text (null: empty), modulo divisor."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def batches_of(columns: dict[str, pa.DataType]):
    """A function that makes record batches of these columns from lists or arrays."""
    schema = pa.schema(list(columns.items()))

    def make(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values(), strict=True)], schema=schema)

    return make


def texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch with its texts; null counts as empty."""
    for batch in batches:
        yield batch, [t or "" for t in batch.column(column).to_pylist()]
