"""What the corpus operators share: written intermediate tables, row numbers, free names."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow.fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_folder

#: A word is a run of characters other than these blanks (Java regex).
WORD = r"[^\x20\x09-\x0D]+"
#: The same for Python's ``re``.
WORD_PY = r"[^\x20\t-\r]+"
#: Names of file systems that pyarrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back.

    Later jobs read the committed files: a lost executor costs a re-read, not the whole lineage,
    and Spark knows the table's size when it picks a join.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """pyarrow's file system of a path and the path in it. Spark's names of object stores are understood."""
    for theirs, ours in SCHEMES.items():
        if uri.startswith(theirs + "://"):
            uri = ours + uri[len(theirs) :]
    return arrow_fs.FileSystem.from_uri(uri)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, lengthened until no column of ``df`` has that name (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Consecutive numbers from 0 in the given order, without a one-task sort.

    Rows are dealt by ranges of ``order``, sorted and written, one file per range. A row's number
    is its place in its file, which Parquet knows, plus the rows of all earlier files. Rows equal
    in all of ``order`` may swap numbers. ``df`` must not have ``name``, ``piece`` or ``place``.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(ranged.withColumn("piece", F.spark_partition_id()), "ordered")
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so as many as shuffle partitions: a bound that holds at any size.
    shifts = rows.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).select(
        "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift")
    )
    placed = rows.select("*", F.col("_metadata.row_index").alias("place"))
    return (
        placed.join(F.broadcast(shifts), "piece")
        .withColumn(name, F.col("place") + F.col("shift"))
        .drop("piece", "place", "shift")
    )
