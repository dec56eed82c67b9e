"""Scans: Parquet tables and partition folders, CSV exports, JSON documents, SQL tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import ORDER_DOCUMENT, TRANSFER_PAGE


def read_table(
    spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType | None = None
) -> DataFrame:
    """A Parquet file, folder or list of folders as one scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def period_filter(months: Sequence[dt.date], year: str = "year", month: str = "month") -> Column:
    """Predicate on the partition columns, pruned before any file is opened."""
    wanted = F.lit(False)
    for m in months:
        wanted = wanted | ((F.col(year) == m.year) & (F.col(month).cast("int") == m.month))
    return wanted


def read_partitions(
    spark: SparkSession,
    root: str,
    months: Sequence[dt.date] | None = None,
    bare: Sequence[str] = ("source", "company", "channel"),
    **equal: str,
) -> DataFrame:
    """Folders ``<source>/<company>/<channel>/year=YYYY/month=MM`` below ``root``.

    All segments become columns, read from the file path. Months and segments asked for by
    value narrow the path pattern, so files of other folders are not opened.
    """
    pattern = "/".join([root.rstrip("/"), *[equal.get(b, "*") for b in bare]])
    if months is not None:
        pattern += "/{" + ",".join(f"year={m.year}/month={m:%m}" for m in months) + "}"
    scan = spark.read.option("recursiveFileLookup", "true").parquet(pattern)
    part = r"year=(\d+)/month=(\d+)"
    path = F.col("_metadata.file_path")
    segments = "/".join(["([^/]+)"] * len(bare)) + "/"
    found = {
        b: F.regexp_extract(path, segments + "year=", i + 1) for i, b in enumerate(bare)
    }
    return scan.withColumns(
        {
            **found,
            "year": F.regexp_extract(path, part, 1).cast("int"),
            "month": F.regexp_extract(path, part, 2),
        }
    )


def read_keyed(
    spark: SparkSession, root: str, months: Sequence[dt.date] | None = None, **equal: str
) -> DataFrame:
    """A table written with ``partitionBy``; months and other partition values are pruned."""
    df = spark.read.parquet(root)
    if months is not None:
        df = df.where(period_filter(months))
    for name, value in equal.items():
        df = df.where(F.col(name) == value)
    return df


def read_export(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    skip: Column | None = None,
    delimiter: str = ",",
    multi_line: bool = True,
    file: str | None = None,
) -> DataFrame:
    """A marketplace export landed as CSV: every column as text, by header name.

    ``skip`` marks rows that are not data, such as a description row under the header. Fields may
    hold line breaks, so a file is read by one task, and its lines are spread before they are worked
    on; ``multi_line=False`` is for exports without them, whose large files are split over tasks.
    ``file`` names a column for the path of a row's file.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", delimiter)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    if file:
        df = df.withColumn(file, F.col("_metadata.file_path"))
    if skip is not None:
        df = df.where(~F.coalesce(skip, F.lit(False)))
    return df.hint("rebalance") if multi_line else df


def read_offset_export(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], header_row: Sequence[str] | None = None, file: str | None = None
) -> DataFrame:
    """An export whose header does not stand in the first line.

    The header is the first line of a file whose first two fields have its names; it and all
    lines above it are dropped, and so are lines without any value. Lines keep their place in the
    file, so a data line may have empty fields anywhere. A file without that line is kept whole.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    header = list(header_row or columns)
    df = spark.read.schema(schema).option("multiLine", True).option("escape", '"').csv(path if isinstance(path, str) else list(path))
    # A file that may hold line breaks in fields is one task, whose row ids rise with the lines.
    placed = df.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__line"))
    named = F.lit(True)
    for c, h in list(zip(columns, header))[:2]:
        named = named & F.col(f"`{c}`").eqNullSafe(h)
    headers = placed.where(named).groupBy("__file").agg(F.min("__line").alias("__header"))
    marked = placed.join(headers, "__file", "left")
    filled = F.coalesce(*[F.col(f"`{c}`") for c in columns]).isNotNull()
    below = F.col("__header").isNull() | (F.col("__line") > F.col("__header"))
    kept = [F.col(f"`{c}`") for c in columns] + ([F.col("__file").alias(file)] if file else [])
    return marked.where(filled & below).select(*kept).hint("rebalance")


def description_row(column: str) -> Column:
    """True for the row under the header that explains the columns: its number is no number."""
    name = F.col(f"`{column}`")
    return name.isNotNull() & name.try_cast("double").isNull()


#: Layouts of dropped exports: title lines above the header, a row of explanations below it (told by a
#: column that holds numbers); all others start with their header.
TITLED_EXPORTS = ("tokopedia",)
DESCRIBED_EXPORTS = {"tiktok": "Quantity"}


def read_dropped(spark: SparkSession, marketplace: str, paths: Sequence[str], columns: Sequence[str], file: str = "file") -> DataFrame:
    """Dropped CSV exports of a marketplace in its own layout, with the path of each row's file."""
    name = marketplace.lower()
    if name in TITLED_EXPORTS:
        return read_offset_export(spark, paths, columns, file=file)
    skip = description_row(DESCRIBED_EXPORTS[name]) if name in DESCRIBED_EXPORTS else None
    return read_export(spark, list(paths), columns, skip, file=file)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Order documents, one JSON object per line."""
    return spark.read.schema(ORDER_DOCUMENT).json(path)


def parse_orders(df: DataFrame, column: str) -> DataFrame:
    """Order documents held as JSON text in a column."""
    return df.select(F.from_json(column, ORDER_DOCUMENT).alias("doc")).select("doc.*")


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of the transfer interface, one JSON object per line."""
    return spark.read.schema(TRANSFER_PAGE).json(path)


def read_sql(
    spark: SparkSession, url: str, table: str, where: Sequence[str] = (), **options: str
) -> DataFrame:
    """A database table; each predicate in ``where`` becomes one parallel read."""
    if where:
        return spark.read.jdbc(url, table, predicates=list(where), properties=options)
    return spark.read.options(**options).jdbc(url, table)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path and modification time of every file, without reading file contents."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("modificationTime").alias("modified"))
    )


def with_source(frames: Mapping[str, DataFrame], name: str = "source") -> DataFrame:
    """Union of frames by column name with a column telling which frame a row came from."""
    out = None
    for key, df in frames.items():
        tagged = df.withColumn(name, F.lit(key))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
