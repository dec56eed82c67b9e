"""Sinks: monthly Parquet, split deliveries, table bundles, SQL append, quarantine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored


#: Folder name of a month that rows without a date belong to.
NO_MONTH = "year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__"


def _whole_months(
    df: DataFrame, path: str, by: Sequence[str], months: Sequence[dt.date | None], file_format: str, **options: object
) -> None:
    """Each month's folder (outermost) replaced as a whole by its rows of ``df`` (with year and month).

    A folder that the rows no longer fill vanishes, and so does all of a month without rows. A
    rebuild names one or two months, so this is as many writes; the rows are computed once. A
    month's old files go when its write begins: until the job ends, a run that failed is repeated.
    """
    if len(months) > 1:
        df = stored(df, "months")
    for m in months:
        own = (F.col("year").isNull() if m is None else F.col("year") == m.year) & (
            F.col("month").isNull() if m is None else F.col("month").cast("int") == m.month
        )
        folder = NO_MONTH if m is None else f"year={m.year}/month={m:%m}"
        writer = df.where(own).drop("year", "month").write.mode("overwrite").option("partitionOverwriteMode", "static")
        for name, value in options.items():
            writer = writer.option(name, value)
        writer.format(file_format).partitionBy(*by).save(f"{path.rstrip('/')}/{folder}")


def there(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path``."""
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def with_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns({"year": F.year(date), "month": F.date_format(date, "MM")})


def write_months(
    df: DataFrame, path: str, date: str, by: Sequence[str] = (), files_per_partition: int = 1, months: Sequence[dt.date] | None = None
) -> None:
    """Parquet partitioned by year, month and then ``by``; the months of ``df`` are replaced as a whole.

    ``months`` names the months that are rebuilt: rows of others are not written, and a named month
    without rows ends up empty. Without it, all months that occur are replaced.

    Rows are rebalanced over the keys: adaptive execution splits a month that is too large for
    one task and joins small ones. ``files_per_partition`` above 1 instead spreads every month
    over so many tasks by a hash of its rows.
    """
    keyed = with_month(df, date)
    parts = ["year", "month", *by]
    if files_per_partition > 1:
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_partition))
        keyed = keyed.repartition(*parts, spread)
    else:
        keyed = keyed.hint("rebalance", *parts)
    # Where a month is one folder, or nothing is there yet, what occurs is replaced in one write.
    if months is None and (not by or not there(df.sparkSession, path)):
        writer = keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*parts).parquet(path)
        return
    if months is None:
        keyed = stored(keyed, "months")
        # As many rows as months occur.
        found = keyed.select("year", F.col("month").cast("int").alias("month")).distinct().collect()
        months = [None if r.year is None else dt.date(r.year, r.month, 1) for r in found]
    _whole_months(keyed, path, by, months, "parquet")


def write_split(
    df: DataFrame, path: str, by: Sequence[str], file_format: str = "csv", months: Sequence[dt.date] | None = None, whole: bool = False
) -> None:
    """One folder per combination of ``by``, in a single pass.

    Folders not met stay, unless ``months`` names the months that are rebuilt: these, the outermost
    folders (``df`` has year and month), are replaced as a whole, so what left a month's deliveries
    leaves no folder behind. ``whole`` replaces all of ``path``.
    """
    options = {"header": True} if file_format == "csv" else {}
    if months is not None:
        _whole_months(df, path, by, months, file_format, **options)
        return
    mode = "static" if whole else "dynamic"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode).options(**options)
    writer.format(file_format).partitionBy(*by).save(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table of the catalog whose rows lie in ``buckets`` by a hash of ``keys``, sorted by them.

    Tables bucketed alike on a key are joined and summed on it without a shuffle, however often.
    The number of buckets is the parallelism of such a join: choose it by the largest table.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bundle(tables: Mapping[str, DataFrame], path: str, file_format: str = "parquet") -> None:
    """A report of several named tables, one folder each."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(file_format).save(f"{path.rstrip('/')}/{name}")


def append_sql(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.options(**options).mode("append").jdbc(url, table)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def quarantine(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows passing every check, and the others with the names of the checks they failed.

    A check that evaluates to NULL has failed.
    """
    failed = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(passed, F.lit(False)), F.lit(name))
                for name, passed in checks.items()
            ]
        )
    )
    marked = df.withColumn("reasons", failed)
    good = marked.where(F.size("reasons") == 0).drop("reasons")
    return good, marked.where(F.size("reasons") > 0)
