"""Daily export drops merged into the monthly raw table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_month, parse_date, previous_month
from ..functions.text import delete
from ..operators.changes import replace_by_date
from ..sources.schemas import EXPORT_DATE_COLUMNS, EXPORT_SKU_COLUMNS
from ..sources.writers import quarantine


def cleaned(drop: DataFrame, marketplace: str) -> DataFrame:
    """A drop with the date of each row (``drop_date``, NULL where it cannot be read) and a cleaned code.

    Some exports end their dates with a tab.
    """
    column, formats = EXPORT_DATE_COLUMNS[marketplace]
    sku = EXPORT_SKU_COLUMNS[marketplace]
    return drop.withColumn("drop_date", parse_date(delete(F.col(f"`{column}`"), "\t"), *formats)).withColumn(sku, delete(F.trim(F.col(f"`{sku}`")), "\n"))


def open_rows(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of the months that may still change.

    Until day 30 the current and the previous month are open; on day 31 only the current one.
    Both periods are chosen by a predicate on the parsed date, without listing the months first.
    """
    months = [as_of] if as_of.day >= 31 else [as_of, previous_month(as_of)]
    open_month = F.lit(False)
    for month in months:
        open_month = open_month | in_month("drop_date", month)
    kept = rows.where(open_month)
    return kept.drop("year", "month") if {"year", "month"} <= set(rows.columns) else kept


def prepare_drop(drop: DataFrame, marketplace: str, as_of: dt.date) -> DataFrame:
    """Rows of the months that may still change, with a cleaned code and the drop date."""
    return open_rows(cleaned(drop, marketplace), as_of)


def write_snapshot(drop: DataFrame, marketplace: str, as_of: dt.date, path: str) -> DataFrame:
    """All rows of a day's drop as they were delivered, by brand, year and month; read back.

    A second drop of the day replaces the snapshot as a whole.
    """
    dated = cleaned(drop, marketplace)
    keyed = dated.withColumns({"year": F.year("drop_date"), "month": F.date_format("drop_date", "MM")})
    by = ["brand", "year", "month"]
    keyed.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
    return drop.sparkSession.read.schema(keyed.schema).parquet(path)


def write_drop(prepared: DataFrame, path: str, scope: Sequence[str] = ("brand",)) -> None:
    """Write a prepared drop into the monthly raw table.

    The table is partitioned by scope, month and day, so the days of the drop replace the same
    days of their scope, nothing else is rewritten, and a repeated run gives the same table.
    """
    by = [*scope, "year", "month", "drop_date"]
    keyed = prepared.withColumns({"year": F.year("drop_date"), "month": F.date_format("drop_date", "MM")})
    writer = keyed.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def undated(drop: DataFrame, marketplace: str) -> DataFrame:
    """Rows of a drop whose date cannot be read, with the reason; they belong to no month."""
    column, formats = EXPORT_DATE_COLUMNS[marketplace]
    return quarantine(drop, {column: parse_date(F.col(f"`{column}`"), *formats).isNotNull()})[1]


def merge_drop(
    existing: DataFrame | None,
    drop: DataFrame,
    marketplace: str,
    as_of: dt.date,
    scope: Sequence[str] = ("brand",),
) -> DataFrame:
    """The monthly raw rows after a drop: its dates replace the same dates of its brand.

    Rows whose date cannot be read are not merged; ``undated`` returns them.
    """
    prepared = prepare_drop(drop, marketplace, as_of)
    return prepared if existing is None else replace_by_date(existing, prepared, "drop_date", scope)
