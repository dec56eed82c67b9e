"""Stored roll-ups of sales by store and day, of which only open months are made anew.

Month-to-date, year-to-date and distinct-order reports read the roll-ups of the year, which are as
many rows as stores and days, instead of the year's lines. A month that is delivered again is the
only one whose lines are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_month
from ..functions.values import sum0
from ..operators.accumulating import EXACT_MEASURES, unified_lines, unified_sales, valid_sales
from ..operators.aggregating import group_sum
from ..operators.distinct_orders import BITS, BUCKET, counted, merged, order_bitmaps, order_numbers
from ..session import stored
from ..sources.readers import period_filter
from ..sources.writers import write_months
from .jobs import Lake, any_month

STORE_DAY = ("dataareaid", "axcode", "order_create_date")
SUMS = ("quantity", *EXACT_MEASURES)


def day_rollup(lines: DataFrame) -> DataFrame:
    """Valid sales summed per company, store and day."""
    return group_sum(unified_sales(valid_sales(lines)), STORE_DAY, *SUMS)


def rollup_lines(lake: Lake, months: Sequence[dt.date] | None, source: str = "pos_detail") -> DataFrame:
    """The lines of the months that are rolled up (None: of all); other months' files are not opened."""
    if months is None:
        lines = lake.read(source)
        return lines.drop("year", "month") if {"year", "month"} <= set(lines.columns) else lines
    return lake.read_months(source, months).where(any_month("order_create_date", months))


def refresh_rollups(lake: Lake, months: Sequence[dt.date] | None, source: str = "pos_detail", table: str = "sales_rollup") -> None:
    """Make the roll-ups of ``months`` anew from their lines; those of other months stay as they are.
    None makes those of all months, as for a first load.

    Beside the sums, in ``<table>_orders``, stand the bitmaps of each store's and day's orders, over
    numbers kept in ``<table>_numbers``, to which each run adds those of the orders it sees first.
    """
    lines = rollup_lines(lake, months, source)
    write_months(day_rollup(lines), lake.path(table), "order_create_date", months=months)
    orders = stored(unified_lines(valid_sales(lines)).select(*STORE_DAY, "ordernumber").distinct(), "orders")
    known = numbers_of(lake, table)
    new = stored(order_numbers(orders, known=known), "numbers")
    new.write.mode("append").parquet(lake.path(f"{table}_numbers"))
    write_months(order_bitmaps(orders, known.unionByName(new), STORE_DAY), lake.path(f"{table}_orders"), "order_create_date", months=months)


def numbers_of(lake: Lake, table: str = "sales_rollup") -> DataFrame:
    """Order numbers given so far; an order keeps its first one should a failed run have left two."""
    schema = "ordernumber string, order_no bigint"
    empty = lake.spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(lake.path(f"{table}_numbers"))
    held = lake.spark.read.schema(schema).parquet(lake.path(f"{table}_numbers"))
    return held.groupBy("ordernumber").agg(F.min("order_no").alias("order_no"))


def month_and_year_to_date(rollup: DataFrame, as_of: dt.date, keys: Sequence[str] = ("dataareaid", "axcode")) -> DataFrame:
    """Sums of the month and of the year up to ``as_of`` per key, from day roll-ups.

    A rollup table's folders of other years and of later months are not opened.
    """
    held = rollup
    if {"year", "month"} <= set(rollup.columns):
        held = rollup.where((F.col("year") == as_of.year) & (F.col("month").cast("int") <= as_of.month))
    day = F.col("order_create_date")
    so_far = held.where((F.year(day) == as_of.year) & (day <= F.lit(as_of)))
    month = in_month("order_create_date", as_of)
    sums = {f"{m}_mtd": sum0(F.when(month, F.col(m))) for m in SUMS} | {f"{m}_ytd": sum0(m) for m in SUMS}
    return group_sum(so_far, keys, **sums)


def orders_to_date(bitmaps: DataFrame, as_of: dt.date, keys: Sequence[str] = ("dataareaid", "axcode")) -> DataFrame:
    """Distinct orders of the month and of the year up to ``as_of`` per key; an order of two days counts once."""
    day = F.col("order_create_date")
    so_far = bitmaps.where((F.year(day) == as_of.year) & (day <= F.lit(as_of)))
    year = counted(merged(so_far, **{k: k for k in keys}), *keys, name="orders_ytd")
    month = counted(merged(so_far.where(in_month("order_create_date", as_of)), **{k: k for k in keys}), *keys, name="orders_mtd")
    both = year.unionByName(month, allowMissingColumns=True)
    return both.groupBy(*keys).agg(sum0("orders_mtd").cast("long").alias("orders_mtd"), sum0("orders_ytd").cast("long").alias("orders_ytd"))


def run_to_date(lake: Lake, as_of: dt.date, table: str = "sales_rollup") -> DataFrame:
    """Sums and distinct orders to date per store, from the stored roll-ups alone."""
    months = [dt.date(as_of.year, m, 1) for m in range(1, as_of.month + 1)]
    sums = month_and_year_to_date(lake.read(table).where(period_filter(months)), as_of)
    bitmaps = lake.read(f"{table}_orders").where(period_filter(months)).select(*STORE_DAY, BUCKET, BITS)
    return sums.join(orders_to_date(bitmaps, as_of), ["dataareaid", "axcode"], "left")
