"""The monthly accumulation report with its promotion report and control totals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import sum0
from ..operators.accumulating import (
    PERIOD_DATES,
    PERIODS,
    PRODUCT_COLUMNS,
    SALES_GRAIN,
    online_as_sales,
    promo_sales,
    sales_accumulation,
    sum_lines,
    unified_lines,
    valid_sales,
)
from ..operators.aggregating import compared_totals, observed_write
from ..operators.joining import keep_facts, present_in
from ..operators.products import report_products
from ..session import grouped_where_they_are, scratch_folder

VALUE = "cust_paid_peritem"


class AccumulationReport(NamedTuple):
    accumulation: DataFrame
    promotions: DataFrame
    checks: DataFrame


def month_pattern(pattern: DataFrame, month: dt.date) -> DataFrame:
    """Calendar rows of one month."""
    return pattern.where(F.trunc("pattern_date", "month") == F.lit(month.replace(day=1)))


def on_dates(sales: DataFrame, dates: DataFrame, column: str) -> DataFrame:
    """Sales on the dates a calendar column names; the calendar side is one row per date."""
    named = dates.select(column).distinct()
    return present_in(sales, named, {"order_create_date": column}, bounded=True)


def sales_of_periods(
    offline: DataFrame, online: DataFrame | None, stores: DataFrame, pattern: DataFrame
) -> tuple[DataFrame, dict[str, Decimal]]:
    """Sales per company, store, date and barcode on all dates the calendar names, written once, and
    their paid value per period, observed by that write.

    Report, dates in use and control totals all start from this table, so both channels are read
    and summed once. The dates to read come from the calendar: last month and last year need no
    loop over months, and January finds December of the year before. A sale counts once per period
    that names its date.
    """
    sold = None if online is None else online_as_sales(online, stores)
    named = F.explode(F.array(*PERIOD_DATES.values())).alias("__any")
    lines = on_dates(unified_lines(valid_sales(offline), sold), pattern.select(named), "__any")
    # Put together by the grain once, for the distinct orders and for the sums.
    summed = sum_lines(lines.repartition(*SALES_GRAIN))
    roles = F.inline(F.array(*[F.struct(F.lit(p).alias("__period"), F.col(d).alias("__date")) for p, d in PERIOD_DATES.items()]))
    # A row per calendar date, so broadcast whatever the amount of sales.
    played = pattern.select(roles).where("__date is not null").groupBy("__date").agg(F.collect_set("__period").alias("__periods"))
    marked = keep_facts(summed, played, {"order_create_date": "__date"}, bounded=True)
    totals = {p: _paid(F.when(F.array_contains("__periods", p), F.col(VALUE))) for p in PERIODS}
    path = scratch_folder(pattern.sparkSession, "sold")
    with grouped_where_they_are(pattern.sparkSession):
        found = observed_write(marked, "sold", totals, lambda df: write_small(df.drop("__periods"), path))
    return pattern.sparkSession.read.schema(summed.schema).parquet(path), found


def write_small(df: DataFrame, path: str) -> None:
    """Tables that are read again right away are written in zstd."""
    df.write.option("compression", "zstd").parquet(path)


def _paid(value: Column) -> Column:
    return F.bround(sum0(value), 2)


def period_report(
    sold: DataFrame, stores: DataFrame, products: DataFrame, pattern: DataFrame
) -> DataFrame:
    """The accumulation report of ``sales_of_periods``."""
    used = present_in(pattern, sold.select("order_create_date").distinct(), {"pattern_date": "order_create_date"}, bounded=True)
    return sales_accumulation(sold, pattern, used, stores, report_products(products, PRODUCT_COLUMNS))


def report_totals() -> dict[str, Column]:
    """The report's paid value per period, to be observed by the write of the report."""
    return {p: _paid(F.col(VALUE + p)) for p in PERIODS}


def period_checks(spark: SparkSession, sold: Mapping[str, Decimal], report: Mapping[str, Decimal]) -> DataFrame:
    """Whether the report's paid value per period is that of the sales, from the totals of both writes."""
    titles = ("this month", "last month", "last year")
    return compared_totals(spark, [(title, sold[p], report[p]) for p, title in zip(PERIODS, titles)])


def period_promotions(offline: DataFrame, stores: DataFrame, pattern: DataFrame) -> DataFrame:
    """The promotion report of the calendar's own dates."""
    return promo_sales(on_dates(valid_sales(offline), pattern, "pattern_date"), stores)


def accumulation_report(
    offline: DataFrame,
    online: DataFrame | None,
    stores: DataFrame,
    products: DataFrame,
    pattern: DataFrame,
) -> AccumulationReport:
    """Everything the monthly report delivers, from sales lines of all periods; the report is written once."""
    sold, before = sales_of_periods(offline, online, stores, pattern)
    spark = pattern.sparkSession
    path = scratch_folder(spark, "report")
    report = period_report(sold, stores, products, pattern)
    with grouped_where_they_are(spark):
        after = observed_write(report, "report", report_totals(), lambda df: write_small(df, path))
    return AccumulationReport(
        spark.read.schema(report.schema).parquet(path), period_promotions(offline, stores, pattern), period_checks(spark, before, after)
    )
