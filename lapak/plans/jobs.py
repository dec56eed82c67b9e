"""End-to-end jobs: read a lake folder, run a pipeline for the months due, write its tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import in_month, next_month, previous_month, rebuild_months
from ..operators.aggregating import observed_write
from ..operators.changes import ACCUMULATION_KEY, PROMO_KEY, Upsert, round_report, upsert
from ..operators.dedup import number_rows
from ..operators.marketplaces import LAYOUTS, normalise_all, processed_matcher
from ..operators.products import active_items
from ..sources.readers import period_filter, read_table
from ..session import grouped_where_they_are, stored
from ..sources.writers import there, write_bundle, write_months, write_split
from .accumulation import (
    AccumulationReport,
    month_pattern,
    period_checks,
    period_promotions,
    period_report,
    report_totals,
    sales_of_periods,
)
from .online_detail import online_sales_detail
from .pos_detail import pos_sales_detail, pos_sales_report

ONLINE_LATE_UNTIL = 19


@dataclass(frozen=True)
class Lake:
    """Tables by name below one root folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def read_months(self, name: str, months: Sequence[dt.date]) -> DataFrame:
        """A table's folders of these months, without the folder columns.

        A landed table that has no month folders is read whole; rows are not filtered.
        """
        df = self.read(name)
        if {"year", "month"} <= set(df.columns):
            df = df.where(period_filter(months)).drop("year", "month")
        return df


def any_month(column: str, months: Sequence[dt.date]) -> Column:
    return reduce(lambda a, b: a | b, [in_month(column, m) for m in months])


def calendar_months(pattern: DataFrame) -> list[dt.date]:
    """Months that any date of these calendar rows falls into."""
    dates = F.explode(F.array("pattern_date", "pattern_lm", "pattern_last_year")).alias("d")
    months = pattern.select(dates).where("d is not null").select(F.trunc("d", "month").alias("m"))
    # A calendar month names a handful of months.
    return sorted(r.m for r in months.distinct().collect())


def run_pos_detail(lake: Lake, as_of: dt.date) -> list[dt.date]:
    """POS sales detail of the months still open on ``as_of``."""
    months = rebuild_months(as_of)
    detail = pos_sales_detail(
        lake.read_months("pos_orders", months).where(any_month("time_created", months)),
        lake.read_months("pos_payments", months).where(any_month("time_created", months)),
        lake.read("stores"),
        lake.read("promotions"),
        lake.read("products"),
        lake.read("receipts"),
        lake.read("brand_margins"),
        as_of,
    )
    write_months(detail, lake.path("pos_detail"), "order_create_date", by=["dataareaid"], months=months)
    return months


def run_pos_report(lake: Lake, as_of: dt.date) -> None:
    """POS report of the open months, one delivery per company, channel and department head."""
    months = rebuild_months(as_of)
    detail = lake.read_months("pos_detail", months).where(any_month("order_create_date", months))
    report = pos_sales_report(detail, lake.read("erp_staging"))
    deliveries = report.withColumns(
        {"company": F.col("dataareaid"), "sales_channel": F.col("main_channel"), "head": F.col("so_dept_head"),
         "year": F.year("order_create_date"), "month": F.date_format("order_create_date", "MM")}
    )
    # The open months are replaced as a whole: under a new head no line is delivered twice.
    write_split(deliveries, lake.path("pos_report"), ["company", "sales_channel", "head"], "parquet", months)


def run_online_detail(lake: Lake, as_of: dt.date) -> list[dt.date]:
    """Online sales detail of the months still open, from the landed marketplace exports."""
    months = rebuild_months(as_of, ONLINE_LATE_UNTIL)
    # Export times carry zones, so a sale may lie in the folder of the month beside its own.
    around = sorted({n for m in months for n in (previous_month(m), m, next_month(m))})
    exports = {m: lake.read_months(f"exports/{m}", around) for m in LAYOUTS}
    items = active_items(
        lake.read("legacy_items"), lake.read("item_stops"), ["pulldate", "modifieddatetime", "recid"]
    )
    lines = normalise_all(exports, processed_matcher(items)).where(any_month("date", months))
    detail = online_sales_detail(lines, lake.read("products"), lake.read("margins"))
    write_months(detail, lake.path("online_detail"), "date", by=["marketplace"], months=months)
    return months


def run_accumulation(lake: Lake, month: dt.date) -> AccumulationReport:
    """The accumulation report of a month with promotions and control totals, as three tables.

    Only the months that the calendar names are read. The control totals are those of the sales and
    of the report as both were written: no table is read again for them.
    """
    pattern = month_pattern(lake.read("pattern"), month)
    months = calendar_months(pattern)
    offline, stores = lake.read_months("pos_detail", months), lake.read("stores")
    sold, before = sales_of_periods(offline, lake.read_months("online_detail", months), stores, pattern)
    folder = f"reports/{month:%Y-%m}"
    report = period_report(sold, stores, lake.read("products"), pattern)
    with grouped_where_they_are(lake.spark):
        after = observed_write(report, "report", report_totals(), lambda df: write_bundle({"accumulation": df}, lake.path(folder)))
    checks = period_checks(lake.spark, before, after)
    write_bundle({"promotions": period_promotions(offline, stores, pattern), "checks": checks}, lake.path(folder))
    return AccumulationReport(*[lake.read(f"{folder}/{part}") for part in AccumulationReport._fields])


#: Report tables: the part of the monthly report they are loaded from, and their key.
REPORT_TABLES = {"sales_akum": ("accumulation", ACCUMULATION_KEY), "sales_promo": ("promotions", PROMO_KEY)}


def _written_at(report: DataFrame) -> Column:
    """When a report's files were written: the same for a load that is repeated."""
    found = report.agg(F.max("_metadata.file_modification_time").cast("string")).first()[0]
    return F.lit(found).cast("timestamp")


def load_report_months(lake: Lake, month: dt.date) -> dict[str, int]:
    """Upsert a month's written reports into report tables kept by month (``<table>_by_month``); returns changed rows per table.

    Only the months that a load holds are read, merged and rewritten: other months' files stay. The
    log of a load, if it changed anything, is written before the table, under the load's month and
    the time of its report. A load that is repeated finds nothing to change and leaves both as they are.
    """
    changed = {}
    for table, (part, key) in REPORT_TABLES.items():
        report = lake.read(f"reports/{month:%Y-%m}/{part}")
        new = stored(round_report(report), "load")
        # As many rows as months are loaded, usually one.
        months = [r.m for r in new.select(F.trunc("order_create_date", "month").alias("m")).where("m is not null").distinct().collect()]
        name = f"{table}_by_month"
        path = lake.path(name)
        if there(lake.spark, path):
            held = lake.read(name)
            last = held.agg(F.max("id")).first()[0] or 0
            existing = held.where(period_filter(months)).drop("year", "month") if months else held.limit(0).drop("year", "month")
        else:
            last, existing = 0, new.limit(0).select(F.lit(0).cast("long").alias("id"), "*")
        result = upsert(existing, new, key, table, stamp=_written_at(report))
        merged = stored(result.merged.unionByName(_with_ids(result.inserts, existing, last)), "merged")
        log = stored(result.log, "log")
        changed[table] = log.count()
        if changed[table]:
            log.write.mode("overwrite").parquet(lake.path(f"logging_{name}/load={month:%Y-%m}/at={log.first().timestamp:%Y%m%d%H%M%S}"))
        if not merged.isEmpty():
            write_months(merged, path, "order_create_date")
    return changed


def load_reports(lake: Lake, month: dt.date, version: int) -> dict[str, Upsert]:
    """Upsert a month's written reports into the report tables, as a new version of each.

    Version ``version`` is read and ``version + 1`` written, so nothing read is overwritten. New
    rows get ids above the largest one in use. The log has the time of the report, so a repeated
    run writes the same log.
    """
    results = {}
    for table, (part, key) in REPORT_TABLES.items():
        existing = lake.read(f"{table}/version={version}")
        report = lake.read(f"reports/{month:%Y-%m}/{part}")
        result = upsert(existing, round_report(report), key, table, stamp=_written_at(report))
        target = lake.path(f"{table}/version={version + 1}")
        merged = result.merged.unionByName(_with_ids(result.inserts, existing))
        merged.write.mode("overwrite").parquet(target)
        # Below its version, so that a repeated run replaces its own log.
        result.log.write.mode("overwrite").parquet(lake.path(f"logging_{table}/version={version + 1}"))
        results[table] = result
    return results


def _with_ids(inserts: DataFrame, existing: DataFrame, last: int | None = None) -> DataFrame:
    """Ids for inserted rows: the next numbers above those in use, without gaps, in row order."""
    if last is None:  # one value, an aggregate of the table
        last = existing.agg(F.max("id")).first()[0] or 0
    numbered = number_rows(inserts, inserts.columns, name="__n").withColumn("id", F.col("__n") + F.lit(last))
    return numbered.select(*[F.col(c).cast(existing.schema[c].dataType) for c in existing.columns])
