"""End-to-end jobs of the online channel: raw drops, staging lines, daily reports, deliveries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import next_month, previous_month, rebuild_months, reference_date
from ..operators.marketplaces import LAYOUTS, normalise_all, staging_matcher
from ..operators.monitoring import export_files, fresh_and_stale, newest_files
from ..operators.online_reports import (
    daily_lines,
    daily_totals_agree,
    delivery_extract,
    numbered_settlement,
    online_daily_report,
    online_targets,
    sales_by_day,
    sales_by_item,
    sales_by_status,
    settlement_template,
)
from ..operators.rejects import checked, reject_report
from ..sources.readers import file_inventory, read_dropped
from ..sources.schemas import EXPORT_DATE_COLUMNS
from ..sources.writers import with_month, write_bundle, write_months, write_split
from .jobs import ONLINE_LATE_UNTIL, Lake, any_month, calendar_months
from .raw_drop import open_rows, write_drop, write_snapshot

#: Dropped spreadsheets are landed as CSV; a workbook beside them is left alone.
DROPPED_SUFFIX = ".csv"


def run_raw_drop(
    lake: Lake, landing: str, columns: Mapping[str, Sequence[str]], as_of: dt.date
) -> list[str]:
    """Merge the exports that landed on ``as_of`` (local day) into the monthly raw tables.

    The newest CSV file of each brand and marketplace counts, read in the marketplace's own layout;
    sources whose newest file is older are listed in ``raw_stale``. The drop is parsed once, into the
    day's snapshot: ``raw_snapshot/marketplace=../day=..``, by brand, year and month, with what could
    not be read in each row. From there its days replace the same days of their brand in the raw
    table, which is partitioned down to the day, so nothing else is rewritten; a repeated run gives
    the same table and the same snapshot. Rows whose date cannot be read are kept in
    ``raw_undated``, and ``raw_rejects`` tells what could not be read, by column and reason.
    """
    files = export_files(file_inventory(lake.spark, landing)).where(F.col("path").endswith(DROPPED_SUFFIX))
    marketplace = F.lower(F.replace("ecommerce", F.lit(" "))).alias("marketplace")
    newest = newest_files(files.select("brand", marketplace, "path", "modified"))
    fresh, stale = fresh_and_stale(newest, as_of)
    day = f"day={as_of:%Y-%m-%d}"
    stale.write.mode("overwrite").parquet(lake.path(f"raw_stale/{day}"))
    # One path per brand and marketplace.
    paths: dict[str, list[str]] = {}
    for r in fresh.where(F.col("marketplace").isin(*columns)).collect():
        paths.setdefault(r.marketplace, []).append(r.path)
    for name, found in sorted(paths.items()):
        drop = read_dropped(lake.spark, name, found, columns[name], file="file")
        drop = drop.withColumn("brand", F.url_decode(F.element_at(F.split("file", "/"), -4))).drop("file")
        snapshot = write_snapshot(checked(drop, name), name, as_of, lake.path(f"raw_snapshot/marketplace={name}/{day}"))
        write_drop(open_rows(snapshot, as_of).drop("errors"), lake.path(f"exports/{name}"))
        # What has no date has no month: it stands in the snapshot's folder of rows without one.
        undated = snapshot.where("drop_date is null").drop("drop_date", "year", "month", "errors")
        undated.withColumn("reasons", F.array(F.lit(EXPORT_DATE_COLUMNS[name][0]))).write.mode("overwrite").parquet(lake.path(f"raw_undated/{name}/{day}"))
        reject_report(snapshot, name).write.mode("overwrite").parquet(lake.path(f"raw_rejects/{name}/{day}"))
    return sorted(paths)


def run_online_staging(lake: Lake, months: Sequence[dt.date]) -> None:
    """Lines of all marketplaces in the staging layout, for the given months."""
    around = sorted({n for m in months for n in (previous_month(m), m, next_month(m))})
    exports = {m: lake.read_months(f"exports/{m}", around) for m in LAYOUTS}
    lines = normalise_all(exports, staging_matcher(lake.read("products")), "staging")
    write_months(lines.where(any_month("date", months)), lake.path("online_staging"), "date", by=["marketplace"], months=months)


def run_online_daily(lake: Lake, as_of: dt.date) -> bool:
    """Daily, item and status reports of the open months, delivered only if their totals agree.

    The reports are written first and compared as written. Returns whether they were delivered.
    """
    months = rebuild_months(as_of, ONLINE_LATE_UNTIL)
    pattern = lake.read("pattern").where(any_month("pattern_date", months))
    open_lines = lake.read_months("online_detail", months).where(any_month("date", months))
    lines = daily_lines(open_lines, reference_date(as_of))
    last_year = lake.read_months("online_detail", calendar_months(pattern))
    targets = online_targets(lake.read("online_targets")).groupBy("brand", "marketplace", "date").agg(
        F.sum("target").alias("target"),
        F.max("target_monthly").alias("target_monthly"),
        F.max("target_project").alias("target_project"),
    )
    folder = f"online_daily/day={as_of:%Y-%m-%d}"
    reports = {
        "daily": online_daily_report(lines, last_year, pattern, targets),
        "item": sales_by_item(lines),
        "status": sales_by_status(lines),
    }
    write_bundle(reports, lake.path(folder))
    checks = daily_totals_agree(lake.read(f"{folder}/daily"), lake.read(f"{folder}/item"))
    write_bundle({"checks": checks}, lake.path(folder))
    agreed = bool(lake.read(f"{folder}/checks").first().is_matched)
    if agreed:
        for name in reports:
            write_split(lake.read(f"{folder}/{name}").withColumn("file", F.col("brand")), lake.path(f"online_delivery/{name}/day={as_of:%Y-%m-%d}"), ["file"], whole=True)
    return agreed


def run_settlement(lake: Lake, month: dt.date) -> None:
    """The settlement template of a month, numbered per brand, marketplace and status.

    A line settles on its delivery, which may be long after its order, so all lines are read.
    """
    lines = lake.read("online_detail").drop("year", "month")
    numbered = numbered_settlement(settlement_template(lines, month))
    files = with_month(numbered, "transaction_order_date").withColumns(
        {f"file_{c}": F.col(c) for c in ("brand", "marketplace", "transaction_status")}
    )
    write_split(files, lake.path("settlement"), ["file_brand", "file_marketplace", "file_transaction_status"], months=[month])


def run_delivery(lake: Lake, as_of: dt.date) -> None:
    """The delivery extract of the open months, one file set per company and marketplace."""
    months = rebuild_months(as_of, ONLINE_LATE_UNTIL)
    lines = lake.read_months("online_detail", months).where(any_month("date", months))
    extract = with_month(delivery_extract(lines, lake.read("stores")), "date")
    files = extract.withColumn("file", F.col("marketplace"))
    write_split(files, lake.path("delivery"), ["delivery", "file"], months=months)
