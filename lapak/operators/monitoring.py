"""Upload monitoring and newest-file selection over a file inventory."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import local_time
from ..functions.text import delete, keep_alphanumeric, part_of, title_case
from .dedup import latest_per_key, with_duplicate_flag

# Fixed values.
DEADLINE = "10:00"
EXPORT_SUFFIXES = (".csv", ".xlsx")


def export_files(inventory: DataFrame) -> DataFrame:
    """Inventory rows of export files, with the parts of their path.

    Path layout: ``<area>/raw/<brand>/<year>/<month name>/<marketplace>_<month>_<brand>.<ext>``.
    """
    suffix = F.lit(False)
    for ending in EXPORT_SUFFIXES:
        suffix = suffix | F.col("path").endswith(ending)
    parts = F.split("path", "/")
    name = F.try_element_at(parts, F.lit(-1))
    raw = part_of(name, "_", 0)
    return inventory.where(suffix).select(
        "path",
        "modified",
        F.try_element_at(parts, F.lit(-4)).alias("brand"),
        F.try_element_at(parts, F.lit(-3)).alias("year"),
        F.try_element_at(parts, F.lit(-2)).alias("month"),
        title_case(delete(keep_alphanumeric(raw, r"\s\-"), "-")).alias("ecommerce"),
        name.alias("files"),
    )


def upload_monitor(inventory: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Files of the month under report: up to date, late, duplicated.

    ``as_of`` is local time. On the first day the month under report is the previous one.
    """
    shown = as_of.date() if as_of.day > 1 else as_of.date() - dt.timedelta(days=1)
    files = export_files(inventory).where(
        (F.col("year") == f"{shown:%Y}") & (F.col("month") == f"{shown:%B}")
    )
    uploaded = F.date_trunc("minute", local_time("modified"))
    today = F.lit(as_of.date())
    timed = files.withColumns(
        {
            "last_upload": F.date_format(uploaded, "yyyy-MM-dd HH:mm"),
            "last_upload_date": F.to_date(uploaded),
            "last_upload_time": F.date_format(uploaded, "HH:mm"),
        }
    )
    in_time = (F.col("last_upload_date") == today) & (F.col("last_upload_time") <= DEADLINE)
    checked = timed.withColumns(
        {
            "check_upload": F.when(
                F.col("last_upload_date") < today, F.lit("Not Up To Date")
            ).otherwise(F.lit("Up To Date")),
            "is_late": F.when(in_time, F.lit("Ontime")).otherwise(F.lit("Late")),
        }
    )
    return with_duplicate_flag(checked, ["month", "brand", "ecommerce"])


def newest_files(inventory: DataFrame) -> DataFrame:
    """Newest file per brand and marketplace, in local time."""
    shifted = inventory.withColumn("modified", local_time("modified"))
    return latest_per_key(shifted, ["brand", "marketplace"], ["modified", "path"])


def fresh_and_stale(newest: DataFrame, day: dt.date) -> tuple[DataFrame, DataFrame]:
    """Files dropped on ``day``, and sources whose newest file is older."""
    fresh = F.to_date("modified") == F.lit(day)
    return newest.where(fresh), newest.where(~fresh)
