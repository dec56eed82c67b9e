"""Staff and manager incentives from sales, growth, targets and attendance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio, safe_ratio
from ..functions.text import part_of
from ..functions.values import differs, first_match, is_in, not_in, sum0
from .aggregating import group_sum, split_sums
from .joining import attach_totals, keep_facts

# Rules of the scheme.
GROWTH_NEEDED = 0.10
DAYS_NEEDED = 25
SAME_STORE = "SSSG"
EXCLUDED_POSITIONS = ("City Coordinator", "SA-Bazaar", "City Head")
SALES_POSITIONS = ("Sales Assistant", "Sa-Bazaar (Reguler)")
SECOND_COMPANY_MARKS = (" SZ ", " LV ", " PM ")
DEFAULT_MANAGER = "Area Manager"

# Pay for achievement over 1.20, from 1, from 0.95.
STEPS = (1.20, 1.0, 0.95)
SALES_HIGH = (600_000, 400_000, 250_000)  # productivity over 80 million
SALES_MIDDLE = (450_000, 300_000, 200_000)  # productivity from 40 million
SALES_LOW = (300_000, 200_000, 150_000)  # any productivity
STORE_HEAD = (750_000, 500_000, 350_000)
SENIOR_MANAGER = (8_000_000, 5_000_000, 3_000_000)
JUNIOR_MANAGER = (5_000_000, 3_000_000, 2_000_000)
CITY_HEAD = (2_500_000, 1_500_000, 1_000_000)
HIGH_PRODUCTIVITY = 80_000_000
MIDDLE_PRODUCTIVITY = 40_000_000


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Yes")).otherwise(F.lit("No"))


def growth(this_year: Column, last_year: Column) -> Column:
    return safe_ratio(this_year - last_year, last_year)


def growth_met(value: Column, sssg: Column | None = None) -> Column:
    """At least 10 % growth; a store outside the same-store set need not grow."""
    met = value >= GROWTH_NEEDED
    return yes_no(met if sssg is None else met | differs(sssg, SAME_STORE))


def _by_achievement(achievement: Column, pay: Sequence[int], also: Column | None = None):
    over, full, near = STEPS
    tests = [achievement > over, achievement >= full, achievement >= near]
    return [(t if also is None else also & t, F.lit(p)) for t, p in zip(tests, pay)]


def ladder(achievement: Column, pay: Sequence[int]) -> Column:
    return first_match(_by_achievement(achievement, pay), F.lit(0))


def sales_ladder(productivity: Column, achievement: Column) -> Column:
    return first_match(
        [
            *_by_achievement(achievement, SALES_HIGH, productivity > HIGH_PRODUCTIVITY),
            *_by_achievement(achievement, SALES_MIDDLE, productivity >= MIDDLE_PRODUCTIVITY),
            *_by_achievement(achievement, SALES_LOW, productivity > 0),
        ],
        F.lit(0),
    )


def store_month_sales(daily: DataFrame, last_year: DataFrame) -> DataFrame:
    """Sales, target and last year's sales per store and month; online stores take no part."""
    keys = ["dataareaid", "axcode", "month"]
    this = group_sum(
        daily.where(differs("channel", "ONLINE")),
        keys,
        sales_this_year=sum0("cust_paid_peritem"),
        target=sum0("target_daily"),
    )
    before = group_sum(last_year, keys, sales_last_year=sum0("cust_paid_peritem_last_year"))
    return keep_facts(this, before, keys)


def store_performance(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Growth, achievement and growth requirement of each store and month."""
    columns = ["dataareaid", "axcode", "cscode", "stdname", "sssg", "area_head", "city_head"]
    joined = keep_facts(sales, stores.select(*columns), ["dataareaid", "axcode"])
    this, before = F.col("sales_this_year"), F.col("sales_last_year")
    scored = joined.withColumns(
        {"growth": growth(this, before), "achievement": safe_ratio(this, F.col("target"))}
    )
    return scored.withColumn("growthreq", growth_met(F.col("growth"), F.col("sssg")))


def company_of_branch(branch: Column) -> Column:
    marked = F.lit(False)
    for mark in SECOND_COMPANY_MARKS:
        marked = marked | F.coalesce(branch.contains(mark), F.lit(False))
    return F.when(marked, F.lit("mgl")).otherwise(F.lit("mpr"))


def attendance_eligibility(attendance: DataFrame) -> DataFrame:
    """Staff in scope with company, head-count of their branch and the attendance rule.

    The head-count is taken on the full branch code; the store code is its part before a dash.
    """
    staff = attendance.withColumn("dataareaid", company_of_branch(F.col("branch"))).where(
        not_in("job_position", EXCLUDED_POSITIONS)
    )
    counted = attach_totals(
        staff, ["dataareaid", "branch_code"], {"jumlah_karyawan": F.count("employee_id")}
    )
    return counted.withColumns(
        {
            "absenreq": yes_no(F.col("hari_kerja") >= DAYS_NEEDED),
            "axcode": part_of("branch_code", "-", 0),
        }
    ).drop("branch_code")


def staff_incentive(eligible: DataFrame, performance: DataFrame) -> DataFrame:
    """Incentive of each employee; paid where attendance and store growth allow it."""
    columns = [
        "dataareaid", "axcode", "stdname", "sales_last_year", "sales_this_year", "growth",
        "growthreq", "target", "achievement",
    ]
    joined = keep_facts(eligible, performance.select(*columns), ["dataareaid", "axcode"])
    selling = is_in("job_position", SALES_POSITIONS)
    allowed = (F.col("absenreq") == "Yes") & (F.col("growthreq") == "Yes")
    paid = joined.withColumn(
        "productivity", ratio("sales_this_year", "jumlah_karyawan")
    ).withColumn("isincentive", yes_no(allowed))
    calculated = F.when(
        selling, sales_ladder(F.col("productivity"), F.col("achievement"))
    ).otherwise(ladder(F.col("achievement"), STORE_HEAD))
    return paid.withColumn("calculated_incentive", calculated).withColumn(
        "final_incentive",
        F.when(F.col("isincentive") == "Yes", F.col("calculated_incentive")).otherwise(0),
    )


def with_manager_position(performance: DataFrame, managers: DataFrame) -> DataFrame:
    """Position of each store's area head; an unlisted one counts as area manager."""
    positions = managers.select(F.col("full_name").alias("area_head"), "job_position")
    joined = keep_facts(performance, positions, ["area_head"])
    return joined.fillna({"job_position": DEFAULT_MANAGER})


def manager_incentive(
    performance: DataFrame, head: str, pay: Sequence[int], position: str | None = None
) -> DataFrame:
    """Incentive per manager and month: achievement over all stores, growth over same stores.

    One pass computes both sums.
    """
    if position is not None:
        performance = performance.where(F.col("job_position") == position)
    sums = split_sums(
        performance,
        [head, "month"],
        ["target", "sales_last_year", "sales_this_year"],
        F.col("sssg") == SAME_STORE,
        "_sssg",
    ).drop("target_sssg")
    scored = sums.withColumns(
        {
            "growth": growth(F.col("sales_this_year_sssg"), F.col("sales_last_year_sssg")),
            "achievement": safe_ratio("sales_this_year", "target"),
        }
    ).withColumn("growthreq", growth_met(F.col("growth")))
    return scored.withColumn("incentive", ladder(F.col("achievement"), pay)).withColumn(
        "final_incentive", F.when(F.col("growthreq") == "Yes", F.col("incentive")).otherwise(0)
    )
