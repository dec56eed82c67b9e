"""Unified sales and the accumulation report against last month and last year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rename_all, report_title
from ..functions.numbers import ratio
from ..functions.text import part_of
from ..functions.values import all_present, differs, is_in, sum0, zero_if_null
from .aggregating import group_sum, running_total, two_sided
from .calendar import calendar_pattern, date_dimension, shift_dates
from .joining import full_outer, keep_facts, present_in

# Fixed values.
WEBSITE_NAMES = ("MANZONESTORE.ID", "MINIMALSTORE.ID", "MOCSTORE.ID", "MATAHARISTORE.COM", "WEBSITE")
UNDETECTED = ("undetected", "Undetected")
VOID_STATUS = 7

MEASURES = ("ordernumber", "quantity", "cust_paid_peritem", "hpp_total")
EXACT_MEASURES = ("cust_paid_peritem", "hpp_total")
PERIODS = ("", "_lm", "_ly")
PERIOD_DATES = {"": "pattern_date", "_lm": "pattern_lm", "_ly": "pattern_last_year"}
# Column names that readers expect.
PRODUCT_COLUMNS = (
    "dataareaid", "codebars", "itemid", "umbrellabrand", "subbrand", "world", "category", "subcategory",
)
DAY_GRAIN = (
    "dataareaid", "axcode", "order_create_date", "day", "day_name", "day_score", "week", "month",
    "month_score", "itemid", "umbrellabrand", "subbrand", "world", "category", "subcategory",
)
# Identifies an accumulated row of a store; the other grain columns follow from the date.
ROW_ORDER = (
    "order_create_date", "itemid", "umbrellabrand", "subbrand", "world", "category", "subcategory",
)
STORE_COLUMNS = (
    "dataareaid", "brand", "channel", "deptstore", "groupstore", "cscode", "axcode", "whcode",
    "stdname", "sqm", "sssg", "openstatus", "so_dept_head", "area_head", "city_head",
)
PROMO_STORE_COLUMNS = (
    "dataareaid", "channel", "brand", "groupstore", "axcode", "stdname", "sqm", "sssg",
    "so_dept_head", "area_head", "city_head",
)
#: The rows' own grain; the rest of ``DAY_GRAIN`` follows from the date.
STORE_ROW = ("dataareaid", "axcode", *ROW_ORDER)
REPORT_COLUMNS = (
    *STORE_COLUMNS, "target", "target_daily", *(c for c in DAY_GRAIN if c not in ("dataareaid", "axcode")),
    *(m + s for s in PERIODS for m in MEASURES),
)
REPORT_WORDS = {
    "ordernumber": "orders", "cust_paid_peritem": "sales", "_ly": "_last_year", "_lm": "_last_month",
}


def valid_sales(lines: DataFrame) -> DataFrame:
    """Offline lines that were paid, settled and not void; unknown values are kept."""
    return lines.where(
        differs("istransaction", "0")
        & differs("issettled", False)
        & differs("status_order", VOID_STATUS)
        & differs("channel", "ONLINE")
    )


def website_to_shopify(marketplace: Column) -> Column:
    return F.when(is_in(marketplace, WEBSITE_NAMES), F.lit("SHOPIFY")).otherwise(marketplace)


def online_stores(stores: DataFrame) -> DataFrame:
    """Online stores with brand and marketplace read from a ``<word> <brand> <marketplace>`` name."""
    online = stores.withColumn("channel", F.upper("channel")).where("channel = 'ONLINE'")
    marketplace = website_to_shopify(F.coalesce(part_of("stdname", " ", 2), F.lit("")))
    return online.withColumns(
        {"brand": part_of("stdname", " ", 1), "marketplace": marketplace}
    )


def online_as_sales(lines: DataFrame, stores: DataFrame) -> DataFrame:
    """Online lines that were not cancelled, in the shape of offline sales.

    Brand and marketplace name one store; should the master name several, the smallest code
    is used, so no line is counted twice.
    """
    store = (
        online_stores(stores)
        .groupBy("brand", "marketplace")
        .agg(F.min(F.struct("axcode", "dataareaid")).alias("s"))
        .select("brand", "marketplace", "s.dataareaid", "s.axcode")
    )
    sold = lines.where(differs("sales_status", "CANCELED")).select(
        "brand",
        "marketplace",
        F.col("date").alias("order_create_date"),
        F.col("order_no").alias("ordernumber"),
        "codebars",
        F.col("qty_sold").alias("quantity"),
        F.col("value_after_voucher").alias("cust_paid_peritem"),
        F.col("existing_hpp").alias("hpp_total"),
    )
    return keep_facts(sold, store, ["brand", "marketplace"]).drop("brand", "marketplace")


SALES_GRAIN = ("dataareaid", "axcode", "order_create_date", "codebars")


def unified_lines(offline: DataFrame, online: DataFrame | None = None) -> DataFrame:
    """Lines of both channels that have the whole grain.

    A barcode the master does not know falls back to the scanned one.
    """
    sales = offline
    if online is not None:
        sales = offline.unionByName(online, allowMissingColumns=True)
    scanned = F.col("productdata_barcode")
    codebars = F.when(
        is_in("codebars", UNDETECTED) & scanned.isNotNull(), scanned
    ).otherwise(F.col("codebars"))
    return (
        sales.withColumn("codebars", codebars)
        .select(*SALES_GRAIN, "ordernumber", "quantity", *EXACT_MEASURES)
        .where(all_present(SALES_GRAIN))
    )


def unified_sales(offline: DataFrame, online: DataFrame | None = None) -> DataFrame:
    """Sales per company, store, date and barcode over both channels.

    Orders are distinct within the grain; adding them up over barcodes counts a mixed order
    more than once.
    """
    return sum_lines(unified_lines(offline, online))


def sum_lines(lines: DataFrame) -> DataFrame:
    """Unified lines at their grain. Money is summed as decimals, so the order of rows and
    partial sums does not show in the result."""

    def exact(name: str) -> Column:
        is_exact = isinstance(lines.schema[name].dataType, T.DecimalType)
        return F.col(name) if is_exact else F.col(name).cast("decimal(28,6)")

    sums = {m: F.bround(sum0(exact(m)), 2) for m in EXACT_MEASURES}
    return group_sum(
        lines, SALES_GRAIN, "quantity", ordernumber=F.count_distinct("ordernumber"), **sums
    )


def compare_periods(
    this_month: DataFrame, last_month: DataFrame, last_year: DataFrame, pattern: DataFrame
) -> DataFrame:
    """Sales of a date beside those of its counterparts, per company, store and barcode.

    All three inputs are already at that grain. Calendar rows without a sale this month take
    no part, nor do sales on dates the calendar does not know.
    """
    keys = ["dataareaid", "axcode", "id", "codebars"]
    rows = calendar_pattern(pattern)
    sold_dates = this_month.select("order_create_date").distinct()
    used = present_in(rows, sold_dates, {"pattern_date": "order_create_date"}, bounded=True)
    frames = []
    for sales, column, suffix in zip(
        (this_month, last_month, last_year),
        ("pattern_date", "pattern_lm", "pattern_last_year"),
        PERIODS,
    ):
        shifted = shift_dates(sales, used, "order_create_date", column)
        frames.append(shifted.select(*keys, *[F.col(m).alias(m + suffix) for m in MEASURES]))
    wide = reduce(lambda a, b: full_outer(a, b, keys), frames)
    return wide.withColumns(
        {m + s: zero_if_null(m + s).alias(m + s) for m in MEASURES for s in PERIODS}
    )


def _in_roles(sold: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each sale once per role its date plays: this month, last month, last year.

    ``calendar`` holds the three dates of a row and whatever is to be attached.
    """
    roles = F.array(
        *[
            F.struct(F.lit(p).alias("role"), F.col(d).alias("__date"))
            for p, d in PERIOD_DATES.items()
        ]
    )
    kept = [c for c in calendar.columns if c not in PERIOD_DATES.values()]
    meant = calendar.select(*kept, F.col("pattern_date").alias("__day"), F.inline(roles))
    # Three rows per calendar date, so broadcast whatever the amount of sales.
    met = sold.join(F.broadcast(meant), F.col("order_create_date") == F.col("__date"), "inner")
    return met.withColumn("order_create_date", F.col("__day")).drop("__day", "__date")


def _role_sums() -> dict[str, Column]:
    return {m + p: sum0(F.when(F.col("role") == p, F.col(m))) for p in PERIODS for m in MEASURES}


def align_periods(sold: DataFrame, pattern: DataFrame, by: Sequence[str] = ("codebars",)) -> DataFrame:
    """Sales of a date beside those of its counterparts, in one pass over ``sold``.

    A sale is summed into the columns of each role its date plays. The result is that of
    outer-joining three separately prepared frames, without preparing or joining them.
    For totals of a coarser grain (``by`` empty: of a store's day) the sales are summed to it
    before they take their roles; sales without a barcode are left out all the same.
    """
    if "codebars" not in by:
        known = sold.where(F.col("codebars").isNotNull())
        sold = group_sum(known, ["dataareaid", "axcode", "order_create_date", *by], *MEASURES)
    met = _in_roles(sold, calendar_pattern(pattern))
    return group_sum(met, ["dataareaid", "axcode", "id", *by], **_role_sums())


def sales_accumulation(
    sold: DataFrame, pattern: DataFrame, used: DataFrame, stores: DataFrame, products: DataFrame
) -> DataFrame:
    """The accumulation report: store, day and category grain, three periods, targets.

    ``sold`` holds the unified sales of all dates ``pattern`` names, ``used`` the pattern rows
    whose own date has sales; the month weight counts all rows of ``pattern``. Sums are
    additive, so sales go straight to the category grain in one aggregation.
    """
    days = date_dimension(calendar_pattern(pattern)).drop("pattern_date")
    calendar = keep_facts(calendar_pattern(used), days, ["id"], bounded=True).drop("id")
    dates = [c for c in calendar.columns if c not in PERIOD_DATES.values()]
    attributes = [c for c in PRODUCT_COLUMNS if c not in ("dataareaid", "codebars")]
    # Each sale meets its product before it takes its roles, so a third of the rows is shuffled for it.
    detailed = keep_facts(sold, products, ["dataareaid", "codebars"]).fillna("Undetected", attributes)
    roles = calendar.select(*PERIOD_DATES.values())
    # A store's sales of a product are put together before they take their roles too: the sums of a day then
    # need no other shuffle where the rows need not be put together by all keys.
    placed = detailed.repartition("dataareaid", "axcode", *attributes)
    grouped = group_sum(_in_roles(placed, roles), STORE_ROW, **_role_sums())
    # What follows from the date is attached to the sums; a date's calendar rows agree on it.
    dated = calendar.select(F.col("pattern_date").alias("order_create_date"), *dates).distinct()
    return _targets_on_first_rows(grouped, first_rows(detailed, roles), dated, stores)


def first_rows(detailed: DataFrame, calendar: DataFrame) -> DataFrame:
    """The first row of each store and day in ``ROW_ORDER``, and whether it is the first of the store.

    Found by minima, which tasks take before the shuffle: no row with its sums is moved, and no window
    holds a store or a day. The first row of a date is found before the date takes its roles.
    """
    within = [c for c in ROW_ORDER if c != "order_create_date"]
    store = ["dataareaid", "axcode"]
    date = [*store, "order_create_date"]
    least = detailed.where(all_present(STORE_ROW)).groupBy(*date).agg(F.min(F.struct(*within)).alias("__row"))
    day = _in_roles(least, calendar).where(all_present(date)).groupBy(*date).agg(F.min("__row").alias("__row"))
    begun = day.groupBy(*store).agg(F.min("order_create_date").alias("__begun"))
    led = keep_facts(day, begun, store, null_safe=False)
    return led.select(*store, "order_create_date", "__row.*", (F.col("order_create_date") == F.col("__begun")).alias("__of_store"))


def _targets_on_first_rows(grouped: DataFrame, firsts: DataFrame, dated: DataFrame, stores: DataFrame) -> DataFrame:
    """Store attributes on accumulated rows, the daily target on the first row of a store and day, the
    target on the first of a store, 0 on the others.

    The rows' keys are complete, so the first rows are joined where the sums were grouped.
    """
    copy = F.row_number().over(Window.partitionBy("dataareaid", "axcode").orderBy(*[c for c in (*STORE_COLUMNS, "target") if c not in ("dataareaid", "axcode")]))
    # A store that the master names twice has its targets once.
    named = stores.select(*STORE_COLUMNS, "target").withColumn("__copy", copy)
    marked = keep_facts(grouped, firsts, list(STORE_ROW), null_safe=False, flag="__of_day")
    joined = keep_facts(keep_facts(marked, dated, ["order_create_date"], bounded=True), named, ["dataareaid", "axcode"])
    once = F.coalesce(F.col("__copy"), F.lit(1)) == 1
    daily = ratio("target", "month_score") * F.col("day_score")
    zero = F.lit(0)
    report = joined.withColumns(
        {
            "target_daily": F.when(F.col("__of_day") & once, daily).otherwise(zero.cast("double")),
            "target": F.when(F.coalesce(F.col("__of_store"), F.lit(False)) & once, F.col("target")).otherwise(zero.cast(stores.schema["target"].dataType)),
        }
    )
    return report.select(*REPORT_COLUMNS)


def promo_sales(offline: DataFrame, stores: DataFrame) -> DataFrame:
    """Paid value per store, date, promotion and remark; anything but the regular price is a promo."""
    grouped = group_sum(
        offline,
        ["dataareaid", "axcode", "order_create_date", "promocode", "remarks"],
        "cust_paid_peritem",
    )
    is_promo = F.when(is_in("promocode", ("", "regular")), 0).otherwise(1)
    return keep_facts(
        grouped.withColumn("is_promo", is_promo),
        stores.select(*PROMO_STORE_COLUMNS),
        ["dataareaid", "axcode"],
    )


def promo_orders(offline: DataFrame, stores: DataFrame) -> DataFrame:
    """Distinct orders, quantity and paid value per store and its heads, date and promotion."""
    heads = stores.select("dataareaid", "axcode", "so_dept_head", "area_head", "city_head")
    return group_sum(
        keep_facts(offline, heads, ["dataareaid", "axcode"]),
        [
            "dataareaid", "axcode", "so_dept_head", "area_head", "city_head", "order_create_date",
            "promocode", "remarks",
        ],
        "quantity",
        "cust_paid_peritem",
        ordernumber=F.count_distinct("ordernumber"),
    )


def month_to_date(report: DataFrame) -> DataFrame:
    """Month totals of an accumulation report by store, brand and category."""
    return group_sum(
        report,
        ["dataareaid", "axcode", "month", "umbrellabrand", "subbrand", "category", "subcategory"],
        *[m + s for s in PERIODS for m in MEASURES],
        "target",
        "target_daily",
    )


def mtd_ytd_report(months: DataFrame, month: str, stores: DataFrame) -> DataFrame:
    """One month beside the year so far, per store, brand and category.

    ``months`` holds the month-to-date rows of the year up to and including ``month``.
    """
    keys = ["dataareaid", "axcode", "umbrellabrand", "subbrand", "category", "subcategory"]
    summed = [
        m + s
        for s in ("", "_ly")
        for m in ("ordernumber", "quantity", "cust_paid_peritem")
        if m + s in months.columns
    ] + [t for t in ("target", "target_daily") if t in months.columns]
    chosen = F.col("month") == month
    this = [m for m in months.columns if m not in [*keys, "month"]]
    grouped = group_sum(
        months.where(F.col("month") <= month),
        keys,
        **{m: sum0(F.when(chosen, F.col(m))) for m in this},
        **{f"{m}_ytd": sum0(m) for m in summed},
    ).withColumn("month", F.lit(month))
    return keep_facts(grouped, stores.select(*PROMO_STORE_COLUMNS), ["dataareaid", "axcode"])


def year_to_date(months: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running totals over the months of each year."""
    return running_total(
        months,
        [*keys, "year"],
        "month",
        {"quantity": "quantity_ytd", "cust_paid_peritem": "cust_paid_peritem_ytd"},
    )


def daily_store_report(report: DataFrame, stores: DataFrame) -> DataFrame:
    """Day totals of an accumulation report with store attributes."""
    grouped = group_sum(
        report, ["dataareaid", "axcode", "month", "week", "order_create_date"], *MEASURES
    )
    return keep_facts(grouped, stores.select(*PROMO_STORE_COLUMNS), ["dataareaid", "axcode"])


def per_day_comparison(wide: DataFrame, pattern: DataFrame, stores: DataFrame) -> DataFrame:
    """Day totals of all three periods with the counterpart dates and the daily target."""
    rows = calendar_pattern(pattern)
    days = date_dimension(rows).select("id", "pattern_date", "day_score", "month_score")
    days = keep_facts(
        days, rows.select("id", "pattern_lm", "pattern_last_year"), ["id"], bounded=True
    )
    dated = keep_facts(wide, days, ["id"], bounded=True)
    measures = [m + s for s in PERIODS for m in MEASURES if m != "hpp_total"]
    grouped = group_sum(
        dated.withColumnRenamed("pattern_date", "order_create_date"),
        ["dataareaid", "axcode", "order_create_date", "day_score", "month_score"],
        *measures,
        order_create_date_lm=F.max("pattern_lm"),
        order_create_date_ly=F.max("pattern_last_year"),
    )
    targeted = keep_facts(
        grouped, stores.select("dataareaid", "axcode", "target"), ["dataareaid", "axcode"]
    )
    return targeted.withColumn(
        "target_daily", ratio("target", "month_score") * F.col("day_score")
    )


def category_year_report(report: DataFrame, months: DataFrame) -> DataFrame:
    """Accumulated rows beside the store-category year, shown once per store and category.

    The year and the first date of a store and category are one short row, which meets the rows of that
    date: they are shuffled once, and a window holds a category's rows of one date only. A year that has
    no rows keeps its own.
    """
    keys = ["dataareaid", "axcode", "umbrellabrand", "subbrand", "category"]
    measures = ("cust_paid_peritem", "cust_paid_peritem_ly")
    dates = report.select(*keys, F.struct("order_create_date").alias("__begun"))
    paid = months.where(all_present(keys)).select(*keys, F.lit(True).alias("__paid"), *measures)
    year = two_sided(dates, paid).groupBy(*keys).agg(
        F.min("__begun").alias("__begun"), F.max("__paid").alias("__paid"), *[sum0(m).alias(f"{m}_ytd") for m in measures]
    )
    shown = [f"{m}_ytd" for m in measures]
    year = year.select(
        *keys, "__begun.order_create_date", F.lit(True).alias("__year"), F.col("__begun").isNull().alias("__alone"),
        *[F.when(F.col("__paid"), F.col(c)).alias(c) for c in shown],
    )
    rows = two_sided(report.withColumn("__year", F.lit(False)), year)
    within = [c for c in ROW_ORDER if c not in (*keys, "order_create_date")]
    window = Window.partitionBy(*keys, "order_create_date").orderBy("__year", *within)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.col("__year") | ((F.row_number().over(window) == 1) & F.max("__year").over(whole))
    rows = rows.withColumns({"__first": first, **{c: F.max(c).over(whole) for c in shown}})
    rows = rows.where(~F.col("__year") | F.col("__alone"))
    zero = {c: F.lit(0).cast(year.schema[c].dataType) for c in shown}
    once = [F.when(F.col("__first"), F.col(c)).otherwise(zero[c]).alias(c) for c in shown]
    return rows.select(*keys, *[c for c in report.columns if c not in keys], *once)


def titled(report: DataFrame) -> DataFrame:
    """Report headings in words."""
    return rename_all(report, lambda c: report_title(c, REPORT_WORDS))
