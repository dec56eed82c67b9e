"""Grouped aggregates and window-like operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapak.functions.columns import snake
from lapak.operators.accumulating import unified_sales, valid_sales, year_to_date
from lapak.operators.aggregating import (
    control_total,
    group_sum,
    header_totals,
    melt,
    pivot_sum,
    processing_log,
    split_sums,
)
from lapak.operators.dedup import (
    derepeat,
    first_per_key,
    latest_per_key,
    latest_two_stage,
    number_rows,
    with_duplicate_flag,
)
from lapak.operators.joining import attach_totals, keep_facts
from lapak.operators.payments import METHODS, share_of_order

from .registry import query, r

ALL_METHODS = (*METHODS, "Cash")
VALID = """istransaction IS DISTINCT FROM '0' AND issettled IS DISTINCT FROM FALSE
  AND status_order IS DISTINCT FROM 7 AND channel IS DISTINCT FROM 'ONLINE'"""


def case_sum(condition: str, value: str) -> str:
    return f"sum(CASE WHEN {condition} THEN {value} ELSE 0 END)"


@query(
    "SELECT order_id, transaction_id, "
    + ", ".join(f"{r(case_sum(f'payment_method_name = {m!r}', 'payment_total'))} AS {snake(m)}" for m in ALL_METHODS)
    + " FROM pos_payments GROUP BY 1, 2",
    "pos_payments",
)
def payment_pivot(s):
    """Payment methods as columns."""
    return pivot_sum(
        s.pos_payments, ["order_id", "transaction_id"], "payment_method_name", "payment_total", ALL_METHODS
    )


@query(
    f"""SELECT axcode, stdname, kind, {r('amount')} AS amount FROM (
      SELECT axcode, stdname, sqm AS floor_space, target AS month_target FROM stores)
    UNPIVOT (amount FOR kind IN (floor_space, month_target))""",
    "stores",
)
def target_unpivot(s):
    """Wide columns to rows."""
    wide = s.stores.select(
        "axcode", "stdname", F.col("sqm").alias("floor_space"), F.col("target").alias("month_target")
    )
    return melt(wide, ["axcode", "stdname"], "kind", "amount")


@query(
    f"""SELECT channel, order_create_date, count(DISTINCT ordernumber) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity,
      {r('sum(cust_paid_peritem)')} AS cust_paid_peritem, {r('CAST(sum(cust_paid_peritem) AS DOUBLE) / count(*)')} AS mean_paid,
      max(promocode) AS last_promo, count(*) AS line_count
    FROM sales_lines GROUP BY 1, 2""",
    "sales_lines",
)
def mixed_aggregates(s):
    """Sum, mean, maximum, distinct count and row count in one pass."""
    return group_sum(
        s.sales_lines,
        ["channel", "order_create_date"],
        "quantity",
        "cust_paid_peritem",
        orders=F.count_distinct("ordernumber"),
        mean_paid=F.sum("cust_paid_peritem").cast("double") / F.count(F.lit(1)),
        last_promo=F.max("promocode"),
        line_count=F.count(F.lit(1)),
    )


LATEST = "SELECT user_id, event_id, event_type, round(value, 4) AS value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {0}) AS n FROM events) WHERE n = 1"


@query(LATEST.format("ts DESC, event_id DESC"))
def latest_per_user(s):
    """Last event per user."""
    return latest_per_key(s.events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(LATEST.format("ts, event_id"))
def first_per_user(s):
    """First event per user."""
    return first_per_key(s.events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    """SELECT codebars, variantnumber, recid FROM (
      SELECT *, row_number() OVER (PARTITION BY codebars ORDER BY pulldate DESC, recid DESC) AS m FROM (
        SELECT *, row_number() OVER (PARTITION BY variantnumber ORDER BY pulldate DESC, recid DESC) AS n
        FROM products WHERE dataareaid = 'mpr') WHERE n = 1) WHERE m = 1""",
    "products",
)
def two_stage_dedup(s):
    """Latest row per variant, then per barcode."""
    own = s.products.where("dataareaid = 'mpr'").select("codebars", "variantnumber", "pulldate", "recid")
    return latest_two_stage(own, "variantnumber", "codebars", ["pulldate", "recid"]).drop("pulldate")


STORE_DAY = f"""sd AS (SELECT l.dataareaid, l.axcode, order_create_date, CAST(sum(quantity) AS BIGINT) AS quantity, s.target
  FROM sales_lines l JOIN stores s ON l.axcode = s.axcode AND l.dataareaid = s.dataareaid GROUP BY 1, 2, 3, 5)"""


@query(
    STORE_DAY
    + """ SELECT dataareaid, axcode, order_create_date, quantity,
      CASE WHEN row_number() OVER (PARTITION BY dataareaid, axcode, target ORDER BY order_create_date) = 1
        THEN round(target, 4) ELSE 0.0::DOUBLE END AS target FROM sd""",
    "sales_lines stores",
)
def derepeat_target(s):
    """A store target kept on the store's first day only."""
    days = group_sum(s.sales_lines, ["dataareaid", "axcode", "order_create_date"], "quantity")
    stores = s.stores.select("dataareaid", "axcode", "target")
    joined = keep_facts(days, stores, ["dataareaid", "axcode"])
    return derepeat(joined, {"target": ["dataareaid", "axcode"]}, ["dataareaid", "axcode", "order_create_date"])


@query(
    "SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS headcount FROM orders"
)
def headcount(s):
    """Group size on every row."""
    return attach_totals(
        s.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], {"headcount": F.count("o_orderkey")}
    )


@query(
    f"""SELECT order_number, product_barcode, order_product_quantity,
      {r('''CASE WHEN order_product_quantity > 0 THEN greatest(CAST(order_product_total AS DOUBLE) /
        NULLIF(CAST(sum(CASE WHEN order_product_quantity > 0 THEN order_product_total END) OVER (PARTITION BY order_id) AS DOUBLE), 0), 0)
        ELSE 0 END''')} AS share FROM pos_orders""",
    "pos_orders",
)
def share_of_order_total(s):
    """Each line's share of its order's bought value."""
    lines = s.pos_orders.select(
        "order_id", "order_number", "product_barcode", "order_product_quantity", "order_product_total"
    )
    bought = F.when(F.col("order_product_quantity") > 0, F.col("order_product_total"))
    lines = attach_totals(lines, ["order_id"], {"bought": F.sum(bought)})
    share = share_of_order(F.col("order_product_quantity"), F.col("order_product_total"), F.col("bought"))
    return lines.withColumn("share", share).drop("order_id", "order_product_total", "bought")


@query(
    f"""SELECT so_dept_head, {r('sum(cust_paid_peritem)')} AS cust_paid_peritem, CAST(sum(quantity) AS BIGINT) AS quantity,
      {r(case_sum("sssg = 'SSSG'", 'cust_paid_peritem'))} AS cust_paid_peritem_sssg,
      CAST({case_sum("sssg = 'SSSG'", 'quantity')} AS BIGINT) AS quantity_sssg
    FROM sales_lines l JOIN stores s ON l.axcode = s.axcode AND l.dataareaid = s.dataareaid GROUP BY 1""",
    "sales_lines stores",
)
def filtered_vs_all_sum(s):
    """Sums over all stores and over same stores, side by side."""
    stores = s.stores.select("dataareaid", "axcode", "so_dept_head", "sssg")
    joined = keep_facts(s.sales_lines, stores, ["dataareaid", "axcode"])
    return split_sums(
        joined, ["so_dept_head"], ["cust_paid_peritem", "quantity"], F.col("sssg") == "SSSG", "_sssg"
    )


@query(
    f"""SELECT "Name" AS name, "Created at" AS created, "Fulfilled at" AS fulfilled, {r('sum(CAST("Discount Amount" AS DECIMAL(18,2)))')} AS discount
    FROM raw_shopify WHERE "Name" IS NOT NULL AND "Created at" IS NOT NULL AND "Fulfilled at" IS NOT NULL GROUP BY 1, 2, 3""",
    "raw_shopify",
)
def header_group(s):
    """One row per order header; continuation lines and unfulfilled orders are left out."""
    rows = s.raw_shopify.select(
        F.col("Name").alias("name"),
        F.col("`Created at`").alias("created"),
        F.col("`Fulfilled at`").alias("fulfilled"),
        F.col("`Discount Amount`").cast("decimal(18,2)").alias("discount"),
    )
    return header_totals(rows, ["name", "created", "fulfilled"], "discount")


@query(
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) OVER w AS total_files,
      CASE WHEN count(*) OVER w > 1 THEN 'Duplicated' ELSE 'Not Duplicated' END AS is_duplicated
    FROM orders WINDOW w AS (PARTITION BY o_custkey, CAST(o_orderdate AS DATE))"""
)
def duplicate_flag(s):
    """Rows whose key occurs more than once."""
    days = s.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return with_duplicate_flag(days, ["o_custkey", "day"])


@query(
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS no,
    CAST(o_orderdate AS DATE) AS day FROM orders"""
)
def numbered_lines(s):
    """Consecutive numbers within each status, in date order."""
    rows = s.orders.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    return number_rows(rows, ["day", "o_orderkey"], ["o_orderstatus"])


MONTHS = f"""m AS (SELECT dataareaid, axcode, year(order_create_date) AS year, month(order_create_date) AS month,
  CAST(sum(quantity) AS BIGINT) AS quantity, sum(cust_paid_peritem) AS cust_paid_peritem
  FROM sales_lines WHERE {VALID} GROUP BY 1, 2, 3, 4)"""


def month_sales(s):
    dated = valid_sales(s.sales_lines).withColumns(
        {
            "year": F.year("order_create_date").cast("bigint"),
            "month": F.month("order_create_date").cast("bigint"),
        }
    )
    return group_sum(dated, ["dataareaid", "axcode", "year", "month"], "quantity", "cust_paid_peritem")


@query(
    MONTHS + f" SELECT dataareaid, axcode, year, month, quantity, {r('cust_paid_peritem')} AS cust_paid_peritem FROM m",
    "sales_lines",
)
def mtd_sales(s):
    """Month totals per store."""
    return month_sales(s)


@query(
    MONTHS
    + f""" SELECT dataareaid, axcode, year, month, quantity, {r('cust_paid_peritem')} AS cust_paid_peritem,
      CAST(sum(quantity) OVER w AS BIGINT) AS quantity_ytd, {r('sum(cust_paid_peritem) OVER w')} AS cust_paid_peritem_ytd
    FROM m WINDOW w AS (PARTITION BY dataareaid, axcode, year ORDER BY month ROWS UNBOUNDED PRECEDING)""",
    "sales_lines",
)
def ytd_sales(s):
    """Running year totals per store."""
    return year_to_date(month_sales(s), ["dataareaid", "axcode"])


@query(
    """SELECT 'offline' AS check_name, a AS amount_before, a AS amount_after, TRUE AS is_matched FROM (
      SELECT CAST(round_even(sum(cust_paid_peritem), 2) AS DOUBLE) AS a FROM sales_lines WHERE """
    + VALID
    + ")",
    "sales_lines",
)
def control_totals(s):
    """Totals before and after grouping agree."""
    kept = valid_sales(s.sales_lines)
    return control_total(kept, "cust_paid_peritem", unified_sales(kept), "cust_paid_peritem", "offline")


@query(
    f"""t AS (SELECT CAST(round_even(sum(cust_paid_peritem), 2) AS DOUBLE) AS a, CAST(round_even(sum(cust_paid_peritem) FILTER (WHERE promocode <> 'regular'), 2) AS DOUBLE) AS b
      FROM sales_lines WHERE {VALID})
    SELECT 'promoted only' AS check_name, a AS amount_before, b AS amount_after, a = b AS is_matched FROM t""",
    "sales_lines",
)
def control_totals_mismatch(s):
    """A step that loses lines shows in its control total."""
    kept = valid_sales(s.sales_lines)
    return control_total(kept, "cust_paid_peritem", unified_sales(kept.where("promocode <> 'regular'")), "cust_paid_peritem", "promoted only")


@query(
    f"""SELECT channel, count(*) AS "row", CAST(sum(quantity) AS BIGINT) AS quantity, {r('sum(cust_paid_peritem)')} AS cust_paid_peritem,
      '2024-07-02' AS date_process, '03:04:05' AS time_process FROM sales_lines GROUP BY 1""",
    "sales_lines",
    name="processing_log",
)
def _processing_log(s):
    """Rows, quantity and paid value by channel with a stamp."""
    return processing_log(s.sales_lines, F.lit("2024-07-02 03:04:05").cast("timestamp"))


@query(
    f"""SELECT dataareaid, axcode, order_create_date,
      CASE WHEN codebars IN ('undetected', 'Undetected') AND productdata_barcode IS NOT NULL THEN productdata_barcode ELSE codebars END AS codebars,
      count(DISTINCT ordernumber) AS ordernumber, CAST(sum(quantity) AS BIGINT) AS quantity,
      {r('round_even(sum(cust_paid_peritem), 2)')} AS cust_paid_peritem, {r('round_even(sum(hpp_total), 2)')} AS hpp_total
    FROM sales_lines WHERE {VALID} GROUP BY 1, 2, 3, 4""",
    "sales_lines",
)
def unified_sales_daily(s):
    """Offline sales per company, store, date and barcode."""
    return unified_sales(valid_sales(s.sales_lines))
