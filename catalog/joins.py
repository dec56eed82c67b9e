"""Join shapes over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapak.operators.accumulating import compare_periods, unified_sales, valid_sales
from lapak.operators.calendar import calendar_pattern, shift_dates
from lapak.operators.joining import (
    absent_from,
    attach_totals,
    full_outer,
    keep_facts,
    present_in,
    with_leading_zero_retry,
)
from lapak.operators.products import match_online_codes
from lapak.plans.pos_detail import staging_sync

from .registry import query, r


@query(
    f"""SELECT o.order_number, o.product_barcode, o.order_product_quantity, p.itemid, p.umbrellabrand,
      {r('p.hpp')} AS hpp
    FROM pos_orders o LEFT JOIN match_items p ON o.dataareaid = p.dataareaid AND o.product_barcode = p.codebars""",
    "pos_orders match_items",
)
def enrich_left(s):
    """Composite-key left join; the company's own products only."""
    dim = s.match_items.select("dataareaid", "codebars", "itemid", "umbrellabrand", "hpp")
    lines = s.pos_orders.select("dataareaid", "order_number", "product_barcode", "order_product_quantity")
    return keep_facts(lines, dim, {"dataareaid": "dataareaid", "product_barcode": "codebars"}).drop(
        "dataareaid"
    )


@query(
    """SELECT l.ordernumber, l.codebars, l.axcode, l.channel, s.stdname, s.region, s.channel AS channel_store
    FROM sales_lines l LEFT JOIN stores s ON l.axcode = s.axcode AND s.channel <> 'ONLINE'""",
    "sales_lines stores",
)
def facts_with_store(s):
    """Facts preserved against a filtered dimension; colliding names get a suffix."""
    dim = s.stores.where("channel <> 'ONLINE'").select("axcode", "stdname", "region", "channel")
    lines = s.sales_lines.select("ordernumber", "codebars", "axcode", "channel")
    return keep_facts(lines, dim, ["axcode"], suffix="_store")


@query(
    """SELECT o.order_number, o.product_barcode, CASE WHEN t.transaction_id IS NULL THEN '0' ELSE '1' END AS istransaction
    FROM pos_orders o LEFT JOIN (SELECT DISTINCT transaction_id, order_id FROM pos_payments) t
      ON o.transaction_id = t.transaction_id AND o.order_id = t.order_id""",
    "pos_orders pos_payments",
)
def match_indicator(s):
    """Whether a line's order was paid."""
    paid = s.pos_payments.select("transaction_id", "order_id").distinct()
    lines = s.pos_orders.select("order_number", "product_barcode", "transaction_id", "order_id")
    flagged = keep_facts(lines, paid, ["transaction_id", "order_id"], flag="paid")
    return flagged.select(
        "order_number",
        "product_barcode",
        F.when(F.col("paid"), F.lit("1")).otherwise(F.lit("0")).alias("istransaction"),
    )


@query(
    f"""SELECT b.ok, b.ln, b.sku, COALESCE(x.codebars, z.codebars) AS codebars,
      COALESCE(x.itemid, z.itemid) AS itemid, {r('COALESCE(x.hpp, z.hpp)')} AS hpp
    FROM online_base b
    LEFT JOIN match_items x ON x.dataareaid = 'mpr' AND x.codebars = b.sku
    LEFT JOIN match_items z ON z.dataareaid = 'mpr' AND x.codebars IS NULL AND z.codebars = '0' || b.sku""",
    "online_base match_items",
)
def barcode_two_step(s):
    """Exact barcode, else with a zero in front."""
    dim = s.match_items.where("dataareaid = 'mpr'").select("codebars", "itemid", "hpp")
    dim = dim.withColumn("code", F.col("codebars"))
    lines = s.online_base.select("ok", "ln", "sku")
    return with_leading_zero_retry(lines, "sku", dim, "code").drop("code")


def toggled(code: str) -> str:
    return f"CASE WHEN {code} LIKE '0%' THEN substr({code}, 2) ELSE '0' || {code} END"


def cascade_joins(alias: str, code: str) -> str:
    """One left join per step of the cascade, as the steps are described."""
    t = toggled(f"{alias}.{code}")
    c = f"{alias}.{code}"
    return f"""
    LEFT JOIN match_items a1 ON {alias}.brand = 'SZ' AND a1.dataareaid = 'mgl' AND a1.alucode = {c}
    LEFT JOIN match_items a2 ON {alias}.brand = 'SZ' AND a2.dataareaid = 'mgl' AND a2.codebars = {c}
    LEFT JOIN match_items a3 ON {alias}.brand = 'SZ' AND a3.dataareaid = 'mpr' AND a3.codebars = {c}
    LEFT JOIN match_items a4 ON {alias}.brand = 'SZ' AND a4.dataareaid = 'mgl' AND a4.codebars = {t}
    LEFT JOIN match_items a5 ON {alias}.brand = 'SZ' AND a5.dataareaid = 'mpr' AND a5.codebars = {t}
    LEFT JOIN match_items c1 ON {alias}.brand <> 'SZ' AND c1.dataareaid = 'mpr' AND c1.codebars = {c}
    LEFT JOIN match_items c2 ON {alias}.brand <> 'SZ' AND c2.dataareaid = 'mpr' AND {c} NOT LIKE '0%'
      AND c2.codebars = '0' || {c}
    """


def cascade_pick(column: str) -> str:
    steps = ", ".join(f"a{i}.{column}" for i in range(1, 6))
    return f"COALESCE({steps}, c1.{column}, c2.{column})"


def cascade_code(alias: str, code: str) -> str:
    """Code column after the cascade: other brands keep the code that was tried last."""
    c = f"{alias}.{code}"
    tried = f"CASE WHEN {c} LIKE '0%' THEN {c} ELSE '0' || {c} END"
    return f"CASE WHEN {alias}.brand = 'SZ' THEN {cascade_pick('codebars')} ELSE COALESCE({cascade_pick('codebars')}, {tried}) END"


@query(
    f"""SELECT b.ok, b.ln, b.brand, CASE WHEN b.brand = 'SZ' THEN b.sku ELSE {cascade_code('b', 'sku')} END AS barcode,
      {cascade_code('b', 'sku')} AS codebars, {cascade_pick('itemid')} AS itemid,
      {cascade_pick('subcategory')} AS subcategory, {r(cascade_pick('hpp'))} AS hpp
    FROM online_base b {cascade_joins('b', 'sku')}""",
    "online_base match_items",
)
def match_cascade(s):
    """Seller codes matched over both companies' codes in a fixed order."""
    lines = s.online_base.select("ok", "ln", "brand", F.col("sku").alias("barcode"))
    matched = match_online_codes(lines, s.match_items)
    return matched.select("ok", "ln", "brand", "barcode", "codebars", "itemid", "subcategory", "hpp")


PERIOD_SALES = """
sold AS (SELECT dataareaid, axcode, order_create_date,
    CASE WHEN codebars IN ('undetected', 'Undetected') AND productdata_barcode IS NOT NULL
      THEN productdata_barcode ELSE codebars END AS codebars,
    count(DISTINCT ordernumber) AS ordernumber, sum(quantity) AS quantity,
    round_even(sum(cust_paid_peritem), 2) AS cust_paid_peritem, round_even(sum(hpp_total), 2) AS hpp_total
  FROM sales_lines
  WHERE istransaction IS DISTINCT FROM '0' AND issettled IS DISTINCT FROM FALSE
    AND status_order IS DISTINCT FROM 7 AND channel IS DISTINCT FROM 'ONLINE'
  GROUP BY 1, 2, 3, 4),
used AS (SELECT * FROM pattern WHERE pattern_date IN (SELECT order_create_date FROM sold)),
tm AS (SELECT pattern_date AS day, s.* FROM used JOIN sold s ON pattern_date = order_create_date),
lm AS (SELECT pattern_date AS day, s.* FROM used JOIN sold s ON pattern_lm = order_create_date),
ly AS (SELECT pattern_date AS day, s.* FROM used JOIN sold s ON pattern_last_year = order_create_date)
"""


@query(
    PERIOD_SALES
    + f""", k AS (SELECT dataareaid, axcode, day, codebars FROM tm UNION SELECT dataareaid, axcode, day, codebars FROM lm
      UNION SELECT dataareaid, axcode, day, codebars FROM ly)
    SELECT k.dataareaid, k.axcode, k.day AS order_create_date, k.codebars,
      CAST(COALESCE(tm.ordernumber, 0) AS BIGINT) AS ordernumber, CAST(COALESCE(lm.quantity, 0) AS BIGINT) AS quantity_lm,
      {r('COALESCE(tm.cust_paid_peritem, 0)')} AS cust_paid_peritem,
      {r('COALESCE(lm.cust_paid_peritem, 0)')} AS cust_paid_peritem_lm,
      {r('COALESCE(ly.cust_paid_peritem, 0)')} AS cust_paid_peritem_ly
    FROM k LEFT JOIN tm USING (dataareaid, axcode, day, codebars) LEFT JOIN lm USING (dataareaid, axcode, day, codebars)
      LEFT JOIN ly USING (dataareaid, axcode, day, codebars)""",
    "sales_lines pattern",
)
def lm_ly_full_outer(s):
    """A day's sales beside its counterparts last month and last year."""
    sold = unified_sales(valid_sales(s.sales_lines))
    wide = compare_periods(sold, sold, sold, s.pattern)
    days = calendar_pattern(s.pattern).select("id", F.col("pattern_date").alias("order_create_date"))
    return keep_facts(wide, days, ["id"]).select(
        "dataareaid", "axcode", "order_create_date", "codebars", "ordernumber", "quantity_lm",
        "cust_paid_peritem", "cust_paid_peritem_lm", "cust_paid_peritem_ly",
    )


@query(
    """SELECT pattern_date, pattern_lm FROM pattern
    WHERE pattern_lm IN (SELECT order_create_date FROM sales_lines WHERE channel = 'ONLINE')""",
    "pattern sales_lines",
)
def semi_calendar(s):
    """Calendar rows whose last-month date had online sales."""
    online = s.sales_lines.where("channel = 'ONLINE'")
    return present_in(s.pattern, online, {"pattern_lm": "order_create_date"}).select(
        "pattern_date", "pattern_lm"
    )


@query(
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
)
def anti_new_dates(s):
    """Orders without a returned line."""
    returned = s.lineitem.where("l_returnflag = 'R'")
    return absent_from(s.orders, returned, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_custkey")


@query(
    f"""SELECT o.order_number AS ordernumber, o.product_barcode AS barcode, o.order_product_quantity AS quantity,
      e.stagingnumber AS staging_number_365, e.quantity AS quantity_staging_365,
      {r('e.subtotaldetail')} AS subtotal_staging_365,
      CASE WHEN o.order_product_quantity = e.quantity THEN 'sync' ELSE 'not sync' END AS is_sync
    FROM pos_orders o LEFT JOIN erp_staging e ON e.transnumber = o.order_number AND e.barcode = o.product_barcode
      AND e.dataareaid = o.dataareaid AND e.pullstatus = 'Current'""",
    "pos_orders erp_staging",
    name="staging_sync",
)
def _staging_sync(s):
    """Lines reconciled with the other system's quantities."""
    lines = s.pos_orders.select(
        "dataareaid",
        F.col("order_number").alias("ordernumber"),
        F.col("product_barcode").alias("barcode"),
        F.col("order_product_quantity").alias("quantity"),
    )
    return staging_sync(lines, s.erp_staging).drop("dataareaid")


@query(
    f"""SELECT pattern_date, s.axcode, s.ordernumber, {r('s.cust_paid_peritem')} AS cust_paid_peritem
    FROM pattern JOIN sales_lines s ON pattern_last_year = s.order_create_date""",
    "pattern sales_lines",
)
def calendar_shift(s):
    """Sales seen from the date they are compared with a year later."""
    rows = calendar_pattern(s.pattern)
    sales = s.sales_lines.select("axcode", "ordernumber", "cust_paid_peritem", "order_create_date")
    shifted = shift_dates(sales, rows, "order_create_date", "pattern_last_year")
    days = rows.select("id", "pattern_date")
    return keep_facts(shifted, days, ["id"]).select(
        "pattern_date", "axcode", "ordernumber", "cust_paid_peritem"
    )


@query(
    f"""SELECT o_orderkey, COALESCE(n, 0) AS line_count, {r('COALESCE(total, 0)')} AS total
    FROM orders FULL JOIN (SELECT l_orderkey, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2))) AS total
      FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"""
)
def header_detail_outer(s):
    """Headers with and without details in one outer join."""
    details = s.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("total"),
    )
    joined = full_outer(s.orders.select("o_orderkey"), details, ["o_orderkey"])
    return joined.select(
        "o_orderkey",
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        F.coalesce("total", F.lit(0)).alias("total"),
    )


@query(
    f"""SELECT order_number, product_barcode, order_product_quantity,
      {r('sum(order_product_total) OVER (PARTITION BY order_id)')} AS order_value,
      count(*) OVER (PARTITION BY order_id) AS order_lines FROM pos_orders""",
    "pos_orders",
)
def order_total_on_line(s):
    """Order totals written onto every line."""
    lines = s.pos_orders.select(
        "order_id", "order_number", "product_barcode", "order_product_quantity", "order_product_total"
    )
    totals = {"order_value": F.sum("order_product_total"), "order_lines": F.count(F.lit(1))}
    return attach_totals(lines, ["order_id"], totals).drop("order_id", "order_product_total")
