"""Projections, filters and whole-frame edits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lapak.functions.columns import (
    camel_to_snake,
    col_or,
    conform,
    drop_matching,
    fill_by_type,
    fill_from,
    rename_all,
    report_title,
    round_columns,
)
from lapak.functions.dates import in_month
from lapak.functions.values import (
    differs,
    first_match,
    is_in,
    map_values,
    not_in,
    replace_values,
)
from lapak.operators.accumulating import REPORT_WORDS, valid_sales
from lapak.operators.joining import keep_facts
from lapak.sources.readers import with_source

from .registry import query, r, rs

LINE_KEY = "dataareaid, axcode, order_create_date, codebars, ordernumber, quantity"


@query(
    f"""SELECT {LINE_KEY}, {rs('cust_paid_peritem, hpp_total')}, promocode, remarks
    FROM sales_lines WHERE istransaction IS DISTINCT FROM '0' AND issettled IS DISTINCT FROM FALSE
      AND status_order IS DISTINCT FROM 7 AND channel IS DISTINCT FROM 'ONLINE'""",
    "sales_lines",
)
def valid_sales_filter(s):
    """Paid, settled, not void, not online."""
    return valid_sales(s.sales_lines).select(
        *LINE_KEY.split(", "), "cust_paid_peritem", "hpp_total", "promocode", "remarks"
    )


@query(
    """SELECT dataareaid AS data_area_id, store_branch_extcode AS store_code, order_number,
      order_product_quantity AS product_quantity, 'indiepos' AS datasource,
      CAST(NULL AS VARCHAR) AS employee_nik FROM pos_orders""",
    "pos_orders",
)
def project_rename(s):
    """Column list, rename map, constant column and a column the source lacks."""
    renamed = s.pos_orders.withColumnsRenamed(
        {
            "dataareaid": "data_area_id",
            "store_branch_extcode": "store_code",
            "order_product_quantity": "product_quantity",
        }
    ).withColumn("datasource", F.lit("indiepos"))
    return conform(
        renamed,
        ["data_area_id", "store_code", "order_number", "product_quantity", "datasource", "employee_nik"],
    )


@query(
    f"""SELECT ordernumber AS "Orders", {r('cust_paid_peritem')} AS "Sales",
      order_create_date AS "Order Create Date", quantity AS "Quantity Last Year" FROM sales_lines""",
    "sales_lines",
)
def bulk_rename(s):
    """Report headings from column names."""
    df = s.sales_lines.select(
        "ordernumber", "cust_paid_peritem", "order_create_date", F.col("quantity").alias("quantity_ly")
    )
    return rename_all(df, lambda c: report_title(c, REPORT_WORDS))


@query(
    """SELECT o_orderkey AS order_key, o_custkey AS store_pos_id, o_orderstatus AS cust_paid_status
    FROM orders"""
)
def camel_rename(s):
    """camelCase headings to snake_case."""
    df = s.orders.select(
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_custkey").alias("StorePosID"),
        F.col("o_orderstatus").alias("custPaidStatus"),
    )
    return rename_all(df, camel_to_snake)


@query("SELECT o_orderkey, o_custkey FROM orders")
def drop_by_name(s):
    """Columns whose name holds a marker are dropped."""
    df = s.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status_drop"))
    return drop_matching(df, "_drop")


@query(
    """SELECT order_number, product_barcode,
      CASE order_status WHEN 6 THEN 'Finish' WHEN 5 THEN 'Received' END AS status_order
    FROM pos_orders""",
    "pos_orders",
)
def status_label_map(s):
    """Status codes to labels; codes without a label become NULL."""
    return s.pos_orders.select(
        "order_number",
        "product_barcode",
        map_values("order_status", {6: "Finish", 5: "Received"}).alias("status_order"),
    )


@query(
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'PROMOTION' WHEN 'ECONOMY' THEN 'BASIC'
      ELSE p_type END AS p_type FROM part"""
)
def override_replace(s):
    """Dictionary replacement that keeps unmatched values."""
    return s.part.select(
        "p_partkey", replace_values("p_type", {"PROMO": "PROMOTION", "ECONOMY": "BASIC"}).alias("p_type")
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
      CASE WHEN o.new_status IS NOT NULL THEN o.new_status ELSE l_returnflag END AS status
    FROM lineitem LEFT JOIN (SELECT o_orderkey, 'X' AS new_status FROM orders WHERE o_orderstatus = 'P') o
      ON l_orderkey = o.o_orderkey"""
)
def record_override(s):
    """Corrections of single orders from a table of overrides."""
    overrides = s.orders.where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit("X").alias("new_status")
    )
    joined = keep_facts(s.lineitem, overrides, ["l_orderkey"])
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.coalesce("new_status", "l_returnflag").alias("status"),
    )


@query(f"SELECT order_number, product_barcode, {r('order_product_discount')} AS discount, 0 AS member_point FROM pos_orders", "pos_orders")
def optional_column(s):
    """A column, or a constant where the source lacks it."""
    df = s.pos_orders
    return df.select(
        "order_number",
        "product_barcode",
        col_or(df, "order_product_discount").alias("discount"),
        col_or(df, "member_point").alias("member_point"),
    )


@query(
    """SELECT o_orderkey, COALESCE(l_partkey, 0) AS l_partkey, round(COALESCE(l_quantity, 0), 4) AS l_quantity,
      COALESCE(l_returnflag, 'undetected') AS l_returnflag
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"""
)
def type_driven_fill(s):
    """Orders without lines: missing numbers 0, missing text ``undetected``."""
    lines = s.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity", "l_returnflag")
    joined = keep_facts(s.orders.select("o_orderkey"), lines, ["o_orderkey"])
    return fill_by_type(joined, 0, "undetected")


@query(
    """SELECT order_number, product_barcode, COALESCE(promotion_description, promotion_title) AS remarks,
      COALESCE(promotion_description, 'Regular') AS shown FROM pos_orders""",
    "pos_orders",
)
def cascade_fill(s):
    """NULLs filled from another column, and from a constant."""
    df = s.pos_orders.withColumn("remarks", F.col("promotion_description"))
    filled = fill_from(df, "remarks", "promotion_title").withColumnRenamed("promotion_description", "shown")
    return filled.fillna({"shown": "Regular"}).select("order_number", "product_barcode", "remarks", "shown")


@query(
    f"""SELECT {LINE_KEY} FROM sales_lines
    WHERE order_create_date >= DATE '2000-07-01' AND order_create_date < DATE '2000-08-01'""",
    "sales_lines",
)
def period_filter(s):
    """Rows whose own month is the reporting month."""
    month = dt.date(2000, 7, 1)
    return s.sales_lines.where(in_month("order_create_date", month)).select(*LINE_KEY.split(", "))


@query("SELECT brand, order_no, barcode, date FROM online_lines WHERE date <= DATE '1999-12-31'", "online_lines")
def date_cutoff(s):
    """Rows up to a report date."""
    return s.online_lines.where(F.col("date") <= F.lit(dt.date(1999, 12, 31))).select(
        "brand", "order_no", "barcode", "date"
    )


@query(
    """SELECT order_number, product_barcode, promotion_description FROM pos_orders
    WHERE promotion_description IS DISTINCT FROM 'Disc 5'
      AND COALESCE(promotion_description NOT IN ('Disc 1', 'Disc 2'), TRUE)""",
    "pos_orders",
)
def not_in_keep_null(s):
    """``!=`` and non-membership that keep rows without a value."""
    return s.pos_orders.where(
        differs("promotion_description", "Disc 5") & not_in("promotion_description", ["Disc 1", "Disc 2"])
    ).select("order_number", "product_barcode", "promotion_description")


@query(
    """SELECT order_number, product_barcode,
      CASE WHEN order_product_quantity < 0 THEN 'return' WHEN promotion_description IN ('Disc 9', 'Disc 10') THEN 'deep'
        WHEN promotion_description IS NOT NULL THEN 'promo' ELSE 'regular' END AS kind
    FROM pos_orders""",
    "pos_orders",
)
def conditional_label(s):
    """First matching branch, with a default."""
    kind = first_match(
        [
            (F.col("order_product_quantity") < 0, "return"),
            (is_in("promotion_description", ["Disc 9", "Disc 10"]), "deep"),
            (F.col("promotion_description").isNotNull(), "promo"),
        ],
        "regular",
    )
    return s.pos_orders.select("order_number", "product_barcode", kind.alias("kind"))


@query(
    f"""SELECT order_no, barcode, {r('round_even(basic_price * CAST(0.125 AS DECIMAL(4,3)), 2)')} AS two,
      {r('round_even(basic_price * CAST(0.125 AS DECIMAL(4,3)), 0)')} AS zero FROM online_lines""",
    "online_lines",
)
def round_policy(s):
    """Half-to-even rounding to cents and to whole units."""
    part = F.col("basic_price") * F.lit("0.125").cast("decimal(4,3)")
    df = s.online_lines.select("order_no", "barcode", part.alias("two"), part.alias("zero"))
    return round_columns(round_columns(df, ["two"], 2), ["zero"], 0)


@query(
    """SELECT 'orders' AS source, o_orderkey AS key, o_orderstatus AS label, CAST(NULL AS BIGINT) AS line FROM orders
    UNION ALL SELECT 'lines', l_orderkey, CAST(NULL AS VARCHAR), CAST(l_linenumber AS BIGINT) FROM lineitem"""
)
def keyed_union(s):
    """Frames with different columns in one frame, tagged by source."""
    return with_source(
        {
            "orders": s.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("label")),
            "lines": s.lineitem.select(
                F.col("l_orderkey").alias("key"), F.col("l_linenumber").cast("bigint").alias("line")
            ),
        }
    )


@query(
    """SELECT DISTINCT marketplace, brand FROM online_base""",
    "online_base",
)
def distinct_sources(s):
    """Distinct brand and marketplace pairs."""
    return s.online_base.select("marketplace", "brand").distinct()
