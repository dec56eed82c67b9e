"""Text, number and date functions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lapak.functions.dates import (
    day_name,
    day_score,
    gap_days,
    local_time,
    month_name,
    parse_date,
    project_day,
    week_label,
    week_of_month,
)
from lapak.functions.numbers import safe_ratio, tax_base, with_tax, zero_below
from lapak.functions.text import (
    clean_address,
    delete,
    keep_alphanumeric,
    part_of,
    phone,
    postcode,
    title_case,
    unquote,
    whole_number,
    zero_toggle,
)

from .registry import query, r


@query(
    """SELECT s_suppkey, upper(s_name) AS upper_name, regexp_replace(s_name, '[^a-zA-Z0-9]', '', 'g') AS symbols,
      replace(s_name, 'Supplier', '') AS cut, 'Dki-Jakarta O''Neil 3Abc ' || CAST(s_suppkey AS VARCHAR) AS title,
      'a, ' || s_name || 'b' AS address, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS padded,
      trim('  ' || s_name || ' ') AS trimmed
    FROM supplier"""
)
def clean_text(s):
    """Case, symbol deletion, literal deletion, title case, address cleanup, padding."""
    name = F.col("s_name")
    raw_title = F.concat(F.lit("DKI-JAKARTA o'neil 3abc "), F.col("s_suppkey").cast("string"))
    raw_address = F.concat(F.lit("a\n"), name, F.lit(" b"))
    return s.supplier.select(
        "s_suppkey",
        F.upper(name).alias("upper_name"),
        keep_alphanumeric(name).alias("symbols"),
        delete(name, "Supplier").alias("cut"),
        title_case(raw_title).alias("title"),
        clean_address(raw_address).alias("address"),
        F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("padded"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
    )


@query(
    """SELECT axcode, string_split(stdname, ' ')[2] AS second, string_split(stdname, ' ')[3] AS third,
      string_split(stdname, ' ')[9] AS missing FROM stores""",
    "stores",
)
def split_name(s):
    """Words of a store name; NULL where the name is shorter."""
    return s.stores.select(
        "axcode",
        part_of("stdname", " ", 1).alias("second"),
        part_of("stdname", " ", 2).alias("third"),
        part_of("stdname", " ", 8).alias("missing"),
    )


@query(
    """c AS (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN '+62 812-' || CAST(c_custkey AS VARCHAR)
        WHEN c_nationkey < 10 THEN '0812' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
        WHEN c_nationkey < 15 THEN '812.' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')
        WHEN c_nationkey < 20 THEN '12' ELSE NULL END AS raw FROM customer),
    d AS (SELECT c_custkey, regexp_replace(COALESCE(raw, ''), '[^a-zA-Z0-9]', '', 'g') AS p FROM c),
    e AS (SELECT c_custkey, CASE WHEN p LIKE '62%' THEN '0' || substr(p, 3) ELSE p END AS p FROM d),
    f AS (SELECT c_custkey, CASE WHEN p LIKE '0%' THEN p ELSE '0' || p END AS p FROM e)
    SELECT c_custkey, CASE WHEN length(p) < 10 THEN '*******' ELSE p END AS phone FROM f""".replace(
        "c AS (", "WITH c AS (", 1
    )
)
def phone_mask(s):
    """Phone numbers in one local form; short ones masked."""
    n, k = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    raw = (
        F.when(n < 5, F.concat(F.lit("+62 812-"), k))
        .when(n < 10, F.concat(F.lit("0812"), F.lpad(k, 8, "0")))
        .when(n < 15, F.concat(F.lit("812."), F.lpad(k, 7, "0")))
        .when(n < 20, F.lit("12"))
    )
    return s.customer.select("c_custkey", phone(raw).alias("phone"))


@query(
    """SELECT ok, ln, sku, price * qty AS amount, CASE WHEN ls = 'O' THEN NULL ELSE price END AS maybe
    FROM online_base""",
    "online_base",
)
def currency_parse(s):
    """Currency text with thousand dots to whole numbers; bad text to NULL."""
    amount = F.col("price") * F.col("qty")
    text = F.concat(F.lit("IDR "), F.replace(F.format_number(amount, 0), F.lit(","), F.lit(".")))
    maybe = F.when(F.col("ls") == "O", F.lit("n/a")).otherwise(F.col("price").cast("string"))
    return s.online_base.select(
        "ok", "ln", "sku",
        whole_number(text, "IDR ").alias("amount"),
        whole_number(maybe).alias("maybe"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed
    FROM orders"""
)
def multi_format_date(s):
    """Dates in several formats; text in none of them becomes NULL."""
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd-MM-yyyy HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd MMM yyyy HH:mm"))
        .otherwise(F.lit("soon"))
    )
    parsed = parse_date(text, "dd-MM-yyyy HH:mm:ss", "dd MMM yyyy HH:mm", "yyyy-MM-dd")
    return s.orders.select("o_orderkey", parsed.alias("parsed"))


@query(
    """SELECT o_orderkey, CAST((day(o_orderdate) - 1) // 7 + 1 AS INT) AS week_no,
      'Week ' || CAST((day(o_orderdate) - 1) // 7 + 1 AS VARCHAR) AS week,
      dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name,
      CASE WHEN dayname(o_orderdate) IN ('Saturday', 'Sunday') THEN 2.0::DOUBLE WHEN dayname(o_orderdate) = 'Friday' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS day_score
    FROM orders"""
)
def week_and_score(s):
    """Week of month, weekday, month name and weight of a day."""
    d = "o_orderdate"
    return s.orders.select(
        "o_orderkey",
        week_of_month(F.dayofmonth(d)).alias("week_no"),
        week_label(d).alias("week"),
        day_name(d).alias("day_name"),
        month_name(d).alias("month_name"),
        day_score(d).alias("day_score"),
    )


@query(
    """SELECT o_orderkey, CAST(date_diff('day', DATE '1998-03-01', CAST(o_orderdate AS DATE)) + 1 AS INT) AS project_day,
      CAST((o_orderdate + INTERVAL 23 HOUR) + INTERVAL 7 HOUR AS DATE) AS local_date, last_day(CAST(o_orderdate AS DATE)) AS month_end
    FROM orders"""
)
def project_and_local_day(s):
    """Campaign day number, date in business time, last day of the month."""
    late = F.col("o_orderdate") + F.expr("INTERVAL 23 HOURS")
    return s.orders.select(
        "o_orderkey",
        project_day("o_orderdate", dt.date(1998, 3, 1)).alias("project_day"),
        F.to_date(local_time(late)).alias("local_date"),
        F.last_day("o_orderdate").alias("month_end"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
      CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS INT) AS gap
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def date_gap(s):
    """Days between two dates, without sign."""
    joined = s.lineitem.join(s.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        gap_days("l_shipdate", "o_orderdate").alias("gap"),
    )


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
      {r('COALESCE(l_extendedprice / NULLIF(l_discount, 0), 0)')} AS per_discount FROM lineitem"""
)
def safe_ratio_zero(s):
    """Ratios whose divisor may be zero."""
    return s.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        safe_ratio("l_extendedprice", "l_discount").alias("per_discount"),
    )


@query(
    f"""SELECT order_no, barcode, {r('CAST(value_after_voucher AS DOUBLE) / 1.11')} AS dpp,
      {r('CAST(existing_hpp AS DOUBLE) + CAST(existing_hpp AS DOUBLE) * 0.11')} AS cost_with_tax,
      {r('CASE WHEN voucher < 1000 THEN 0 ELSE voucher END')} AS clamped FROM online_lines""",
    "online_lines",
)
def tax_and_clamp(s):
    """Value without tax, cost with tax, small amounts to zero."""
    return s.online_lines.select(
        "order_no",
        "barcode",
        tax_base("value_after_voucher").alias("dpp"),
        with_tax("existing_hpp").alias("cost_with_tax"),
        zero_below("voucher", 1000).alias("clamped"),
    )


@query(
    """SELECT ok, ln, sku, CASE WHEN sku LIKE '0%' THEN substr(sku, 2) ELSE '0' || sku END AS toggled,
      sku AS unquoted, CAST(10000 + nation AS VARCHAR) AS postcode FROM online_base""",
    "online_base",
)
def code_cleanup(s):
    """Leading-zero toggle, spreadsheet quoting, postcode cleanup."""
    quoted = F.when(F.col("ln") > 3, F.concat(F.lit('="'), "sku", F.lit('"'))).otherwise(F.col("sku"))
    code = F.concat(F.lit("'"), (F.col("nation") + 10000).cast("string"), F.lit(".0"))
    return s.online_base.select(
        "ok", "ln", "sku",
        zero_toggle("sku").alias("toggled"),
        unquote(quoted).alias("unquoted"),
        postcode(code).alias("postcode"),
    )
