"""Stored roll-ups, distinct orders from bitmaps, rejected values, snapshots of drops."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lapak.operators.accumulating import unified_lines, valid_sales
from lapak.operators.distinct_orders import counted, distinct_orders, merged, order_bitmaps, order_numbers
from lapak.operators.reconcile import reconcile
from lapak.operators.rejects import checked, reject_report, united, write_checked
from lapak.plans.jobs import Lake
from lapak.plans.raw_drop import open_rows, write_snapshot
from lapak.plans.rollups import STORE_DAY, refresh_rollups, run_to_date
from lapak.session import scratch_folder, stored
from lapak.sources.writers import write_months

from .aggregates import VALID
from .registry import query, r
from .shapes import DUCK, RAW, SPARK

UNIFIED = f"""u AS (SELECT dataareaid, axcode, order_create_date AS d, ordernumber,
  CASE WHEN codebars IN ('undetected', 'Undetected') AND productdata_barcode IS NOT NULL THEN productdata_barcode ELSE codebars END AS code
  FROM sales_lines WHERE {VALID})"""


@query(
    f"""{UNIFIED}, c AS (SELECT u.*, p_brand AS category FROM u JOIN part ON code = lpad(CAST(p_partkey AS VARCHAR), 8, '0'))
    SELECT 'day' AS grain, axcode, strftime(d, '%Y-%m-%d') AS period, 'all' AS category, count(DISTINCT ordernumber) AS ordernumber FROM c GROUP BY ALL
    UNION ALL SELECT 'month', axcode, strftime(d, '%Y-%m'), 'all', count(DISTINCT ordernumber) FROM c GROUP BY ALL
    UNION ALL SELECT 'year', axcode, strftime(d, '%Y'), 'all', count(DISTINCT ordernumber) FROM c GROUP BY ALL
    UNION ALL SELECT 'month', axcode, strftime(d, '%Y-%m'), category, count(DISTINCT ordernumber) FROM c GROUP BY ALL
    UNION ALL SELECT 'year', 'all', strftime(d, '%Y'), category, count(DISTINCT ordernumber) FROM c GROUP BY ALL""",
    "sales_lines",
)
def distinct_orders_periods(s):
    """Distinct orders per store and day, month, year and category, all merged from one set of bitmaps."""
    category = s.part.select(F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("codebars"), F.col("p_brand").alias("category"))
    lines = unified_lines(valid_sales(s.sales_lines)).join(category, "codebars")
    numbers = stored(order_numbers(lines), "numbers")
    bits = stored(order_bitmaps(lines, numbers, [*STORE_DAY, "category"]), "bitmaps")
    # Coarser sets are merged from the months', which are far fewer than the days'.
    day, month = (F.date_format("order_create_date", form) for form in ("yyyy-MM-dd", "yyyy-MM"))
    months = stored(merged(bits, axcode="axcode", period=month, category="category"), "months")
    year, every = F.substring("period", 1, 4), F.lit("all")
    counts = {
        "day": [distinct_orders(bits, axcode="axcode", period=day, category=every)],
        "month": [distinct_orders(months, axcode="axcode", period="period", category=every), counted(months, "axcode", "period", "category")],
        "year": [distinct_orders(months, axcode="axcode", period=year, category=every), distinct_orders(months, axcode=every, period=year, category="category")],
    }
    return united([rows.withColumn("grain", F.lit(grain)) for grain, parts in counts.items() for rows in parts])


@query(
    """SELECT event_type, strftime(ts, '%Y-%m-%d') AS period, count(DISTINCT user_id) AS users FROM events GROUP BY ALL
    UNION ALL SELECT event_type, strftime(ts, '%Y-%m'), count(DISTINCT user_id) FROM events GROUP BY ALL
    UNION ALL SELECT 'all', strftime(ts, '%Y-%m'), count(DISTINCT user_id) FROM events GROUP BY ALL
    UNION ALL SELECT 'all', strftime(ts, '%Y'), count(DISTINCT user_id) FROM events GROUP BY ALL"""
)
def distinct_users_periods(s):
    """Distinct users, who come on many days and in many ways: days and kinds merge exactly."""
    rows = s.events.select("user_id", "event_type", F.to_date("ts").alias("day"))
    numbers = stored(order_numbers(rows, "user_id", ["day", "event_type"]), "numbers")
    bits = stored(order_bitmaps(rows, numbers, ["event_type", "day"], "user_id"), "bitmaps")

    def of(kind, form: str):
        return distinct_orders(bits, "users", event_type=kind, period=F.date_format("day", form))

    return united([of("event_type", "yyyy-MM-dd"), of("event_type", "yyyy-MM"), of(F.lit("all"), "yyyy-MM"), of(F.lit("all"), "yyyy")])


AS_OF = dt.date(1995, 6, 17)


@query(
    f"""m AS (SELECT * REPLACE (CAST(quantity + CASE WHEN strftime(order_create_date, '%Y-%m') = '1995-03' THEN 1 ELSE 0 END AS INT) AS quantity) FROM sales_lines
      WHERE NOT (strftime(order_create_date, '%Y-%m') = '1995-03' AND promocode = 'regular')),
    v AS (SELECT *, order_create_date >= DATE '1995-06-01' AS mtd FROM m WHERE {VALID} AND order_create_date >= DATE '1995-01-01' AND order_create_date <= DATE '1995-06-17')
    SELECT dataareaid, axcode, CAST(coalesce(sum(quantity) FILTER (WHERE mtd), 0) AS BIGINT) AS quantity_mtd, CAST(sum(quantity) AS BIGINT) AS quantity_ytd,
      {r('coalesce(sum(cust_paid_peritem) FILTER (WHERE mtd), 0)')} AS cust_paid_peritem_mtd, {r('sum(cust_paid_peritem)')} AS cust_paid_peritem_ytd,
      {r('coalesce(sum(hpp_total) FILTER (WHERE mtd), 0)')} AS hpp_total_mtd, {r('sum(hpp_total)')} AS hpp_total_ytd,
      count(DISTINCT ordernumber) FILTER (WHERE mtd) AS orders_mtd, count(DISTINCT ordernumber) AS orders_ytd
    FROM v GROUP BY 1, 2""",
    "sales_lines",
)
def rollup_to_date(s):
    """Month and year to date from stored roll-ups, after one month was delivered again and rolled up alone."""
    spark = s.lineitem.sparkSession
    lake = Lake(spark, scratch_folder(spark, "rollup"))
    write_months(s.sales_lines, lake.path("pos_detail"), "order_create_date")
    refresh_rollups(lake, None)
    march = dt.date(1995, 3, 1)
    again = lake.read_months("pos_detail", [march]).where("promocode <> 'regular'").withColumn("quantity", (F.col("quantity") + 1).cast("int"))
    write_months(stored(again, "again"), lake.path("pos_detail"), "order_create_date", months=[march])
    refresh_rollups(lake, [march])
    return run_to_date(lake, AS_OF)


#: What is spoiled in each export: column, text put there (None: as it is), condition, reason.
SPOILED = {
    "shopee": [("Harga Awal", "n/a", "{Status Pesanan} = 'Batal'", "not a number"), ("Waktu Pengiriman Diatur", "31/12/2020", "{Status Pembatalan/ Pengembalian} = 'Permintaan Disetujui'", "not a date")],
    "lazada": [("unitPrice", "12,5x", "{status} = 'canceled'", "not a number"), ("deliveredDate", None, "{deliveredDate} = 'not a date'", "not a date")],
    "tiktok": [("SKU Unit Original Price", "IDR -.-", "{Order Status} = 'Canceled'", "not a number"), ("Created Time", " ", "{Order Substatus} = 'Delivered'", "empty")],
    "shopify": [("Lineitem price", "free", "{Lineitem quantity} = '7'", "not a number")],
    "tokopedia": [("Harga Jual (IDR)", "-", "{Status Terakhir} = 'Pesanan Diproses'", "not a number"), ("Tanggal Pembayaran", "2020-01-01", "{Kota} = 'Kota 3'", "not a date")],
    "zalora": [("Unit Price", "1.000,00", "{Status} = 'delivery failed'", "not a number"), ("Created at", "yesterday", "{Reason} = 'Refused'", "not a date")],
    "blibli": [("Diskon", "10%", "{Order Status} = 'Order Batal'", "not a number"), ("Tanggal Order", "01/13/2020 10:00", "{Total Barang} = '9'", "not a date")],
}


def _quoted(condition: str, dialect) -> str:
    for part in condition.split("{")[1:]:
        name = part.split("}")[0]
        condition = condition.replace("{" + name + "}", dialect.q(name))
    return condition


def _rejects_sql() -> str:
    parts = []
    for m, spoiled in SPOILED.items():
        conditions = [_quoted(c, DUCK) for _, _, c, _ in spoiled]
        for (column, text, _, reason), c in zip(spoiled, conditions):
            example = text if text is not None else "not a date"
            parts.append(f"SELECT '{m}' AS marketplace, '{column}' AS \"column\", '{reason}' AS reason, count(*) AS rows, '{example}' AS example FROM own_{m} WHERE {c} HAVING count(*) > 0")
        bad = " OR ".join(f"coalesce({c}, FALSE)" for c in conditions)
        for reason, test in (("good", f"NOT ({bad})"), ("rejected", bad)):
            parts.append(f"SELECT '{m}', '(rows)', '{reason}', count(*), NULL FROM own_{m} WHERE {test} HAVING count(*) > 0")
    return " UNION ALL ".join(parts)


@query(_rejects_sql(), " ".join(f"own_{m}" for m in RAW))
def export_rejects(s):
    """Values that cannot be read, per marketplace, column and reason; good rows and rejects in two sinks."""
    spark, s = s.lineitem.sparkSession, s.landed("online_base")
    out = []
    for m, spoiled in SPOILED.items():
        raw = getattr(s, f"own_{m}")
        spoiling = {c: F.when(F.expr(_quoted(test, SPARK)), F.lit(text)).otherwise(F.col(f"`{c}`")) for c, text, test, _ in spoiled if text is not None}
        good, rejects = write_checked(checked(raw.withColumns(spoiling), m), scratch_folder(spark, f"checked-{m}"))
        out.append(reject_report(rejects, m))
        for reason, rows in (("good", good), ("rejected", rejects)):
            n = rows.agg(F.count(F.lit(1)).alias("rows")).where("rows > 0")
            out.append(n.select(F.lit(m).alias("marketplace"), F.lit("(rows)").alias("column"), F.lit(reason).alias("reason"), "rows", F.lit(None).cast("string").alias("example")))
    return united(out)


DROP_DAY = dt.date(1998, 7, 3)


@query(
    """SELECT brand, "Nomor Invoice" AS invoice, "Nomor SKU" AS sku, strftime(strptime("Tanggal Pembayaran", '%d-%m-%Y %H:%M:%S'), '%Y-%m') AS month,
      strptime("Tanggal Pembayaran", '%d-%m-%Y %H:%M:%S') >= TIMESTAMP '1998-06-01' AND strptime("Tanggal Pembayaran", '%d-%m-%Y %H:%M:%S') < TIMESTAMP '1998-08-01' AS is_open
    FROM own_tokopedia""",
    "own_tokopedia",
)
def raw_snapshot(s):
    """A day's drop as delivered, by brand and month, delivered twice that day; which of its rows are still open."""
    spark, s = s.lineitem.sparkSession, s.sold_on("tokopedia")
    path = scratch_folder(spark, "snapshot") + "/marketplace=tokopedia/day=1998-07-03"
    write_snapshot(s.own_tokopedia.where("brand < 'MN'"), "tokopedia", DROP_DAY, path)
    write_snapshot(s.own_tokopedia, "tokopedia", DROP_DAY, path)
    held = spark.read.parquet(path)
    marks = F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
    rows = held.select("brand", F.col("`Nomor Invoice`").alias("invoice"), F.col("`Nomor SKU`").alias("sku"), marks.alias("month"), "drop_date")
    still = open_rows(rows, DROP_DAY).select("drop_date").distinct().withColumn("is_open", F.lit(True))
    return rows.join(still, "drop_date", "left").withColumn("is_open", F.coalesce("is_open", F.lit(False))).drop("drop_date")


DIFFERENCES = f"""a AS (SELECT dataareaid, axcode, order_create_date AS d, ordernumber, codebars, CAST(sum(quantity) AS BIGINT) AS q, sum(cust_paid_peritem) AS v
  FROM sales_lines GROUP BY ALL),
b AS (SELECT dataareaid, axcode, order_create_date AS d, ordernumber, codebars, CAST(sum(quantity + CASE WHEN promocode = 'P7' THEN 1 ELSE 0 END) AS BIGINT) AS q, sum(cust_paid_peritem) AS v
  FROM sales_lines WHERE NOT (status_order = 7 AND channel = 'SHOWROOM') GROUP BY ALL
  UNION ALL SELECT 'new', axcode, order_create_date, ordernumber, codebars, CAST(sum(quantity) AS BIGINT), sum(cust_paid_peritem) FROM sales_lines WHERE status_order = 7 AND promocode = 'P3' GROUP BY ALL)"""


@query(
    f"""{DIFFERENCES} SELECT dataareaid, axcode, strftime(d, '%Y-%m-%d') AS day, ordernumber, codebars, a.q AS quantity_here, b.q AS quantity_there,
      {r('a.v')} AS cust_paid_peritem_here, {r('b.v')} AS cust_paid_peritem_there,
      CASE WHEN b.q IS NULL THEN 'only here' WHEN a.q IS NULL THEN 'only there' ELSE 'different' END AS state
    FROM a FULL JOIN b USING (dataareaid, axcode, d, ordernumber, codebars) WHERE a.q IS DISTINCT FROM b.q OR a.v IS DISTINCT FROM b.v""",
    "sales_lines",
)
def reconciled_by_digest(s):
    """Lines two systems do not share, found by digests per company, store and day before any line is joined."""
    here = s.sales_lines.withColumn("quantity", F.col("quantity").cast("long"))
    changed = here.where("not (status_order = 7 and channel = 'SHOWROOM')").withColumn("quantity", F.col("quantity") + F.when(F.col("promocode") == "P7", 1).otherwise(0))
    there = changed.unionByName(here.where("status_order = 7 and promocode = 'P3'").withColumn("dataareaid", F.lit("new")))
    found = reconcile(here, there, STORE_DAY, ["ordernumber", "codebars"], ["quantity", "cust_paid_peritem"])
    return found.withColumn("day", F.date_format("order_create_date", "yyyy-MM-dd")).drop("order_create_date")
