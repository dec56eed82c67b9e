"""Tables that change: upserts, replace-by-date, store dimension and versions, uploads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lapak.functions.dates import rebuild_months
from lapak.operators.accumulating import valid_sales
from lapak.operators.aggregating import group_sum
from lapak.operators.changes import PROMO_KEY, replace_by_date, store_versions, upsert
from lapak.operators.monitoring import export_files, newest_files, upload_monitor
from lapak.operators.stores import store_dimension
from lapak.plans.raw_drop import merge_drop
from lapak.sources.readers import period_filter
from lapak.sources.writers import quarantine

from .aggregates import VALID
from .registry import query, r

# The stored promotion table holds every group but those of promo 7, with older values for promo 3.
PROMO = f"""new AS (SELECT dataareaid, axcode, order_create_date, promocode, remarks, sum(cust_paid_peritem) AS cust_paid_peritem,
    CAST(sum(quantity) AS BIGINT) AS quantity FROM sales_lines WHERE {VALID} GROUP BY 1, 2, 3, 4, 5),
existing AS (SELECT axcode || '/' || strftime(order_create_date, '%Y%m%d') || '/' || promocode || '/' || dataareaid AS id, dataareaid, axcode, order_create_date, promocode, remarks,
    CASE WHEN promocode = 'P3' THEN cust_paid_peritem + 1 ELSE cust_paid_peritem END AS cust_paid_peritem,
    CASE WHEN promocode = 'P4' THEN NULL ELSE quantity END AS quantity FROM new WHERE promocode <> 'P7')"""


def promo_load(s):
    new = group_sum(valid_sales(s.sales_lines), PROMO_KEY, "cust_paid_peritem", "quantity")
    code = F.col("promocode")
    existing = new.where(code != "P7").select(
        F.concat_ws(
            "/", "axcode", F.date_format("order_create_date", "yyyyMMdd"), "promocode", "dataareaid"
        ).alias("id"),
        *PROMO_KEY,
        F.when(code == "P3", F.col("cust_paid_peritem") + 1)
        .otherwise(F.col("cust_paid_peritem"))
        .cast(new.schema["cust_paid_peritem"].dataType)
        .alias("cust_paid_peritem"),
        F.when(code != "P4", F.col("quantity")).alias("quantity"),
    )
    stamp = F.lit("2024-07-02 03:04:05").cast("timestamp")
    return upsert(existing, new, PROMO_KEY, "sales_promo", stamp=stamp)


@query(
    f"""{PROMO} SELECT e.id, e.dataareaid, e.axcode, e.order_create_date, e.promocode, e.remarks, {r('n.cust_paid_peritem')} AS cust_paid_peritem, n.quantity
    FROM existing e JOIN new n ON e.dataareaid = n.dataareaid AND e.axcode = n.axcode AND e.order_create_date = n.order_create_date
      AND e.promocode = n.promocode AND e.remarks = n.remarks""",
    "sales_lines",
)
def upsert_merged(s):
    """The existing table with changed values replaced."""
    return promo_load(s).merged


@query(
    f"{PROMO} SELECT dataareaid, axcode, order_create_date, promocode, remarks, {r('cust_paid_peritem')} AS cust_paid_peritem, quantity FROM new WHERE promocode = 'P7'",
    "sales_lines",
)
def upsert_inserts(s):
    """Rows whose key the table does not hold yet."""
    return promo_load(s).inserts


@query(
    f"""{PROMO} SELECT e.id, 'sales_promo' AS table_name, 'update' AS operation,
      CASE WHEN e.promocode = 'P3' THEN '{{"cust_paid_peritem":"' || CAST(n.cust_paid_peritem AS VARCHAR) || '"}}'
        ELSE '{{"quantity":"' || CAST(n.quantity AS VARCHAR) || '"}}' END AS changes, '2024-07-02 03:04:05' AS timestamp
    FROM existing e JOIN new n ON e.dataareaid = n.dataareaid AND e.axcode = n.axcode AND e.order_create_date = n.order_create_date
      AND e.promocode = n.promocode AND e.remarks = n.remarks WHERE e.promocode IN ('P3', 'P4')""",
    "sales_lines",
)
def upsert_change_log(s):
    """One log row per updated row, with the changed values as JSON."""
    return promo_load(s).log


@query(
    """e AS (SELECT o_orderkey, o_orderstatus AS brand, CAST(o_orderdate AS DATE) AS day, 'old' AS version FROM orders),
    n AS (SELECT o_orderkey, o_orderstatus AS brand, CAST(o_orderdate AS DATE) AS day, 'new' AS version FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P')
    SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.day = e.day AND n.brand = e.brand) UNION ALL SELECT * FROM n""".replace("e AS (", "WITH e AS (", 1),
    name="replace_by_date",
)
def _replace_by_date(s):
    """A re-delivered date replaces the rows of that date, of its own brand only."""
    days = s.orders.select("o_orderkey", F.col("o_orderstatus").alias("brand"), F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    old = days.select("o_orderkey", "brand", "day", F.lit("old").alias("version"))
    urgent = days.where("o_orderpriority = '1-URGENT' and brand <> 'P'")
    return replace_by_date(old, urgent.select("o_orderkey", "brand", "day", F.lit("new").alias("version")), "day", ["brand"])


DROP_DAY = dt.date(2000, 7, 20)


@query(
    """new AS (SELECT brand, "No. Order" AS order_no, trim("Merchant SKU") AS sku, CAST(strptime("Tanggal Order", '%d/%m/%Y %H:%M') AS DATE) AS drop_date, 'drop' AS origin
      FROM own_blibli WHERE brand <> 'SZ' AND strptime("Tanggal Order", '%d/%m/%Y %H:%M') >= DATE '2000-06-01' AND strptime("Tanggal Order", '%d/%m/%Y %H:%M') < DATE '2000-08-01'),
    old AS (SELECT brand, "No. Order" AS order_no, "Merchant SKU" AS sku, CAST(strptime("Tanggal Order", '%d/%m/%Y %H:%M') AS DATE) AS drop_date, 'table' AS origin FROM own_blibli)
    SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.drop_date = old.drop_date AND new.brand = old.brand) UNION ALL SELECT * FROM new""",
    "own_blibli",
)
def raw_drop_merge(s):
    """A daily drop of some brands merged into the raw table: open months only, replaced by date."""
    raw = s.own_blibli
    table = raw.withColumn("drop_date", F.to_date("Tanggal Order", "dd/MM/yyyy HH:mm"))
    merged = merge_drop(
        table.withColumn("origin", F.lit("table")), raw.where("brand <> 'SZ'").withColumn("origin", F.lit("drop")), "blibli", DROP_DAY
    )
    return merged.select(
        "brand", F.col("`No. Order`").alias("order_no"), F.col("`Merchant SKU`").alias("sku"), "drop_date", "origin"
    )


@query(
    """SELECT order_no, date, brand FROM online_lines
    WHERE (year(date) = 2000 AND month(date) = 12) OR (year(date) = 2001 AND month(date) = 1)""",
    "online_lines",
)
def rebuild_window(s):
    """Months to rebuild on a day early in January: December and January."""
    months = rebuild_months(dt.date(2001, 1, 4))
    keyed = s.online_lines.withColumns({"year": F.year("date"), "month": F.date_format("date", "MM")})
    return keyed.where(period_filter(months)).select("order_no", "date", "brand")


@query(
    """SELECT "Nomor Invoice" AS invoice, "Nomor SKU" AS sku, CASE WHEN "Nomor Invoice" IS NULL THEN 'invoice' ELSE '' END
      || CASE WHEN "Nomor SKU" LIKE 'X%' THEN 'sku' ELSE '' END AS reasons
    FROM raw_tokopedia WHERE "Nomor Invoice" IS NULL OR "Nomor SKU" LIKE 'X%'""",
    "raw_tokopedia",
)
def bad_rows(s):
    """Rows failing a check, with the checks they failed."""
    checks = {"invoice": F.col("`Nomor Invoice`").isNotNull(), "sku": ~F.col("`Nomor SKU`").startswith("X")}
    _, bad = quarantine(s.raw_tokopedia, checks)
    return bad.select(
        F.col("`Nomor Invoice`").alias("invoice"),
        F.col("`Nomor SKU`").alias("sku"),
        F.array_join("reasons", "").alias("reasons"),
    )


ERP = """erp AS (SELECT 'CS' || k AS mds, 'WH' || k AS wh, k AS code, s_name AS name, s_acctbal AS sqm, n_nationkey AS n, s_suppkey AS s FROM (
  SELECT *, CAST(s_suppkey AS VARCHAR) AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey))"""
PLACES = "CASE n % 5 WHEN 0 THEN 'Jawa Tengah' WHEN 1 THEN 'DKI Jakarta' WHEN 2 THEN 'Sumatera Selatan' WHEN 3 THEN 'Nusa Tenggara' ELSE 'Bali' END"
STORE_SQL = f"""{ERP},
dim AS (SELECT CASE WHEN n < 12 THEN 1 ELSE 2 END AS company_key, CASE WHEN sqm > 2000 THEN s END AS store_pos_id, CAST(NULL AS VARCHAR) AS store_dynamics_id, wh AS warehouse_key,
  CASE WHEN sqm <= 2000 THEN NULL WHEN s % 4 = 0 THEN 'Close' ELSE 'Open' END AS store_pos_status, CASE WHEN s % 2 = 0 THEN 'Open' ELSE 'Close' END AS store_dynamics_status, 'BR' AS brand_key,
  code AS store_code, CAST(NULL AS VARCHAR) AS store_invoice_code, mds AS store_mds_code, CASE s % 3 WHEN 0 THEN 'SSSG' WHEN 1 THEN 'Non SSSG' END AS store_sssg, name AS store_name,
  'OFFLINE' AS store_main_channel, 'SHOWROOM' AS store_channel, 'Indonesia' AS store_country, CASE WHEN n % 2 = 0 THEN 'NTT Timur' ELSE 'Jawa' END AS store_region, {PLACES} AS store_province,
  'Bandung-Barat' AS store_city, 'Jalan 1 Blok, ' || code AS store_address, sqm AS store_sqm,
  CASE WHEN sqm > 2000 AND s % 4 = 2 THEN 'Yes' ELSE 'No' END AS store_sync_status, 'current' AS current_status FROM erp)"""


def store_lists(s):
    n, k = F.col("n_nationkey"), F.col("s_suppkey")
    joined = s.supplier.join(s.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    code = k.cast("string")
    province = (
        F.when(n % 5 == 0, "JAWA TENGA").when(n % 5 == 1, "DKI JAKARTA").when(n % 5 == 2, "SUMATERA S")
        .when(n % 5 == 3, "NUSA TENGG").otherwise("BALI")
    )
    erp = joined.select(
        F.when(n < 12, "mpr").otherwise("mgl").alias("DataAreaId"),
        F.concat(F.lit("CS"), code).alias("MdsCode"),
        F.concat(F.lit("WH"), code).alias("Whcode"),
        code.alias("AxCode"),
        F.lit("BR").alias("Brand"),
        F.col("s_name").alias("StdName"),
        F.col("s_acctbal").alias("Sqm"),
        F.lit("OFFLINE").alias("MainChannel"),
        F.lit("SHOWROOM").alias("Channel"),
        F.when(n % 2 == 0, "NTT TIMUR").otherwise("JAWA").alias("Region"),
        province.alias("Province"),
        F.lit("KOTA BANDUNG-BARAT").alias("City"),
        F.concat(F.lit("Jalan 1 \nBlok\n"), code).alias("Address"),
        F.when(k % 2 == 0, "Open").otherwise("Close").alias("OpenStatus"),
        F.when(k % 3 == 0, 1).when(k % 3 == 1, 0).alias("Sssg"),
    )
    pos = s.supplier.where("s_acctbal > 2000").select(
        k.alias("id"), code.alias("extCode"), F.when(k % 4 == 0, 0).otherwise(1).alias("status")
    )
    return erp, pos


DIM_OUT = """company_key, store_pos_id, store_dynamics_id, warehouse_key, store_pos_status, store_dynamics_status, brand_key, store_code, store_invoice_code,
  store_mds_code, store_sssg, store_name, store_main_channel, store_channel, store_country, store_region, store_province, store_city, store_address"""


@query(
    f"""WITH {STORE_SQL} SELECT {DIM_OUT}, {r('store_sqm')} AS store_sqm, store_sync_status, current_status FROM dim""",
    name="store_dim",
)
def _store_dim(s):
    """Store dimension from the ERP and POS lists."""
    return store_dimension(*store_lists(s))


VERSIONS = f"""{STORE_SQL},
base AS (SELECT *, DATE '2024-01-01' AS start_date, CAST(NULL AS DATE) AS end_date, 'k' || store_code AS x FROM dim WHERE brand_key = 'BR' AND store_sssg IS DISTINCT FROM 'SSSG'),
ex AS (SELECT CAST(store_code AS BIGINT) AS code_no, store_code, CASE WHEN store_pos_status = 'Open' THEN 'Old name' ELSE store_name END AS store_name, store_pos_status, start_date, end_date FROM base)"""


@query(
    f"""WITH {VERSIONS}
    SELECT store_code, store_name, store_pos_status, start_date, CASE WHEN store_name = 'Old name' THEN DATE '2024-07-02' END AS end_date,
      CASE WHEN store_name = 'Old name' THEN 'previous' ELSE 'current' END AS current_status FROM ex
    UNION ALL SELECT store_code, store_name, store_pos_status, DATE '2024-07-02', NULL, 'current' FROM dim
      WHERE store_sssg = 'SSSG' OR store_pos_status = 'Open'""",
)
def store_scd2(s):
    """Next version of the store dimension: closed, opened, new and unchanged stores."""
    dim = store_dimension(*store_lists(s)).select("store_code", "store_name", "store_pos_status", "store_sssg")
    first = F.lit(dt.date(2024, 1, 1))
    existing = dim.where(~F.col("store_sssg").eqNullSafe("SSSG")).select(
        F.col("store_code").cast("bigint").alias("store_key"),
        "store_code",
        F.when(F.col("store_pos_status") == "Open", F.lit("Old name")).otherwise(F.col("store_name")).alias("store_name"),
        "store_pos_status",
        first.alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        first.alias("create_date"),
        first.alias("update_date"),
        F.lit("current").alias("current_status"),
    )
    versions = store_versions(existing, dim.drop("store_sssg"), F.lit(dt.date(2024, 7, 2)))
    return versions.drop("store_key", "create_date", "update_date")


INVENTORY = """inv AS (SELECT 'e-commerce/raw/' || CASE event_type WHEN 'view' THEN 'SZ' WHEN 'click' THEN 'MN' ELSE 'MC' END || '/2024/January/'
  || CASE user_id % 3 WHEN 0 THEN 'shopee' WHEN 1 THEN 'tik-tok' ELSE 'LAZADA' END || '_January_' || CAST(event_id AS VARCHAR) || CASE WHEN event_type = 'error' THEN '.txt' ELSE '.csv' END AS path,
  ts AS modified, event_id, event_type, user_id FROM events)"""


def inventory(s):
    brand = F.when(F.col("event_type") == "view", "SZ").when(F.col("event_type") == "click", "MN").otherwise("MC")
    market = F.when(F.col("user_id") % 3 == 0, "shopee").when(F.col("user_id") % 3 == 1, "tik-tok").otherwise("LAZADA")
    ending = F.when(F.col("event_type") == "error", ".txt").otherwise(".csv")
    return s.events.select(
        F.concat(
            F.lit("e-commerce/raw/"), brand, F.lit("/2024/January/"), market, F.lit("_January_"),
            F.col("event_id").cast("string"), ending,
        ).alias("path"),
        F.col("ts").alias("modified"),
    )


@query(
    f"""WITH {INVENTORY},
    f AS (SELECT path, string_split(path, '/')[3] AS brand, string_split(path, '/')[5] AS month, string_split(path, '/')[6] AS files,
      CASE user_id % 3 WHEN 0 THEN 'Shopee' WHEN 1 THEN 'Tiktok' ELSE 'Lazada' END AS ecommerce, date_trunc('minute', modified + INTERVAL 7 HOUR) AS up
      FROM inv WHERE path LIKE '%.csv' OR path LIKE '%.xlsx')
    SELECT path, brand, month, files, ecommerce, strftime(up, '%Y-%m-%d %H:%M') AS last_upload,
      CASE WHEN CAST(up AS DATE) < DATE '2024-01-20' THEN 'Not Up To Date' ELSE 'Up To Date' END AS check_upload,
      CASE WHEN CAST(up AS DATE) = DATE '2024-01-20' AND strftime(up, '%H:%M') <= '10:00' THEN 'Ontime' ELSE 'Late' END AS is_late,
      count(*) OVER w AS total_files, CASE WHEN count(*) OVER w > 1 THEN 'Duplicated' ELSE 'Not Duplicated' END AS is_duplicated
    FROM f WINDOW w AS (PARTITION BY month, brand, ecommerce)""",
    name="upload_monitor",
)
def _upload_monitor(s):
    """Uploads that are late, out of date or duplicated."""
    return upload_monitor(inventory(s), dt.datetime(2024, 1, 20, 12)).drop(
        "year", "modified", "last_upload_date", "last_upload_time"
    )


@query(
    f"""WITH {INVENTORY}, f AS (SELECT path, string_split(path, '/')[3] AS brand, CASE user_id % 3 WHEN 0 THEN 'Shopee' WHEN 1 THEN 'Tiktok' ELSE 'Lazada' END AS marketplace, modified FROM inv WHERE path LIKE '%.csv')
    SELECT brand, marketplace, path, strftime(modified + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS modified FROM (
      SELECT *, row_number() OVER (PARTITION BY brand, marketplace ORDER BY modified DESC, path DESC) AS n FROM f) WHERE n = 1""",
    name="newest_files",
)
def _newest_files(s):
    """Newest file per brand and marketplace."""
    files = export_files(inventory(s)).select(
        "brand", F.col("ecommerce").alias("marketplace"), "path", "modified"
    )
    return newest_files(files)
