"""Marketplace normalisation, sale status, online detail, product master upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapak.operators.marketplaces import (
    PRICE_COLUMNS,
    normalise,
    normalise_all,
    processed_matcher,
    staging_matcher,
)
from lapak.operators.products import (
    active_items,
    refresh_cost,
    refresh_online,
    repair_cost,
)
from lapak.operators.status import margin_rate, sale_status
from lapak.plans.online_detail import (
    ONLINE_LINE,
    add_product_group,
    online_sales_detail,
)

from .joins import cascade_code, cascade_joins, cascade_pick
from .registry import query, r
from .shapes import RAW

SHOWN = (
    "brand", "marketplace", "date", "ship_date", "delivered_date", "order_status", "sub_status",
    "cancel_status", "cancel_reason", "cancel_by", "order_no", "courier", "tracking_no",
    "recipient_name", "recipient_phone", "recipient_address", "recipient_district",
    "recipient_city", "recipient_postcode", "barcode", "codebars", "itemid", "subcategory",
    "qty_sold",
)
AMOUNTS = ("hpp", *PRICE_COLUMNS)


def col(name: str) -> str:
    return f'"{name}"'


def dotted(name: str, prefix: str = "") -> str:
    text = f"replace(replace({col(name)}, '{prefix}', ''), '.', '')" if prefix else f"replace({col(name)}, '.', '')"
    return f"CAST({text} AS BIGINT)"


def plain(name: str) -> str:
    return f"CAST({col(name)} AS DECIMAL(18,2))"


def iso(name: str) -> str:
    return f"CAST(try_strptime(substr({col(name)}, 1, 10), '%Y-%m-%d') AS DATE)"


def day(name: str, *formats: str) -> str:
    parts = [f"try_strptime({col(name)}, '{f}')" for f in formats]
    return f"CAST(COALESCE({', '.join(parts)}) AS DATE)"


NULL_TEXT, NULL_DATE = "CAST(NULL AS VARCHAR)", "CAST(NULL AS DATE)"

# Per marketplace: text and parsed columns over the export, then prices over the matched line.
# ``b`` is the basic price of the product match.
SPECS: dict[str, dict] = {
    "shopee": {
        "text": {
            "date": iso("Waktu Pesanan Dibuat"), "ship_date": iso("Waktu Pengiriman Diatur"),
            "delivered_date": iso("Waktu Pesanan Selesai"), "order_status": 'upper("Status Pesanan")',
            "sub_status": col("Status Pembatalan/ Pengembalian"), "cancel_reason": col("Alasan Pembatalan"),
            "order_no": col("No. Pesanan"), "courier": col("Opsi Pengiriman"), "tracking_no": col("No. Resi"),
            "recipient_name": col("Nama Penerima"), "recipient_phone": col("No. Telepon"),
            "recipient_address": col("Alamat Pengiriman"), "recipient_district": col("Provinsi"),
            "recipient_city": col("Kota/Kabupaten"),
            "barcode": """CASE WHEN "Nomor Referensi SKU" LIKE chr(10) || '%' THEN replace("Nomor Referensi SKU", chr(10), '')
              ELSE string_split("Nomor Referensi SKU", chr(10))[1] END""",
            "qty_sold": 'CAST("Jumlah" AS INT)', "in_order": 'CAST("Jumlah Produk di Pesan" AS INT)',
            "p": dotted("Harga Awal"), "ed": dotted("Total Diskon"), "su": dotted("Diskon Dari Shopee"),
            "sv": dotted("Voucher Ditanggung Penjual"), "fee": dotted("Ongkos Kirim Dibayar oleh Pembeli"),
            "cut": dotted("Estimasi Potongan Biaya Pengiriman"), "fr": dotted("Perkiraan Ongkos Kirim"),
        },
        "prices": {
            "basic_price": "p", "subsidy": "su", "voucher": "sv / in_order", "existing_basic_price": "p * qty_sold",
            "discount": "ed / qty_sold", "existing_voucher": "sv / in_order * qty_sold",
            "net_sales": "p - ed / qty_sold", "existing_net_sales": "p * qty_sold - ed", "existing_discount": "ed",
            "delivery_fee": "fee / in_order * qty_sold",
            "value_after_voucher": "p * qty_sold - ed - sv / in_order * qty_sold + su",
        },
        "staging": {
            "value_after_voucher": "p * qty_sold - ed - sv / in_order * qty_sold + su + fee / in_order * qty_sold + cut / in_order * qty_sold - fr / in_order * qty_sold",
        },
    },
    "lazada": {
        "text": {
            "date": f"COALESCE({iso('createTime')}, {day('createTime', '%d %m %Y %H:%M:%S', '%d %b %Y %H:%M')})",
            "ship_date": f"COALESCE({iso('updateTime')}, {day('updateTime', '%d %m %Y %H:%M:%S', '%d %b %Y %H:%M')})",
            "delivered_date": iso("deliveredDate"), "order_status": "upper(status)",
            "cancel_status": 'upper("buyerFailedDeliveryReturnInitiator")', "cancel_reason": col("buyerFailedDeliveryReason"),
            "order_no": col("orderNumber"), "courier": col("shippingProvider"), "tracking_no": col("trackingCode"),
            "recipient_name": col("customerName"), "recipient_address": col("shippingAddress"),
            "recipient_city": col("shippingCity"), "recipient_postcode": col("shippingPostCode"),
            "barcode": "CASE WHEN \"sellerSku\" = '7297014564-1699015393637-1' THEN '8990100029488' ELSE \"sellerSku\" END",
            "qty_sold": "1", "n": plain("unitPrice"), "v": 'abs(COALESCE(CAST("sellerDiscountTotal" AS DECIMAL(18,2)), 0))',
            "fee": plain("shippingFee"),
        },
        "prices": {
            "basic_price": "b", "net_sales": "n", "voucher": "v", "discount": "b - n", "existing_basic_price": "b",
            "existing_discount": "b - n", "existing_net_sales": "n", "existing_voucher": "v",
            "value_after_voucher": "n - v", "delivery_fee": "fee",
        },
    },
    "tiktok": {
        "text": {
            **{c: f"CAST(try_strptime(replace({col(n)}, chr(9), ''), '%d/%m/%Y %H:%M:%S') AS DATE)" for c, n in (
                ("date", "Created Time"), ("ship_date", "Shipped Time"), ("delivered_date", "Delivered Time"))},
            "order_status": 'upper("Order Status")', "sub_status": col("Order Substatus"),
            "cancel_status": col("Cancelation/Return Type"), "cancel_by": col("Cancel By"), "cancel_reason": col("Cancel Reason"),
            "order_no": col("Order ID"), "courier": col("Shipping Provider Name"), "tracking_no": col("Tracking ID"),
            "recipient_name": col("Recipient"), "recipient_phone": col("Phone #"),
            "recipient_address": "replace(\"Detail Address\", '=', '')", "recipient_district": col("Districts"),
            "recipient_city": col("Regency and City"), "recipient_postcode": col("Zipcode"),
            "barcode": "string_split(\"Seller SKU\", '.')[1]", "qty_sold": 'CAST("Quantity" AS INT)',
            "p": dotted("SKU Unit Original Price", "IDR "), "eb": dotted("SKU Subtotal Before Discount", "IDR "),
            "en": dotted("SKU Subtotal After Discount", "IDR "), "ed": dotted("SKU Seller Discount", "IDR "),
            "su": f"COALESCE({dotted('SKU Platform Discount', 'IDR ')}, 0)", "fee": dotted("Shipping Fee After Discount", "IDR "),
        },
        "prices": {
            "basic_price": "p", "existing_basic_price": "eb", "existing_net_sales": "en", "existing_discount": "ed",
            "subsidy": "su", "delivery_fee": "fee", "voucher": "0", "existing_voucher": "0",
            "discount": "ed / NULLIF(qty_sold, 0)", "net_sales": "en / NULLIF(qty_sold, 0)", "value_after_voucher": "en + su",
        },
    },
    "tokopedia": {
        "where": '"Nomor Invoice" IS NOT NULL',
        "text": {
            "date": day("Tanggal Pembayaran", "%d-%m-%Y %H:%M:%S"), "ship_date": day("Tanggal Pengiriman Barang", "%d-%m-%Y"),
            "delivered_date": day("Tanggal Pesanan Selesai", "%d-%m-%Y"),
            "order_status": "upper(string_split(\"Status Terakhir\", ' -' || chr(10))[1])",
            "cancel_reason": "CASE WHEN \"Status Terakhir\" LIKE '%-%' THEN 'Stok habis' ELSE '' END",
            "order_no": col("Nomor Invoice"), "courier": col("Nama Kurir"), "tracking_no": col("No Resi / Kode Booking"),
            "recipient_name": col("Nama Penerima"), "recipient_phone": col("No Telp Penerima"),
            "recipient_address": col("Alamat Pengiriman"), "recipient_district": col("Provinsi"), "recipient_city": col("Kota"),
            "barcode": col("Nomor SKU"), "qty_sold": 'CAST("Jumlah Produk Dibeli" AS INT)', "p": plain("Harga Awal (IDR)"),
            "n": plain("Harga Jual (IDR)"), "su": plain("Jumlah Subsidi Tokopedia (IDR)"), "tv": plain("Nilai Kupon Toko Terpakai (IDR)"),
        },
        "prices": {
            "basic_price": "p", "net_sales": "n", "subsidy": "su", "voucher": "tv / qty_sold", "discount": "p - n",
            "existing_basic_price": "p * qty_sold", "existing_discount": "(p - n) * qty_sold",
            "existing_voucher": "tv / qty_sold * qty_sold", "existing_net_sales": "p * qty_sold - (p - n) * qty_sold",
            "value_after_voucher": "p * qty_sold - (p - n) * qty_sold - tv / qty_sold * qty_sold + su",
        },
        "staging": {
            "voucher": "ov", "existing_voucher": "ov * qty_sold",
            "value_after_voucher": "p * qty_sold - (p - n) * qty_sold - ov * qty_sold",
        },
        "staging_extra": ", avg(CAST(tv AS DOUBLE)) OVER (PARTITION BY brand, order_no) / sum(qty_sold) OVER (PARTITION BY brand, order_no) AS ov",
    },
    "zalora": {
        "text": {
            "date": iso("Created at"), "delivered_date": iso("Updated at"), "order_status": 'upper("Status")',
            "cancel_reason": col("Reason"), "order_no": col("Order Number"), "courier": col("Shipping Provider"),
            "tracking_no": col("Tracking Code"), "recipient_name": col("Shipping Name"),
            "recipient_phone": col("Shipping Phone Number2"), "recipient_address": col("Shipping Address"),
            "recipient_district": col("Shipping Region"), "recipient_city": col("Shipping City"),
            "recipient_postcode": col("Shipping Postcode"), "barcode": col("Seller SKU"), "qty_sold": "1",
            "n": plain("Unit Price"), "fee": plain("Shipping Fee"),
            "v": f"{plain('Unit Price')} - {plain('Paid Price')} - {plain('Store Credits')} - {plain('Wallet Credits')}",
        },
        "prices": {
            "basic_price": "b", "net_sales": "n", "voucher": "v", "delivery_fee": "fee", "existing_voucher": "v",
            "discount": "b - n", "existing_basic_price": "b", "existing_discount": "b - n",
            "existing_net_sales": "b - (b - n)", "value_after_voucher": "b - (b - n) - v",
        },
    },
    "blibli": {
        "text": {
            "date": day("Tanggal Order", "%d/%m/%Y %H:%M"), "order_status": 'upper("Order Status")',
            "order_no": "string_split(\"No. Order\", '\"')[2]", "courier": col("Servis Logistik"), "tracking_no": col("No. Awb"),
            "barcode": "CASE WHEN \"Merchant SKU\" LIKE '%\"%' THEN string_split(\"Merchant SKU\", '\"')[2] ELSE \"Merchant SKU\" END",
            "qty_sold": 'CAST("Total Barang" AS INT)', "p": plain("Harga item pesanan"), "eb": plain("Total harga item pesanan"),
            "dc": plain("Diskon"), "v": plain("Voucher seller"),
        },
        "prices": {
            "basic_price": "p", "existing_basic_price": "eb", "discount": "dc", "voucher": "abs(v)", "net_sales": "p - dc",
            "existing_discount": "dc * qty_sold", "existing_net_sales": "eb - dc * qty_sold", "existing_voucher": "abs(v) * qty_sold",
            "value_after_voucher": "eb - dc * qty_sold - abs(v) * qty_sold",
        },
        "staging": {
            "voucher": "v", "existing_voucher": "v * qty_sold", "value_after_voucher": "eb - dc * qty_sold - v * qty_sold",
        },
    },
    "shopify": {
        "text": {
            "date": "CAST(substr(created, 1, 10) AS DATE)", "ship_date": "CAST(substr(fulfilled, 1, 10) AS DATE)",
            "order_status": "upper(financial)", "sub_status": "upper(fulfillment)", "order_no": "reference || name",
            "recipient_name": "ship_name", "recipient_phone": "phone", "recipient_address": "street",
            "recipient_district": "province", "recipient_city": "city", "recipient_postcode": "zip", "barcode": "sku",
            "qty_sold": "qty", "n": "price", "v": "CAST(discount AS DOUBLE) / in_order",
        },
        "prices": {
            "basic_price": "b", "net_sales": "n", "voucher": "v", "existing_net_sales": "n * qty_sold",
            "existing_basic_price": "b * qty_sold", "existing_voucher": "v * qty_sold", "discount": "b - n",
            "existing_discount": "(b - n) * qty_sold", "value_after_voucher": "n * qty_sold - v * qty_sold",
        },
    },
}

SHOPIFY_SOURCE = """
shopify_rows AS (SELECT brand, "Name" AS name, "Created at" AS created, "Fulfilled at" AS fulfilled, COALESCE("Email", '') AS email,
  "Financial Status" AS financial, "Fulfillment Status" AS fulfillment, "Payment Reference" AS reference,
  "Shipping Name" AS ship_name, "Shipping Phone" AS phone, "Shipping Street" AS street,
  COALESCE("Shipping Province Name", '') AS province, "Shipping City" AS city, "Shipping Zip" AS zip,
  CAST("Discount Amount" AS DECIMAL(18,2)) AS discount, CAST("Lineitem quantity" AS INT) AS qty,
  CAST("Lineitem price" AS DECIMAL(18,2)) AS price, string_split("Lineitem sku", '.')[1] AS sku FROM {raw}),
shopify_heads AS (SELECT brand, created, fulfilled, name, email, financial, fulfillment, reference, ship_name, phone, street, province,
  city, zip, sum(discount) AS discount FROM shopify_rows WHERE created IS NOT NULL AND fulfilled IS NOT NULL GROUP BY ALL),
shopify_sums AS (SELECT brand, name, sum(qty) AS in_order FROM shopify_rows GROUP BY 1, 2),
shopify_joined AS (SELECT l.qty, l.price, l.sku, h.*, t.in_order FROM shopify_heads h
  JOIN shopify_sums t ON t.brand = h.brand AND t.name = h.name
  JOIN shopify_rows l ON l.brand = h.brand AND l.name = h.name),
"""


def normal_sql(marketplace: str, raw: str, variant: str = "processed") -> str:
    """CTE ``norm_<marketplace>`` over the export ``raw``, with the cascade as plain left joins."""
    spec = SPECS[marketplace]
    text = spec["text"]
    prices = {**spec["prices"], **(spec.get("staging", {}) if variant == "staging" else {})}
    names = {**text, "brand": "brand"}
    source, before = raw, ""
    if marketplace == "shopify":
        source, before = "shopify_joined", SHOPIFY_SOURCE.replace("{raw}", raw)
    parsed = ", ".join(f"{sql} AS {n}" for n, sql in names.items())
    where = f"WHERE {spec['where']}" if "where" in spec else ""
    extra = spec.get("staging_extra", "") if variant == "staging" else ""
    helpers = {n for n in text if n not in SHOWN}
    as_double = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in helpers)
    second = "k.brand = 'SZ'"
    if variant == "staging":
        joins = """LEFT JOIN prod a1 ON a1.dataareaid = CASE WHEN k.brand = 'SZ' THEN 'mgl' ELSE 'mpr' END AND a1.codebars = k.barcode
          LEFT JOIN prod a2 ON a2.dataareaid = CASE WHEN k.brand = 'SZ' THEN 'mgl' ELSE 'mpr' END AND a2.codebars = '0' || k.barcode"""
        pick = lambda c: f"COALESCE(a1.{c}, a2.{c})"
        code, shown_code = pick("codebars"), "k.barcode"
    else:
        joins, pick = cascade_joins("k", "barcode"), cascade_pick
        code = cascade_code("k", "barcode")
        shown_code = f"CASE WHEN {second} THEN k.barcode ELSE {code} END"
    empty = {
        c: (NULL_DATE if c.endswith("date") else "CAST(NULL AS VARCHAR)")
        for c in SHOWN
        if c not in text and c not in ("brand", "marketplace", "codebars", "itemid", "subcategory")
    }
    kept = ", ".join(
        [f"k.{c}" for c in SHOWN if c in text and c not in ("barcode",)]
        + [f"{v} AS {c}" for c, v in empty.items()]
    )
    values = ", ".join(f"CAST({prices.get(c, 'NULL')} AS DOUBLE) AS {c}" for c in PRICE_COLUMNS if c != "existing_hpp")
    outer = ", ".join(c for c in SHOWN if c != "marketplace")
    m = marketplace
    return f"""{before}
    parsed_{m} AS (SELECT {parsed} FROM {source} {where}),
    keyed_{m} AS (SELECT * REPLACE ({as_double}){extra} FROM parsed_{m}),
    hit_{m} AS (SELECT {kept}, k.brand, {shown_code} AS barcode, {code} AS codebars, {pick('itemid')} AS itemid,
      {pick('subcategory')} AS subcategory, CAST({pick('hpp')} AS DOUBLE) AS hpp, CAST({pick('basicprice')} AS DOUBLE) AS b,
      {', '.join(f'k.{h}' for h in helpers)}{', k.ov' if extra else ''} FROM keyed_{m} k {joins}),
    norm_{m} AS (SELECT {outer}, '{m.upper()}' AS marketplace, hpp, {values}, hpp * qty_sold AS existing_hpp FROM hit_{m})"""


STAGING_PROD = """prod AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataareaid, codebars
  ORDER BY pulldate DESC, modifieddatetime DESC, recid DESC) AS n FROM products WHERE pullstatus = 'Current') WHERE n = 1)"""


def exported(s, raw: str):
    """An export as ``read_export`` returns it, its lines spread: before their texts are made, while they are short."""
    return getattr(s.spread("lineitem"), raw)


def _register(marketplace: str) -> None:
    shown = f"{', '.join(SHOWN)}, {', '.join(f'{r(c)} AS {c}' for c in AMOUNTS)}"
    raw = f"raw_{marketplace}"

    @query(
        f"{normal_sql(marketplace, raw)} SELECT {shown} FROM norm_{marketplace}",
        f"{raw} match_items",
        name=f"normalise_{marketplace}",
    )
    def run(s):
        match = processed_matcher(s.match_items)
        return normalise(marketplace, exported(s, raw), match).select(*SHOWN, *AMOUNTS)

    @query(
        f"{STAGING_PROD}, {normal_sql(marketplace, raw, 'staging')} SELECT {shown} FROM norm_{marketplace}",
        f"{raw} products",
        name=f"normalise_{marketplace}_staging",
    )
    def run_staging(s):
        match = staging_matcher(s.products)
        return normalise(marketplace, exported(s, raw), match, "staging").select(*SHOWN, *AMOUNTS)


for _m in RAW:
    _register(_m)

STATUSES = (
    "BATAL", "CANCELED", "COMPLETED", "CONFIRMED", "DELIVERED", "DELIVERY FAILED", "DIBATALKAN PEMBELI",
    "DIBATALKAN PENJUAL [PERMINTAAN PEMBELI]", "DIBATALKAN SISTEM", "EXPIRED", "IN TRANSIT: RETURNING TO SELLER",
    "ORDER BATAL", "PACKAGE RETURNED", "RETURNED", "PAID", "PESANAN SELESAI", "PESANAN TIBA", "SELESAI",
    "BELUM BAYAR", "TERKIRIM", "UNPAID", "SHIPPED", "LOST BY 3PL", "SEDANG DIKIRIM",
)
STATUS_SOURCE = f"""raw AS (SELECT ok, ln, sku, qty, ([{', '.join(f"'{x}'" for x in STATUSES)}])[CAST(suppkey % {len(STATUSES)} AS INT) + 1] AS status,
  CASE rf WHEN 'A' THEN 'UNFULFILLED' WHEN 'N' THEN 'DELIVERED' ELSE 'PERMINTAAN DISETUJUI' END AS sub,
  CASE WHEN ls = 'F' THEN NULL WHEN tax < 4 THEN 'CANCEL-BUYER' ELSE 'SELLER' END AS cancel FROM online_base)"""


@query(
    f"""{STATUS_SOURCE}
    SELECT ok, ln, sku, qty, status, CASE
      WHEN status IN ('PESANAN SELESAI', 'PESANAN TIBA', 'TERKIRIM') THEN 'DELIVERED'
      WHEN status = 'SEDANG DIKIRIM' THEN 'ONPROGRESS'
      WHEN status IN ('COMPLETED', 'DELIVERED') THEN CASE WHEN cancel IS NULL THEN 'DELIVERED' ELSE 'CANCELED' END
      WHEN status = 'CONFIRMED' THEN CASE WHEN cancel = 'SELLER' THEN 'CANCELED' ELSE 'DELIVERED' END
      WHEN status = 'PAID' THEN CASE WHEN sub = 'UNFULFILLED' THEN 'ONPROGRESS' ELSE 'DELIVERED' END
      WHEN status = 'SELESAI' THEN CASE WHEN sub = 'PERMINTAAN DISETUJUI' THEN 'CANCELED' ELSE 'DELIVERED' END
      WHEN status = 'SHIPPED' THEN CASE WHEN sub = 'DELIVERED' THEN 'DELIVERED' WHEN cancel = 'SELLER' THEN 'CANCELED' ELSE 'ONPROGRESS' END
      ELSE 'CANCELED' END AS sales_status FROM raw""",
    "online_base",
    name="sale_status",
)
def _sale_status(s):
    """Every raw status with every sub-status and cancellation."""
    rf, ls = F.col("rf"), F.col("ls")
    status = F.get(F.array(*[F.lit(x) for x in STATUSES]), (F.col("suppkey") % len(STATUSES)).cast("int"))
    sub = F.when(rf == "A", "UNFULFILLED").when(rf == "N", "DELIVERED").otherwise("PERMINTAAN DISETUJUI")
    cancel = F.when(ls == "F", F.lit(None)).when(F.col("tax") < 4, "CANCEL-BUYER").otherwise("SELLER")
    lines = s.online_base.select("ok", "ln", "sku", "qty", status.alias("status"), sub.alias("sub"), cancel.alias("cancel"))
    return lines.withColumn(
        "sales_status", sale_status(F.col("status"), F.col("sub"), F.col("cancel"))
    ).drop("sub", "cancel")


@query(
    f"""SELECT l.brand, l.marketplace, l.order_no, l.codebars, l.date,
      {r("CASE WHEN l.marketplace = 'TIKTOK' AND month(l.date) >= 5 THEN 0.065::DOUBLE ELSE m.margin_pct END")} AS margin_pct
    FROM online_lines l LEFT JOIN (SELECT brand, CASE marketplace WHEN 'WEBSITE' THEN 'SHOPIFY' WHEN 'TIK-TOK' THEN 'TIKTOK'
      ELSE marketplace END AS marketplace, margin_pct FROM margins) m ON l.brand = m.brand AND l.marketplace = m.marketplace""",
    "online_lines margins",
)
def margin_lookup(s):
    """Margin by brand and marketplace with one dated override."""
    lines = s.online_lines.select("brand", "marketplace", "order_no", "codebars", "date")
    return margin_rate(lines, s.margins)


@query(
    """SELECT dataareaid, itemid, codebars, stopped, recid FROM (
      SELECT i.dataareaid, i.itemid, i.codebars, i.recid, i.pulldate, COALESCE(t.stopped, 0) AS stopped,
        row_number() OVER (PARTITION BY i.dataareaid, i.codebars ORDER BY i.pulldate DESC, i.recid DESC) AS n
      FROM legacy_items i LEFT JOIN item_stops t ON t.dataareaid = i.dataareaid AND t.itemid = i.itemid
      WHERE COALESCE(t.stopped, 0) = 0) WHERE n = 1""",
    "legacy_items item_stops",
    name="active_items",
)
def _active_items(s):
    """Legacy items that are not stopped, last row per barcode."""
    stops = s.item_stops.withColumn("inventdimid", F.lit(None).cast("string"))
    return active_items(s.legacy_items, stops, ["pulldate", "recid"]).select(
        "dataareaid", "itemid", "codebars", "stopped", "recid"
    )


@query(
    f"""ax AS (SELECT dataareaid, codebars, hpp FROM (SELECT *, row_number() OVER (PARTITION BY dataareaid, codebars
        ORDER BY pulldate DESC, recid DESC) AS n FROM legacy_items) WHERE n = 1),
    mp AS (SELECT codebars, hpp FROM (SELECT *, row_number() OVER (PARTITION BY codebars ORDER BY pulldate, recid) AS n
        FROM products WHERE pullstatus = 'Current' AND dataareaid = 'mpr') WHERE n = 1),
    a AS (SELECT p.dataareaid, p.recid, p.codebars, p.umbrellabrand, p.pullstatus, CASE WHEN p.pullstatus = 'Current' THEN COALESCE(CASE WHEN ax.hpp > 430 THEN ax.hpp ELSE 0 END, 0) ELSE 0 END AS hppax, p.hpp
      FROM products p LEFT JOIN ax ON ax.dataareaid = p.dataareaid AND ax.codebars = p.codebars),
    b AS (SELECT *, CASE WHEN pullstatus = 'Current' AND hpp = 0 THEN hppax ELSE hpp END AS h FROM a),
    c AS (SELECT b.*, mp.hpp AS first_hpp FROM b LEFT JOIN mp ON mp.codebars = b.codebars)
    SELECT dataareaid, recid, codebars, {r('hppax')} AS hppax, {r('''CASE WHEN pullstatus = 'Current' AND dataareaid = 'mgl'
      AND umbrellabrand IN ('Minimal', 'Manzone') AND h = 0
      THEN CAST(COALESCE(first_hpp, 0) * CAST(1.03 AS DECIMAL(4,2)) AS DECIMAL(18,2)) ELSE h END''')} AS hpp FROM c""",
    "products legacy_items",
)
def master_cost_repair(s):
    """Zero costs filled from the legacy table, then from the first company plus 3 %."""
    cheap = F.when(F.col("hpp") > 430, F.col("hpp")).otherwise(F.lit(0)).cast("decimal(18,2)")
    legacy = s.legacy_items.withColumn("hpp", cheap)
    return repair_cost(s.products, legacy).select("dataareaid", "recid", "codebars", "hppax", "hpp")


@query(
    f"""one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataareaid, codebars ORDER BY itemid, pulldate, recid) AS n FROM legacy_items) WHERE n = 1)
    SELECT p.dataareaid, p.recid, p.codebars, {r('CASE WHEN p.hpp = 0 THEN COALESCE(o.hpp, 0) ELSE p.hpp END')} AS hpp
    FROM products p LEFT JOIN one o ON o.dataareaid = p.dataareaid AND o.codebars = p.codebars""",
    "products legacy_items",
)
def line_cost_refresh(s):
    """Zero costs replaced by the legacy cost of the same company and barcode."""
    lines = s.products.select("dataareaid", "recid", "codebars", "hpp")
    return refresh_cost(lines, s.legacy_items.select("dataareaid", "codebars", "itemid", "hpp"))


REFRESH_PROD = """newprod AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataareaid, codebars ORDER BY pulldate DESC, recid DESC) AS m
  FROM (SELECT *, row_number() OVER (PARTITION BY dataareaid, variantnumber ORDER BY pulldate DESC, recid DESC) AS n
    FROM products WHERE pullstatus = 'Current') WHERE n = 1) WHERE m = 1)"""


@query(
    f"""{REFRESH_PROD},
    j AS (SELECT l.brand, l.order_no, l.codebars, l.qty_sold, p.itemid, p.subcategory,
      CASE WHEN p.hpp = 0 THEN l.hpp ELSE p.hpp END AS hpp FROM online_lines l LEFT JOIN newprod p
      ON p.dataareaid = CASE WHEN l.brand = 'SZ' THEN 'mgl' ELSE 'mpr' END AND p.codebars = l.codebars)
    SELECT brand, order_no, codebars, qty_sold, itemid, subcategory, {r('hpp')} AS hpp, {r('hpp * qty_sold')} AS existing_hpp FROM j""",
    "online_lines products",
)
def online_product_refresh(s):
    """Online lines brought to the current master of their company."""
    lines = s.online_lines.select("brand", "order_no", "codebars", "qty_sold", "hpp", "subcategory")
    return refresh_online(lines, s.products).select(
        "brand", "order_no", "codebars", "qty_sold", "itemid", "subcategory", "hpp", "existing_hpp"
    )


MARKETS = tuple(RAW)


def cents(c: str) -> str:
    return f"round_even(CAST(COALESCE({c}, 0) AS DECIMAL(28,8)), 2) AS {c}"


def units(c: str) -> str:
    return f"CAST(round_even(CAST({c} AS DECIMAL(28,8)), 0) AS DOUBLE) AS {c}"


UNITS = (
    "basic_price", "discount", "voucher", "net_sales", "hpp", "existing_basic_price", "existing_discount",
    "existing_voucher", "existing_net_sales", "value_after_voucher", "existing_hpp",
)
DETAIL_TEXT = (
    "itemid", "umbrellabrand", "alucode", "season", "world", "category", "yearmonth",
)

DETAIL_SQL = f"""{', '.join(normal_sql(m, f'own_{m}') for m in MARKETS)},
lines AS ({' UNION ALL BY NAME '.join(f'SELECT * FROM norm_{m}' for m in MARKETS)}),
{REFRESH_PROD},
ref AS (SELECT l.* EXCLUDE (itemid, subcategory, hpp, existing_hpp), p.itemid, p.umbrellabrand, p.alucode, p.season, p.world, p.category,
  p.subcategory, p.monthyear AS yearmonth, CASE WHEN p.hpp = 0 THEN l.hpp ELSE CAST(p.hpp AS DOUBLE) END AS hpp
  FROM lines l LEFT JOIN newprod p ON p.dataareaid = CASE WHEN l.brand = 'SZ' THEN 'mgl' ELSE 'mpr' END AND p.codebars = l.codebars),
cents AS (SELECT * REPLACE ({', '.join(cents(c) for c in (*UNITS[:4], 'hpp', *UNITS[5:10], 'subsidy', 'delivery_fee'))}),
  round_even(CAST(COALESCE(hpp * qty_sold, 0) AS DECIMAL(28,8)), 2) AS existing_hpp FROM ref),
clean AS (SELECT * REPLACE (upper(COALESCE(sub_status, '')) AS sub_status, COALESCE(cancel_status, '') AS cancel_status,
  COALESCE(cancel_reason, '') AS cancel_reason, COALESCE(cancel_by, '') AS cancel_by, COALESCE(courier, '') AS courier,
  regexp_replace(COALESCE(tracking_no, ''), '[^a-zA-Z0-9]', '', 'g') AS tracking_no,
  regexp_replace(COALESCE(recipient_name, ''), '[^a-zA-Z0-9\\s]', '', 'g') AS recipient_name,
  COALESCE(recipient_address, '') AS recipient_address, COALESCE(recipient_district, '') AS recipient_district,
  COALESCE(recipient_city, '') AS recipient_city, COALESCE(subcategory, '') AS subcategory,
  replace(replace(COALESCE(recipient_postcode, ''), '.0', ''), '''', '') AS recipient_postcode),
  regexp_replace(COALESCE(recipient_phone, ''), '[^a-zA-Z0-9]', '', 'g') AS ph FROM cents),
phoned AS (SELECT * EXCLUDE (ph, recipient_phone), CASE WHEN ph LIKE '62%' THEN '0' || substr(ph, 3) WHEN ph LIKE '0%' THEN ph ELSE '0' || ph END AS ph,
  strftime(date, '%B') AS month_report, strftime(date, '%m') AS monthnum,
  CASE WHEN order_status IN ('BATAL', 'CANCELED', 'DELIVERY FAILED', 'DIBATALKAN PEMBELI', 'ORDER BATAL', 'RETURNED') THEN 'CANCELED'
    WHEN order_status IN ('PESANAN SELESAI', 'TERKIRIM') THEN 'DELIVERED'
    WHEN order_status IN ('COMPLETED', 'DELIVERED') THEN CASE WHEN cancel_status = '' THEN 'DELIVERED' ELSE 'CANCELED' END
    WHEN order_status = 'CONFIRMED' THEN CASE WHEN cancel_status IN ('', 'CANCEL-BUYER') THEN 'DELIVERED' ELSE 'CANCELED' END
    WHEN order_status = 'PAID' THEN CASE WHEN sub_status = 'UNFULFILLED' THEN 'ONPROGRESS' ELSE 'DELIVERED' END
    WHEN order_status = 'SELESAI' THEN CASE WHEN sub_status = 'PERMINTAAN DISETUJUI' THEN 'CANCELED' ELSE 'DELIVERED' END
    WHEN order_status = 'SHIPPED' AND sub_status = 'DELIVERED' THEN 'DELIVERED'
    WHEN order_status = 'SHIPPED' AND cancel_status NOT IN ('', 'CANCEL-BUYER') THEN 'CANCELED'
    ELSE 'ONPROGRESS' END AS sales_status FROM clean),
marg AS (SELECT p.* EXCLUDE (ph), CASE WHEN length(ph) < 10 THEN '*******' ELSE ph END AS recipient_phone,
  CASE WHEN p.marketplace = 'TIKTOK' AND month(p.date) >= 5 THEN 0.065::DOUBLE ELSE m.margin_pct END AS margin_pct,
  CAST(existing_hpp AS DOUBLE) + CAST(existing_hpp AS DOUBLE) * 0.11::DOUBLE AS existing_hpp_11,
  CAST(value_after_voucher AS DOUBLE) / 1.11::DOUBLE AS dpp
  FROM phoned p LEFT JOIN margins m ON m.brand = p.brand AND m.marketplace = CASE p.marketplace WHEN 'SHOPIFY' THEN 'WEBSITE' WHEN 'TIKTOK' THEN 'TIK-TOK' ELSE p.marketplace END),
prof AS (SELECT *, CAST(value_after_voucher AS DOUBLE) - existing_hpp_11 AS gross_profit_hpp11, dpp - CAST(existing_hpp AS DOUBLE) AS gross_profit_dpp FROM marg),
online_detail AS (SELECT * REPLACE ({', '.join(units(c) for c in (*UNITS, 'existing_hpp_11', 'dpp', 'gross_profit_hpp11', 'gross_profit_dpp'))},
  CASE WHEN sales_status = 'ONPROGRESS' AND ship_date IS NULL THEN date ELSE ship_date END AS ship_date,
  COALESCE(delivered_date, CASE WHEN sales_status = 'ONPROGRESS' AND ship_date IS NULL THEN date ELSE ship_date END, date) AS delivered_date) FROM prof)
"""
DETAIL_OUT = [c for c in ONLINE_LINE if c != "pricecategory"]
DETAIL_NUMBERS = {*UNITS, "existing_hpp_11", "dpp", "gross_profit_hpp11", "gross_profit_dpp", "subsidy", "delivery_fee", "margin_pct"}


@query(
    f"{DETAIL_SQL} SELECT {', '.join(f'{r(c)} AS {c}' if c in DETAIL_NUMBERS else c for c in DETAIL_OUT)} FROM online_detail",
    " ".join(f"own_{m}" for m in MARKETS) + " match_items products margins",
    name="online_sales_detail",
)
def _online_sales_detail(s):
    """The canonical online line over all marketplaces."""
    s = s.landed("online_base")
    exports = {m: getattr(s, f"own_{m}") for m in MARKETS}
    lines = normalise_all(exports, processed_matcher(s.match_items, s.products))
    return online_sales_detail(lines, s.products, s.margins).select(*DETAIL_OUT)


@query(
    """SELECT order_no, codebars, subcategory, CASE WHEN regexp_matches(subcategory, 'KAFTAN|GAMIS|SARUNG|SHANGHAI')
      THEN 'FESTIVE' ELSE 'REGULAR' END AS category_product FROM online_lines""",
    "online_lines",
)
def festive_category(s):
    """FESTIVE sub-categories."""
    return add_product_group(s.online_lines.select("order_no", "codebars", "subcategory"))
