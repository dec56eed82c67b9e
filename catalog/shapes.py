"""Driver tables in the shapes the operators expect.

Shapes only rename and recombine the given tables, so their SQL is written once and rendered for
both engines; the operators under test and their SQL counterparts are written separately.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapak.session import configure, stored
from lapak.sources.readers import read_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# Fact tables with the columns that nearly identify a row.

JAVA_TO_STRFTIME = {
    "yyyy": "%Y", "MMMM": "%B", "MMM": "%b", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S",
}


@dataclass(frozen=True)
class Dialect:
    name: str

    def q(self, identifier: str) -> str:
        return f"`{identifier}`" if self.name == "spark" else f'"{identifier}"'

    def intdiv(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"

    def fmt(self, ts: str, pattern: str) -> str:
        if self.name == "spark":
            return f"date_format({ts}, '{pattern}')"
        for java, c in JAVA_TO_STRFTIME.items():
            pattern = pattern.replace(java, c)
        return f"strftime({ts}, '{pattern}')"

    def add_hours(self, ts: str, hours: str) -> str:
        if self.name == "spark":
            return f"timestampadd(HOUR, {hours}, {ts})"
        return f"({ts} + to_hours({hours}))"

    def add_days(self, date: str, days: int) -> str:
        return f"date_add({date}, {days})" if self.name == "spark" else f"CAST({date} + {days} AS DATE)"

    def joined(self, plain: str, spread: str) -> str:
        """The joins of a shape. Spark joins in the order given, so there the lines are shuffled once per
        large table, and what belongs to an order is put together before the lines meet it."""
        return spread if self.name == "spark" else plain

    def newline(self) -> str:
        return "chr(10)"

    def tab(self) -> str:
        return "chr(9)"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")

STORE_OF_ORDER = ("o_custkey", "15")  # customers per supplier
COMPANY = "CASE WHEN n_regionkey <= 1 THEN 'mpr' ELSE 'mgl' END"
PCT = "CAST(round(l_discount * 100) AS INT)"
TAX = "CAST(round(l_tax * 100) AS INT)"
SIGN = "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END"
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
RATE = "CAST(l_discount AS DECIMAL(18,2))"
LINE_TOTAL = f"CAST({PRICE} * (1 - {RATE}) AS DECIMAL(18,2))"
LINE_DISCOUNT = f"CAST({PRICE} * {RATE} AS DECIMAL(18,2))"
CODE = "lpad(CAST({0} AS STRING), 8, '0')"
BRAND_NO = "CAST(replace(p_brand, 'Brand#', '') AS INT)"
ONLINE_BRAND = (
    f"CASE WHEN {BRAND_NO} <= 5 THEN 'SZ' WHEN {BRAND_NO} <= 10 THEN 'MN' "
    f"WHEN {BRAND_NO} <= 15 THEN 'MC' WHEN {BRAND_NO} <= 20 THEN 'MT' ELSE 'ED' END"
)
UMBRELLA = (
    f"CASE WHEN {BRAND_NO} = 6 THEN 'Minimal' WHEN {BRAND_NO} = 7 THEN 'Stocklot' "
    f"WHEN {BRAND_NO} = 8 THEN 'Manzone' ELSE p_brand END"
)
MARKETPLACE = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'SHOPEE' WHEN 'AUTOMOBILE' THEN 'TOKOPEDIA' "
    "WHEN 'FURNITURE' THEN 'TIKTOK' "
    "WHEN 'HOUSEHOLD' THEN CASE WHEN l_linestatus = 'F' THEN 'LAZADA' ELSE 'ZALORA' END "
    "ELSE CASE WHEN l_linestatus = 'F' THEN 'SHOPIFY' ELSE 'BLIBLI' END END"
)
MARKETPLACES = ("SHOPEE", "TOKOPEDIA", "TIKTOK", "LAZADA", "ZALORA", "WEBSITE", "BLIBLI")
BRANDS = ("SZ", "MN", "MC", "MT", "ED")
SKU = (
    "CASE WHEN l_linenumber <= 2 THEN {c} WHEN l_linenumber <= 4 THEN substr({c}, 2) "
    "WHEN l_linenumber = 5 THEN 'A' || CAST(l_partkey AS STRING) "
    "WHEN l_linenumber = 6 THEN '0' || {c} ELSE 'X' || {c} END"
).replace("{c}", CODE.format("l_partkey"))

POS_LINES = """{{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    JOIN {{supplier}} ON s_suppkey = {store} JOIN {{nation}} ON s_nationkey = n_nationkey
    JOIN {{part}} ON l_partkey = p_partkey"""
POS_LINES_SPREAD = """{{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
    JOIN (SELECT * FROM {{orders}} JOIN {{supplier}} ON s_suppkey = {store}
      JOIN {{nation}} ON s_nationkey = n_nationkey) ON l_orderkey = o_orderkey"""
ONLINE_LINES = """{lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    JOIN {customer} ON o_custkey = c_custkey JOIN {part} ON l_partkey = p_partkey"""
ONLINE_LINES_SPREAD = """{lineitem} JOIN {part} ON l_partkey = p_partkey
    JOIN (SELECT * FROM {orders} JOIN {customer} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey"""
# Where one marketplace is wanted, the orders that can be on it leave few lines to meet the parts.
ONLINE_LINES_OF_SOME = """{{lineitem}}
    JOIN (SELECT * FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey WHERE {own}) ON l_orderkey = o_orderkey
    JOIN {{part}} ON l_partkey = p_partkey"""


def _pick(number: str, values: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {number} {cases} ELSE '{values[-1]}' END"


def pos_orders(d: Dialect) -> str:
    store = d.intdiv(*STORE_OF_ORDER)
    created = d.add_hours("o_orderdate", "CAST(o_custkey % 24 AS INT)")
    return f"""
    SELECT {COMPANY} AS dataareaid, s_name AS store_branch_name, s_suppkey AS store_branch_id,
      CAST(s_suppkey AS STRING) AS store_branch_extcode, n_name AS store_branch_description,
      {created} AS time_created, l_shipdate AS time_modified,
      CAST(l_orderkey AS STRING) AS order_id, 'T' || CAST(l_orderkey AS STRING) AS transaction_id,
      'I' || CAST(l_orderkey AS STRING) AS invoice_id, CAST(l_suppkey AS STRING) AS employment_id,
      CAST(o_custkey AS STRING) AS customer_id, 'SO' || CAST(l_orderkey AS STRING) AS order_number,
      l_linenumber AS order_total_product, CAST(l_quantity AS INT) AS order_total_quantity,
      {PRICE} AS order_subtotal, {LINE_DISCOUNT} AS order_discount,
      CAST(o_totalprice AS DECIMAL(18,2)) AS order_total, TRUE AS order_isrecord,
      (l_linestatus = 'F' OR l_tax > 0.025) AS order_issettled,
      CASE o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 5 ELSE 7 END AS order_status,
      CAST({SIGN} * CAST(l_quantity AS INT) AS INT) AS order_product_quantity,
      CAST({SIGN} * {PRICE} AS DECIMAL(18,2)) AS order_product_subtotal,
      CAST({SIGN} * {LINE_DISCOUNT} AS DECIMAL(18,2)) AS order_product_discount,
      CAST({SIGN} * {LINE_TOTAL} AS DECIMAL(18,2)) AS order_product_total,
      CAST({TAX} AS DECIMAL(18,2)) AS order_product_promotion_value,
      {PCT} AS order_product_promotion_id, {PCT} AS promotion_id,
      'Promo ' || CAST({PCT} AS STRING) AS promotion_title,
      CASE WHEN {PCT} > 0 THEN 'Disc ' || CAST({PCT} AS STRING) END AS promotion_description,
      CASE WHEN {TAX} = 0 THEN 'None' ELSE CAST({TAX} AS STRING) END AS compliment_value,
      l_partkey AS product_id, {CODE.format("l_partkey")} AS product_barcode,
      CAST(p_retailprice AS DECIMAL(18,2)) AS product_price,
      CASE WHEN l_linenumber = 7 AND l_linestatus = 'O' THEN 'superseded' ELSE 'latest' END AS pull_status
    FROM {d.joined(POS_LINES, POS_LINES_SPREAD).format(store=store)}
    """


def pos_payments(d: Dialect) -> str:
    store = d.intdiv(*STORE_OF_ORDER)
    created = d.add_hours("o_orderdate", "CAST(o_custkey % 24 AS INT)")
    return f"""
    SELECT CAST({store} AS STRING) AS store_branch_extcode, CAST({store} AS BIGINT) AS store_branch_id,
      {created} AS time_created, 'T' || CAST(l_orderkey AS STRING) AS transaction_id,
      CAST(l_orderkey AS STRING) AS order_id, {LINE_TOTAL} AS payment_total,
      CAST(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS payment_change,
      CAST({TAX} AS DECIMAL(18,2)) AS payment_fee, CAST(o_totalprice AS DECIMAL(18,2)) AS payment_amount,
      CASE WHEN l_returnflag = 'A' THEN 'Cash'
        WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Gift Card'
        WHEN l_returnflag = 'N' THEN 'External Gift Card'
        WHEN l_linestatus = 'F' THEN 'Return Payment' ELSE 'Member Point' END AS payment_method_name,
      CASE WHEN l_linenumber = 7 AND l_linestatus = 'O' THEN 'superseded' ELSE 'latest' END AS pull_status
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    WHERE o_orderstatus <> 'P'
    """


def stores(d: Dialect) -> str:
    nth = d.intdiv("s_suppkey", "4")
    brand = _pick(f"({nth} % 5)", BRANDS)
    market = _pick(f"({d.intdiv(nth, '5')} % 7)", MARKETPLACES)
    channel = CHANNEL
    key = "CAST(s_suppkey AS STRING)"
    return f"""
    SELECT {COMPANY} AS dataareaid, 'CF' || {key} AS cfcode, 'CS' || {key} AS cscode,
      'WH' || {key} AS whcode, {key} AS axcode,
      CASE WHEN s_suppkey % 4 = 0 THEN 'ONLINE ' || {brand} || ' ' || {market}
        ELSE 'STORE ' || replace(s_name, '#', ' ') END AS stdname,
      {brand} AS brand, {channel} AS main_channel, {channel} AS channel, r_name AS groupstore,
      n_name AS deptstore, n_name AS province, r_name AS region,
      CASE WHEN n_nationkey = 3 THEN 'KOTA BATAM' ELSE n_name END AS city,
      'HEAD ' || CAST(r_regionkey AS STRING) AS so_dept_head,
      'AREA ' || CAST(n_nationkey AS STRING) AS area_head,
      'CITY ' || CAST(n_nationkey % 7 AS STRING) AS city_head,
      CASE WHEN s_suppkey % 3 = 0 THEN 'NON SSSG' ELSE 'SSSG' END AS sssg,
      CASE WHEN s_acctbal < 0 THEN 'CLOSE' ELSE 'OPEN' END AS openstatus, s_acctbal AS sqm,
      CAST(100000 + 1000 * s_suppkey AS DOUBLE) AS target
    FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
    JOIN {{region}} ON n_regionkey = r_regionkey
    """


def products(d: Dialect) -> str:
    def branch(company: str, version: int) -> str:
        raised = 1 if company == "mgl" else 0
        if version == 1:
            status = "CASE WHEN p_size % 2 = 0 THEN 'Current' ELSE 'Old' END"
        else:
            status = "CASE WHEN p_size = 17 THEN 'Old' ELSE 'Current' END"
        half = "CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2))"
        return f"""
        SELECT '{company}' AS dataareaid, 'I' || CAST(p_partkey AS STRING) AS itemid,
          'A' || CAST(p_partkey AS STRING) AS alucode, 'R' || CAST(p_size AS STRING) AS articlecode,
          p_name AS itemname, 'V' || CAST(p_partkey AS STRING) AS variantnumber,
          {CODE.format("p_partkey")} AS codebars, CAST(p_size AS STRING) AS size,
          p_name AS style, {UMBRELLA} AS umbrellabrand, p_brand || ' SUB' AS subbrand,
          'DEPT ' || p_type AS department, 'WORLD ' || CAST(p_size % 3 AS STRING) AS world,
          p_type || CASE WHEN p_size <= 10 THEN ' CSG' ELSE '' END AS category,
          CASE WHEN p_size <= 10 THEN 'KAFTAN - LONG' WHEN p_size <= 20 THEN 'PANTS - SARUNG'
            WHEN p_size <= 30 THEN 'KOKO - SHANGHAI' WHEN p_size <= 40 THEN 'KOKO - SHIRT'
            ELSE 'SHIRT - LONG' END AS subcategory,
          CASE WHEN p_size % 5 = 0 THEN 'OT' ELSE 'S' || CAST(p_size % 5 AS STRING) END AS season,
          CASE WHEN p_size <= 10 THEN 'CSG' ELSE 'REG' END AS itemmodelgroup,
          CASE WHEN p_size > 25 THEN 'HIGH' ELSE 'LOW' END AS pricecategory,
          DATE '2024-0{version}-01' AS monthyear,
          CASE WHEN p_size % 7 = 0 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST({half} + {version + raised} AS DECIMAL(18,2)) END AS hpp,
          CAST(p_retailprice AS DECIMAL(18,2)) AS basicprice,
          CAST(CAST(p_retailprice AS DECIMAL(18,2)) - {version} AS DECIMAL(18,2)) AS saleprice,
          {status} AS pullstatus, TIMESTAMP '2024-0{version}-02 00:00:00' AS pulldate,
          TIMESTAMP '2024-0{version}-01 00:00:00' AS modifieddatetime,
          p_partkey * 2 + {version} AS recid
        FROM {{part}} {"WHERE p_size <> 13" if company == "mgl" else ""}
        """

    return " UNION ALL ".join(branch(c, v) for c in ("mpr", "mgl") for v in (1, 2))


def match_items(d: Dialect) -> str:
    return """
    SELECT dataareaid, codebars, itemid, umbrellabrand, alucode, season, world, category,
      subcategory, pricecategory, monthyear AS yearmonth, hpp, basicprice
    FROM {products} WHERE monthyear = DATE '2024-02-01'
    """


def legacy_items(d: Dialect) -> str:
    return """
    SELECT dataareaid, itemid, codebars, alucode, articlecode, umbrellabrand, category,
      subcategory, world, season, CAST(basicprice - 500 AS DECIMAL(18,2)) AS hpp, size AS size_,
      style, monthyear AS yearmonth, basicprice, saleprice, pricecategory, pulldate,
      modifieddatetime, recid
    FROM {products}
    """


def item_stops(d: Dialect) -> str:
    def branch(company: str) -> str:
        return f"""SELECT '{company}' AS dataareaid, 'I' || CAST(p_partkey AS STRING) AS itemid,
          CASE WHEN p_size = 23 THEN 1 ELSE 0 END AS stopped FROM {{part}} WHERE p_size > 20"""

    return branch("mpr") + " UNION ALL " + branch("mgl")


def receipts(d: Dialect) -> str:
    def branch(company: str) -> str:
        return f"""SELECT '{company}' AS dataareaid, 'I' || CAST(l_partkey AS STRING) AS itemid,
          CAST(max(l_shipdate) AS DATE) AS last_ax_gr FROM {{lineitem}} GROUP BY l_partkey"""

    return branch("mpr") + " UNION ALL " + branch("mgl")


def brand_margins(d: Dialect) -> str:
    return f"""
    SELECT {UMBRELLA} AS brand_name, CAST(max({BRAND_NO}) % 4 AS DOUBLE) / 10 AS cost_of_margin
    FROM {{part}} GROUP BY {UMBRELLA}
    """


def promotions(d: Dialect) -> str:
    return f"""
    SELECT {PCT} AS id, 'P' || CAST({PCT} AS STRING) AS usedkey
    FROM {{lineitem}} WHERE l_discount > 0 GROUP BY {PCT}
    """


def erp_staging(d: Dialect) -> str:
    return """
    SELECT dataareaid, order_number AS transnumber, 'SN' || order_id AS stagingnumber,
      product_barcode AS barcode, CAST(sum(order_product_quantity) AS INT) AS quantity,
      CAST(sum(order_product_total) AS DECIMAL(18,2)) AS subtotaldetail, 'Current' AS pullstatus
    FROM {pos_orders} GROUP BY dataareaid, order_number, order_id, product_barcode
    """


CHANNEL = "CASE s_suppkey % 4 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'KEY ACCOUNT' ELSE 'SHOWROOM' END"


def sales_lines(d: Dialect) -> str:
    """Stored POS sales detail, the columns the reports read."""
    store = d.intdiv(*STORE_OF_ORDER)
    created = d.add_hours("o_orderdate", "CAST(o_custkey % 24 AS INT)")
    quantity = f"CAST({SIGN} * CAST(l_quantity AS INT) AS INT)"
    half = "CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1))"
    code = CODE.format("l_partkey")
    return f"""
    SELECT {COMPANY} AS dataareaid, CAST(s_suppkey AS STRING) AS axcode, {CHANNEL} AS channel,
      CAST({created} AS DATE) AS order_create_date,
      CASE WHEN l_linenumber = 7 THEN 'undetected' ELSE {code} END AS codebars,
      {code} AS productdata_barcode, 'SO' || CAST(l_orderkey AS STRING) AS ordernumber,
      {quantity} AS quantity, CAST({SIGN} * {LINE_TOTAL} AS DECIMAL(18,2)) AS cust_paid_peritem,
      CAST({half} * {quantity} AS DECIMAL(18,2)) AS hpp_total,
      CASE WHEN {PCT} = 0 THEN 'regular' ELSE 'P' || CAST({PCT} AS STRING) END AS promocode,
      CASE WHEN {PCT} > 0 THEN 'Disc ' || CAST({PCT} AS STRING) ELSE 'Regular' END AS remarks,
      CASE WHEN o_orderstatus = 'P' THEN '0' ELSE '1' END AS istransaction,
      (l_linestatus = 'F' OR l_tax > 0.025) AS issettled,
      CASE o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 5 ELSE 7 END AS status_order
    FROM {d.joined(POS_LINES, POS_LINES_SPREAD).format(store=store)}
    """


def pattern(d: Dialect) -> str:
    """Every order date with its counterparts four and fifty-two weeks back."""
    return f"""
    SELECT p AS pattern_date, {d.add_days("p", -28)} AS pattern_lm,
      {d.add_days("p", -364)} AS pattern_last_year
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS p FROM {{orders}})
    """


def possible_on(marketplace: str) -> str:
    """Whether lines of an order can be on the marketplace, told by its customer alone."""
    either = (MARKETPLACE.replace("l_linestatus = 'F'", settled) for settled in ("TRUE", "FALSE"))
    return f"'{marketplace.upper()}' IN ({', '.join(either)})"


def online_base(d: Dialect, lines: str | None = None) -> str:
    """Order lines as sold online: every line of the table, on one marketplace each."""
    return f"""
    SELECT {ONLINE_BRAND} AS brand, {MARKETPLACE} AS marketplace,
      CAST(l_orderkey AS STRING) AS ok, l_linenumber AS ln, {SKU} AS sku,
      {CODE.format("l_partkey")} AS code, CAST(l_quantity AS INT) AS qty,
      CAST(round(p_retailprice * 100) AS BIGINT) AS price, {PCT} AS pct, {TAX} AS tax,
      o_orderdate AS od, l_shipdate AS sd, o_orderstatus AS os, l_returnflag AS rf,
      l_linestatus AS ls, c_name AS customer, c_nationkey AS nation, o_custkey AS custkey,
      l_suppkey AS suppkey
    FROM {lines or d.joined(ONLINE_LINES, ONLINE_LINES_SPREAD)}
    """


def online_lines(d: Dialect) -> str:
    """Canonical online lines with exact decimals, as input of the online reports."""
    disc = d.intdiv("price * pct", "100")
    vou = d.intdiv("price * tax", "100")
    dec = "DECIMAL(18,2)"
    gross = f"(price - {disc} - {vou}) * qty"
    return f"""
    SELECT brand, marketplace, CAST(od AS DATE) AS date, CAST(sd AS DATE) AS ship_date,
      CAST(sd AS DATE) AS delivered_date, upper(os) AS order_status, rf AS sub_status,
      'ORD' || ok AS order_no, code AS barcode, code AS codebars, qty AS qty_sold,
      CAST(price AS {dec}) AS basic_price, CAST({disc} AS {dec}) AS discount,
      CAST({vou} AS {dec}) AS voucher, CAST(price - {disc} AS {dec}) AS net_sales,
      CAST({d.intdiv("price", "2")} AS {dec}) AS hpp, CAST(tax * 100 AS {dec}) AS subsidy,
      CAST({disc} * qty AS {dec}) AS existing_discount, CAST({vou} * qty AS {dec}) AS existing_voucher,
      CAST((price - {disc}) * qty AS {dec}) AS existing_net_sales,
      CAST({gross} AS {dec}) AS value_after_voucher,
      CAST({d.intdiv("price", "2")} * qty AS {dec}) AS existing_hpp,
      CAST({d.intdiv(gross + " * 100", "111")} AS {dec}) AS dpp,
      CAST({d.intdiv(gross + " * 100", "111")} - {d.intdiv("price", "2")} * qty AS {dec}) AS gross_profit_dpp,
      CASE WHEN os = 'P' THEN 'ONPROGRESS' WHEN rf = 'R' THEN 'CANCELED' ELSE 'DELIVERED' END AS sales_status,
      'Courier ' || ls AS courier, 'RS' || ok AS tracking_no, CAST(tax * 1000 AS {dec}) AS delivery_fee,
      customer AS recipient_name, '0812' || lpad(CAST(custkey AS STRING), 8, '0') AS recipient_phone,
      'Street ' || CAST(custkey AS STRING) AS recipient_address,
      'District ' || CAST(nation AS STRING) AS recipient_district,
      CASE WHEN nation = 3 THEN '' ELSE 'City ' || CAST(nation AS STRING) END AS recipient_city,
      lpad(CAST(nation AS STRING), 5, '1') AS recipient_postcode,
      'Brand ' || brand AS umbrellabrand, 'A' || code AS alucode,
      CASE WHEN tax = 5 THEN 'OT' ELSE 'S' END AS season, 'Cat ' || ls AS category,
      CASE WHEN pct <= 2 THEN 'KAFTAN - LONG' WHEN pct <= 4 THEN 'PANTS - SARUNG'
        WHEN pct <= 6 THEN 'TOP - SHANGHAI' WHEN pct <= 8 THEN 'KOKO - SHIRT' ELSE 'SHIRT - LONG' END AS subcategory,
      'PC' AS pricecategory, DATE '2024-01-01' AS yearmonth
    FROM {{online_base}}
    """


def margins(d: Dialect) -> str:
    """Margin by brand and marketplace; marketplaces partly under their old names."""
    old = "CASE marketplace WHEN 'SHOPIFY' THEN 'WEBSITE' WHEN 'TIKTOK' THEN 'TIK-TOK' ELSE marketplace END"
    return f"""
    SELECT brand, {old} AS marketplace, CAST(max(tax) AS DOUBLE) / 100 AS margin_pct
    FROM {{online_base}} WHERE brand <> 'ED' GROUP BY brand, {old}
    """


def _dots(value: str, d: Dialect) -> str:
    thousands = d.intdiv(value, "1000")
    rest = f"lpad(CAST({value} % 1000 AS STRING), 3, '0')"
    return f"CASE WHEN {value} < 1000 THEN CAST({value} AS STRING) ELSE CAST({thousands} AS STRING) || '.' || {rest} END"


def _columns(d: Dialect, columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {d.q(name)}" for name, sql in columns.items())


def _export(d: Dialect, columns: dict[str, str], own: str) -> str:
    return f"SELECT brand, {_columns(d, columns)} FROM {{online_base}} WHERE {own}"


CANCEL = "CASE WHEN rf = 'N' AND ls = 'O' THEN 'cancel-buyer' WHEN rf = 'R' THEN 'seller' END"


def raw_shopee(d: Dialect, own: str = "TRUE") -> str:
    return _export(d, {
        "Waktu Pesanan Dibuat": d.fmt("od", "yyyy-MM-dd HH:mm"),
        "Waktu Pengiriman Diatur": f"CASE WHEN os <> 'P' THEN {d.fmt('sd', 'yyyy-MM-dd HH:mm')} END",
        "Waktu Pesanan Selesai": f"CASE WHEN os = 'F' THEN {d.fmt('sd', 'yyyy-MM-dd HH:mm')} END",
        "Status Pesanan": "CASE os WHEN 'F' THEN 'Selesai' WHEN 'O' THEN 'Sedang Dikirim' ELSE 'Batal' END",
        "Status Pembatalan/ Pengembalian": "CASE WHEN rf = 'R' THEN 'Permintaan Disetujui' END",
        "No. Pesanan": "'SP' || ok",
        "Nomor Referensi SKU": f"CASE WHEN ln = 1 THEN {d.newline()} || sku WHEN ln = 2 THEN sku || {d.newline()} || 'size' ELSE sku END",
        "Jumlah": "CAST(qty AS STRING)",
        "Jumlah Produk di Pesan": "CAST(qty + ln AS STRING)",
        "Harga Awal": _dots("price", d),
        "Total Diskon": _dots(f"({d.intdiv('price * pct', '100')} * qty)", d),
        "Diskon Dari Shopee": _dots("(tax * 500)", d),
        "Voucher Ditanggung Penjual": _dots("(tax * 700)", d),
        "Alasan Pembatalan": "CASE WHEN os = 'P' THEN 'Berubah pikiran' END",
        "Opsi Pengiriman": "'Reguler'",
        "No. Resi": "'RS-' || ok",
        "Ongkos Kirim Dibayar oleh Pembeli": _dots("(tax * 900)", d),
        "Estimasi Potongan Biaya Pengiriman": _dots("(tax * 300)", d),
        "Perkiraan Ongkos Kirim": _dots("(tax * 400)", d),
        "Nama Penerima": "customer",
        "No. Telepon": "CASE WHEN ln = 1 THEN '123' ELSE '+62 812-' || lpad(CAST(custkey AS STRING), 7, '0') END",
        "Alamat Pengiriman": "'Jalan ' || CAST(custkey AS STRING)",
        "Provinsi": "'Prov ' || CAST(nation AS STRING)",
        "Kota/Kabupaten": "'Kota ' || CAST(nation AS STRING)",
    }, own)


def raw_lazada(d: Dialect, own: str = "TRUE") -> str:
    return _export(d, {
        "createTime": f"CASE WHEN ln <= 3 THEN {d.fmt('od', 'yyyy-MM-dd HH:mm:ss')} ELSE {d.fmt('od', 'dd MM yyyy HH:mm:ss')} END",
        "updateTime": d.fmt("sd", "dd MMM yyyy HH:mm"),
        "deliveredDate": f"CASE WHEN os = 'F' THEN {d.fmt('sd', 'yyyy-MM-dd')} WHEN ln = 7 THEN 'not a date' END",
        "status": "CASE WHEN os = 'P' THEN 'canceled' WHEN os = 'O' THEN 'shipped' WHEN ln <= 2 THEN 'delivered' WHEN ln <= 4 THEN 'confirmed' ELSE 'returned' END",
        "orderNumber": "'LZ' || ok",
        "sellerSku": "CASE WHEN sku = 'X00000001' THEN '7297014564-1699015393637-1' ELSE sku END",
        "unitPrice": f"CAST(price - {d.intdiv('price * pct', '100')} AS STRING) || '.00'",
        "sellerDiscountTotal": "CASE WHEN tax = 0 THEN NULL ELSE '-' || CAST(tax * 100 AS STRING) || '.50' END",
        "buyerFailedDeliveryReturnInitiator": CANCEL,
        "buyerFailedDeliveryReason": "CASE WHEN rf = 'R' THEN 'damaged' END",
        "shippingProvider": "'LEX'",
        "trackingCode": "'LX/' || ok",
        "shippingFee": "CAST(tax AS STRING)",
        "customerName": "customer",
        "shippingAddress": "'Jalan ' || CAST(custkey AS STRING)",
        "shippingCity": "'Kota ' || CAST(nation AS STRING)",
        "shippingPostCode": "CAST(10000 + nation AS STRING) || '.0'",
    }, own)


def raw_tiktok(d: Dialect, own: str = "TRUE") -> str:
    def idr(value: str) -> str:
        return f"'IDR ' || {_dots(value, d)}"

    disc = f"({d.intdiv('price * pct', '100')} * qty)"
    return _export(d, {
        "Order ID": "'TT' || ok",
        "Order Status": "CASE os WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Shipped' ELSE 'Canceled' END",
        "Order Substatus": "CASE WHEN os = 'O' AND ls = 'F' THEN 'Delivered' WHEN os = 'O' THEN 'In transit' END",
        "Cancelation/Return Type": CANCEL,
        "Cancel By": "CASE WHEN os = 'P' THEN 'User' END",
        "Cancel Reason": "CASE WHEN os = 'P' THEN 'No longer needed' END",
        "Seller SKU": "sku || '.0'",
        "Quantity": "CASE WHEN ln = 7 AND ls = 'O' THEN '0' ELSE CAST(qty AS STRING) END",
        "SKU Unit Original Price": idr("price"),
        "SKU Subtotal Before Discount": idr("(price * qty)"),
        "SKU Platform Discount": f"CASE WHEN tax = 0 THEN NULL ELSE {idr('(tax * 250)')} END",
        "SKU Seller Discount": idr(disc),
        "SKU Subtotal After Discount": idr(f"(price * qty - {disc})"),
        "Order Amount": idr("(price * qty)"),
        "Shipping Fee After Discount": idr("(tax * 1000)"),
        "Created Time": f"{d.fmt('od', 'dd/MM/yyyy HH:mm:ss')} || {d.tab()}",
        "Shipped Time": f"CASE WHEN os <> 'P' THEN {d.fmt('sd', 'dd/MM/yyyy HH:mm:ss')} || {d.tab()} ELSE {d.tab()} END",
        "Delivered Time": f"CASE WHEN os = 'F' THEN {d.fmt('sd', 'dd/MM/yyyy HH:mm:ss')} END",
        "Shipping Provider Name": "'J&T'",
        "Tracking ID": "'JT' || ok",
        "Recipient": "customer || '*'",
        "Phone #": "'(+62)812*****' || CAST(custkey AS STRING)",
        "Detail Address": "'=Jalan ' || CAST(custkey AS STRING)",
        "Districts": "'Kec ' || CAST(nation AS STRING)",
        "Regency and City": "'Kota ' || CAST(nation AS STRING)",
        "Zipcode": "'''' || CAST(20000 + nation AS STRING)",
    }, own)


def raw_shopify(d: Dialect, own: str = "TRUE") -> str:
    """Header fields on the first lines of an order only; order names are per customer and day."""
    head = "ln <= 2"

    def header(sql: str) -> str:
        return f"CASE WHEN {head} THEN {sql} END"

    return _export(d, {
        "Name": "'#' || ok",
        "Created at": header(f"{d.fmt('od', 'yyyy-MM-dd HH:mm:ss')} || ' +0700'"),
        "Fulfilled at": f"CASE WHEN {head} AND os <> 'P' THEN {d.fmt('od', 'yyyy-MM-dd')} || ' 10:00:00 +0700' END",
        "Email": "CAST(NULL AS STRING)",
        "Financial Status": header("'paid'"),
        "Fulfillment Status": header("CASE os WHEN 'F' THEN 'fulfilled' ELSE 'unfulfilled' END"),
        "Payment Reference": header("'PR' || ok || '/'"),
        "Shipping Name": header("customer"),
        "Shipping Phone": header("'62812' || lpad(CAST(custkey AS STRING), 7, '0')"),
        "Shipping Street": header("'Jalan ' || CAST(custkey AS STRING)"),
        "Shipping Province Name": "CASE WHEN nation > 12 AND ln <= 2 THEN 'Prov ' || CAST(nation AS STRING) END",
        "Shipping City": header("'Kota ' || CAST(nation AS STRING)"),
        "Shipping Zip": header("'''' || CAST(30000 + nation AS STRING)"),
        "Subtotal": header("CAST(price * qty AS STRING)"),
        "Total": header("CAST(price * qty AS STRING)"),
        "Discount Amount": header("CAST(tax * 1000 AS STRING) || '.00'"),
        "Lineitem quantity": "CAST(qty AS STRING)",
        "Lineitem price": f"CAST(price - {d.intdiv('price * pct', '100')} AS STRING) || '.00'",
        "Lineitem sku": "sku || CASE WHEN ln = 3 THEN '.0' ELSE '' END",
    }, own)


def raw_tokopedia(d: Dialect, own: str = "TRUE") -> str:
    return _export(d, {
        "Nomor Invoice": "CASE WHEN ln = 7 AND ls = 'O' AND rf = 'N' THEN NULL ELSE 'INV/' || ok END",
        "Tanggal Pembayaran": d.fmt("od", "dd-MM-yyyy HH:mm:ss"),
        "Status Terakhir": f"CASE os WHEN 'F' THEN 'Pesanan Selesai' WHEN 'O' THEN 'Pesanan Diproses' ELSE 'Dibatalkan Pembeli -' || {d.newline()} || 'Stok habis' END",
        "Tanggal Pesanan Selesai": f"CASE WHEN os = 'F' THEN {d.fmt('sd', 'dd-MM-yyyy')} END",
        "Tanggal Pengiriman Barang": f"CASE WHEN os <> 'P' THEN {d.fmt('sd', 'dd-MM-yyyy')} END",
        "Nomor SKU": "sku",
        "Jumlah Produk Dibeli": "CAST(qty AS STRING)",
        "Harga Awal (IDR)": "CAST(price AS STRING)",
        "Harga Jual (IDR)": f"CAST(price - {d.intdiv('price * pct', '100')} AS STRING)",
        "Jumlah Subsidi Tokopedia (IDR)": "CAST(tax * 200 AS STRING)",
        "Nilai Kupon Toko Terpakai (IDR)": "CAST(tax * 1500 AS STRING)",
        "Nama Kurir": "'SiCepat'",
        "No Resi / Kode Booking": "'SC' || ok",
        "Nama Penerima": "customer",
        "No Telp Penerima": "'812' || lpad(CAST(custkey AS STRING), 7, '0')",
        "Alamat Pengiriman": "'Jalan ' || CAST(custkey AS STRING)",
        "Provinsi": "'Prov ' || CAST(nation AS STRING)",
        "Kota": "'Kota ' || CAST(nation AS STRING)",
    }, own)


def raw_zalora(d: Dialect, own: str = "TRUE") -> str:
    net = f"(price - {d.intdiv('price * pct', '100')})"
    return _export(d, {
        "Created at": d.fmt("od", "yyyy-MM-dd HH:mm:ss"),
        "Updated at": d.fmt("sd", "yyyy-MM-dd HH:mm:ss"),
        "Order Number": "'ZL' || ok",
        "Status": "CASE os WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'delivery failed' END",
        "Reason": "CASE WHEN os = 'P' THEN 'Refused' END",
        "Seller SKU": "sku",
        "Unit Price": f"CAST({net} AS STRING)",
        "Paid Price": f"CAST({net} - tax * 900 AS STRING)",
        "Store Credits": "CAST(tax * 100 AS STRING)",
        "Wallet Credits": "CAST(tax * 50 AS STRING)",
        "Shipping Provider": "'ZDS'",
        "Tracking Code": "'Z-' || ok",
        "Shipping Fee": "CAST(tax * 10 AS STRING)",
        "Shipping Name": "customer",
        "Shipping Phone Number2": "'0813' || lpad(CAST(custkey AS STRING), 7, '0')",
        "Shipping Address": "'Jalan ' || CAST(custkey AS STRING)",
        "Shipping Region": "'Prov ' || CAST(nation AS STRING)",
        "Shipping City": "'Kota ' || CAST(nation AS STRING)",
        "Shipping Postcode": "CAST(40000 + nation AS STRING)",
    }, own)


def raw_blibli(d: Dialect, own: str = "TRUE") -> str:
    return _export(d, {
        "No. Order": "'=\"' || ok || '\"'",
        "Tanggal Order": d.fmt("od", "dd/MM/yyyy HH:mm"),
        "Merchant SKU": "CASE WHEN ln % 2 = 0 THEN '=\"' || sku || '\"' ELSE sku END",
        "Total Barang": "CAST(qty AS STRING)",
        "Harga item pesanan": "CAST(price AS STRING)",
        "Total harga item pesanan": "CAST(price * qty AS STRING)",
        "Order Status": "CASE os WHEN 'F' THEN 'Terkirim' WHEN 'O' THEN 'Siap Dikirim' ELSE 'Order Batal' END",
        "Diskon": f"CAST({d.intdiv('price * pct', '100')} AS STRING)",
        "Voucher seller": "'-' || CAST(tax * 300 AS STRING)",
        "Servis Logistik": "'BES'",
        "No. Awb": "'AWB' || ok",
    }, own)


RAW = {
    "shopee": raw_shopee, "lazada": raw_lazada, "tiktok": raw_tiktok, "shopify": raw_shopify,
    "tokopedia": raw_tokopedia, "zalora": raw_zalora, "blibli": raw_blibli,
}

SHAPES = {
    f.__name__: f
    for f in (
        pos_orders, pos_payments, stores, products, match_items, legacy_items, item_stops, receipts,
        brand_margins, promotions, erp_staging, sales_lines, pattern, online_base, online_lines, margins,
        raw_shopee, raw_lazada, raw_tiktok, raw_shopify, raw_tokopedia, raw_zalora, raw_blibli,
    )
}
SHAPES.update(
    {
        f"own_{m}": (lambda d, f=f, m=m: f(d, f"marketplace = '{m.upper()}'"))
        for m, f in RAW.items()
    }
)


#: Small tables beside the lines. Written, as masters are, they have a size that Spark knows; worked out
#: of the line tables in each plan they count as large as those, and the lines are shuffled to meet them.
MASTERS = ("stores", "promotions", "brand_margins", "margins")


def _needs(sql: str) -> list[str]:
    return [n for n in (*TABLES, *SHAPES) if "{" + n + "}" in sql]


def duck(*names: str) -> str:
    """CTE definitions of the shapes and everything they build on, without the word WITH."""
    done: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in done or name in TABLES:
            return
        sql = SHAPES[name](DUCK)
        for dep in _needs(sql):
            visit(dep)
            sql = sql.replace("{" + dep + "}", dep)
        done[name] = sql

    for name in names:
        visit(name)
    return ", ".join(f"{n} AS ({s})" for n, s in done.items())


def load(
    spark: SparkSession, sf_dir: str, name: str, loaded: dict[str, DataFrame] | None = None
) -> DataFrame:
    """A driver table or a shape as a DataFrame; ``loaded`` keeps the ones already built."""
    loaded = {} if loaded is None else loaded
    if name not in loaded:
        if name in TABLES:
            df = read_table(spark, f"{sf_dir}/{name}.parquet")
            # The files carry zone-less times; they are UTC.
            naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
            loaded[name] = df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df
        else:
            sql = SHAPES[name](SPARK)
            parts = {n: load(spark, sf_dir, n, loaded) for n in _needs(sql)}
            df = spark.sql(sql, **parts)
            loaded[name] = stored(df, name) if name in MASTERS else df
    return loaded[name]


class Shapes:
    """Shapes of one folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._loaded = configure(spark), sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        return load(self._spark, self._dir, name, self._loaded)

    def landed(self, name: str) -> Shapes:
        """These shapes with ``name`` written once, for queries that start from it many times."""
        loaded = {name: stored(getattr(self, name), name)}
        return self._with(loaded)

    def sold_on(self, marketplace: str) -> Shapes:
        """These shapes with the lines of one marketplace alone, written once."""
        sql = online_base(SPARK, ONLINE_LINES_OF_SOME.format(own=possible_on(marketplace)))
        lines = self._spark.sql(sql, **{n: getattr(self, n) for n in _needs(sql)})
        return self._with({"online_base": stored(lines.where(F.col("marketplace") == marketplace.upper()), "online_base")})

    def spread(self, name: str) -> Shapes:
        """These shapes with the rows of ``name`` spread over all tasks, where its files are read by few."""
        rows = getattr(self, name)
        if rows.rdd.getNumPartitions() >= self._spark.sparkContext.defaultParallelism:
            return self
        return self._with({name: rows.hint("rebalance")})

    def _with(self, loaded: dict[str, DataFrame]) -> Shapes:
        other = Shapes(self._spark, self._dir)
        other._loaded.update(loaded)
        return other
