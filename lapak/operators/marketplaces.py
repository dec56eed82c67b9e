"""Seven marketplace export layouts to one online sales line.

Each layout function takes the export as landed (text columns under the marketplace's own
headings, plus ``brand``) and returns ``LINE`` columns. ``match_and_price`` then attaches the
product and the prices that depend on it, so any number of layouts can be united first and
joined with the products once. ``existing_x`` is always x times the quantity sold.

Two generations of some formulas exist. ``variant="processed"`` is the default;
``variant="staging"`` is the older one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col_or
from ..functions.dates import parse_date
from ..functions.numbers import ratio, try_money
from ..functions.text import delete, part_of, unquote, whole_number
from ..functions.values import all_present, replace_values, sum0, zero_if_null
from .aggregating import header_totals
from .joining import attach_totals, keep_facts, with_leading_zero_retry
from .products import MATCHED_ATTRIBUTES, REFRESHED, current_products, match_online_codes, online_company

Matcher = Callable[[DataFrame], DataFrame]

TEXT_COLUMNS = (
    "order_status", "sub_status", "cancel_status", "cancel_reason", "cancel_by", "order_no",
    "courier", "tracking_no", "recipient_name", "recipient_phone", "recipient_address",
    "recipient_district", "recipient_city", "recipient_postcode",
)
PRICE_COLUMNS = (
    "basic_price", "discount", "voucher", "net_sales", "subsidy", "existing_basic_price",
    "existing_discount", "existing_voucher", "existing_net_sales", "value_after_voucher",
    "existing_hpp", "delivery_fee",
)
# Before the product match; ``master_priced`` lines take their basic price from the product.
LINE = (
    "brand", "marketplace", "date", "ship_date", "delivered_date", *TEXT_COLUMNS, "barcode",
    "qty_sold", "master_priced", *(c for c in PRICE_COLUMNS if c != "existing_hpp"),
)
NORMALISED = (
    "brand", "marketplace", "date", "ship_date", "delivered_date", *TEXT_COLUMNS, "barcode",
    "codebars", *MATCHED_ATTRIBUTES, "qty_sold", *PRICE_COLUMNS,
)

# Seller codes that stand for a barcode.
SHOPEE_CODES = {
    "BZY23-07FLMASS020MA-L": "0100000005408",
    "BZY23-07FLMASS021WH-M": "0100000005446",
    "BZY23-07FLMASS021WH-L": "0100000005453",
    "BZY23-07FLMASS022WH-XXL": "0100000005521",
    "BZY23-07FLMASS023WH-L": "0100000005552",
    "BZY23-07FLMASS024NA-L": "0100000005606",
    "BZY23-07FLMASS020MA-XL": "0100000005415",
    "BZY23-07FLMASS021WH-XL": "0100000005460",
    "BZY23-07FLMASS022WH-L": "0100000005507",
}
LAZADA_CODES = {
    "6602762588-1699015282254-2": "1000000055576",
    "4706454460-1699014985409-1": "1000000046013",
    "5352440765-1699015083673-2": "1000000050742",
    "7297014564-1699015393637-1": "8990100029488",
    "7522936912-1699015452330-1": "1000000048232",
    "5352440765-1699015083673-0": "1000000050745",
    "7305118850-1699015398170-1": "1000000031093",
    "4649934693-1699014956928-1": "1000000042404",
    "7305118850-1699015398170-3": "1000000031091",
    "7522936912-1699015452330-4": "1000000048234",
    "6602388074-1699015280054-6": "1000000055416",
    "5352514169-1699015084655-4": "1000000050749",
    "3723278397-1699014951607-2": "1000000045751",
    "5894284477-1699015176635-0": "1000000052600",
    "5271584448-1699015053124-4": "1000000044392",
    "5271702013-1699015053483-0": "1000000044427",
    "6639176097-1699015302656-4": "1000000056804",
    "5820826883-1699015167635-0": "1000000053672",
    "5820880795-1699015168648-2": "1000000053667",
    "4707216187-1699014987176-0": "1000000055956",
    "6149578751-1699015242385-3": "1000000044509",
    "1454814545-1699014932147-0": "1000000042425",
}
NO_SHIP_DATE = "1900-01-01"


def processed_matcher(items: DataFrame, products: DataFrame | None = None) -> Matcher:
    """Match against the active item tables of both companies.

    With ``products`` the attributes :func:`refresh_online` takes from that master come along.
    """
    return lambda lines: match_online_codes(lines, items, products)


def staging_matcher(products: DataFrame) -> Matcher:
    """Match against the product master of the brand's company, retrying with a leading zero."""
    names = [a for a in MATCHED_ATTRIBUTES if a in products.columns]
    master = current_products(products)
    if "yearmonth" not in names:
        master = master.withColumn("yearmonth", F.to_date("monthyear"))
        names.append("yearmonth")
    master = master.select("dataareaid", "codebars", *names)

    master = master.withColumn("__code", F.col("codebars"))

    def match(lines: DataFrame) -> DataFrame:
        scoped = lines.withColumn("dataareaid", online_company(F.col("brand")))
        matched = with_leading_zero_retry(scoped, "barcode", master, "__code", ["dataareaid"])
        return matched.drop("dataareaid", "__code")

    return match


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def _text(df: DataFrame, names: Mapping[str, str]) -> dict[str, Column]:
    """Canonical text columns from the export's headings; absent ones are NULL."""
    empty = F.lit(None).cast("string")
    return {
        c: (col_or(df, names[c], empty).cast("string") if c in names else empty)
        for c in TEXT_COLUMNS
    }


def _line(
    df: DataFrame, marketplace: str, prices: Mapping[str, Column], master_priced: bool = False, match: Matcher | None = None
) -> DataFrame:
    """The uniform line of an export, with its product if ``match`` is given; prices it does not give stay NULL.

    The product is matched before the prices are worked out, so they are not shuffled with the line.
    """
    missing = F.lit(None)
    own = {
        "marketplace": F.lit(marketplace),
        "master_priced": F.lit(master_priced),
        **{c: prices.get(c, missing).cast("double") for c in PRICE_COLUMNS},
    }
    found: list[str] = []
    if match is not None:
        before = df.columns
        df = match(df)
        found = [c for c in df.columns if c not in before]
    return df.select(*[own[c].alias(c) if c in own else F.col(c) for c in LINE], *found)


C = F.col


def match_and_price(lines: DataFrame, match: Matcher) -> DataFrame:
    """Product attributes, prices based on the product's basic price, and cost."""
    return _priced(match(lines))


def _priced(matched: DataFrame) -> DataFrame:
    priced = matched.withColumn("__basic", C("basicprice").cast("double"))
    basic, qty = C("__basic"), C("qty_sold")
    discount = basic - C("net_sales")
    net = F.coalesce("existing_net_sales", basic * qty - discount * qty)
    from_master = {
        "basic_price": basic,
        "discount": discount,
        "existing_basic_price": basic * qty,
        "existing_discount": discount * qty,
        "existing_net_sales": net,
        "value_after_voucher": net - C("existing_voucher"),
    }
    return priced.withColumns(
        {
            **{n: F.when(C("master_priced"), c).otherwise(C(n)) for n, c in from_master.items()},
            "existing_hpp": C("hpp").cast("double") * qty,
        }
    ).select(*NORMALISED, *[c for c in matched.columns if c.endswith(REFRESHED)])


def shopee(raw: DataFrame, variant: str = "processed", match: Matcher | None = None) -> DataFrame:
    sku = _raw("Nomor Referensi SKU").cast("string")
    first_line = part_of(sku, "\n", 0)
    sku = F.when(sku.startswith("\n"), delete(sku, "\n")).otherwise(
        F.when(first_line == "", F.lit("0000")).otherwise(first_line)
    )
    in_order = _raw("Jumlah Produk di Pesan").try_cast("int")
    lines = raw.select(
        "brand",
        *[c.alias(n) for n, c in _text(raw, {
            "order_status": "Status Pesanan", "sub_status": "Status Pembatalan/ Pengembalian",
            "cancel_reason": "Alasan Pembatalan", "order_no": "No. Pesanan",
            "courier": "Opsi Pengiriman", "tracking_no": "No. Resi",
            "recipient_name": "Nama Penerima", "recipient_phone": "No. Telepon",
            "recipient_address": "Alamat Pengiriman", "recipient_district": "Provinsi",
            "recipient_city": "Kota/Kabupaten",
        }).items()],
        iso_date("Waktu Pesanan Dibuat").alias("date"),
        iso_date("Waktu Pengiriman Diatur").alias("ship_date"),
        iso_date("Waktu Pesanan Selesai").alias("delivered_date"),
        replace_values(sku, SHOPEE_CODES).alias("barcode"),
        _raw("Jumlah").try_cast("int").alias("qty_sold"),
        in_order.alias("in_order"),
        whole_number(_raw("Harga Awal")).alias("basic_price"),
        whole_number(_raw("Total Diskon")).alias("existing_discount"),
        whole_number(_raw("Diskon Dari Shopee")).alias("subsidy"),
        whole_number(_raw("Voucher Ditanggung Penjual")).alias("seller_voucher"),
        whole_number(_raw("Ongkos Kirim Dibayar oleh Pembeli")).alias("fee"),
        whole_number(_raw("Estimasi Potongan Biaya Pengiriman")).alias("shipping_cut"),
        whole_number(_raw("Perkiraan Ongkos Kirim")).alias("freight"),
    ).withColumn("order_status", F.upper("order_status"))

    qty = C("qty_sold")

    def own_part(name: str) -> Column:
        return ratio(C(name), C("in_order")) * qty

    voucher = ratio(C("seller_voucher"), C("in_order"))
    discount = ratio(C("existing_discount"), qty)
    net = C("basic_price") * qty - C("existing_discount")
    value = net - voucher * qty + C("subsidy")
    if variant == "staging":
        value = value + own_part("fee") + own_part("shipping_cut") - own_part("freight")
    return _line(lines, "SHOPEE", {
        "basic_price": C("basic_price"),
        "discount": discount,
        "voucher": voucher,
        "net_sales": C("basic_price") - discount,
        "subsidy": C("subsidy"),
        "existing_basic_price": C("basic_price") * qty,
        "existing_discount": C("existing_discount"),
        "existing_voucher": voucher * qty,
        "existing_net_sales": net,
        "value_after_voucher": value,
        "delivery_fee": own_part("fee"),
    }, match=match)


def iso_date(name: str) -> Column:
    """Date part of an ISO time text, whatever time or offset follows it."""
    return parse_date(F.substring(_raw(name).cast("string"), 1, 10), "yyyy-MM-dd")


def lazada(raw: DataFrame, variant: str = "processed", match: Matcher | None = None) -> DataFrame:
    def date(name: str) -> Column:
        text = _raw(name).cast("string")
        return F.coalesce(
            iso_date(name), parse_date(text, "dd MM yyyy HH:mm:ss", "dd MMM yyyy HH:mm")
        )

    lines = raw.select(
        "brand",
        *[c.alias(n) for n, c in _text(raw, {
            "order_status": "status", "cancel_status": "buyerFailedDeliveryReturnInitiator",
            "cancel_reason": "buyerFailedDeliveryReason", "order_no": "orderNumber",
            "courier": "shippingProvider", "tracking_no": "trackingCode",
            "recipient_name": "customerName", "recipient_address": "shippingAddress",
            "recipient_city": "shippingCity", "recipient_postcode": "shippingPostCode",
        }).items()],
        date("createTime").alias("date"),
        date("updateTime").alias("ship_date"),
        date("deliveredDate").alias("delivered_date"),
        replace_values(_raw("sellerSku").cast("string"), LAZADA_CODES).alias("barcode"),
        F.lit(1).alias("qty_sold"),
        try_money(_raw("unitPrice")).alias("net_sales"),
        F.abs(zero_if_null(try_money(_raw("sellerDiscountTotal")))).alias("voucher"),
        try_money(_raw("shippingFee")).alias("delivery_fee"),
    ).withColumns(
        {"order_status": F.upper("order_status"), "cancel_status": F.upper("cancel_status")}
    )
    return _line(lines, "LAZADA", {
        "net_sales": C("net_sales"),
        "voucher": C("voucher"),
        "existing_net_sales": C("net_sales") * C("qty_sold"),
        "existing_voucher": C("voucher") * C("qty_sold"),
        "delivery_fee": C("delivery_fee"),
    }, master_priced=True, match=match)


def tiktok(raw: DataFrame, variant: str = "processed", match: Matcher | None = None) -> DataFrame:
    def amount(name: str) -> Column:
        return zero_if_null(whole_number(_raw(name), "IDR "))

    def date(name: str) -> Column:
        return parse_date(delete(_raw(name).cast("string"), "\t"), "dd/MM/yyyy HH:mm:ss")

    lines = raw.select(
        "brand",
        *[c.alias(n) for n, c in _text(raw, {
            "order_status": "Order Status", "sub_status": "Order Substatus",
            "cancel_status": "Cancelation/Return Type", "cancel_by": "Cancel By",
            "cancel_reason": "Cancel Reason", "order_no": "Order ID",
            "courier": "Shipping Provider Name", "tracking_no": "Tracking ID",
            "recipient_name": "Recipient", "recipient_phone": "Phone #",
            "recipient_address": "Detail Address", "recipient_district": "Districts",
            "recipient_city": "Regency and City", "recipient_postcode": "Zipcode",
        }).items()],
        date("Created Time").alias("date"),
        date("Shipped Time").alias("ship_date"),
        date("Delivered Time").alias("delivered_date"),
        part_of(_raw("Seller SKU").cast("string"), ".", 0).alias("barcode"),
        zero_if_null(_raw("Quantity").try_cast("int")).alias("qty_sold"),
        amount("SKU Unit Original Price").alias("basic_price"),
        amount("SKU Subtotal Before Discount").alias("existing_basic_price"),
        amount("SKU Subtotal After Discount").alias("existing_net_sales"),
        amount("SKU Seller Discount").alias("existing_discount"),
        amount("SKU Platform Discount").alias("subsidy"),
        amount("Shipping Fee After Discount").alias("delivery_fee"),
    ).withColumns(
        {
            "order_status": F.upper("order_status"),
            "recipient_address": delete("recipient_address", "="),
        }
    )
    return _line(lines, "TIKTOK", {
        **{n: C(n) for n in (
            "basic_price", "existing_basic_price", "existing_net_sales", "existing_discount",
            "subsidy", "delivery_fee",
        )},
        "voucher": F.lit(0),
        "existing_voucher": F.lit(0),
        "discount": ratio(C("existing_discount"), C("qty_sold")),
        "net_sales": ratio(C("existing_net_sales"), C("qty_sold")),
        "value_after_voucher": C("existing_net_sales") + C("subsidy"),
    }, match=match)


SHOPIFY_HEADER = (
    "Created at", "Fulfilled at", "Name", "Email", "Financial Status", "Fulfillment Status",
    "Payment Reference", "Shipping Name", "Shipping Phone", "Shipping Street",
    "Shipping Province Name", "Shipping City", "Shipping Zip",
)


def shopify(
    raw: DataFrame, variant: str = "processed", keep_incomplete: bool = False, match: Matcher | None = None
) -> DataFrame:
    """Header fields stand on an order's first line only; order names start anew in each brand's shop.

    An order whose header lacks a field (not yet fulfilled, no payment reference) is left out,
    unless ``keep_incomplete`` groups on the order name alone.
    """
    plain = {h: f"h{i}" for i, h in enumerate(SHOPIFY_HEADER)}
    filled = {h: F.coalesce(_raw(h), F.lit("")) for h in ("Email", "Shipping Province Name")}
    source = raw.select(
        "brand",
        *[filled.get(h, _raw(h)).cast("string").alias(p) for h, p in plain.items()],
        try_money(_raw("Discount Amount")).alias("order_discount"),
        _raw("Lineitem quantity").try_cast("int").alias("qty_sold"),
        try_money(_raw("Lineitem price")).alias("net_sales"),
        part_of(_raw("Lineitem sku").cast("string"), ".", 0).alias("barcode"),
    )
    name = plain["Name"]
    if keep_incomplete:
        others = [p for p in plain.values() if p != name]
        headers = source.where(all_present([name])).groupBy("brand", name).agg(
            *[F.max(p).alias(p) for p in others], sum0("order_discount").alias("order_discount")
        )
    else:
        headers = header_totals(source, ["brand", *plain.values()], "order_discount")
    quantities = source.groupBy("brand", name).agg(sum0("qty_sold").alias("in_order"))
    headers = keep_facts(headers, quantities, ["brand", name])
    headers = headers.withColumn("voucher", ratio(C("order_discount"), C("in_order")))
    headers = headers.withColumnsRenamed({name: "__name", "brand": "__brand"})
    details = source.select("brand", name, "qty_sold", "net_sales", "barcode")
    # Same rows as headers joined to their lines; the larger side stays on the left.
    same = F.col("brand").eqNullSafe(F.col("__brand")) & F.col(name).eqNullSafe(F.col("__name"))
    joined = details.join(headers, same, "inner")

    def head(h: str) -> Column:
        return C(plain[h]) if h != "Name" else C("__name")

    text = {
        "order_status": F.upper(head("Financial Status")),
        "sub_status": F.upper(head("Fulfillment Status")),
        "order_no": F.concat(F.coalesce(head("Payment Reference"), F.lit("")) if keep_incomplete
                             else head("Payment Reference"), head("Name")),
        "recipient_name": head("Shipping Name"),
        "recipient_phone": head("Shipping Phone"),
        "recipient_address": head("Shipping Street"),
        "recipient_district": head("Shipping Province Name"),
        "recipient_city": head("Shipping City"),
        "recipient_postcode": head("Shipping Zip"),
    }
    empty = F.lit(None).cast("string")
    lines = joined.select(
        "brand",
        *[text.get(c, empty).alias(c) for c in TEXT_COLUMNS],
        iso_date(plain["Created at"]).alias("date"),
        F.coalesce(iso_date(plain["Fulfilled at"]), F.lit(NO_SHIP_DATE).cast("date")).alias("ship_date"),
        F.lit(None).cast("date").alias("delivered_date"),
        "barcode",
        "qty_sold",
        "net_sales",
        "voucher",
    )
    return _line(lines, "SHOPIFY", {
        "net_sales": C("net_sales"),
        "voucher": C("voucher"),
        "existing_net_sales": C("net_sales") * C("qty_sold"),
        "existing_voucher": C("voucher") * C("qty_sold"),
    }, master_priced=True, match=match)


def tokopedia(raw: DataFrame, variant: str = "processed", match: Matcher | None = None) -> DataFrame:
    status = _raw("Status Terakhir").cast("string")
    reason = F.when(status.contains(" -\n"), part_of(status, "-\n", 1)).otherwise(F.lit(""))
    lines = raw.where(_raw("Nomor Invoice").isNotNull()).select(
        "brand",
        *[c.alias(n) for n, c in (_text(raw, {
            "order_no": "Nomor Invoice", "courier": "Nama Kurir",
            "tracking_no": "No Resi / Kode Booking", "recipient_name": "Nama Penerima",
            "recipient_phone": "No Telp Penerima", "recipient_address": "Alamat Pengiriman",
            "recipient_district": "Provinsi", "recipient_city": "Kota",
        }) | {
            "order_status": F.upper(part_of(status, " -\n", 0)), "cancel_reason": reason,
        }).items()],
        parse_date(_raw("Tanggal Pembayaran"), "dd-MM-yyyy HH:mm:ss").alias("date"),
        parse_date(_raw("Tanggal Pengiriman Barang"), "dd-MM-yyyy").alias("ship_date"),
        parse_date(_raw("Tanggal Pesanan Selesai"), "dd-MM-yyyy").alias("delivered_date"),
        _raw("Nomor SKU").cast("string").alias("barcode"),
        _raw("Jumlah Produk Dibeli").try_cast("int").alias("qty_sold"),
        try_money(_raw("Harga Awal (IDR)")).alias("basic_price"),
        try_money(_raw("Harga Jual (IDR)")).alias("net_sales"),
        try_money(_raw("Jumlah Subsidi Tokopedia (IDR)")).alias("subsidy"),
        try_money(_raw("Nilai Kupon Toko Terpakai (IDR)")).alias("total_voucher"),
    )
    basic, net, qty = C("basic_price"), C("net_sales"), C("qty_sold")
    existing_net = basic * qty - (basic - net) * qty
    if variant == "staging":
        mean = ratio(F.sum("total_voucher"), F.count("total_voucher"))
        lines = attach_totals(lines, ["brand", "order_no"], {"voucher": ratio(mean, F.sum("qty_sold"))})
        value = existing_net.cast("double") - C("voucher") * qty
    else:
        lines = lines.withColumn("voucher", ratio(C("total_voucher"), qty))
        value = existing_net.cast("double") - C("voucher") * qty + C("subsidy")
    return _line(lines, "TOKOPEDIA", {
        "basic_price": basic,
        "discount": basic - net,
        "voucher": C("voucher"),
        "net_sales": net,
        "subsidy": C("subsidy"),
        "existing_basic_price": basic * qty,
        "existing_discount": (basic - net) * qty,
        "existing_voucher": C("voucher") * qty,
        "existing_net_sales": existing_net,
        "value_after_voucher": value,
    }, match=match)


def zalora(raw: DataFrame, variant: str = "processed", match: Matcher | None = None) -> DataFrame:
    lines = raw.select(
        "brand",
        *[c.alias(n) for n, c in _text(raw, {
            "order_status": "Status", "cancel_reason": "Reason", "order_no": "Order Number",
            "courier": "Shipping Provider", "tracking_no": "Tracking Code",
            "recipient_name": "Shipping Name", "recipient_phone": "Shipping Phone Number2",
            "recipient_address": "Shipping Address", "recipient_district": "Shipping Region",
            "recipient_city": "Shipping City", "recipient_postcode": "Shipping Postcode",
        }).items()],
        iso_date("Created at").alias("date"),
        F.lit(None).cast("date").alias("ship_date"),
        iso_date("Updated at").alias("delivered_date"),
        _raw("Seller SKU").cast("string").alias("barcode"),
        F.lit(1).alias("qty_sold"),
        try_money(_raw("Unit Price")).alias("net_sales"),
        (
            try_money(_raw("Unit Price"))
            - try_money(_raw("Paid Price"))
            - try_money(_raw("Store Credits"))
            - try_money(_raw("Wallet Credits"))
        ).alias("voucher"),
        try_money(_raw("Shipping Fee")).alias("delivery_fee"),
    ).withColumn("order_status", F.upper("order_status"))
    return _line(lines, "ZALORA", {
        "net_sales": C("net_sales"),
        "voucher": C("voucher"),
        "existing_voucher": C("voucher") * C("qty_sold"),
        "delivery_fee": C("delivery_fee"),
    }, master_priced=True, match=match)


def blibli(raw: DataFrame, variant: str = "processed", match: Matcher | None = None) -> DataFrame:
    voucher = try_money(_raw("Voucher seller"))
    lines = raw.select(
        "brand",
        *[c.alias(n) for n, c in (_text(raw, {
            "order_status": "Order Status", "courier": "Servis Logistik", "tracking_no": "No. Awb",
        }) | {"order_no": unquote(_raw("No. Order").cast("string"))}).items()],
        parse_date(_raw("Tanggal Order"), "dd/MM/yyyy HH:mm").alias("date"),
        F.lit(None).cast("date").alias("ship_date"),
        F.lit(None).cast("date").alias("delivered_date"),
        unquote(_raw("Merchant SKU").cast("string")).alias("barcode"),
        _raw("Total Barang").try_cast("int").alias("qty_sold"),
        try_money(_raw("Harga item pesanan")).alias("basic_price"),
        try_money(_raw("Total harga item pesanan")).alias("existing_basic_price"),
        try_money(_raw("Diskon")).alias("discount"),
        (voucher if variant == "staging" else F.abs(voucher)).alias("voucher"),
    ).withColumn("order_status", F.upper("order_status"))
    qty = C("qty_sold")
    net = C("existing_basic_price") - C("discount") * qty
    return _line(lines, "BLIBLI", {
        "basic_price": C("basic_price"),
        "discount": C("discount"),
        "voucher": C("voucher"),
        "net_sales": C("basic_price") - C("discount"),
        "existing_basic_price": C("existing_basic_price"),
        "existing_discount": C("discount") * qty,
        "existing_voucher": C("voucher") * qty,
        "existing_net_sales": net,
        "value_after_voucher": net - C("voucher") * qty,
    }, match=match)


LAYOUTS: dict[str, Callable[..., DataFrame]] = {
    "blibli": blibli,
    "lazada": lazada,
    "shopee": shopee,
    "shopify": shopify,
    "tiktok": tiktok,
    "tokopedia": tokopedia,
    "zalora": zalora,
}


def layout(marketplace: str, raw: DataFrame, variant: str = "processed", match: Matcher | None = None) -> DataFrame:
    """The uniform line of an export, by marketplace name in any letter case."""
    return LAYOUTS[marketplace.lower()](raw, variant=variant, match=match)


def normalise(
    marketplace: str, raw: DataFrame, match: Matcher, variant: str = "processed"
) -> DataFrame:
    """One export to normalised, matched and priced lines."""
    return _priced(layout(marketplace, raw, variant, match))


def normalise_all(
    exports: Mapping[str, DataFrame], match: Matcher, variant: str = "processed"
) -> DataFrame:
    """All exports united by column name, matched in a single join."""
    lines = [layout(m, raw, variant) for m, raw in exports.items()]
    return match_and_price(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lines), match
    )
