"""Values of marketplace exports that do not parse, each with its reason, beside the rows that do.

The layouts turn a text that is no date or number into NULL, which later sums count as 0. Here the
same readings are tried on every typed column of an export, and what fails is kept: one pass over
the export marks its rows, and one write sends good rows and rejects to two sinks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.numbers import try_money
from ..functions.text import delete, whole_number
from ..sources.schemas import EXPORT_DATE_COLUMNS
from .marketplaces import iso_date

Reading = Callable[[str], Column]


def _raw(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _day(*formats: str) -> Reading:
    return lambda name: parse_date(_raw(name), *formats)


def _day_or_iso(*formats: str) -> Reading:
    return lambda name: F.coalesce(iso_date(name), parse_date(_raw(name), *formats))


def _tabbed_day(*formats: str) -> Reading:
    return lambda name: parse_date(delete(_raw(name), "\t"), *formats)


def _money(name: str) -> Column:
    return try_money(_raw(name))


def _whole(name: str) -> Column:
    return whole_number(_raw(name))


def _rupiah(name: str) -> Column:
    return whole_number(_raw(name), "IDR ")


def _count(name: str) -> Column:
    return _raw(name).try_cast("int")


#: How each layout reads the dates and numbers of its export.
DATES: dict[str, dict[str, Reading]] = {
    "shopee": dict.fromkeys(("Waktu Pesanan Dibuat", "Waktu Pengiriman Diatur", "Waktu Pesanan Selesai"), iso_date),
    "lazada": dict.fromkeys(("createTime", "updateTime", "deliveredDate"), _day_or_iso("dd MM yyyy HH:mm:ss", "dd MMM yyyy HH:mm")),
    "tiktok": dict.fromkeys(("Created Time", "Shipped Time", "Delivered Time"), _tabbed_day("dd/MM/yyyy HH:mm:ss")),
    "shopify": dict.fromkeys(("Created at", "Fulfilled at"), iso_date),
    "tokopedia": {
        "Tanggal Pembayaran": _day("dd-MM-yyyy HH:mm:ss"),
        "Tanggal Pengiriman Barang": _day("dd-MM-yyyy"),
        "Tanggal Pesanan Selesai": _day("dd-MM-yyyy"),
    },
    "zalora": dict.fromkeys(("Created at", "Updated at"), iso_date),
    "blibli": {"Tanggal Order": _day("dd/MM/yyyy HH:mm")},
}
NUMBERS: dict[str, dict[str, Reading]] = {
    "shopee": dict.fromkeys(("Jumlah", "Jumlah Produk di Pesan"), _count)
    | dict.fromkeys(
        ("Harga Awal", "Total Diskon", "Diskon Dari Shopee", "Voucher Ditanggung Penjual", "Ongkos Kirim Dibayar oleh Pembeli",
         "Estimasi Potongan Biaya Pengiriman", "Perkiraan Ongkos Kirim"),
        _whole,
    ),
    "lazada": dict.fromkeys(("unitPrice", "sellerDiscountTotal", "shippingFee"), _money),
    "tiktok": {"Quantity": _count}
    | dict.fromkeys(
        ("SKU Unit Original Price", "SKU Subtotal Before Discount", "SKU Subtotal After Discount", "SKU Seller Discount",
         "SKU Platform Discount", "Shipping Fee After Discount"),
        _rupiah,
    ),
    "shopify": {"Lineitem quantity": _count} | dict.fromkeys(("Discount Amount", "Lineitem price"), _money),
    "tokopedia": {"Jumlah Produk Dibeli": _count}
    | dict.fromkeys(
        ("Harga Awal (IDR)", "Harga Jual (IDR)", "Jumlah Subsidi Tokopedia (IDR)", "Nilai Kupon Toko Terpakai (IDR)"), _money
    ),
    "zalora": dict.fromkeys(("Unit Price", "Paid Price", "Store Credits", "Wallet Credits", "Shipping Fee"), _money),
    "blibli": {"Total Barang": _count}
    | dict.fromkeys(("Harga item pesanan", "Total harga item pesanan", "Diskon", "Voucher seller"), _money),
}
#: An order's date has to be there, but for exports that write it on an order's first line only.
WITHOUT_DATE = ("shopify",)
_ERRORS = "array<struct<column:string,value:string,reason:string>>"


def value_errors(raw: DataFrame, marketplace: str) -> Column:
    """Array of (column, value, reason) for every typed value of a row that cannot be read.

    An empty value is an error for the order date only. Columns that an export lacks have none.
    """
    name = marketplace.lower()
    found = []
    for reason, readings in (("not a date", DATES[name]), ("not a number", NUMBERS[name])):
        for column, read in readings.items():
            if column not in raw.columns:
                continue
            text = _raw(column)
            empty = F.coalesce(F.regexp_replace(text, r"\s+", "") == "", F.lit(True))
            wrong = F.when(~empty & read(column).isNull(), F.lit(reason))
            if column == EXPORT_DATE_COLUMNS[name][0] and name not in WITHOUT_DATE:
                wrong = F.when(empty, F.lit("empty")).otherwise(wrong)
            error = F.struct(F.lit(column).alias("column"), text.alias("value"), wrong.alias("reason"))
            found.append(F.when(wrong.isNotNull(), error))
    return F.array_compact(F.array(*found)).cast(_ERRORS) if found else F.array().cast(_ERRORS)


def checked(raw: DataFrame, marketplace: str, errors: str = "errors") -> DataFrame:
    """``raw`` with the errors of each row."""
    return raw.withColumn(errors, value_errors(raw, marketplace))


def write_checked(rows: DataFrame, path: str, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Checked rows written in one pass to two sinks below ``path``, ``rejected=false`` and ``rejected=true``.

    Returns what the sinks hold: the good rows, without errors, and the rejects with theirs. A
    repeated run replaces both.
    """
    marked = rows.withColumn("rejected", F.size(errors) > 0)
    marked.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(path)
    sinks = rows.sparkSession.read.schema(marked.schema).parquet(path)
    return sinks.where("not rejected").drop("rejected", errors), sinks.where("rejected").drop("rejected")


def reject_report(rejects: DataFrame, marketplace: str, errors: str = "errors") -> DataFrame:
    """marketplace, column, reason, rows and an example: what failed, and how often."""
    each = rejects.select(F.explode(errors).alias("e"))
    return each.groupBy(F.lit(marketplace.lower()).alias("marketplace"), F.col("e.column").alias("column"), F.col("e.reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("e.value").alias("example")
    )


def united(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
