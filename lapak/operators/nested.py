"""Nested order and transfer documents to flat rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import LOCAL_OFFSET_HOURS


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Every field of every struct as its own column with a dotted name; arrays stay."""

    def leaves(struct: T.StructType, path: list[str]) -> list[tuple[list[str], str]]:
        out = []
        for field in struct.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                out.append((here, separator.join(here)))
        return out

    return df.select(
        *[
            F.col(".".join(f"`{p}`" for p in path)).alias(name)
            for path, name in leaves(df.schema, [])
        ]
    )


def order_headers(orders: DataFrame) -> DataFrame:
    """One row per order document, structs flattened."""
    return flatten_structs(orders)


def order_lines(orders: DataFrame) -> DataFrame:
    """One row per order line and promotion; an order without lines, and a line without
    promotions, keeps one row."""
    lines = orders.select(
        "id",
        "orderNumber",
        F.col("storeBranchData.extCode").alias("store_branch_extcode"),
        "timeCreated",
        F.explode_outer("orderProductDatas").alias("line"),
    )
    promoted = lines.select(
        "id", "orderNumber", "store_branch_extcode", "timeCreated", "line",
        F.explode_outer("line.promotionDatas").alias("promotion"),
    )
    return promoted.select(
        F.col("id").alias("order_id"),
        F.col("orderNumber").alias("order_number"),
        "store_branch_extcode",
        F.col("timeCreated").alias("time_created"),
        F.col("line.id").alias("order_product_id"),
        F.col("line.productData.barcode").alias("product_barcode"),
        F.col("line.quantity").alias("order_product_quantity"),
        F.col("line.total").alias("order_product_total"),
        F.col("promotion.value").alias("order_product_promotion_value"),
        F.col("promotion.promotionData.id").alias("promotion_id"),
        F.col("promotion.promotionData.detail.usedKey").alias("promocode"),
    )


def order_payments(orders: DataFrame) -> DataFrame:
    """One row per payment with the transaction's id; orders without payments give none."""
    return orders.select(
        F.col("transactionData.id").alias("transaction_id"),
        F.col("id").alias("order_id"),
        F.explode("transactionData.paymentDatas").alias("p"),
    ).select(
        "transaction_id",
        "order_id",
        F.col("p.id").alias("payment_id"),
        F.col("p.paymentMethodData.name").alias("payment_method_name"),
        F.col("p.amount").alias("payment_amount"),
        F.col("p.fee").alias("payment_fee"),
        F.col("p.total").alias("payment_total"),
        F.col("p.change").alias("payment_change"),
    )


def orders_between(
    orders: DataFrame, first: dt.date, last: dt.date, stores: list[str] | None = None
) -> DataFrame:
    """Orders created within local days, optionally of some stores only."""
    shift = dt.timedelta(hours=LOCAL_OFFSET_HOURS)
    start = dt.datetime.combine(first, dt.time()) - shift
    end = dt.datetime.combine(last + dt.timedelta(days=1), dt.time()) - shift

    def moment(value: dt.datetime) -> Column:
        return F.lit(f"{value:%Y-%m-%d %H:%M:%S}").cast("timestamp")

    kept = orders.where((F.col("timeCreated") >= moment(start)) & (F.col("timeCreated") < moment(end)))
    if stores:
        kept = kept.where(F.col("storeBranchData.extCode").isin(stores))
    return kept


def transfer_lines(pages: DataFrame) -> DataFrame:
    """Page to header to detail; an empty page and a header without details keep one row."""
    headers = pages.select("current_page", F.explode_outer("Data").alias("header"))
    fields = [
        f.name
        for f in pages.schema["Data"].dataType.elementType.fields
        if f.name != "Details"
    ]
    details = headers.select(
        "current_page",
        *[F.col(f"header.{f}").alias(f) for f in fields],
        F.explode_outer("header.Details").alias("detail"),
    )
    inner = pages.schema["Data"].dataType.elementType["Details"].dataType.elementType
    return details.select(
        "current_page",
        *[F.col(f).alias(f + "Header" if f in inner.names and f != "TransferId" else f) for f in fields],
        *[
            F.col(f"detail.{f}").alias(f + "Detail" if f in fields else f)
            for f in inner.names
            if f != "TransferId"
        ],
    )
