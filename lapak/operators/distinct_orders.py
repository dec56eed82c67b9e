"""Distinct orders over any period and grouping, from bitmaps that merge.

Orders per barcode cannot be added up, since an order with two barcodes would count twice. Here
every order has a dense number, and a store's day holds the set of its order numbers as exact
bitmaps; days merge into months and years, barcodes into categories, by a bitwise or, and the set
bits are the distinct orders. No report has to go back to the lines.

Numbers are given in the order of date and store, so a day's orders lie close together and fill one
or two bitmaps of 32,768 bits. Orders that arrive later get the next numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import number_rows

#: Columns of a numbered order and of a bitmap.
NUMBER, BUCKET, BITS = "order_no", "bucket", "orders"


def order_numbers(
    lines: DataFrame, order: str = "ordernumber", near: Sequence[str] = ("order_create_date", "axcode"), known: DataFrame | None = None
) -> DataFrame:
    """``order`` and its number, from 1, for every order of ``lines`` that is not in ``known``.

    New orders get the numbers above those in use. NULL is no order.
    """
    name = F.col(f"`{order}`").alias(order)
    first = F.min(F.struct(*[F.col(c) for c in near])).alias("__near")
    orders = lines.where(F.col(f"`{order}`").isNotNull()).groupBy(name).agg(first)
    last = 0
    if known is not None:
        orders = orders.join(known.select(order), order, "left_anti")
        last = known.agg(F.max(NUMBER)).first()[0] or 0
    placed = orders.select(order, *[F.col(f"__near.{c}").alias(f"__{i}") for i, c in enumerate(near)])
    numbered = number_rows(placed, [*[f"__{i}" for i in range(len(near))], order], name="__n")
    return numbered.select(order, (F.col("__n") + F.lit(last)).cast("long").alias(NUMBER))


def order_bitmaps(lines: DataFrame, numbers: DataFrame, by: Sequence[str], order: str = "ordernumber") -> DataFrame:
    """``by``, bucket and bits: the orders of each group. Lines without an order have none.

    What is shuffled are a group's distinct numbers, short rows of which a bitmap takes at most
    32,768 however hot the group, and not a bitmap of 4 KB for each line or two.
    """
    met = lines.select(*by, order).join(numbers.select(F.col(order), NUMBER), order)
    bucket, place = F.bitmap_bucket_number(NUMBER), F.bitmap_bit_position(NUMBER)
    single = met.select(*by, bucket.alias(BUCKET), place.alias("__place")).distinct()
    gathered = single.repartition(*[F.col(f"`{c}`") for c in (*by, BUCKET)])
    return gathered.groupBy(*by, BUCKET).agg(F.bitmap_construct_agg("__place").alias(BITS))


def merged(bitmaps: DataFrame, **by: Column | str) -> DataFrame:
    """Bitmaps of a coarser grouping: ``by`` gives its columns, by name or expression."""
    keys = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in by.items()]
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(bitmaps: DataFrame, *by: str, name: str = "ordernumber") -> DataFrame:
    """Distinct orders per ``by``, the columns that ``bitmaps`` are grouped by."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).cast("long").alias(name))


def distinct_orders(bitmaps: DataFrame, name: str = "ordernumber", **by: Column | str) -> DataFrame:
    """Distinct orders of a coarser grouping."""
    return counted(merged(bitmaps, **by), *by, name=name)
