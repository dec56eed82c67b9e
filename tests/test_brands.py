"""Brands share order names and dates without mixing; unreadable dates are kept apart."""

import datetime as dt

from lapak.operators.marketplaces import SHOPIFY_HEADER, shopify
from lapak.plans.raw_drop import merge_drop, undated
from lapak.sources.schemas import EXPORT_DATE_COLUMNS, EXPORT_SKU_COLUMNS


def test_shopify_orders_of_two_brands(frame):
    columns = ["brand", *SHOPIFY_HEADER, "Discount Amount", "Lineitem quantity", "Lineitem price", "Lineitem sku"]
    rows = []
    for brand, customer, discount in (("A", "Ani", "100"), ("B", "Budi", "60")):
        head = {c: "x" for c in SHOPIFY_HEADER} | {
            "Name": "#1001", "Created at": "2024-01-02 03:04:05 +0700", "Fulfilled at": "2024-01-03 03:04:05 +0700", "Shipping Name": customer,
        }
        rows.append((brand, *[head[c] for c in SHOPIFY_HEADER], discount, "2", "500", f"sku{brand}"))
    out = shopify(frame(", ".join(f"`{c}` string" for c in columns), rows))
    found = {r.brand: r for r in out.collect()}
    assert out.count() == 2
    assert found["A"].recipient_name == "Ani" and found["B"].recipient_name == "Budi"
    assert float(found["A"].voucher) == 50 and float(found["B"].voucher) == 30


def test_drop_replaces_its_brand_and_undated_rows_are_returned(frame):
    date, sku = EXPORT_DATE_COLUMNS["blibli"][0], EXPORT_SKU_COLUMNS["blibli"]
    schema = f"brand string, `{date}` string, `{sku}` string"
    drop = frame(schema, [("A", "05/07/2000 10:00", "new"), ("A", "no date", "lost"), ("A", None, "none")])
    old = frame(schema + ", drop_date date", [(b, "05/07/2000 09:00", f"old{b}", dt.date(2000, 7, 5)) for b in "AB"])
    merged = merge_drop(old, drop, "blibli", dt.date(2000, 7, 20))
    assert sorted(r[sku] for r in merged.collect()) == ["new", "oldB"]
    assert sorted(r[sku] for r in undated(drop, "blibli").collect()) == ["lost", "none"]
