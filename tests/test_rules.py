"""Rule tables and business decisions at their boundaries."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from lapak.operators import incentives as inc
from lapak.operators.accumulating import align_periods, compare_periods, online_stores
from lapak.operators.calendar import date_dimension, calendar_pattern
from lapak.operators.changes import replace_by_date, store_versions, upsert
from lapak.operators.marketplaces import normalise, processed_matcher
from lapak.operators.monitoring import upload_monitor
from lapak.operators.payments import allocate_payments, payment_summary
from lapak.operators.products import (
    cost_line_plus_margin,
    cost_margin_first,
    cost_per_unit,
    match_online_codes,
)
from lapak.operators.status import (
    CANCELED_STATUSES,
    DELIVERED_STATUSES,
    fill_dates,
    margin_rate,
    sale_status,
)

D = dt.date


def test_sale_status_table(frame):
    subs = [None, "", "UNFULFILLED", "DELIVERED", "PERMINTAAN DISETUJUI"]
    cancels = [None, "", "CANCEL-BUYER", "SELLER"]
    others = ["COMPLETED", "DELIVERED", "CONFIRMED", "paid", "PAID", "SELESAI", "SHIPPED", "ELSE", None]
    raws = [*CANCELED_STATUSES, *DELIVERED_STATUSES, *others]
    assert len({r.upper() for r in raws if r and r != "ELSE"}) == 23

    def expected(raw, sub, cancel):
        sub, cancel = sub or "", cancel or ""
        if raw in CANCELED_STATUSES:
            return "CANCELED"
        if raw in DELIVERED_STATUSES:
            return "DELIVERED"
        if raw in ("COMPLETED", "DELIVERED"):
            return "CANCELED" if cancel else "DELIVERED"
        if raw == "CONFIRMED":
            return "DELIVERED" if cancel in ("", "CANCEL-BUYER") else "CANCELED"
        if raw in ("paid", "PAID"):
            return "ONPROGRESS" if sub == "UNFULFILLED" else "DELIVERED"
        if raw == "SELESAI":
            return "CANCELED" if sub == "PERMINTAAN DISETUJUI" else "DELIVERED"
        if raw == "SHIPPED":
            if sub == "DELIVERED":
                return "DELIVERED"
            return "ONPROGRESS" if cancel in ("", "CANCEL-BUYER") else "CANCELED"
        return "ONPROGRESS"

    df = frame("raw string, sub string, cancel string", list(itertools.product(raws, subs, cancels)))
    out = df.withColumn("got", sale_status(F.col("raw"), F.col("sub"), F.col("cancel"))).collect()
    assert [r for r in out if r.got != expected(r.raw, r.sub, r.cancel)] == []


def test_date_back_fill(frame):
    rows = [("ONPROGRESS", D(2024, 1, 1), None, None), ("DELIVERED", D(2024, 1, 1), D(2024, 1, 2), None),
            ("DELIVERED", D(2024, 1, 1), None, None), ("CANCELED", D(2024, 1, 1), None, D(2024, 1, 9))]
    out = fill_dates(frame("sales_status string, date date, ship_date date, delivered_date date", rows)).collect()
    assert [(r.ship_date and r.ship_date.day, r.delivered_date.day) for r in out] == [(1, 1), (2, 2), (None, 1), (None, 9)]


def test_margin_override_from_may(frame):
    lines = frame("brand string, marketplace string, date date", [
        ("A", "TIKTOK", D(2024, 4, 30)), ("A", "TIKTOK", D(2024, 5, 1)), ("A", "SHOPIFY", D(2024, 6, 1)), ("B", "TIKTOK", D(2024, 4, 1))])
    rates = frame("brand string, marketplace string, margin_pct double", [("A", "TIK-TOK", 0.1), ("A", "WEBSITE", 0.2)])
    got = {(r.brand, r.marketplace, r.date.month): r.margin_pct for r in margin_rate(lines, rates).collect()}
    assert got == {("A", "TIKTOK", 4): 0.1, ("A", "TIKTOK", 5): 0.065, ("A", "SHOPIFY", 6): 0.2, ("B", "TIKTOK", 4): None}


def test_staff_ladder_boundaries(frame):
    cases = {
        (80_000_001.0, 1.2001): 600_000, (80_000_001.0, 1.2): 400_000, (80_000_001.0, 1.0): 400_000,
        (80_000_001.0, 0.95): 250_000, (80_000_001.0, 0.949): 0, (80_000_000.0, 1.3): 450_000,
        (40_000_000.0, 1.0): 300_000, (40_000_000.0, 0.95): 200_000, (39_999_999.0, 1.21): 300_000,
        (1.0, 1.0): 200_000, (1.0, 0.95): 150_000, (0.0, 1.3): 0,
    }
    df = frame("p double, a double", list(cases))
    got = {(r.p, r.a): r.x for r in df.withColumn("x", inc.sales_ladder(F.col("p"), F.col("a"))).collect()}
    assert got == cases
    heads = {1.21: 8_000_000, 1.2: 5_000_000, 1.0: 5_000_000, 0.95: 3_000_000, 0.9: 0}
    df = frame("a double", [(a,) for a in heads])
    assert {r.a: r.x for r in df.withColumn("x", inc.ladder(F.col("a"), inc.SENIOR_MANAGER)).collect()} == heads


def test_growth_requirement(frame):
    df = frame("g double, s string", [(0.10, "SSSG"), (0.0999, "SSSG"), (0.0, "NON"), (0.0, None)])
    got = [r.x for r in df.select(inc.growth_met(F.col("g"), F.col("s")).alias("x")).collect()]
    assert got == ["Yes", "No", "Yes", "Yes"]


def test_attendance(frame):
    rows = [("e1", "Sales Assistant", "10-A", "MALL SZ EAST", 25), ("e2", "Sales Assistant", "10-A", "MALL SZ EAST", 24),
            ("e3", "City Head", "10-A", "MALL SZ EAST", 30), ("e4", None, "11", "MALL", 25)]
    df = frame("employee_id string, job_position string, branch_code string, branch string, hari_kerja int", rows)
    got = {r.employee_id: (r.dataareaid, r.axcode, r.jumlah_karyawan, r.absenreq) for r in inc.attendance_eligibility(df).collect()}
    assert got == {"e1": ("mgl", "10", 2, "Yes"), "e2": ("mgl", "10", 2, "No"), "e4": ("mpr", "11", 1, "Yes")}


LINES = "order_id string, order_product_quantity int, order_product_total double, total_transaction_price double, cust_paid double, voucher double, member_point double, return_payment double"


def test_allocation_edges(frame):
    rows = [("a", 1, 600.0, 1000.0, 800.0, 100.0, 0.0, 0.0), ("b", 1, 400.0, 1000.0, 800.0, 100.0, 0.0, 0.0),
            ("c", -1, -500.0, 1000.0, 800.0, 100.0, 0.0, 0.0), ("d", 1, 10.0, 0.0, 5.0, 0.0, 0.0, 0.0),
            ("e", 1, 10.0, 10.0, None, None, None, None), ("f", 1, -5.0, 10.0, 5.0, 0.0, 0.0, 0.0)]
    got = {r.order_id: r for r in allocate_payments(frame(LINES, rows)).collect()}
    assert (got["a"].payment_contribution, got["a"].cust_paid_peritem, got["a"].voucher_peritem) == (0.6, 480.0, 60.0)
    assert got["a"].invoice_discount_peritem == 0.0 and got["b"].invoice_discount_peritem == 0.0  # 60 and 40: under 100
    assert (got["c"].payment_contribution, got["c"].cust_paid_peritem, got["c"].invoice_discount_peritem) == (0.0, 0.0, 0.0)
    assert got["d"].payment_contribution is None and got["d"].invoice_discount_peritem is None
    assert got["e"].cust_paid_peritem is None and got["e"].invoice_discount_peritem is None
    assert got["f"].payment_contribution == 0.0


def test_payment_summary(frame):
    schema = "store_branch_extcode string, time_created string, transaction_id string, order_id string, payment_method_name string, payment_total double, payment_change double, payment_fee double, payment_amount double"
    rows = [("1", "t", "T1", "o1", "Cash", 100.0, 5.0, 1.0, 100.0), ("1", "t", "T1", "o1", "Gift Card", 50.0, 0.0, 0.0, 200.0),
            ("1", "t", "T1", "o1", None, 7.0, 0.0, 0.0, None), (None, "t", "T2", "o2", "Cash", 9.0, 0.0, 0.0, 9.0)]
    out = payment_summary(frame(schema, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.gift_card, r.voucher, r.payment_total, r.payment_amount, r.cust_paid) == (50.0, 50.0, 157.0, 150.0, 102.0)


def test_cost_definitions(frame):
    df = frame("h double, m double, q int", [(10.0, 3.0, 2), (10.0, 0.0, 2)])
    c = F.col("h"), F.col("m"), F.col("q")
    out = df.select(cost_line_plus_margin(*c).alias("a"), cost_per_unit(*c).alias("b"), cost_margin_first(*c).alias("c")).collect()
    assert [tuple(r) for r in out] == [(23.0, 26.0, 6.0), (20.0, 20.0, 20.0)]


ITEM = "dataareaid string, codebars string, itemid string, umbrellabrand string, alucode string, season string, world string, category string, subcategory string, pricecategory string, yearmonth string, hpp double, basicprice double"


def item(company, code, ident, alu, hpp=1.0):
    return (company, code, ident, None, alu, None, None, None, None, None, None, hpp, 100.0)


def test_code_cascade(frame):
    items = frame(ITEM, [
        item("mgl", "0111", "g1", "AL1"), item("mgl", "AL1", "g2", "AL2"), item("mpr", "0222", "p1", "AL9"),
        item("mgl", "333", "g3", "AL3"), item("mgl", "0444", "g4", "AL4", None), item("mpr", "0444", "p4", "AL5"),
        item("mgl", "0555", "g5", "AL6", None),
    ])
    lines = frame("brand string, barcode string", [
        ("SZ", "AL1"), ("SZ", "0111"), ("SZ", "0222"), ("SZ", "222"), ("SZ", "0333"), ("SZ", "111"), ("SZ", "0444"),
        ("SZ", "0555"), ("SZ", "nope"), ("SZ", None), ("MN", "0222"), ("MN", "222"), ("MN", "0111"), ("MN", "999"), ("MN", "AL9"),
    ])
    got = {(r.brand, r.barcode, r.itemid) for r in match_online_codes(lines, items).collect()}
    assert got == {
        ("SZ", "AL1", "g1"), ("SZ", "0111", "g1"), ("SZ", "0222", "p1"), ("SZ", "222", "p1"), ("SZ", "0333", "g3"),
        ("SZ", "111", "g1"), ("SZ", "0444", "p4"), ("SZ", "0555", "g5"), ("SZ", "nope", None), ("SZ", None, None),
        ("MN", "0222", "p1"), ("MN", "0111", None), ("MN", "0999", None), ("MN", "0AL9", None),
    }
    assert match_online_codes(lines, items).count() == 15


def test_shopify_keeps_incomplete_headers_on_request(frame):
    from lapak.operators.marketplaces import SHOPIFY_HEADER, match_and_price, shopify

    names = [*SHOPIFY_HEADER, "Discount Amount", "Lineitem quantity", "Lineitem price", "Lineitem sku", "brand"]
    full = ["2024-01-02 10:00:00 +0700", "2024-01-03", "#1", None, "paid", "fulfilled", "R", "n", "p", "s", None, "c", "z", "10", "1", "50", "0222", "MN"]
    more = [None] * 2 + ["#1"] + [None] * 10 + [None, "3", "20", "0222.0", "MN"]
    waiting = ["2024-01-02 10:00:00 +0700", None, "#2", None, "paid", "unfulfilled", "Q", "n", "p", "s", "x", "c", "z", "4", "2", "30", "0222", "MN"]
    raw = frame(", ".join(f"`{n}` string" for n in names), [tuple(full), tuple(more), tuple(waiting)])
    match = processed_matcher(frame(ITEM, [item("mpr", "0222", "p1", "AL9")]))
    out = normalise("Shopify", raw, match).orderBy("qty_sold").collect()
    assert [(r.order_no, r.qty_sold, r.voucher, r.existing_voucher, r.basic_price) for r in out] == [("R#1", 1, 2.5, 2.5, 100.0), ("R#1", 3, 2.5, 7.5, 100.0)]
    kept = match_and_price(shopify(raw, keep_incomplete=True), match).where("order_no = 'Q#2'").collect()
    assert [(r.ship_date, r.sub_status) for r in kept] == [(D(1900, 1, 1), "UNFULFILLED")]


PATTERN = "pattern_date date, pattern_lm date, pattern_last_year date"
SOLD = "dataareaid string, axcode string, order_create_date date, codebars string, ordernumber bigint, quantity bigint, cust_paid_peritem double, hpp_total double"


def test_aligning_equals_outer_joins(frame):
    pattern = frame(PATTERN, [(D(2024, 1, d), D(2023, 12, d), D(2023, 1, d) if d < 3 else None) for d in (1, 2, 3, 4)])
    days = [D(2024, 1, 1), D(2024, 1, 3), D(2023, 12, 1), D(2023, 12, 2), D(2023, 12, 3), D(2023, 1, 1), D(2022, 5, 5)]
    sold = frame(SOLD, [("mpr", s, d, b, 1, i, float(i), 1.0) for i, (d, s, b) in enumerate(itertools.product(days, "12", "xy"))])
    used = pattern.where(F.col("pattern_date").isin(D(2024, 1, 1), D(2024, 1, 3)))
    joined = compare_periods(sold, sold, sold, pattern)
    aligned = align_periods(sold, used)
    columns = sorted(joined.columns)
    assert sorted(map(tuple, joined.select(columns).collect())) == sorted(map(tuple, aligned.select(columns).collect()))
    assert joined.count() > 0


def test_month_weight_and_missing_counterpart(frame):
    rows = [(D(2024, 3, d), None, D(2023, 3, d)) for d in (1, 2, 3, 4)]  # Friday to Monday
    out = date_dimension(calendar_pattern(frame(PATTERN, rows))).orderBy("pattern_date").collect()
    assert [r.day_score for r in out] == [1.5, 2.0, 2.0, 1.0]
    assert {r.month_score for r in out} == {6.5}
    assert out[0].id == "2024-03-01//2023-03-01"


def test_online_store_names(frame):
    df = frame("stdname string, channel string", [("ONLINE SZ WEBSITE", "online"), ("ONLINE MN", "ONLINE"), ("X Y Z", "SHOWROOM")])
    assert {(r.brand, r.marketplace) for r in online_stores(df).collect()} == {("SZ", "SHOPIFY"), ("MN", "")}


def test_upsert_twice_changes_nothing(frame):
    schema = "id int, k string, a int, b string"
    existing = frame(schema, [(1, "x", 1, "u"), (2, "y", 2, None), (3, None, 3, "w"), (4, "z", 9, "q")])
    new = frame("k string, a int, b string", [("x", 1, "u"), ("y", 5, None), (None, 3, "v"), ("n", 7, "t")])
    first = upsert(existing, new, ["k"], "t", stamp=F.lit("2024-01-01").cast("timestamp"))
    merged = {r.id: (r.a, r.b) for r in first.merged.collect()}
    assert merged == {1: (1, "u"), 2: (5, None), 3: (3, "v"), 4: (9, "q")}
    assert [(r.k, r.a) for r in first.inserts.collect()] == [("n", 7)]
    assert {r.id: r.changes for r in first.log.collect()} == {2: '{"a":"5"}', 3: '{"b":"v"}'}
    inserted = first.inserts.withColumn("id", F.lit(5)).select(*existing.columns)
    again = upsert(first.merged.unionByName(inserted), new, ["k"], "t")
    assert again.log.count() == 0 and again.inserts.count() == 0


def test_replace_by_date_is_idempotent(frame):
    old = frame("d int, v int", [(1, 1), (1, 2), (2, 3)])
    new = frame("d int, v int", [(1, 9), (3, 4)])
    once = replace_by_date(old, new, "d")
    assert sorted(map(tuple, once.collect())) == [(1, 9), (2, 3), (3, 4)]
    assert sorted(map(tuple, replace_by_date(once, new, "d").collect())) == sorted(map(tuple, once.collect()))


STORE = "store_key bigint, store_code string, store_name string, store_city string, start_date date, end_date date, create_date date, update_date date, current_status string"


def test_store_versions(frame):
    day = D(2024, 1, 1)
    existing = frame(STORE, [
        (1, "same", "n", None, day, None, day, day, "current"), (2, "two", "n", "c", day, None, day, day, "current"),
        (3, "gone", "n", "c", day, None, day, day, "current"), (4, "two", "older", "c", day, day, day, day, "previous"),
    ])
    new = frame("store_code string, store_name string, store_city string", [("same", "n", None), ("two", "m", "d"), ("fresh", "f", "c")])
    out = store_versions(existing, new, F.lit(D(2024, 7, 2)))
    got = sorted((r.store_code, r.store_key, r.store_name, r.current_status, r.end_date) for r in out.collect())
    end = D(2024, 7, 2)
    assert got == [
        ("fresh", 5, "f", "current", None), ("gone", 3, "n", "current", None), ("same", 1, "n", "current", None),
        ("two", 2, "n", "previous", end), ("two", 4, "older", "previous", day), ("two", 6, "m", "current", None),
    ]
    again = store_versions(out, new, F.lit(D(2024, 8, 1)))
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_upload_monitor(frame):
    def at(*x):
        return dt.datetime(2024, 7, *x)

    rows = [("a/raw/SZ/2024/July/Shopee_July_SZ.csv", at(2, 2, 59)), ("a/raw/SZ/2024/July/Shopee_July_SZ.xlsx", at(2, 3, 1)),
            ("a/raw/MN/2024/July/Tik-tok_July_MN.csv", at(1, 3, 0)), ("a/raw/MN/2024/June/Tiktok_June_MN.csv", at(2, 1, 0)),
            ("a/raw/MN/2024/July/notes.txt", at(2, 1, 0))]
    out = upload_monitor(frame("path string, modified timestamp", rows), dt.datetime(2024, 7, 2, 12)).collect()
    got = {r.files: (r.ecommerce, r.check_upload, r.is_late, r.is_duplicated) for r in out}
    assert got == {
        "Shopee_July_SZ.csv": ("Shopee", "Up To Date", "Ontime", "Duplicated"),
        "Shopee_July_SZ.xlsx": ("Shopee", "Up To Date", "Late", "Duplicated"),
        "Tik-tok_July_MN.csv": ("Tiktok", "Not Up To Date", "Late", "Not Duplicated"),
    }


def test_replace_by_date_keeps_other_scopes(frame):
    old = frame("brand string, d timestamp, v int", [("A", dt.datetime(2024, 1, 1, 8), 1), ("B", dt.datetime(2024, 1, 1, 9), 2), ("A", None, 3)])
    new = frame("brand string, d timestamp, v int", [("A", dt.datetime(2024, 1, 1, 20), 4)])
    assert sorted(r.v for r in replace_by_date(old, new, "d", ["brand"]).collect()) == [2, 3, 4]


def test_upsert_takes_a_repeated_key_once(frame):
    old = frame("id int, k string, v int", [(1, "a", 1)])
    load = frame("k string, v int", [("a", 2), ("a", 3), ("b", 4), ("b", 4)])
    result = upsert(old, load, ["k"], "t")
    assert [tuple(r) for r in result.merged.collect()] == [(1, "a", 3)]
    assert [tuple(r) for r in result.inserts.collect()] == [("b", 4)]
