"""What a large input must not send through shuffles and files more often than needed."""

import datetime as dt
import glob
from decimal import Decimal

from pyspark.sql import functions as F

from catalog import nested, pos
from catalog.shapes import RAW, Shapes
from lapak.operators.accumulating import ROW_ORDER, SALES_GRAIN, align_periods, category_year_report, sales_accumulation, sum_lines
from lapak.operators.aggregating import group_sum
from lapak.operators.dedup import derepeat, number_rows
from lapak.operators.distinct_orders import distinct_orders, order_bitmaps
from lapak.operators.joining import full_outer, keep_facts
from lapak.operators.marketplaces import normalise, processed_matcher
from lapak.operators.online_reports import settlement_template
from lapak.operators.open_documents import known_and_unknown, read_documents
from lapak.operators.payments import order_value
from lapak.operators.products import match_online_codes, refresh_online
from lapak.plans.pos_detail import PAID_BY, _paid_orders, pos_sales_report, staging_sync, with_products, with_staging
from lapak.session import ALL_KEYS, grouped_where_they_are, stored

FOLDER = "/root/testdata/sf0.001"


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_land_compressed_and_whole(spark):
    s = Shapes(spark, FOLDER)
    documents = nested.order_json(s)
    path = nested.landed(documents)
    files = glob.glob(path.removeprefix("file:") + "/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == sorted(r[0] for r in documents.collect())


def test_fields_of_nested_levels_are_found(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"id": "1", "x": 1, "s": {"k": 2, "y": null, "t": {"z": "q"}}, "a": [{"m": 1}, {"n": 2, "t": {"w": 3}}]}\n'
        '{"id": "2", "s": 5, "a": null}\n[1]\nbroken\n'
    )
    held = known_and_unknown(read_documents(spark, str(tmp_path)), "id string, s struct<k:int,t:struct<v:int>>, a array<struct<n:int,t:struct<v:int>>>")
    rows = held.select("id", F.explode("unknown_fields").alias("f")).select("id", "f.path", F.to_json("f.value")).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("1", "$.a[*].m", "1"), ("1", "$.a[*].t.w", "3"), ("1", "$.s.t.z", '"q"'), ("1", "$.s.y", "null"), ("1", "$.x", "1"),
    ]


def test_orders_meet_their_customers_before_the_lines(spark):
    joins = [line for line in logical(Shapes(spark, FOLDER).online_base).splitlines() if "Join Inner" in line]
    assert len(joins) == 3 and "o_orderkey" in joins[0]


def test_age_is_looked_up_per_product(frame):
    day = dt.date(2024, 1, 1)
    lines = frame("line int, dataareaid string, product_barcode string", [(1, "a", "x"), (2, "a", "none"), (3, "b", "none"), (4, None, None), (5, "a", "y")])
    master = frame("dataareaid string, product_barcode string, itemid string, subcategory string", [("a", "x", "i", "s"), ("a", "y", None, None)])
    aged = frame("dataareaid string, itemid string, last_ax_gr date, age int", [("a", "i", day, 1), ("a", "undetected", day, 2), (None, "undetected", day, 3), ("a", "other", day, 4)])
    out = with_products(lines, master, aged)
    assert sorted(tuple(r) for r in out.select("line", "itemid", "subcategory", "age").collect()) == [
        (1, "i", "s", 1), (2, "undetected", "undetected", 2), (3, "undetected", "undetected", None),
        (4, "undetected", "undetected", 3), (5, "undetected", "undetected", 2),
    ]


def test_report_has_no_window_over_its_rows(spark):
    s = Shapes(spark, FOLDER)
    sold = s.sales_lines.select(
        "dataareaid", "axcode", "order_create_date", "codebars", F.lit(1).alias("ordernumber"), "quantity", "cust_paid_peritem", "hpp_total"
    )
    products = s.products.select("dataareaid", "codebars", "itemid", "umbrellabrand", "subbrand", "world", "category", "subcategory")
    text = logical(sales_accumulation(sold, s.pattern, s.pattern, s.stores, products))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("itemid" not in w for w in windows)


def test_orders_of_one_marketplace_are_chosen_before_the_lines(spark):
    s = Shapes(spark, FOLDER)
    for market in RAW:
        some = s.sold_on(market).online_base
        whole = s.online_base.where(F.col("marketplace") == market.upper())
        assert some.exceptAll(whole).isEmpty() and whole.exceptAll(some).isEmpty(), market


def test_intermediate_tables_are_written_small(spark):
    table = stored(spark.range(10), "small")
    assert table.inputFiles() and all(f.endswith(".zstd.parquet") for f in table.inputFiles())


def test_numbered_rows_are_shuffled_once(frame):
    rows = frame("g string, v int", [("a", 2), ("a", 1), ("b", 5), (None, 3), ("a", None), ("b", 5)])
    out = number_rows(rows, ["v"], ["g"])
    assert "Window [" not in logical(out)
    got = sorted(((r.g or "", r.v or 0, r.no) for r in out.collect()))
    assert got == [("", 3, 1), ("a", 0, 1), ("a", 1, 2), ("a", 2, 3), ("b", 5, 1), ("b", 5, 2)]


def test_settled_lines_are_grouped_once(spark):
    text = logical(settlement_template(Shapes(spark, FOLDER).online_lines))
    assert "Join Inner" not in text and "settled" not in text


def test_days_are_summed_before_they_take_roles(frame):
    day = [dt.date(2024, 3, d) for d in range(1, 4)]
    sold = frame(
        "dataareaid string, axcode string, order_create_date date, codebars string, ordernumber long, quantity long, cust_paid_peritem decimal(18,2), hpp_total decimal(18,2)",
        [(a, "1", d, c, n, q, Decimal(p), Decimal(h)) for a, d, c, n, q, p, h in (
            ("a", day[0], "x", 1, 2, 3, 4), ("a", day[0], "y", 1, None, 3, 4), ("a", day[1], None, 9, 9, 9, 9), ("a", day[1], "x", 5, 6, 7, 8), (None, day[1], "x", 1, 1, 1, 1))],
    )
    pattern = frame("pattern_date date, pattern_lm date, pattern_last_year date", [(day[1], day[0], day[0]), (day[0], day[2], day[2])])
    fine = align_periods(sold, pattern)
    keys = ["dataareaid", "axcode", "id"]
    names = [c for c in fine.columns if c not in (*keys, "codebars")]
    expected = fine.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    got = align_periods(sold, pattern, by=())
    assert sorted(tuple(r) for r in got.select(*keys, *names).collect()) == sorted(tuple(r) for r in expected.select(*keys, *names).collect())


def test_prices_are_worked_out_after_the_match(spark):
    s = Shapes(spark, FOLDER)
    seen = []

    def match(lines):
        seen.append(lines.columns)
        return processed_matcher(s.match_items)(lines)

    for market in RAW:
        normalise(market, getattr(s, f"raw_{market}"), match)
    assert len(seen) == 7 and not any("value_after_voucher" in columns for columns in seen)


def test_long_files_are_not_spread(spark):
    s = Shapes(spark, FOLDER)
    s._loaded["lineitem"] = s.lineitem.repartition(64).localCheckpoint()
    assert "Rebalance" not in logical(s.spread("lineitem").lineitem)
    assert "Rebalance" in logical(Shapes(spark, FOLDER).spread("lineitem").lineitem)


ITEM = (
    "dataareaid string, codebars string, itemid string, umbrellabrand string, alucode string, season string, world string,"
    " category string, subcategory string, pricecategory string, yearmonth date, hpp decimal(18,2), basicprice decimal(18,2)"
)


def test_lines_meet_items_and_master_in_one_join(frame):
    day, now = dt.date(2024, 2, 1), dt.datetime(2024, 2, 1)
    items = frame(ITEM, [(c, b, f"i{c}{b}", "u", a, "s", "w", "c", "sub", "p", day, None if h is None else Decimal(h), Decimal(9)) for c, b, a, h in (
        ("mgl", "0111", "A1", 5), ("mgl", None, "A2", 6), ("mgl", "222", "A3", None), ("mpr", "0333", "A4", 7), ("mpr", "0111", "A5", 8))])
    master = frame(
        "dataareaid string, codebars string, variantnumber string, itemid string, umbrellabrand string, subbrand string, alucode string, season string, monthyear date,"
        " world string, category string, subcategory string, hpp decimal(18,2), basicprice decimal(18,2), pullstatus string, pulldate timestamp, modifieddatetime timestamp, recid int",
        [(c, b, f"v{i}", f"m{i}", "u", "sb", "a", "s", day, "w", "c", f"n{i}", Decimal(h), Decimal(3), "Current", now, now, i) for i, (c, b, h) in enumerate((
            ("mgl", "0111", 0), ("mgl", None, 2), ("mpr", "0333", 3), ("mpr", "0444", 4), ("mpr", "00555", 5), ("mpr", None, 6), ("mgl", "0444", 7), ("mpr", "0", 8), (None, "0444", 9)))],
    )
    codes = ["A1", "0111", "111", "A2", "A3", "222", "0222", "333", "0333", "00333", "444", "0444", "0555", "00555", "", "0", "x", None]
    lines = frame("brand string, barcode string, qty_sold int", [(b, c, i) for b in ("SZ", "MN", None) for i, c in enumerate(codes)])

    def rows(df):
        return sorted(map(str, df.select(sorted(df.columns)).collect()))

    apart = refresh_online(match_online_codes(lines, items), master)
    together = refresh_online(match_online_codes(lines, items, master), master)
    assert rows(together) == rows(apart) and together.count() == 54


def test_value_and_payments_of_an_order_meet_its_lines_once(frame):
    lines = frame("line int, transaction_id string, order_id string, store_branch_id long, order_product_quantity int, order_product_total decimal(18,2)", [
        (i, t, o, s, q, None if v is None else Decimal(v)) for i, (t, o, s, q, v) in enumerate((
            ("t", "o", 1, 2, 5), ("t", "o", 1, -1, 9), ("u", "o", 1, 1, 6), ("t", "o", None, 1, None), ("t", None, 1, 1, 7), (None, None, None, 1, 8),
            ("t", "p", 1, 1, None), ("t", "q", 1, -1, 3), ("t", "r", 1, None, 3)))])
    paid = frame("transaction_id string, order_id string, store_branch_id long, cust int", [("t", "o", 1, 1), ("t", "o", 1, 2), ("t", "o", None, 3), ("t", None, 1, 4), ("t", "q", 1, 5)])
    apart = keep_facts(lines, order_value(lines, "order_transaction_price"), ["order_id"], null_safe=False)
    apart = keep_facts(apart, paid, list(PAID_BY), null_safe=False)
    once = keep_facts(lines, _paid_orders(lines, paid), list(PAID_BY))
    assert once.dtypes == apart.dtypes
    assert sorted(map(str, once.collect())) == sorted(map(str, apart.collect()))


def test_bitmaps_are_made_where_their_numbers_were_gathered(frame):
    lines = frame("k string, ordernumber string", [("a", "1"), ("a", "1"), ("a", "2"), (None, "1"), ("b", "3"), ("b", None)])
    numbers = frame("ordernumber string, order_no long", [("1", 1), ("2", 40000), ("3", 3)])
    bits = order_bitmaps(lines, numbers, ["k"])
    plan = bits._jdf.queryExecution().executedPlan().toString()
    above = plan.split("REPARTITION_BY_COL")[0]
    assert "bitmap_construct_agg" in above and "Exchange" in plan and "ENSURE_REQUIREMENTS" not in above
    assert sorted((r.k or "", r.ordernumber) for r in distinct_orders(bits, k="k").collect()) == [("", 1), ("a", 2), ("b", 1)]


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def test_settings_of_a_write_are_put_back(spark):
    before = {name: spark.conf.get(name) for name in ALL_KEYS}
    try:
        with grouped_where_they_are(spark):
            assert {spark.conf.get(name) for name in ALL_KEYS} == {"false"}
            raise KeyError
    except KeyError:
        pass
    assert {name: spark.conf.get(name) for name in ALL_KEYS} == before


def test_sales_are_put_together_once_for_orders_and_sums(spark):
    s = Shapes(spark, FOLDER)
    lines = s.landed("sales_lines").sales_lines.select(*SALES_GRAIN, "ordernumber", "quantity", "cust_paid_peritem", "hpp_total")
    with grouped_where_they_are(spark):
        assert len(exchanges(sum_lines(lines.repartition(*SALES_GRAIN)))) == 1
    assert len(exchanges(sum_lines(lines))) == 2


def test_sums_of_the_report_are_not_shuffled(spark):
    s = Shapes(spark, FOLDER)
    sold = s.sales_lines.select(
        "dataareaid", "axcode", "order_create_date", "codebars", F.lit(1).alias("ordernumber"), "quantity", "cust_paid_peritem", "hpp_total"
    )
    products = s.products.select("dataareaid", "codebars", "itemid", "umbrellabrand", "subbrand", "world", "category", "subcategory")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with grouped_where_they_are(spark):
            found = exchanges(sales_accumulation(sold, s.pattern, s.pattern, s.stores, products))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found and not any("order_create_date" in e and "itemid" in e for e in found)


def test_category_years_are_shown_once_with_one_shuffle_of_the_rows(frame):
    day = [dt.date(2024, 3, d) for d in range(1, 5)]
    schema = (
        "dataareaid string, axcode string, order_create_date date, itemid string, umbrellabrand string, subbrand string, world string,"
        " category string, subcategory string, cust_paid_peritem decimal(18,2), cust_paid_peritem_ly decimal(18,2)"
    )

    def rows(*some):
        return frame(schema, [(c, "1", d, i, "u", "s", "w", k, sub, v and Decimal(v), v and Decimal(v + 1)) for c, d, i, k, sub, v in some])

    report = rows(
        ("a", day[1], "x", "k", "z", 1), ("a", day[1], "x", "k", "y", 2), ("a", day[2], "b", "k", "y", 3), ("a", day[0], "z", "m", "y", 4),
        ("a", None, "q", "m", "y", 5), ("a", day[3], "q", None, "y", 6), ("a", day[3], None, None, "y", None), ("b", day[0], "x", "k", "y", 7), (None, day[0], "x", "k", "y", 8),
    )
    months = rows(("a", day[0], "x", "k", "y", 10), ("a", day[1], "x", "k", "y", 20), ("a", day[1], "x", "m", "y", None), ("c", day[1], "x", "k", "y", 30), ("a", day[1], "x", None, "y", 40))
    keys = ["dataareaid", "axcode", "umbrellabrand", "subbrand", "category"]
    year = group_sum(months, keys, **{f"{m}_ytd": F.coalesce(F.sum(m), F.lit(0)) for m in ("cust_paid_peritem", "cust_paid_peritem_ly")})
    apart = derepeat(full_outer(report, year, keys), {"cust_paid_peritem_ytd": keys, "cust_paid_peritem_ly_ytd": keys}, ROW_ORDER, spread=["order_create_date"])
    once = category_year_report(report, months)
    assert len(exchanges(once)) == 2
    assert once.columns == apart.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, apart.collect()))
    # Of rows that are the same one shows both years, as in SQL.
    twice = category_year_report(report.union(report), months).where("axcode = '1' and dataareaid = 'a' and category = 'k'")
    years = [(r.cust_paid_peritem_ytd, r.cust_paid_peritem_ly_ytd) for r in twice.collect()]
    assert len(years) == 6 and sorted(y for y in years if y != (0, 0)) == [(Decimal(30), Decimal(32))]


def test_documents_are_worked_out_once(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"id": "1", "n": 1, "x": {"k": [1, "q"]}, "s": {"v": 2.50, "y": null}}\n{"id": 7, "n": "no", "s": null, "t": "2024"}\n'
        '{"ID": "a", "id": null}\n[{"id": "in"}]\n[1]\n"text"\nnull\n{}\nbroken\n'
    )
    schema = "id string, n int, s struct<v:decimal(18,2)>, t string"
    read = read_documents(spark, str(tmp_path))
    whole = known_and_unknown(read, schema)
    # As the whole document's text is read.
    plain = read.where("document is not null").select(F.from_json(F.to_json("document"), schema).alias("k")).select("k.*")

    def rows(df):
        return sorted(map(str, df.collect()))

    assert rows(whole.drop("unknown_fields")) == rows(plain) and len(rows(plain)) == 8
    some = known_and_unknown(read, schema, ["id", "t"])
    assert some.columns == ["id", "t", "unknown_fields"]
    shown = F.transform("unknown_fields", lambda f: F.struct(f["path"], F.to_json(f["value"])))
    assert rows(some.select("id", "t", shown)) == rows(whole.select("id", "t", shown))
    text = logical(some.select("id", F.explode("unknown_fields")))
    assert text.count("parseJson") == 1 and text.count("map_entries") == 2
    assert [r.broken for r in read.where("document is null").collect()] == ["broken"]


def test_payments_of_a_transaction_meet_its_lines_once(frame):
    lines = frame("line int, transaction_id string, order_id string, order_product_quantity int, order_product_total decimal(18,2)", [
        (i, t, o, q, None if v is None else Decimal(v)) for i, (t, o, q, v) in enumerate((
            ("t", "o", 2, 5), ("t", "o", -1, 9), ("u", "o", 1, 6), ("t", None, 1, 7), (None, "o", 1, 8), (None, None, 1, 8), ("t", "p", -1, 3), ("t", "q", None, 3)))])
    paid = frame("transaction_id string, order_id string, cust int", [("t", "o", 1), ("t", "o", 2), ("t", None, 3), (None, "o", 4), ("t", "p", None)])
    by = ["transaction_id", "order_id"]
    apart = keep_facts(lines, order_value(lines), ["order_id"], null_safe=False)
    apart = keep_facts(apart, paid, by, null_safe=False, flag="__paid")
    once = keep_facts(lines, _paid_orders(lines, paid, by, "total_transaction_price", "__paid"), by)
    assert once.columns == apart.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, apart.collect()))


def test_the_erp_is_met_while_lines_are_narrow(spark, frame):
    lines = frame("ordernumber string, barcode string, dataareaid string, quantity int", [("1", "a", "m", 1), ("1", None, "m", 2), (None, "b", None, 3), ("2", "a", "m", None)])
    staging = frame(
        "dataareaid string, transnumber string, barcode string, stagingnumber string, quantity int, subtotaldetail decimal(18,2), pullstatus string",
        [("m", "1", "a", "s1", 1, None, "Current"), ("m", "1", "a", "s2", 2, None, "Current"), ("m", "1", None, "s3", 3, None, "Current"),
         (None, None, "b", "s4", 3, None, "Current"), ("m", "2", "a", "s5", 1, None, "Old")],
    )
    met = with_staging(lines, staging, {c: c for c in ("ordernumber", "barcode", "dataareaid")})
    assert sorted(map(str, staging_sync(met, staging).collect())) == sorted(map(str, staging_sync(lines, staging).collect()))
    s = Shapes(spark, FOLDER)
    stamp = F.lit("2024-07-02 03:04:05").cast("timestamp")
    early, late = (pos_sales_report(pos.detail(s, given), s.erp_staging, stamp) for given in (s.erp_staging, None))
    assert early.columns == late.columns
    assert early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty()
    # The order's lines meet the ERP below the join with the products.
    joins = [line for line in logical(early).splitlines() if "Join LeftOuter" in line]
    depth = [i for i, line in enumerate(joins) if "__k_ordernumber" in line]
    assert depth and depth[0] > next(i for i, line in enumerate(joins) if "__k_product_barcode" in line)
