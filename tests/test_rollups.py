"""Roll-ups, order bitmaps, observed totals, rejects, open documents, rebuilt months."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lapak.operators.aggregating import compared_totals, observed_write
from lapak.operators.distinct_orders import counted, distinct_orders, merged, order_bitmaps, order_numbers
from lapak.operators.open_documents import drift_report, known_and_unknown, read_documents
from lapak.operators.reconcile import differing_scopes, reconcile
from lapak.operators.rejects import DATES, NUMBERS, checked, reject_report, write_checked
from lapak.plans import rollups
from lapak.plans.jobs import Lake
from lapak.session import require_shared
from lapak.sources import writers
from lapak.sources.readers import read_dropped
from lapak.streaming.inventory import inventory, list_new_files

D = dt.date


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# Distinct orders


LINES = "ordernumber string, axcode string, order_create_date date, category string"


def lines():
    rows = [(f"o{i % 37}", f"s{i % 3}", D(2024, 1 + i % 2, 1 + i % 9), f"c{i % 4}") for i in range(400)]
    return [*rows, (None, "s0", D(2024, 1, 1), "c0"), ("o1", None, None, None), ("x", "s9", D(2024, 1, 1), None)]


def test_bitmaps_count_distinct_orders_of_any_grouping(frame):
    df = frame(LINES, lines())
    bits = order_bitmaps(df, order_numbers(df), ["axcode", "order_create_date", "category"])
    for by in (["axcode"], ["category"], ["axcode", "order_create_date"], []):
        found = counted(merged(bits, **{c: c for c in by}), *by)
        expected = df.groupBy(*by).agg(F.count_distinct("ordernumber").alias("ordernumber")).where("ordernumber > 0")
        assert rows_of(found) == rows_of(expected)
    month = F.trunc("order_create_date", "month")
    assert rows_of(distinct_orders(bits, m=month)) == rows_of(df.groupBy(month.alias("m")).agg(F.count_distinct("ordernumber")))


def test_order_numbers_are_dense_and_stay(frame):
    df = frame(LINES, lines())
    first = order_numbers(df.where("axcode = 's0'"))
    assert [r.order_no for r in first.orderBy("order_no").collect()] == list(range(1, first.count() + 1))
    new = order_numbers(df, known=first)
    both = first.unionByName(new)
    assert both.count() == both.select("ordernumber").distinct().count() == df.select("ordernumber").where("ordernumber is not null").distinct().count()
    assert sorted(r.order_no for r in both.collect()) == list(range(1, both.count() + 1))
    assert order_numbers(df, known=both).count() == 0


def test_more_orders_than_a_bitmap_holds(spark):
    df = spark.range(100_000).selectExpr("cast(id as string) as ordernumber", "'s' as axcode", "date'2024-01-01' + cast(id % 50 as int) as order_create_date")
    bits = order_bitmaps(df, order_numbers(df), ["axcode", "order_create_date"])
    assert bits.select("bucket").distinct().count() == 4
    assert counted(merged(bits, axcode="axcode"), "axcode").first().ordernumber == 100_000
    assert max(r.ordernumber for r in counted(bits, "order_create_date").collect()) == 2000


# Roll-ups


def sales(spark, month, n, start=0):
    rows = spark.range(start, start + n).selectExpr(
        "'mpr' as dataareaid", "concat('s', id % 3) as axcode", f"date'2024-{month:02d}-01' + cast(id % 28 as int) as order_create_date",
        "concat('c', id % 5) as codebars", "concat('c', id % 5) as productdata_barcode", f"concat('o', id div 3 + {month}) as ordernumber",
        "cast(1 + id % 4 as int) as quantity", "cast(id as decimal(18,2)) as cust_paid_peritem", "cast(1 as decimal(18,2)) as hpp_total",
        "'1' as istransaction", "true as issettled", "6 as status_order", "'SHOWROOM' as channel",
    )
    return rows


def test_only_the_open_month_is_rolled_up_again(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for month in (1, 2, 3):
        writers.write_months(sales(spark, month, 300), lake.path("pos_detail"), "order_create_date", by=["dataareaid"], months=[D(2024, month, 1)])
    rollups.refresh_rollups(lake, None)
    stamps = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(lake.path("sales_rollup")) for f in fs if "month=02" not in d}
    again = sales(spark, 2, 200, 50)
    writers.write_months(again, lake.path("pos_detail"), "order_create_date", by=["dataareaid"], months=[D(2024, 2, 1)])
    opened = [r[0] for r in rollups.rollup_lines(lake, [D(2024, 2, 1)]).select(F.input_file_name()).distinct().collect()]
    assert opened and all("/month=02/" in f for f in opened)
    rollups.refresh_rollups(lake, [D(2024, 2, 1)])
    after = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(lake.path("sales_rollup")) for f in fs if "month=02" not in d}
    assert {f: t for f, t in after.items() if f.endswith(".parquet")} == {f: t for f, t in stamps.items() if f.endswith(".parquet")}
    as_of = D(2024, 3, 10)
    every = sales(spark, 1, 300).unionByName(again).unionByName(sales(spark, 3, 300)).where(F.col("order_create_date") <= as_of)
    march = F.col("order_create_date") >= D(2024, 3, 1)
    expected = every.groupBy("dataareaid", "axcode").agg(
        F.sum(F.when(march, F.col("quantity"))).alias("quantity_mtd"), F.sum("quantity").alias("quantity_ytd"),
        F.sum(F.when(march, F.col("cust_paid_peritem"))).cast("double").alias("paid_mtd"), F.sum("cust_paid_peritem").cast("double").alias("paid_ytd"),
        F.count_distinct(F.when(march, F.col("ordernumber"))).alias("orders_mtd"), F.count_distinct("ordernumber").alias("orders_ytd"),
    )
    report = rollups.run_to_date(lake, as_of)
    got = report.select("dataareaid", "axcode", "quantity_mtd", "quantity_ytd", F.col("cust_paid_peritem_mtd").cast("double"), F.col("cust_paid_peritem_ytd").cast("double"), "orders_mtd", "orders_ytd")
    assert rows_of(got) == rows_of(expected)
    assert not any("pos_detail" in f for f in report.inputFiles())


def test_numbers_survive_a_repeated_refresh(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    writers.write_months(sales(spark, 1, 120), lake.path("pos_detail"), "order_create_date")
    rollups.refresh_rollups(lake, [D(2024, 1, 1)])
    first = rows_of(rollups.run_to_date(lake, D(2024, 1, 31)))
    rollups.refresh_rollups(lake, [D(2024, 1, 1)])
    assert rows_of(rollups.run_to_date(lake, D(2024, 1, 31))) == first
    assert rollups.numbers_of(lake).count() == spark.read.parquet(lake.path("sales_rollup_numbers")).count()


# Observed totals


def test_observed_totals_are_those_of_the_written_rows(spark, tmp_path):
    df = spark.range(1000).repartition(7).selectExpr("id", "cast(id as decimal(18,2)) as v")
    kept = df.where("id % 3 = 0")
    found = observed_write(kept, "kept", {"n": F.count(F.lit(1)), "v": F.sum("v")}, lambda d: d.write.parquet(f"{tmp_path}/kept"))
    written = spark.read.parquet(f"{tmp_path}/kept")
    assert found == {"n": written.count(), "v": written.agg(F.sum("v")).first()[0]}
    none = observed_write(df.where("id < 0"), "none", {"v": F.coalesce(F.sum("v"), F.lit(0))}, lambda d: d.write.parquet(f"{tmp_path}/none"))
    assert none["v"] == 0


def test_compared_totals(spark):
    rows = compared_totals(spark, [("same", 1, 1.0), ("off", 2, 3), ("unknown", None, None)]).collect()
    assert [(r.check_name, r.is_matched) for r in rows] == [("same", True), ("off", False), ("unknown", False)]


# Rejects


@pytest.mark.parametrize("marketplace", sorted(DATES))
def test_every_typed_column_reports_its_failures(spark, marketplace):
    """A text that is neither date nor number fails in each typed column; empty ones fail for the order date only."""
    columns = [*DATES[marketplace], *NUMBERS[marketplace]]
    schema = ", ".join(f"`{c}` string" for c in ["brand", *columns])
    bad, empty, absent = ("SZ", *["?!"] * len(columns)), ("SZ", *[" \t"] * len(columns)), ("SZ", *[None] * len(columns))
    rows = checked(spark.createDataFrame([bad, empty, absent], schema), marketplace).collect()
    assert {(e.column, e.value) for e in rows[0].errors} == {(c, "?!") for c in columns}
    assert {e.reason for e in rows[0].errors} == {"not a date", "not a number"}
    dates = [] if marketplace == "shopify" else [(next(iter(DATES[marketplace])), "empty")]
    for r in rows[1:]:
        assert [(e.column, e.reason) for e in r.errors] == dates


def test_rejects_and_good_rows_are_all_rows(frame, spark, tmp_path):
    rows = [("SZ", "01/02/2024 10:00", "3", "1.5"), ("SZ", "2024-02-01", "3", "x"), ("MN", None, "three", "1"), ("MN", "31/02/2024 10:00", None, None)]
    df = frame("brand string, `Tanggal Order` string, `Total Barang` string, Diskon string", rows)
    for _ in range(2):  # a repeated run gives the same sinks
        good, bad = write_checked(checked(df, "Blibli"), f"{tmp_path}/checked")
        assert good.columns == df.columns and rows_of(good) == [rows[0]]
        assert bad.count() == 3
    report = {(r.column, r.reason): (r.rows, r.example) for r in reject_report(bad, "Blibli").collect()}
    assert report == {
        ("Tanggal Order", "not a date"): (2, "2024-02-01"), ("Tanggal Order", "empty"): (1, None), ("Diskon", "not a number"): (1, "x"),
        ("Total Barang", "not a number"): (1, "three"),
    }


# Open documents


def test_unknown_fields_at_any_depth(spark, tmp_path):
    path = tmp_path / "documents.json"
    path.write_text(
        '{"id":"1","n":2,"more":{"a":[1,2]},"s":{"x":1,"y y":null},"l":[{"k":"a","z":1},{"k":"b"},{"z":"t"}]}\n'
        '{"id":"2"}\nnot json\n{"id":"3","s":"text","l":{"k":"c"},"x.y":true}\n\n'
    )
    schema = "id string, n int, s struct<x: int, t: struct<u: string>>, l array<struct<k: string>>"
    documents = read_documents(spark, str(path))
    assert sorted(r.broken for r in documents.where("broken is not null").collect()) == ["", "not json"]
    held = known_and_unknown(documents, schema)
    rows = {r.id: r for r in held.select("id", "n", "s.x", "l", F.transform("unknown_fields", lambda f: F.concat_ws("=", f["path"], F.to_json(f["value"]))).alias("u")).collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert sorted(rows["1"].u) == ['$.l[*].z="t"', "$.l[*].z=1", '$.more={"a":[1,2]}', "$.s.y y=null"]
    assert (rows["1"].n, rows["1"].x, [e.k for e in rows["1"].l]) == (2, 1, ["a", "b", None])
    assert rows["2"].u == [] and rows["3"].u == ["$.x.y=true"] and rows["3"].x is None
    report = {r.path: (r.occurrences, r.kind) for r in drift_report(held).collect()}
    assert report["$.l[*].z"] == (2, "VARIANT") and report["$.more"] == (1, "OBJECT<a: ARRAY<BIGINT>>") and report["$.x.y"] == (1, "BOOLEAN")


# Months that are rebuilt


def test_a_rebuilt_month_keeps_no_stale_folder(frame, spark, tmp_path):
    """A head who left, a company without sales, a month without any: their old rows go, other months stay."""
    out = f"{tmp_path}/report"
    schema = "company string, head string, v int, year int, month string"
    months = [D(2024, 1, 1), D(2024, 2, 1)]
    rows = [("a", "h1", 1, 2024, "01"), ("a", "h1", 2, 2024, "02"), ("b", "h2", 3, 2024, "02")]
    writers.write_split(frame(schema, rows), out, ["company", "head"], "parquet", months)
    writers.write_split(frame(schema, [("a", "new head", 2, 2024, "02")]), out, ["company", "head"], "parquet", months[1:])
    assert sorted((r.v, r.head) for r in spark.read.parquet(out).collect()) == [(1, "h1"), (2, "new head")]
    writers.write_split(frame(schema, []), out, ["company", "head"], "parquet", months[1:])
    assert [r.v for r in spark.read.parquet(out).collect()] == [1]


def test_a_company_that_vanished_from_a_rebuilt_month(frame, spark, tmp_path):
    out = f"{tmp_path}/detail"
    jan, feb = D(2024, 1, 5), D(2024, 2, 5)
    first = frame("d date, c string, v int", [(jan, "a", 1), (feb, "a", 2), (feb, "b", 3), (None, "a", 4)])
    writers.write_months(first, out, "d", by=["c"])
    writers.write_months(frame("d date, c string, v int", [(feb, "a", 5)]), out, "d", by=["c"])
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 4, 5]
    writers.write_months(frame("d date, c string, v int", [(jan, "b", 6), (feb, "b", 7)]), out, "d", by=["c"], months=[jan.replace(day=1)])
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [4, 5, 6]


def test_whole_deliveries(frame, spark, tmp_path):
    for rows in ([("a", 1), ("b", 2)], [("a", 3)]):
        writers.write_split(frame("file string, v int", rows), f"{tmp_path}/day", ["file"], whole=True)
    assert [r.v for r in spark.read.option("header", True).csv(f"{tmp_path}/day").collect()] == ["3"]


# Dropped layouts


def test_each_marketplace_in_its_own_layout(spark, tmp_path):
    texts = {
        "tokopedia": "Laporan Penjualan\nToko,SZ\n\n\nNomor Invoice,Nomor SKU\nINV/1,001\n",
        "tiktok": "Order ID,Quantity\nPlatform id,Number of items\n0012,3\n",
        "lazada": "orderNumber,sellerSku\n77,abc\n",
    }
    columns = {"tokopedia": ["Nomor Invoice", "Nomor SKU"], "tiktok": ["Order ID", "Quantity"], "lazada": ["orderNumber", "sellerSku"]}
    expected = {"tokopedia": ("INV/1", "001"), "tiktok": ("0012", "3"), "lazada": ("77", "abc")}
    for name, text in texts.items():
        path = tmp_path / f"{name}_August_SZ.csv"
        path.write_text(text)
        rows = read_dropped(spark, name.title(), [str(path)], columns[name]).collect()
        assert [tuple(r)[:2] for r in rows] == [expected[name]]
        assert rows[0].file.endswith(path.name)


# Reconciling by digest


def test_reconcile_finds_every_difference(frame):
    schema = "c string, d int, k string, q bigint, v decimal(18,2)"
    here = [("a", 1, "x", 1, None), ("a", 1, "y", 2, None), ("a", 2, "x", 3, None), (None, 1, "x", 4, None), ("a", 3, "r", 1, None), ("a", 3, "r", 2, None)]
    there = [("a", 1, "y", 2, None), ("a", 1, "x", 1, None), ("a", 2, "x", 4, None), ("b", 1, "x", 5, None), (None, 1, "x", 4, None), ("a", 3, "r", 3, None)]
    found = reconcile(frame(schema, here), frame(schema, there), ["c", "d"], ["k"], ["q"])
    assert rows_of(found.select("c", "d", "k", "q_here", "q_there", "state")) == [("a", 2, "x", 3, 4, "different"), ("b", 1, "x", None, 5, "only there")]
    scopes = differing_scopes(frame(schema, here), frame(schema, there), ["c", "d"], ["c", "d", "k", "q"])
    assert rows_of(scopes) == [("a", 2), ("a", 3), ("b", 1)]
    assert reconcile(frame(schema, here), frame(schema, list(reversed(here))), ["c", "d"], ["k"], ["q"]).count() == 0
    assert rows_of(reconcile(frame(schema, here[:1]), frame(schema, []), ["c"], ["k"], ["q"]).select("k", "state")) == [("x", "only here")]


def test_only_differing_scopes_are_joined(frame):
    schema = "c string, k string, q bigint"
    plan = reconcile(frame(schema, [("a", "x", 1)]), frame(schema, [("a", "x", 2)]), ["c"], ["k"], ["q"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and plan.count("FullOuter") >= 2


# Inventory


def test_inventory_lists_only_what_is_new(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "inventory")
    for day in ("01", "02"):
        folder = landing / day
        folder.mkdir(parents=True)
        (folder / f"a_{day}.csv").write_text("x")
        (folder / "note.txt").write_text("y")
        list_new_files(spark, str(landing), table, str(tmp_path / "mark"), "*.csv").awaitTermination()
    list_new_files(spark, str(landing), table, str(tmp_path / "mark"), "*.csv").awaitTermination()
    rows = inventory(spark, table).collect()
    assert sorted((r.path.split("/")[-1], r.length, r.listed_in) for r in rows) == [("a_01.csv", 1, 0), ("a_02.csv", 1, 1)]
    assert all(r.modified is not None for r in rows)


# Tables that lie together


def test_bucketed_tables_are_joined_without_a_shuffle(spark, tmp_path):
    """Totals of a transaction on its lines: neither the lines nor the payments move."""
    lines = spark.range(3000).selectExpr("concat('t', id % 400) as transaction_id", "id as line", "cast(id as decimal(18,2)) as v")
    payments = spark.range(900).selectExpr("concat('t', id % 450) as transaction_id", "cast(1 as decimal(18,2)) as paid")
    plain = lines.join(payments.groupBy("transaction_id").agg(F.sum("paid").alias("paid")), "transaction_id", "left")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        a = writers.write_bucketed(lines, "bucketed_lines", f"{tmp_path}/lines", ["transaction_id"], 8)
        b = writers.write_bucketed(payments, "bucketed_payments", f"{tmp_path}/payments", ["transaction_id"], 8)
        paid = b.groupBy("transaction_id").agg(F.sum("paid").alias("paid"))
        totals = a.groupBy("transaction_id").agg(F.sum("v").alias("total"))
        joined = a.join(paid, "transaction_id", "left")
        for df in (joined, a.join(totals, "transaction_id").join(paid, "transaction_id", "left")):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert rows_of(joined.select("transaction_id", "line", "v", "paid")) == rows_of(plain.select("transaction_id", "line", "v", "paid"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE IF EXISTS bucketed_lines")
        spark.sql("DROP TABLE IF EXISTS bucketed_payments")


def test_a_local_scratch_folder_is_refused_on_a_cluster():
    require_shared("file:/data/spark-warehouse/x", "local[8]")
    require_shared("s3a://lake/scratch", "yarn")
    with pytest.raises(RuntimeError):
        require_shared("file:/data/spark-warehouse/x", "spark://host:7077")
