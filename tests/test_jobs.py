"""The end-to-end jobs on a lake written from the driver tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from catalog.changes import store_lists
from catalog.people import attendance
from catalog.shapes import RAW, Shapes, load
from lapak.operators.accumulating import online_stores
from lapak.operators.incentives import attendance_eligibility
from lapak.operators.online_reports import sales_by_item
from lapak.plans import jobs, master_jobs, online_jobs

FOLDER = "/root/testdata/sf0.001"
DAY = dt.date(2000, 8, 3)  # July and August are open


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = jobs.Lake(spark, str(tmp_path_factory.mktemp("lake")))
    for name in (
        "pos_orders", "pos_payments", "stores", "promotions", "products", "receipts", "brand_margins",
        "erp_staging", "legacy_items", "item_stops", "margins", "pattern",
    ):
        df = load(spark, FOLDER, name)
        if name == "item_stops":
            df = df.selectExpr("*", "cast(null as string) as inventdimid")
        df.write.parquet(lake.path(name))
    for m in RAW:
        load(spark, FOLDER, f"own_{m}").write.parquet(lake.path(f"exports/{m}"))
    return lake


def test_jobs(spark, lake):
    assert jobs.run_pos_detail(lake, DAY) == [dt.date(2000, 7, 1), dt.date(2000, 8, 1)]
    detail = lake.read("pos_detail")
    orders = lake.read("pos_orders").where("pull_status = 'latest'")
    wanted = orders.where("time_created >= '2000-07-01' and time_created < '2000-09-01'")
    assert detail.count() == wanted.count() > 0
    jobs.run_pos_report(lake, DAY)
    assert lake.read("pos_report").where("company = 'mpr'").count() > 0

    jobs.run_online_detail(lake, DAY)
    online = lake.read("online_detail")
    assert online.select("month_report").distinct().count() == 2
    before = online.count()
    jobs.run_online_detail(lake, DAY)  # the same months again: replaced, not added
    assert lake.read("online_detail").count() == before

    month = dt.date(2000, 7, 1)
    report = jobs.run_accumulation(lake, month)
    checks = {r.check_name: r for r in lake.read("reports/2000-07/checks").collect()}
    held = lake.read("reports/2000-07/accumulation")
    for title, period in (("this month", ""), ("last month", "_lm"), ("last year", "_ly")):
        paid = held.agg(F.sum("cust_paid_peritem" + period)).first()[0] or 0
        assert checks[title].amount_after == pytest.approx(float(paid)) and checks[title].is_matched
    assert checks["this month"].is_matched and checks["this month"].amount_before > 0
    assert report.accumulation.count() == lake.read("reports/2000-07/accumulation").count() > 0

    for table, part in (("sales_akum", "accumulation"), ("sales_promo", "promotions")):
        empty = lake.read(f"reports/2000-07/{part}").limit(0).selectExpr("cast(0 as bigint) as id", "*")
        empty.write.parquet(lake.path(f"{table}/version=0"))
    jobs.load_reports(lake, month, 0)
    stored = lake.read("sales_akum/version=1")
    assert stored.count() == stored.select("id").distinct().count() == report.accumulation.count()
    jobs.load_reports(lake, month, 1)
    assert lake.read("logging_sales_akum").count() == 0
    assert lake.read("sales_akum/version=2").count() == stored.count()


def test_reports_are_loaded_by_month(spark, lake):
    """Files of other months keep their names; a repeated load changes nothing; a changed report is logged once."""
    jobs.run_accumulation(lake, dt.date(2000, 8, 1))
    jobs.run_accumulation(lake, dt.date(1990, 1, 1))  # a month without sales loads nothing
    for month in (dt.date(1990, 1, 1), dt.date(2000, 8, 1), dt.date(2000, 7, 1)):
        jobs.load_report_months(lake, month)

    def files(table):
        return {m: sorted(os.listdir(lake.path(f"{table}/year=2000/month={m}"))) for m in ("08", "07") if os.path.isdir(lake.path(f"{table}/year=2000/month={m}"))}

    august, held = files("sales_akum_by_month").get("08"), lake.read("sales_akum_by_month")
    n = held.count()
    assert n == held.select("id").distinct().count() == lake.read("reports/2000-08/accumulation").count() + lake.read("reports/2000-07/accumulation").count()
    ids = rows_of(held.select("id", "axcode", "order_create_date"))
    assert jobs.load_report_months(lake, dt.date(2000, 7, 1)) == {"sales_akum": 0, "sales_promo": 0}
    report = lake.read("reports/2000-07/accumulation")
    changed = report.withColumn("quantity", F.col("quantity") + F.when(F.col("quantity") > 5, 1).otherwise(0))
    changed = spark.createDataFrame(changed.collect(), report.schema)
    changed.write.mode("overwrite").parquet(lake.path("reports/2000-07/accumulation"))
    counts = jobs.load_report_months(lake, dt.date(2000, 7, 1))
    assert counts == {"sales_akum": changed.where("quantity > 6").count(), "sales_promo": 0}
    assert lake.read("logging_sales_akum_by_month/load=2000-07").count() == counts["sales_akum"] > 0
    assert files("sales_akum_by_month").get("08") == august
    assert rows_of(lake.read("sales_akum_by_month").select("id", "axcode", "order_create_date")) == ids


def test_scans_are_narrowed_to_months(lake):
    months = [dt.date(2000, 8, 1)]
    for table in ("pos_detail", "online_detail"):
        text = lake.read_months(table, months)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_online_reports(spark, lake):
    stores = online_stores(lake.read("stores"))
    word = F.get(F.split("stdname", " "), F.lit(2)).alias("channel")
    days = [F.col("target").alias(f"2000-08-0{i}") for i in (1, 2)]
    stores.select("stdname", F.col("dataareaid").alias("areaid"), "brand", word, *days, F.lit(0).alias("grandtotal")).write.parquet(lake.path("online_targets"))
    assert online_jobs.run_online_daily(lake, DAY)
    folder = "online_daily/day=2000-08-03"
    first = {n: rows_of(lake.read(f"{folder}/{n}")) for n in ("daily", "item", "status", "checks")}
    sold = lake.read("online_detail").where("date <= '2000-08-02' and sales_status <> 'CANCELED'")
    assert sum(r.quantity for r in lake.read(f"{folder}/daily").collect()) == sold.agg(F.sum("qty_sold")).first()[0] > 0
    assert online_jobs.run_online_daily(lake, DAY)
    assert first == {n: rows_of(lake.read(f"{folder}/{n}")) for n in first}
    sent = spark.read.option("header", True).csv(lake.path("online_delivery/daily"))
    assert sent.count() == len(first["daily"])

    online_jobs.run_delivery(lake, DAY)
    sent = spark.read.option("header", True).csv(lake.path("delivery"))
    open_lines = lake.read("online_detail").where("date >= '2000-07-01' and date < '2000-09-01'")
    assert sent.count() == open_lines.where("sales_status <> 'CANCELED'").count()
    online_jobs.run_settlement(lake, dt.date(2000, 8, 1))
    settled = spark.read.option("header", True).csv(lake.path("settlement"))
    per_file = settled.groupBy("brand", "marketplace", "transaction_status").agg(F.count("*").alias("n"), F.max(F.col("no").cast("int")).alias("last"))
    n = settled.count()
    assert n > 0 and per_file.where("n <> last").count() == 0
    online_jobs.run_settlement(lake, dt.date(2000, 8, 1))
    assert spark.read.option("header", True).csv(lake.path("settlement")).count() == n

    online_jobs.run_online_staging(lake, [dt.date(2000, 7, 1)])
    staged = lake.read("online_staging")
    n = staged.count()
    assert n > 0 and {(r.year, r.month) for r in staged.select("year", "month").distinct().collect()} == {(2000, 7)}
    online_jobs.run_online_staging(lake, [dt.date(2000, 7, 1)])
    assert lake.read("online_staging").count() == n


def test_gate_holds_reports_back(spark, lake, monkeypatch):
    monkeypatch.setattr(online_jobs, "sales_by_item", lambda lines: sales_by_item(lines.where("qty_sold > 1")))
    day = dt.date(2000, 8, 4)
    assert not online_jobs.run_online_daily(lake, day)
    assert not os.path.exists(lake.path("online_delivery/daily/day=2000-08-04"))


def land(folder, brand, name, rows, when):
    path = folder / "raw" / brand / "2000" / "August" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    head = "Tanggal Pembayaran,Nomor SKU,Jumlah"
    path.write_text("\n".join([head, *rows]) + "\n")
    os.utime(path, (when.timestamp(), when.timestamp()))


def test_raw_drop(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    landing = tmp_path / "landing"
    columns = {"tokopedia": ["Tanggal Pembayaran", "Nomor SKU", "Jumlah"]}
    noon = dt.datetime(2000, 8, 2, 5, tzinfo=dt.timezone.utc)
    day = dt.timedelta(days=1)
    land(landing, "SZ", "tokopedia_old.csv", ["01-08-2000 10:00:00,9,9"], noon - day)
    land(landing, "SZ", "tokopedia_a.csv", ["01-08-2000 10:00:00,1,1", "02-08-2000 10:00:00,2,1", "?,3,1", "01-01-2000 10:00:00,4,1"], noon)
    land(landing, "MN", "tokopedia_a.csv", ["01-08-2000 11:00:00,5,1"], noon)
    land(landing, "MC", "tokopedia_a.csv", ["01-08-2000 11:00:00,6,1"], noon - day)
    assert online_jobs.run_raw_drop(lake, str(landing), columns, noon.date()) == ["tokopedia"]

    def held():
        return sorted((r.brand, r["Nomor SKU"], r.Jumlah) for r in lake.read("exports/tokopedia").collect())

    assert held() == [("MN", "5", "1"), ("SZ", "1", "1"), ("SZ", "2", "1")]
    assert [r.brand for r in lake.read("raw_stale").collect()] == ["MC"]
    assert [r["Nomor SKU"] for r in lake.read("raw_undated/tokopedia").collect()] == ["3"]
    online_jobs.run_raw_drop(lake, str(landing), columns, noon.date())
    assert len(held()) == 3
    land(landing, "SZ", "tokopedia_b.csv", ["02-08-2000 10:00:00,7,1"], noon + day)
    online_jobs.run_raw_drop(lake, str(landing), columns, (noon + day).date())
    assert held() == [("MN", "5", "1"), ("SZ", "1", "1"), ("SZ", "7", "1")]


def test_raw_drop_layouts_and_snapshot(spark, tmp_path):
    """Title lines and description rows are skipped, a workbook beside a file is left alone, and the day's drop is kept."""
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    folder = tmp_path / "landing" / "raw" / "SZ" / "2000" / "August"
    folder.mkdir(parents=True)
    noon = dt.datetime(2000, 8, 2, 5, tzinfo=dt.timezone.utc)
    files = {
        "tokopedia_August_SZ.csv": "Laporan\nToko,SZ\n\n\nTanggal Pembayaran,Nomor SKU,Jumlah Produk Dibeli\n01-08-2000 10:00:00,1,1\n01-01-2000 10:00:00,2,1\n,3,x\n",
        "tiktok_August_SZ.csv": "Created Time,Seller SKU,Quantity\nWhen,Sku of the seller,How many\n01/08/2000 10:00:00\t,7,2\n",
        "tokopedia_late_SZ.xlsx": "PK binary",
    }
    for i, (name, text) in enumerate(files.items()):
        (folder / name).write_text(text)
        when = (noon + dt.timedelta(minutes=i)).timestamp()
        os.utime(folder / name, (when, when))
    columns = {
        "tokopedia": ["Tanggal Pembayaran", "Nomor SKU", "Jumlah Produk Dibeli"],
        "tiktok": ["Created Time", "Seller SKU", "Quantity"],
    }
    for _ in range(2):
        assert online_jobs.run_raw_drop(lake, str(tmp_path / "landing"), columns, noon.date()) == ["tiktok", "tokopedia"]
        assert [r["Nomor SKU"] for r in lake.read("exports/tokopedia").collect()] == ["1"]
        assert [(r["Seller SKU"], r.Quantity) for r in lake.read("exports/tiktok").collect()] == [("7", "2")]
        held = lake.read("raw_snapshot/marketplace=tokopedia/day=2000-08-02").collect()
        assert sorted((r.brand, r["Nomor SKU"], r.year) for r in held if r.year) == [("SZ", "1", 2000), ("SZ", "2", 2000)]
        assert [r["Nomor SKU"] for r in lake.read("raw_undated/tokopedia").collect()] == ["3"]
        rejects = {(r.column, r.reason): r.rows for r in lake.read("raw_rejects/tokopedia").collect()}
        assert rejects == {("Tanggal Pembayaran", "empty"): 1, ("Jumlah Produk Dibeli", "not a number"): 1}
    whole = spark.read.parquet(lake.path("raw_snapshot"))
    assert {(r.marketplace, str(r.day)) for r in whole.select("marketplace", "day").distinct().collect()} == {("tokopedia", "2000-08-02"), ("tiktok", "2000-08-02")}


def test_masters_and_incentives(spark, lake):
    s = Shapes(spark, FOLDER)
    assert master_jobs.run_fact_sales(lake, DAY) == [dt.date(2000, 7, 1), dt.date(2000, 8, 1)]
    n = lake.read("fact_sales").count()
    assert n == lake.read("pos_detail").count()
    master_jobs.run_fact_sales(lake, DAY)
    assert lake.read("fact_sales").count() == n

    master_jobs.run_cost_repair(lake)
    repaired = rows_of(lake.read("products_repaired").select("codebars", "recid", "hpp"))
    assert len(repaired) == lake.read("products").count()
    master_jobs.run_cost_repair(lake)
    assert rows_of(lake.read("products_repaired").select("codebars", "recid", "hpp")) == repaired

    erp, pos = store_lists(s)
    erp.write.parquet(lake.path("erp_stores"))
    pos.write.parquet(lake.path("pos_stores"))
    assert master_jobs.run_store_dimension(lake, DAY) == 0
    first = lake.read("store_dim/version=0")
    assert sorted(r.store_key for r in first.collect()) == list(range(1, erp.count() + 1))
    assert master_jobs.run_store_dimension(lake, DAY, 0) == 1
    assert rows_of(lake.read("store_dim/version=1").select(*first.columns)) == rows_of(first)

    attendance(s).write.parquet(lake.path("attendance"))
    s.nation.selectExpr("n_name as full_name", "'Junior Area Manager' as job_position").write.parquet(lake.path("managers"))
    master_jobs.run_incentives(lake, dt.date(2000, 7, 1))
    staff = lake.read("incentives/2000-07/staff")
    assert staff.count() == attendance_eligibility(attendance(s)).count() > 0
    heads = lake.read("incentives/2000-07/city_heads")
    assert heads.count() == heads.select("city_head").distinct().count() > 0
