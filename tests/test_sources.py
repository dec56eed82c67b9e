"""Sources, sinks and the file-drop stream on scratch folders."""

import datetime as dt

from pyspark.sql import functions as F

from lapak.operators.nested import order_lines, transfer_lines
from lapak.sources import readers, writers
from lapak.streaming.filedrop import compact_ledger, delivery_of, ingest, newest_delivery

D = dt.date


def test_monthly_write_replaces_only_touched_months(frame, spark, tmp_path):
    out = str(tmp_path / "sales")
    writers.write_months(frame("d date, v int", [(D(2024, 1, 5), 1), (D(2024, 2, 5), 2)]), out, "d")
    writers.write_months(frame("d date, v int", [(D(2024, 2, 6), 7), (D(2024, 2, 7), 8)]), out, "d", files_per_partition=2)
    assert sorted(r.v for r in readers.read_table(spark, out).collect()) == [1, 7, 8]
    kept = readers.read_keyed(spark, out, [D(2024, 2, 1)])
    assert sorted(r.v for r in kept.collect()) == [7, 8]
    assert "PartitionFilters: [" in kept._jdf.queryExecution().executedPlan().toString()


def test_bare_partition_segments(frame, spark, tmp_path):
    for company, v in (("mpr", 1), ("mgl", 2)):
        frame("v int", [(v,)]).write.parquet(f"{tmp_path}/pos/{company}/showroom/year=2024/month=03")
    frame("v int", [(3,)]).write.parquet(f"{tmp_path}/pos/mpr/online/year=2023/month=12")
    rows = readers.read_partitions(spark, str(tmp_path)).collect()
    assert {(r.v, r.source, r.company, r.channel, r.year, r.month) for r in rows} == {
        (1, "pos", "mpr", "showroom", 2024, "03"), (2, "pos", "mgl", "showroom", 2024, "03"), (3, "pos", "mpr", "online", 2023, "12"),
    }
    one = readers.read_partitions(spark, str(tmp_path), [D(2024, 3, 1)], company="mpr")
    assert [r.v for r in one.collect()] == [1]


def test_csv_export_with_description_row(spark, tmp_path):
    path = tmp_path / "tiktok.csv"
    path.write_text('Order ID,Quantity,Detail Address\nPlatform id,Number of items,"Where ""to"""\n0012,3,"two\nlines"\n')
    df = readers.read_export(spark, str(path), ["Order ID", "Quantity", "Detail Address"], readers.description_row("Quantity"))
    assert [tuple(r) for r in df.collect()] == [("0012", "3", "two\nlines")]


def test_export_with_late_header(spark, tmp_path):
    path = tmp_path / "tokopedia.csv"
    path.write_text("Laporan\nToko,\n,\n\nNomor Invoice,Nomor SKU\nINV/1,001\nINV/2,002\n")
    df = readers.read_offset_export(spark, str(path), ["Nomor Invoice", "Nomor SKU"])
    assert [tuple(r) for r in df.collect()] == [("INV/1", "001"), ("INV/2", "002")]


def test_split_bundle_inventory(frame, spark, tmp_path):
    df = frame("brand string, v int", [("A", 1), ("B", 2)])
    writers.write_split(df, f"{tmp_path}/split", ["brand"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/split/brand=A").collect()[0].v == "1"
    writers.write_bundle({"daily": df, "item": df}, f"{tmp_path}/bundle")
    assert readers.read_table(spark, [f"{tmp_path}/bundle/daily", f"{tmp_path}/bundle/item"]).count() == 4
    writers.append_table(df, f"{tmp_path}/bundle/daily")
    assert readers.read_table(spark, f"{tmp_path}/bundle/daily").count() == 4
    files = readers.file_inventory(spark, f"{tmp_path}/split", "*.csv")
    assert files.columns == ["path", "modified"] and files.count() == 2


def test_quarantine(frame):
    df = frame("a int, b int", [(1, 1), (None, 1), (1, -1), (None, None)])
    good, bad = writers.quarantine(df, {"a": F.col("a").isNotNull(), "b": F.col("b") > 0})
    assert good.count() == 1
    assert sorted(r.reasons for r in bad.collect()) == [["a"], ["a", "b"], ["b"]]


def test_order_documents(spark, tmp_path):
    path = tmp_path / "orders.json"
    path.write_text('{"id":"1","orderProductDatas":[{"id":"l1","quantity":2,"promotionDatas":[]},{"id":"l2","promotionDatas":[{"id":"p"},{"id":"q"}]}]}\n{"id":"2","orderProductDatas":[]}\n')
    rows = order_lines(readers.read_orders(spark, str(path))).collect()
    assert sorted((r.order_id, r.order_product_id or "") for r in rows) == [("1", "l1"), ("1", "l2"), ("1", "l2"), ("2", "")]


def test_transfer_pages(spark, tmp_path):
    path = tmp_path / "pages.json"
    path.write_text('{"total_pages":2,"current_page":1,"Data":[{"TransferId":"T1","Status":"open","Details":[{"Barcode":"b","Status":"x"}]},{"TransferId":"T2","Details":[]}]}\n{"total_pages":2,"current_page":2,"Data":[]}\n')
    rows = transfer_lines(readers.read_transfers(spark, str(path))).collect()
    assert sorted((r.current_page, r.TransferId or "", r.Barcode or "", r.StatusDetail or "") for r in rows) == [(1, "T1", "b", "x"), (1, "T2", "", ""), (2, "", "", "")]


def test_late_header_keeps_data_lines_with_empty_fields(spark, tmp_path):
    path = tmp_path / "tokopedia.csv"
    path.write_text('Nomor,x\nNomor Invoice,Nomor SKU,Q\nA1,001,4\nA2,,5\n,002,6\nNomor Invoice,Nomor SKU,7\n,,\n"A\n3",,\n')
    df = readers.read_offset_export(spark, str(path), ["Nomor Invoice", "Nomor SKU", "Q"])
    assert [tuple(r) for r in df.collect()] == [
        ("A1", "001", "4"), ("A2", None, "5"), (None, "002", "6"), ("Nomor Invoice", "Nomor SKU", "7"), ("A\n3", None, None),
    ]


def test_newest_delivery(frame):
    rows = [("d1", "A", 1, "2024-01-01", "f1"), ("d1", "A", 2, "2024-01-02", "f2"), ("d1", "A", 4, "2024-01-03", "f2"),
            ("d2", "A", 3, "2024-01-01", "f1"), ("d1", "B", 5, "2024-01-01", "f1"), (None, None, 6, "2024-01-01", "f1")]
    out = newest_delivery(frame("day string, brand string, v int, arrived_at string, delivery string", rows), "day", ["brand"])
    assert sorted(r.v for r in out.collect()) == [2, 3, 4, 5, 6]


def test_part_files_are_one_delivery(frame):
    names = ["/l/part-00000-aa-bb-c000.snappy.parquet", "/l/part-00001-aa-bb-c001.snappy.parquet", "/l/part-00000-cc-c000.csv", "/l/a-c000.csv", "/l/b.csv"]
    df = frame("p string", [(n,) for n in names])
    assert df.select(delivery_of("p").alias("d")).distinct().count() == 4


def test_months_of_split_deliveries_stay(frame, spark, tmp_path):
    for month in (1, 2):
        df = frame("company string, v int, month int", [("mpr", month, month)])
        writers.write_split(df, f"{tmp_path}/report", ["company", "month"], "parquet")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/report").collect()) == [1, 2]


def test_stream_replaces_redelivered_dates(frame, spark, tmp_path):
    landing, table, mark = (f"{tmp_path}/{n}" for n in ("landing", "table", "mark"))
    frame("day date, v int", [(D(2024, 1, 1), 1), (D(2024, 1, 2), 2)]).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    ingest(spark, landing, table, mark, schema, "day", "parquet").awaitTermination()
    frame("day date, v int", [(D(2024, 1, 2), 5), (D(2024, 1, 2), 6)]).coalesce(1).write.mode("append").parquet(landing)
    ingest(spark, landing, table, mark, schema, "day", "parquet").awaitTermination()
    assert sorted(r.v for r in spark.read.parquet(table).collect()) == [1, 5, 6]


def drop(frame, spark, root, name, rows):
    """One delivery lands and is taken in; what the table then holds."""
    schema = "brand string, day date, v int, at timestamp"
    frame(schema, rows).coalesce(1).write.parquet(f"{root}/landing/{name}")
    return take_in(spark, root, frame(schema, []).schema)


def take_in(spark, root, schema):
    ingest(spark, f"{root}/landing/*", f"{root}/table", f"{root}/mark", schema, "day", "parquet", ["brand"], arrived=F.col("at")).awaitTermination()
    return sorted((r.brand or "", r.day.day, r.v) for r in spark.read.parquet(f"{root}/table").collect())


def test_late_delivery_does_not_replace_a_newer_one(frame, spark, tmp_path):
    def at(day):
        return dt.datetime(2024, 1, day, 8)

    held = drop(frame, spark, tmp_path, "b", [("A", D(2024, 1, 1), 1, at(5)), ("A", D(2024, 1, 2), 2, at(5)), (None, D(2024, 1, 1), 3, at(5))])
    assert held == [("", 1, 3), ("A", 1, 1), ("A", 2, 2)]
    # Older, and seen later: only what nobody delivered since counts.
    rows = [("A", D(2024, 1, 1), 90, at(3)), ("A", D(2024, 1, 3), 4, at(3)), ("B", D(2024, 1, 1), 5, at(3)), (None, D(2024, 1, 1), 91, at(3))]
    held = drop(frame, spark, tmp_path, "a", rows)
    assert held == [("", 1, 3), ("A", 1, 1), ("A", 2, 2), ("A", 3, 4), ("B", 1, 5)]
    # Newer than the late one and older than the first.
    held = drop(frame, spark, tmp_path, "c", [("A", D(2024, 1, 2), 92, at(4)), ("A", D(2024, 1, 3), 6, at(4))])
    assert held == [("", 1, 3), ("A", 1, 1), ("A", 2, 2), ("A", 3, 6), ("B", 1, 5)]
    compact_ledger(spark, f"{tmp_path}/table_ledger")
    assert spark.read.parquet(f"{tmp_path}/table_ledger").count() == 5
    held = drop(frame, spark, tmp_path, "d", [("A", D(2024, 1, 2), 93, at(4)), ("A", D(2024, 1, 1), 7, at(6))])
    assert held == [("", 1, 3), ("A", 1, 7), ("A", 2, 2), ("A", 3, 6), ("B", 1, 5)]


def test_a_repeated_batch_writes_the_same(frame, spark, tmp_path):
    """The table and the ledger are as after one run if a batch is run again from its checkpoint."""
    import shutil

    def at(day):
        return dt.datetime(2024, 1, day, 8)

    drop(frame, spark, tmp_path, "a", [("A", D(2024, 1, 1), 1, at(5)), ("A", D(2024, 1, 2), 2, at(5))])
    once = drop(frame, spark, tmp_path, "b", [("A", D(2024, 1, 1), 3, at(6)), ("A", D(2024, 1, 2), 4, at(4))])
    entries = sorted(map(str, spark.read.parquet(f"{tmp_path}/table_ledger").collect()))
    # As after a failure: the batch was planned and written, its commit is missing.
    shutil.copytree(f"{tmp_path}/mark", f"{tmp_path}/again", ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.strip(".").startswith("1")])
    schema = spark.read.parquet(f"{tmp_path}/landing/a").schema
    ingest(spark, f"{tmp_path}/landing/*", f"{tmp_path}/table", f"{tmp_path}/again", schema, "day", "parquet", ["brand"], arrived=F.col("at")).awaitTermination()
    assert sorted((r.brand, r.day.day, r.v) for r in spark.read.parquet(f"{tmp_path}/table").collect()) == once == [("A", 1, 3), ("A", 2, 2)]
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/table_ledger").collect())) == entries
