"""Given tables written by the sinks and read back by the sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lapak.plans.raw_drop import write_drop
from lapak.session import scratch_folder
from lapak.sources.readers import (
    description_row,
    file_inventory,
    read_export,
    read_keyed,
    read_offset_export,
    read_partitions,
    read_table,
)
from lapak.sources.writers import write_bundle, write_months, write_split

from .registry import query, r

MONTHS = [dt.date(1995, 1, 1), dt.date(1995, 2, 1)]
IN_MONTHS = "o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-03-01'"
EXPORT = ("event_id", "user_id", "event_type", "props")


def _as_text(s, *names):
    return s.events.select(*[F.col(n).cast("string").alias(n) for n in names])


@query(f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in EXPORT)} FROM events")
def csv_export(s):
    """CSV with quoted fields, every column as text."""
    path = scratch_folder(s.events.sparkSession, "export")
    _as_text(s, *EXPORT).write.option("header", True).option("escape", '"').csv(path)
    return read_export(s.events.sparkSession, path, EXPORT, multi_line=False)


def _land_lines(s, above: list[str], names):
    """One file per event type: the lines of ``above``, then the rows; views have no user."""
    path = scratch_folder(s.events.sparkSession, "sheet")
    user = F.when(F.col("event_type") == "view", "").otherwise(F.col("user_id"))
    fields = [F.coalesce(c, F.lit("")) for c in (F.col("event_id"), user, F.col("event_type"))]
    rows = _as_text(s, *names).select("event_type", F.lit(len(above)).alias("at"), F.concat_ws(",", *fields).alias("line"))
    head = s.events.select("event_type").distinct().select("event_type", F.posexplode(F.array(*map(F.lit, above))).alias("at", "line"))
    files = rows.unionByName(head).withColumnRenamed("event_type", "file")
    files.repartition("file").sortWithinPartitions("file", "at").select("file", "line").write.partitionBy("file").text(path)
    return path


SHEET = ("event_id", "user_id", "event_type")
SHEET_SQL = """SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
  event_type FROM events"""


@query(SHEET_SQL)
def offset_export(s):
    """A sheet whose header stands below title lines; data lines may have empty fields."""
    path = _land_lines(s, ["Report", ",,", ",".join(SHEET)], SHEET)
    return read_offset_export(s.events.sparkSession, path, SHEET)


@query(SHEET_SQL)
def described_export(s):
    """A sheet with a row of explanations under the header."""
    path = _land_lines(s, [",".join(SHEET), "Number of the event,Number of the user,Kind"], SHEET)
    return read_export(s.events.sparkSession, path, SHEET, description_row("event_id")).select(*SHEET)


@query(f"SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus FROM orders WHERE {IN_MONTHS}")
def month_folders(s):
    """Orders written by month, two months read back; a rewritten month replaces itself only."""
    spark = s.orders.sparkSession
    path = scratch_folder(spark, "months")
    orders = s.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    write_months(orders, path, "o_orderdate", by=["o_orderstatus"])
    write_months(orders.where(F.trunc("o_orderdate", "month") == F.lit(MONTHS[0])), path, "o_orderdate", by=["o_orderstatus"])
    return read_keyed(spark, path, MONTHS).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus")


@query(
    f"""SELECT o_orderkey, 'pos' AS source, o_orderstatus AS company, 'all' AS channel, CAST(year(o_orderdate) AS INT) AS year, strftime(o_orderdate, '%m') AS month
    FROM orders WHERE o_orderstatus = 'F' AND {IN_MONTHS}"""
)
def partition_segments(s):
    """Folders named by bare segments, one company and two months of it."""
    spark = s.orders.sparkSession
    root = scratch_folder(spark, "segments")
    dated = s.orders.withColumns({"year": F.year("o_orderdate"), "month": F.date_format("o_orderdate", "MM")})
    for company in "FOP":
        part = dated.where(F.col("o_orderstatus") == company).select("o_orderkey", "year", "month")
        part.write.partitionBy("year", "month").parquet(f"{root}/pos/{company}/all")
    return read_partitions(spark, root, MONTHS, company="F").select("o_orderkey", "source", "company", "channel", "year", "month")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment AS segment FROM customer")
def split_delivery(s):
    """One CSV folder per market segment, all read back as one table."""
    path = scratch_folder(s.customer.sparkSession, "split")
    rows = s.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    write_split(rows, path, ["segment"])
    read = s.customer.sparkSession.read.option("header", True).schema("c_custkey string, c_name string, segment string")
    return read.csv(path)


@query(
    f"""SELECT 'customers' AS part, count(*) AS n, {r('sum(CAST(c_acctbal AS DECIMAL(18,2)))')} AS total FROM customer
    UNION ALL SELECT 'suppliers', count(*), {r('sum(CAST(s_acctbal AS DECIMAL(18,2)))')} FROM supplier"""
)
def report_bundle(s):
    """Two tables written as one report, read together."""
    spark = s.customer.sparkSession
    path = scratch_folder(spark, "bundle")

    def balances(df, part: str, name: str):
        return df.select(F.lit(part).alias("part"), F.col(name).cast("decimal(18,2)").alias("balance"))

    write_bundle(
        {"customers": balances(s.customer, "customers", "c_acctbal"), "suppliers": balances(s.supplier, "suppliers", "s_acctbal")}, path
    )
    both = read_table(spark, [f"{path}/customers", f"{path}/suppliers"])
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("balance").alias("total"))


@query(
    f"""again AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events WHERE event_type < 'm' AND month(ts) = 1)
    SELECT event_id, event_type AS brand, strftime(ts, '%Y-%m-%d') AS day, {r("value")} AS value
    FROM events e WHERE NOT EXISTS (SELECT 1 FROM again a WHERE a.event_type = e.event_type AND a.d = CAST(e.ts AS DATE))
    UNION ALL SELECT event_id, event_type, strftime(ts, '%Y-%m-%d'), {r("value + 1")} FROM events WHERE event_type < 'm' AND month(ts) = 1""".replace(
        "again AS", "WITH again AS", 1
    )
)
def monthly_raw_table(s):
    """A first drop and a re-delivery of some brands' days, merged in the raw table's folders."""
    spark = s.events.sparkSession
    path = scratch_folder(spark, "raw")
    drop = s.events.select("event_id", F.col("event_type").alias("brand"), "value", F.to_date("ts").alias("drop_date"))
    write_drop(drop, path)
    again = drop.where("brand < 'm' and month(drop_date) = 1").withColumn("value", F.col("value") + 1)
    write_drop(again, path)
    return read_table(spark, path).select("event_id", "brand", F.date_format("drop_date", "yyyy-MM-dd").alias("day"), "value")


@query("SELECT event_type, strftime(ts, '%Y-%m') AS month, CAST(1 AS BIGINT) AS files, TRUE AS recent FROM events GROUP BY ALL")
def landed_files(s):
    """Files of a folder tree with their modification times, without reading them."""
    spark = s.events.sparkSession
    path = scratch_folder(spark, "files")
    rows = s.events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM").alias("month"))
    rows.repartition("event_type", "month").write.partitionBy("event_type", "month").parquet(path)
    parts = F.split("path", "/")
    named = file_inventory(spark, path, "*.parquet").select(
        *[F.substring_index(F.element_at(parts, -i), "=", -1).alias(n) for n, i in (("event_type", 3), ("month", 2))], "modified"
    )
    recent = F.min(F.col("modified")) > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return named.groupBy("event_type", "month").agg(F.count(F.lit(1)).alias("files"), recent.alias("recent"))
