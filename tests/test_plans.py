"""What the physical plans must and must not contain."""

import re

import pytest

from __spark_entry__ import queries
from catalog import all_queries
from lapak.operators.dedup import latest_per_key

FOLDER = "/root/testdata/sf0.001"
#: One row for the whole input: totals and the calendar's weight of all its days.
WHOLE = ("accumulation_checks", "control_totals", "online_daily_check", "control_totals_mismatch", "online_daily_check_mismatch", "export_rejects")
CHECKED = ["sales_accumulation", "pos_sales_detail", "online_sales_detail", "settlement_template", "payment_allocation"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_stays_in_the_engine(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_query_pairs_all_rows_or_runs_python(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert bad not in text, bad
    if name not in WHOLE:
        assert "SinglePartition" not in text


def test_report_reads_its_lines_once(spark):
    text = plan(queries()["sales_accumulation"](spark, FOLDER))
    scans = re.findall(r"FileScan parquet .*", text)
    assert not any("lineitem" in s or "l_orderkey" in s for s in scans)


def test_unread_columns_are_not_scanned(spark):
    text = plan(queries()["mtd_sales"](spark, FOLDER))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert not any("o_totalprice" in s or "l_shipdate" in s for s in scans)


def test_large_sides_are_shuffled_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries()["enrich_left"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_latest_row_is_picked_before_the_shuffle(spark, frame):
    text = plan(latest_per_key(frame("k int, v int", [(1, 1), (1, 2)]), ["k"], ["v"]))
    assert text.count("WindowGroupLimit") == 2


def test_cascade_joins_the_lines_once(spark):
    text = plan(queries()["match_cascade"](spark, FOLDER))
    # lineitem with orders, customer and part, then one product look-up
    assert len(re.findall(r"(?:BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", text)) == 4
