"""One key holding a third of all rows: same results, and no task that gathers the group."""

import pytest
from pyspark.sql import functions as F

from lapak.operators.accumulating import align_periods
from lapak.operators.dedup import derepeat, latest_per_key, number_rows, with_duplicate_flag
from lapak.operators.joining import attach_totals, keep_facts
from lapak.operators.payments import allocate_payments, order_value

N = 3000


@pytest.fixture
def hot(spark):
    """A third of the rows under one key, some of them identical copies."""
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("k"),
        (F.col("id") % 50).cast("int").alias("d"),
        (F.col("id") % 700).cast("int").alias("i"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_totals(hot):
    rows = attach_totals(hot, ["k"], {"n": F.count(F.lit(1)), "s": F.sum("i")}).collect()
    assert len(rows) == N
    expected = {}
    for r in hot.collect():
        n, s = expected.get(r.k, (0, 0))
        expected[r.k] = (n + 1, s + r.i)
    assert all((r.n, r.s) == expected[r.k] for r in rows)
    flagged = with_duplicate_flag(hot, ["k", "d", "i"]).where("is_duplicated = 'Duplicated'")
    assert flagged.count() > 0


def test_hot_key_of_a_join_is_split(spark, hot):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        wide = hot.withColumn("pad", F.sha2(F.concat("k", F.col("d").cast("string"), F.col("i").cast("string")), 512))
        joined = keep_facts(wide.repartition(16, "d", "i"), hot.groupBy("k").agg(F.max("i").alias("m")), ["k"])
        assert "skew=true" in final_plan(joined)
        assert joined.count() == N
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_first_row_and_latest_row(hot):
    rows = hot.distinct().withColumn("t", F.lit(9.0))
    out = derepeat(rows, {"t": ["k"]}, ["d", "i"], spread=["d"]).where("t > 0").collect()
    expected = {}
    for r in rows.collect():
        expected[r.k] = min(expected.get(r.k, (r.d, r.i)), (r.d, r.i))
    assert {r.k: (r.d, r.i) for r in out} == expected and len(out) == len(expected)
    latest = {r.k: (r.d, r.i) for r in latest_per_key(hot, ["k"], ["d", "i"]).collect()}
    newest = {}
    for r in hot.collect():
        newest[r.k] = max(newest.get(r.k, (r.d, r.i)), (r.d, r.i))
    assert latest == newest


def test_numbers_of_a_hot_group_come_from_many_tasks(hot):
    rows = hot.withColumn("u", F.monotonically_increasing_id())
    numbered = number_rows(rows, ["d", "u"], ["k"])
    got = sorted((r.d, r.u, r.no) for r in numbered.where("k = 'hot'").collect())
    assert [n for *_, n in got] == list(range(1, N // 3 + 1))
    text = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text


def test_allocation_over_one_huge_order(spark):
    lines = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit(1).alias("order_product_quantity"),
        F.lit(10).cast("decimal(18,2)").alias("order_product_total"),
    )
    paid = lines.groupBy("order_id").agg(
        (F.count(F.lit(1)) * 8).cast("decimal(18,2)").alias("cust_paid"),
        (F.count(F.lit(1)) * 2).cast("decimal(18,2)").alias("voucher"),
        F.lit(0).cast("decimal(18,2)").alias("member_point"),
        F.lit(0).cast("decimal(18,2)").alias("return_payment"),
    )
    out = allocate_payments(keep_facts(keep_facts(lines, order_value(lines), ["order_id"]), paid, ["order_id"]))
    sums = out.groupBy("order_id").agg(F.sum("cust_paid_peritem").alias("p"), F.sum("payment_contribution").alias("c"))
    row = sums.where("order_id = 'hot'").collect()[0]
    assert row.p == pytest.approx(N // 3 * 8) and row.c == pytest.approx(1.0)
    assert out.where("abs(cust_paid_peritem - 8) > 1e-9").count() == 0


def test_control_totals_survive_alignment(spark):
    """What goes into the aligned frame comes out of it, per role."""
    sold = spark.range(900).selectExpr(
        "'mpr' AS dataareaid", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 7 AS string) END AS axcode",
        "date_add(date'2024-01-01', cast(id % 60 AS int)) AS order_create_date", "cast(id AS string) AS codebars",
        "1L AS ordernumber", "id AS quantity", "cast(id AS decimal(18,2)) AS cust_paid_peritem", "cast(1 AS decimal(18,2)) AS hpp_total",
    )
    pattern = spark.range(30).selectExpr(
        "date_add(date'2024-02-01', cast(id AS int)) AS pattern_date", "date_add(date'2024-01-04', cast(id AS int)) AS pattern_lm",
        "cast(NULL AS date) AS pattern_last_year",
    )
    wide = align_periods(sold, pattern).agg(F.sum("quantity"), F.sum("quantity_lm"), F.sum("quantity_ly")).collect()[0]
    def total(first, days):
        dates = f"order_create_date BETWEEN date'{first}' AND date_add(date'{first}', {days - 1})"
        return sold.where(dates).agg(F.sum("quantity")).collect()[0][0]

    assert tuple(wide) == (total("2024-02-01", 30), total("2024-01-04", 30), 0)
