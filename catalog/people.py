"""Incentives of staff and managers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapak.operators.aggregating import group_sum
from lapak.operators.incentives import (
    CITY_HEAD,
    JUNIOR_MANAGER,
    SENIOR_MANAGER,
    attendance_eligibility,
    manager_incentive,
    staff_incentive,
    store_month_sales,
    store_performance,
    with_manager_position,
)

from .registry import query, r

# Sales, targets and last year's sales per store and month of 2000, from the stored lines.
SALES = """daily AS (SELECT dataareaid, axcode, channel, month(order_create_date) AS m, year(order_create_date) AS y, cust_paid_peritem FROM sales_lines),
ty AS (SELECT dataareaid, axcode, CAST(m AS VARCHAR) AS month, sum(cust_paid_peritem * 100) AS sales_this_year, sum(cust_paid_peritem * CAST(90 + m AS DECIMAL(18,0))) AS target
  FROM daily WHERE y = 2000 AND channel <> 'ONLINE' GROUP BY 1, 2, 3),
lyr AS (SELECT dataareaid, axcode, CAST(m AS VARCHAR) AS month, sum(cust_paid_peritem * 100) AS sales_last_year FROM daily WHERE y = 1999 GROUP BY 1, 2, 3),
perf0 AS (SELECT ty.*, l.sales_last_year, s.cscode, s.stdname, s.sssg, s.area_head, s.city_head,
  COALESCE((CAST(sales_this_year AS DOUBLE) - CAST(sales_last_year AS DOUBLE)) / NULLIF(CAST(sales_last_year AS DOUBLE), 0), 0) AS growth,
  COALESCE(CAST(sales_this_year AS DOUBLE) / NULLIF(CAST(target AS DOUBLE), 0), 0) AS achievement
  FROM ty LEFT JOIN lyr l USING (dataareaid, axcode, month) LEFT JOIN (SELECT * EXCLUDE (target) FROM stores) s USING (dataareaid, axcode)),
perf AS (SELECT *, CASE WHEN growth >= 0.10::DOUBLE OR sssg IS DISTINCT FROM 'SSSG' THEN 'Yes' ELSE 'No' END AS growthreq FROM perf0)"""


def performance(s):
    lines = s.sales_lines.withColumns(
        {"m": F.month("order_create_date"), "y": F.year("order_create_date")}
    )
    hundred = F.col("cust_paid_peritem") * F.lit(100).cast("decimal(5,0)")
    this = lines.where("y = 2000").select(
        "dataareaid", "axcode", "channel", F.col("m").cast("string").alias("month"),
        hundred.alias("cust_paid_peritem"),
        (F.col("cust_paid_peritem") * (F.col("m") + 90).cast("decimal(18,0)")).alias("target_daily"),
    )
    before = lines.where("y = 1999").select(
        "dataareaid", "axcode", F.col("m").cast("string").alias("month"),
        hundred.alias("cust_paid_peritem_last_year"),
    )
    return store_performance(store_month_sales(this, before), s.stores)


@query(
    f"""{SALES} SELECT dataareaid, axcode, month, {r('sales_this_year')} AS sales_this_year, {r('target')} AS target, {r('sales_last_year')} AS sales_last_year,
      cscode, stdname, sssg, area_head, city_head, {r('growth')} AS growth, {r('achievement')} AS achievement, growthreq FROM perf""",
    "sales_lines stores",
)
def growth_achievement(s):
    """Growth, achievement and growth requirement per store and month."""
    return performance(s)


# Staff: one employee per event user; the branch follows from the user's number and store count.
STAFF = """att AS (SELECT 'E' || CAST(user_id AS VARCHAR) AS employee_id, 'Name ' || CAST(user_id AS VARCHAR) AS full_name,
  CASE user_id % 7 WHEN 0 THEN 'City Head' WHEN 1 THEN 'Store Head' WHEN 2 THEN 'Sa-Bazaar (Reguler)' ELSE 'Sales Assistant' END AS job_position,
  CAST(user_id % 10 AS VARCHAR) || CASE WHEN user_id % 3 = 0 THEN '-A' ELSE '' END AS branch_code,
  CASE WHEN user_id % 4 = 0 THEN 'STORE SZ NORTH' ELSE 'STORE MALL' END AS branch, CAST(count(DISTINCT CAST(ts AS DATE)) AS INT) AS hari_kerja FROM events GROUP BY user_id),
el AS (SELECT CASE WHEN branch LIKE '% SZ %' THEN 'mgl' ELSE 'mpr' END AS dataareaid, * FROM att WHERE job_position <> 'City Head'),
elig AS (SELECT dataareaid, employee_id, full_name, job_position, branch, hari_kerja, count(employee_id) OVER (PARTITION BY dataareaid, branch_code) AS jumlah_karyawan,
  CASE WHEN hari_kerja >= 25 THEN 'Yes' ELSE 'No' END AS absenreq, string_split(branch_code, '-')[1] AS axcode FROM el)"""


def attendance(s):
    u = F.col("user_id")
    position = (
        F.when(u % 7 == 0, "City Head").when(u % 7 == 1, "Store Head")
        .when(u % 7 == 2, "Sa-Bazaar (Reguler)").otherwise("Sales Assistant")
    )
    days = group_sum(s.events, ["user_id"], hari_kerja=F.count_distinct(F.to_date("ts")).cast("int"))
    return days.select(
        F.concat(F.lit("E"), u.cast("string")).alias("employee_id"),
        F.concat(F.lit("Name "), u.cast("string")).alias("full_name"),
        position.alias("job_position"),
        F.concat((u % 10).cast("string"), F.when(u % 3 == 0, "-A").otherwise("")).alias("branch_code"),
        F.when(u % 4 == 0, "STORE SZ NORTH").otherwise("STORE MALL").alias("branch"),
        "hari_kerja",
    )


@query(f"WITH {STAFF} SELECT * FROM elig", name="attendance_eligibility")
def _attendance_eligibility(s):
    """Staff in scope with head-count and the attendance rule."""
    return attendance_eligibility(attendance(s))


def ladder(pay: tuple[int, ...], also: str = "") -> str:
    return " ".join(
        f"WHEN {also}achievement {test} THEN {p}" for test, p in zip(("> 1.20::DOUBLE", ">= 1", ">= 0.95::DOUBLE"), pay)
    )


HEAD = f"CASE {ladder((750000, 500000, 350000))} ELSE 0 END"
SELL = f"""CASE {ladder((600000, 400000, 250000), 'productivity > 80000000 AND ')} {ladder((450000, 300000, 200000), 'productivity >= 40000000 AND ')}
  {ladder((300000, 200000, 150000), 'productivity > 0 AND ')} ELSE 0 END"""
PAID = f"""{STAFF}, j AS (SELECT e.*, p.stdname, p.sales_last_year, p.sales_this_year, p.growth, p.growthreq, p.target, p.achievement,
  CAST(p.sales_this_year AS DOUBLE) / e.jumlah_karyawan AS productivity
  FROM elig e LEFT JOIN (SELECT * FROM perf WHERE month = '7') p ON p.dataareaid = e.dataareaid AND p.axcode = e.axcode),
k AS (SELECT *, CASE WHEN absenreq = 'Yes' AND growthreq = 'Yes' THEN 'Yes' ELSE 'No' END AS isincentive,
  CASE WHEN job_position IN ('Sales Assistant', 'Sa-Bazaar (Reguler)') THEN {SELL} ELSE {HEAD} END AS calculated_incentive FROM j)
SELECT employee_id, dataareaid, axcode, job_position, jumlah_karyawan, absenreq, growthreq, isincentive, {r('productivity')} AS productivity, {r('achievement')} AS achievement,
  calculated_incentive, CASE WHEN isincentive = 'Yes' THEN calculated_incentive ELSE 0 END AS final_incentive FROM k"""


@query(f"{SALES}, {PAID}", "sales_lines stores", name="staff_incentive")
def _staff_incentive(s):
    """Incentive of each employee for one month."""
    paid = staff_incentive(attendance_eligibility(attendance(s)), performance(s).where("month = '7'"))
    return paid.select(
        "employee_id", "dataareaid", "axcode", "job_position", "jumlah_karyawan", "absenreq",
        "growthreq", "isincentive", "productivity", "achievement", "calculated_incentive",
        "final_incentive",
    )


def manager_sql(source: str, head: str, pay: tuple[int, ...]) -> str:
    same = "CASE WHEN sssg = 'SSSG' THEN {} ELSE 0 END"
    return f"""g AS (SELECT {head}, month, sum(target) AS target, sum(sales_last_year) AS sales_last_year, sum(sales_this_year) AS sales_this_year,
      sum({same.format('sales_last_year')}) AS ls, sum({same.format('sales_this_year')}) AS ts FROM {source} GROUP BY 1, 2),
    h AS (SELECT *, COALESCE((CAST(ts AS DOUBLE) - CAST(ls AS DOUBLE)) / NULLIF(CAST(ls AS DOUBLE), 0), 0) AS growth,
      COALESCE(CAST(sales_this_year AS DOUBLE) / NULLIF(CAST(target AS DOUBLE), 0), 0) AS achievement FROM g),
    i AS (SELECT *, CASE {ladder(pay)} ELSE 0 END AS incentive, CASE WHEN growth >= 0.10::DOUBLE THEN 'Yes' ELSE 'No' END AS growthreq FROM h)
    SELECT {head}, month, {r('target')} AS target, {r('COALESCE(sales_last_year, 0)')} AS sales_last_year, {r('sales_this_year')} AS sales_this_year,
      {r('COALESCE(ls, 0)')} AS sales_last_year_sssg, {r('ts')} AS sales_this_year_sssg, {r('growth')} AS growth, {r('achievement')} AS achievement, growthreq,
      incentive, CASE WHEN growthreq = 'Yes' THEN incentive ELSE 0 END AS final_incentive FROM i"""


MANAGERS = """mg AS (SELECT 'AREA ' || CAST(n_nationkey AS VARCHAR) AS full_name, CASE WHEN n_nationkey % 2 = 0 THEN 'Junior Area Manager' ELSE 'Area Manager' END AS job_position
  FROM nation WHERE n_regionkey <> 4),
pm AS (SELECT p.*, COALESCE(mg.job_position, 'Area Manager') AS job_position FROM perf p LEFT JOIN mg ON mg.full_name = p.area_head)"""


def managed(s):
    position = F.when(F.col("n_nationkey") % 2 == 0, "Junior Area Manager").otherwise("Area Manager")
    managers = s.nation.where("n_regionkey <> 4").select(
        F.concat(F.lit("AREA "), F.col("n_nationkey").cast("string")).alias("full_name"),
        position.alias("job_position"),
    )
    return with_manager_position(performance(s), managers)


@query(
    f"{SALES}, {MANAGERS}, {manager_sql('(SELECT * FROM pm WHERE job_position = ' + repr('Area Manager') + ')', 'area_head', SENIOR_MANAGER)}",
    "sales_lines stores",
)
def senior_manager_incentive(s):
    """Area managers."""
    return manager_incentive(managed(s), "area_head", SENIOR_MANAGER, "Area Manager")


@query(
    f"{SALES}, {MANAGERS}, {manager_sql('(SELECT * FROM pm WHERE job_position = ' + repr('Junior Area Manager') + ')', 'area_head', JUNIOR_MANAGER)}",
    "sales_lines stores",
)
def junior_manager_incentive(s):
    """Junior area managers."""
    return manager_incentive(managed(s), "area_head", JUNIOR_MANAGER, "Junior Area Manager")


@query(f"{SALES}, {manager_sql('perf', 'city_head', CITY_HEAD)}", "sales_lines stores")
def city_head_incentive(s):
    """City heads, over all their stores."""
    return manager_incentive(performance(s), "city_head", CITY_HEAD)
