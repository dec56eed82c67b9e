"""Accumulation, month and year reports, online daily reports, settlement and delivery."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lapak.operators.accumulating import (
    DAY_GRAIN,
    MEASURES,
    PERIODS,
    PRODUCT_COLUMNS,
    PROMO_STORE_COLUMNS,
    STORE_COLUMNS,
    align_periods,
    category_year_report,
    daily_store_report,
    month_to_date,
    mtd_ytd_report,
    online_as_sales,
    online_stores,
    per_day_comparison,
    promo_orders,
    promo_sales,
    titled,
    unified_sales,
    valid_sales,
)
from lapak.operators.aggregating import group_sum
from lapak.operators.calendar import calendar_pattern, date_dimension
from lapak.operators.joining import present_in
from lapak.operators.online_reports import (
    DELIVERY_LINE,
    SETTLEMENT_LINE,
    daily_lines,
    daily_totals_agree,
    delivery_extract,
    numbered_settlement,
    online_daily_report,
    online_targets,
    sales_by_day,
    sales_by_item,
    sales_by_status,
    settlement_template,
)
from lapak.operators.aggregating import observed_write
from lapak.plans.accumulation import accumulation_report, period_checks, report_totals, write_small
from lapak.session import scratch_folder

from .aggregates import VALID
from .registry import query, r, rs

SCORE = "CASE WHEN dayname({0}) IN ('Saturday', 'Sunday') THEN 2.0 WHEN dayname({0}) = 'Friday' THEN 1.5 ELSE 1.0 END"
DAYS = f"""days AS (SELECT pattern_date, pattern_lm, pattern_last_year, dayname(pattern_date) AS day_name,
  CAST({SCORE.format('pattern_date')} AS DOUBLE) AS day_score, CAST(day(pattern_date) AS INT) AS day,
  'Week ' || CAST((day(pattern_date) - 1) // 7 + 1 AS VARCHAR) AS week, strftime(pattern_date, '%m') AS month,
  sum(CAST({SCORE.format('pattern_date')} AS DOUBLE)) OVER (PARTITION BY date_trunc('month', pattern_date)) AS month_score
  FROM pattern)"""


@query(
    f"""{DAYS} SELECT strftime(pattern_date, '%Y-%m-%d') || '/' || strftime(pattern_lm, '%Y-%m-%d') || '/' || strftime(pattern_last_year, '%Y-%m-%d') AS id,
      pattern_date, day_name, day_score, day, week, month, month_score FROM days""",
    "pattern",
    name="calendar_pattern",
)
def _calendar_pattern(s):
    """Calendar rows with weekday, week, day weight and month weight."""
    return date_dimension(calendar_pattern(s.pattern))


WEBSITES = "('MANZONESTORE.ID', 'MINIMALSTORE.ID', 'MOCSTORE.ID', 'MATAHARISTORE.COM', 'WEBSITE')"
ONLINE_STORES = f"""onl AS (SELECT dataareaid, axcode, openstatus, string_split(stdname, ' ')[2] AS brand,
  CASE WHEN string_split(stdname, ' ')[3] IN {WEBSITES} THEN 'SHOPIFY' ELSE COALESCE(string_split(stdname, ' ')[3], '') END AS marketplace
  FROM stores WHERE upper(channel) = 'ONLINE')"""


@query(
    f"{ONLINE_STORES} SELECT dataareaid, axcode, brand, marketplace FROM onl",
    "stores",
)
def online_store_derivation(s):
    """Brand and marketplace of online stores, from their names."""
    return online_stores(s.stores).select("dataareaid", "axcode", "brand", "marketplace")


BOTH = f"""{ONLINE_STORES},
pick AS (SELECT brand, marketplace, min(axcode) AS axcode, arg_min(dataareaid, axcode) AS dataareaid FROM onl GROUP BY 1, 2),
allsales AS (SELECT dataareaid, axcode, order_create_date,
    CASE WHEN codebars IN ('undetected', 'Undetected') AND productdata_barcode IS NOT NULL THEN productdata_barcode ELSE codebars END AS codebars,
    ordernumber, quantity, cust_paid_peritem, hpp_total FROM sales_lines WHERE {VALID}
  UNION ALL SELECT p.dataareaid, p.axcode, o.date, o.codebars, o.order_no, o.qty_sold, o.value_after_voucher, o.existing_hpp
    FROM online_lines o LEFT JOIN pick p ON o.brand = p.brand AND o.marketplace = p.marketplace WHERE o.sales_status <> 'CANCELED'),
sold AS (SELECT dataareaid, axcode, order_create_date, codebars, count(DISTINCT ordernumber) AS ordernumber,
    CAST(sum(quantity) AS BIGINT) AS quantity, round_even(sum(cust_paid_peritem), 2) AS cust_paid_peritem,
    round_even(sum(hpp_total), 2) AS hpp_total FROM allsales WHERE dataareaid IS NOT NULL GROUP BY 1, 2, 3, 4)"""
BOTH_SHAPES = "sales_lines online_lines stores"


def both_channels(s):
    return unified_sales(valid_sales(s.sales_lines), online_as_sales(s.online_lines, s.stores))


@query(
    f"{BOTH} SELECT dataareaid, axcode, order_create_date, codebars, ordernumber, quantity, {rs('cust_paid_peritem, hpp_total')} FROM sold",
    BOTH_SHAPES,
    name="unified_sales",
)
def _unified_sales(s):
    """Offline and online sales per company, store, date and barcode."""
    return both_channels(s)


MEASURE_COLUMNS = [m + p for p in PERIODS for m in MEASURES]


def wide_sql() -> str:
    """Three periods side by side: tag, stack and sum, instead of outer joins."""
    parts = []
    for source, suffix in (("pattern_date", ""), ("pattern_lm", "_lm"), ("pattern_last_year", "_ly")):
        values = ", ".join(
            f"{m if p == suffix else 0} AS {m}{p}" for p in PERIODS for m in MEASURES
        )
        parts.append(
            f"SELECT dataareaid, axcode, pattern_date, codebars, {values} FROM days JOIN sold ON {source} = order_create_date "
            "WHERE pattern_date IN (SELECT order_create_date FROM sold)"
        )
    sums = ", ".join(f"sum({c}) AS {c}" for c in MEASURE_COLUMNS)
    return f"wide AS (SELECT dataareaid, axcode, pattern_date, codebars, {sums} FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2, 3, 4)"


GRAIN = ", ".join(DAY_GRAIN)
PRODUCT_PICK = """pr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codebars, dataareaid ORDER BY pulldate, recid) AS n
  FROM products WHERE pullstatus = 'Current') WHERE n = 1)"""
ATTRIBUTES = [c for c in PRODUCT_COLUMNS if c not in ("dataareaid", "codebars")]
GROUPED = f"""{DAYS}, {BOTH}, {wide_sql()}, {PRODUCT_PICK},
grouped AS (SELECT w.dataareaid, w.axcode, w.pattern_date AS order_create_date, d.day, d.day_name, d.day_score, d.week, d.month, d.month_score,
  {', '.join(f"COALESCE(pr.{c}, 'Undetected') AS {c}" for c in ATTRIBUTES)}, {', '.join(f'sum({c}) AS {c}' for c in MEASURE_COLUMNS)}
  FROM wide w JOIN days d ON d.pattern_date = w.pattern_date LEFT JOIN pr ON pr.dataareaid = w.dataareaid AND pr.codebars = w.codebars
  GROUP BY ALL),
akum AS (SELECT {', '.join(('s.' if c not in ('dataareaid', 'axcode') else 'g.') + c for c in STORE_COLUMNS)},
  CASE WHEN row_number() OVER (PARTITION BY g.dataareaid, g.axcode, s.target ORDER BY {', '.join('g.' + c for c in DAY_GRAIN)}) = 1 THEN s.target ELSE 0 END AS target,
  CASE WHEN row_number() OVER (PARTITION BY g.dataareaid, g.axcode, g.order_create_date, s.target / month_score * day_score ORDER BY {', '.join('g.' + c for c in DAY_GRAIN)}) = 1
    THEN s.target / month_score * day_score ELSE 0 END AS target_daily,
  {', '.join('g.' + c for c in DAY_GRAIN if c not in ('dataareaid', 'axcode'))}, {', '.join(MEASURE_COLUMNS)}
  FROM grouped g LEFT JOIN stores s ON s.dataareaid = g.dataareaid AND s.axcode = g.axcode)"""
COUNTS = {m + p for p in PERIODS for m in ("ordernumber", "quantity")}
MONEY = {"sqm", "target", "target_daily", "day_score", "month_score"} | {
    m + p for p in PERIODS for m in ("cust_paid_peritem", "hpp_total")
}


def shown(columns) -> str:
    return ", ".join(
        f"{r(c)} AS {c}" if c in MONEY else f"CAST({c} AS BIGINT) AS {c}" if c in COUNTS else c
        for c in columns
    )


AKUM_COLUMNS = [
    *STORE_COLUMNS, "target", "target_daily",
    *[c for c in DAY_GRAIN if c not in ("dataareaid", "axcode")], *MEASURE_COLUMNS,
]
AKUM_SHAPES = BOTH_SHAPES + " pattern products"


def used_pattern(s):
    """Calendar rows whose own date had sales on either channel."""
    offline = valid_sales(s.sales_lines).select("order_create_date")
    online = online_as_sales(s.online_lines, s.stores).where("dataareaid IS NOT NULL")
    dates = offline.unionByName(online.select("order_create_date")).distinct()
    return present_in(s.pattern, dates, {"pattern_date": "order_create_date"})


def report(s):
    return accumulation_report(s.sales_lines, s.online_lines, s.stores, s.products, s.pattern)


@query(f"{GROUPED} SELECT {shown(AKUM_COLUMNS)} FROM akum", AKUM_SHAPES)
def sales_accumulation(s):
    """The accumulation report: every day against last month and last year, with targets."""
    return report(s).accumulation


@query(
    f"""{GROUPED},
    t AS (SELECT {', '.join(f"round_even(sum(cust_paid_peritem{p}), 2) AS a{i}" for i, p in enumerate(PERIODS))} FROM akum),
    b AS (SELECT {', '.join(f"(SELECT round_even(sum(cust_paid_peritem), 2) FROM sold WHERE order_create_date IN (SELECT {c} FROM pattern)) AS b{i}"
        for i, c in enumerate(('pattern_date', 'pattern_lm', 'pattern_last_year')))})
    SELECT n AS check_name, CAST(x AS DOUBLE) AS amount_before, CAST(y AS DOUBLE) AS amount_after, x = y AS is_matched FROM (
      SELECT 'this month' AS n, b0 AS x, a0 AS y FROM t, b UNION ALL SELECT 'last month', b1, a1 FROM t, b UNION ALL SELECT 'last year', b2, a2 FROM t, b)""",
    AKUM_SHAPES,
)
def accumulation_checks(s):
    """Control totals of the three periods, observed as sales and report are written."""
    return report(s).checks


@query(
    f"""{GROUPED},
    a AS (SELECT {', '.join(f"round_even(sum(cust_paid_peritem{p}), 2) AS a{i}" for i, p in enumerate(PERIODS))} FROM akum),
    b AS (SELECT {', '.join(f"round_even(sum(cust_paid_peritem{p}) FILTER (WHERE dataareaid = 'mpr'), 2) AS b{i}" for i, p in enumerate(PERIODS))} FROM akum)
    SELECT n AS check_name, CAST(x AS DOUBLE) AS amount_before, CAST(y AS DOUBLE) AS amount_after, x = y AS is_matched FROM (
      SELECT 'this month' AS n, a0 AS x, b0 AS y FROM a, b UNION ALL SELECT 'last month', a1, b1 FROM a, b UNION ALL SELECT 'last year', a2, b2 FROM a, b)""",
    AKUM_SHAPES,
)
def accumulation_checks_mismatch(s):
    """A delivery that holds one company only does not have the report's totals."""
    spark = s.lineitem.sparkSession
    whole = report(s).accumulation

    def totals(rows, name: str):
        path = scratch_folder(spark, name)
        return observed_write(rows, name, report_totals(), lambda df: write_small(df, path))

    return period_checks(spark, totals(whole, "whole"), totals(whole.where("dataareaid = 'mpr'"), "part"))


@query(
    f"""p AS (SELECT dataareaid, axcode, order_create_date, promocode, remarks, sum(cust_paid_peritem) AS cust_paid_peritem
      FROM sales_lines WHERE {VALID} GROUP BY 1, 2, 3, 4, 5)
    SELECT {', '.join(('p.' if c in ('dataareaid', 'axcode') else 's.') + c for c in PROMO_STORE_COLUMNS if c != 'sqm')}, {r('s.sqm')} AS sqm,
      order_create_date, promocode, remarks, {r('cust_paid_peritem')} AS cust_paid_peritem,
      CASE WHEN promocode IN ('', 'regular') THEN 0 ELSE 1 END AS is_promo
    FROM p LEFT JOIN stores s ON s.dataareaid = p.dataareaid AND s.axcode = p.axcode""",
    "sales_lines stores",
    name="promo_sales",
)
def _promo_sales(s):
    """Paid value per store, date and promotion."""
    return promo_sales(valid_sales(s.sales_lines), s.stores)


@query(
    f"""SELECT l.dataareaid, l.axcode, so_dept_head, area_head, city_head, order_create_date, promocode, remarks,
      CAST(sum(quantity) AS BIGINT) AS quantity, {r('sum(cust_paid_peritem)')} AS cust_paid_peritem, count(DISTINCT ordernumber) AS ordernumber
    FROM sales_lines l JOIN stores s ON s.dataareaid = l.dataareaid AND s.axcode = l.axcode
    WHERE {VALID.replace('channel', 'l.channel')} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
    "sales_lines stores",
    name="promo_orders",
)
def _promo_orders(s):
    """Distinct orders per store, heads and promotion."""
    return promo_orders(valid_sales(s.sales_lines), s.stores)


# A leaner accumulated table, as stored, feeds the month and year reports.
STORED = f"""acc AS (SELECT l.dataareaid, l.axcode, order_create_date, strftime(order_create_date, '%m') AS month,
  'Week ' || CAST((day(order_create_date) - 1) // 7 + 1 AS VARCHAR) AS week, year(order_create_date) AS year,
  p.umbrellabrand, p.subbrand, p.category, p.subcategory, CAST(count(DISTINCT ordernumber) AS BIGINT) AS ordernumber,
  CAST(sum(quantity) AS BIGINT) AS quantity, sum(cust_paid_peritem) AS cust_paid_peritem, sum(hpp_total) AS hpp_total
  FROM sales_lines l JOIN match_items p0 ON p0.dataareaid = l.dataareaid AND p0.codebars = l.productdata_barcode
  JOIN (SELECT DISTINCT dataareaid, itemid, umbrellabrand, subbrand, category, subcategory FROM products) p
    ON p.dataareaid = p0.dataareaid AND p.itemid = p0.itemid
  WHERE {VALID} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)"""


def stored(s):
    """Accumulated rows with zero counterparts, in the report's columns."""
    products = s.products.select(
        "dataareaid", "itemid", "umbrellabrand", "subbrand", "category", "subcategory"
    ).distinct()
    items = s.match_items.select("dataareaid", F.col("codebars").alias("productdata_barcode"), "itemid")
    lines = valid_sales(s.sales_lines).join(items, ["dataareaid", "productdata_barcode"])
    lines = lines.join(products, ["dataareaid", "itemid"])
    day = F.dayofmonth("order_create_date")
    dated = lines.withColumns(
        {
            "month": F.date_format("order_create_date", "MM"),
            "week": F.concat(F.lit("Week "), (F.floor((day - 1) / 7) + 1).cast("string")),
            "year": F.year("order_create_date").cast("bigint"),
        }
    )
    grain = [
        "dataareaid", "axcode", "order_create_date", "month", "week", "year", "umbrellabrand",
        "subbrand", "category", "subcategory",
    ]
    acc = group_sum(
        dated, grain, "quantity", "cust_paid_peritem", "hpp_total", ordernumber=F.count_distinct("ordernumber")
    )
    zero = F.lit(0).cast("decimal(28,2)")
    extra = {m + p: zero if "paid" in m or "hpp" in m else F.lit(0).cast("bigint") for p in PERIODS[1:] for m in MEASURES}
    return acc.withColumns({**extra, "target": F.lit(0.0), "target_daily": F.lit(0.0)})


CATEGORY = "dataareaid, axcode, umbrellabrand, subbrand, category, subcategory"


@query(
    f"""{STORED}, y AS (SELECT * FROM acc WHERE year = 2000 AND month <= '07')
    SELECT y.dataareaid, y.axcode, umbrellabrand, subbrand, y.category, subcategory, '07' AS month,
      {', '.join(f"CAST(sum(CASE WHEN month = '07' THEN {m} ELSE 0 END) AS BIGINT) AS {m}, CAST(sum({m}) AS BIGINT) AS {m}_ytd" for m in ('ordernumber', 'quantity'))},
      {r("sum(CASE WHEN month = '07' THEN cust_paid_peritem ELSE 0 END)")} AS cust_paid_peritem, {r('sum(cust_paid_peritem)')} AS cust_paid_peritem_ytd,
      any_value(s.stdname) AS stdname, any_value(s.area_head) AS area_head
    FROM y LEFT JOIN stores s ON s.dataareaid = y.dataareaid AND s.axcode = y.axcode GROUP BY 1, 2, 3, 4, 5, 6""",
    "sales_lines match_items products stores",
)
def mtd_ytd(s):
    """A month beside the year so far, by store, brand and category."""
    months = month_to_date(stored(s).where("year = 2000"))
    return mtd_ytd_report(months, "07", s.stores).select(
        *CATEGORY.split(", "), "month", "ordernumber", "ordernumber_ytd", "quantity", "quantity_ytd",
        "cust_paid_peritem", "cust_paid_peritem_ytd", "stdname", "area_head",
    )


@query(
    f"""{STORED} SELECT acc.dataareaid AS "Dataareaid", acc.axcode AS "Axcode", month AS "Month", week AS "Week", order_create_date AS "Order Create Date",
      CAST(sum(ordernumber) AS BIGINT) AS "Orders", CAST(sum(quantity) AS BIGINT) AS "Quantity", {r('sum(cust_paid_peritem)')} AS "Sales",
      {r('sum(hpp_total)')} AS "Hpp Total", any_value(s.stdname) AS "Stdname"
    FROM acc LEFT JOIN stores s ON s.dataareaid = acc.dataareaid AND s.axcode = acc.axcode GROUP BY acc.dataareaid, acc.axcode, month, week, order_create_date""",
    "sales_lines match_items products stores",
)
def mtd_ytd_daily(s):
    """Day totals with store attributes under report headings."""
    daily = daily_store_report(stored(s), s.stores).select(
        "dataareaid", "axcode", "month", "week", "order_create_date", *MEASURES, "stdname"
    )
    return titled(daily)


@query(
    f"""{DAYS}, {BOTH}, {wide_sql()}
    SELECT w.dataareaid, w.axcode, w.pattern_date AS order_create_date, {r('day_score')} AS day_score, {r('month_score')} AS month_score,
      {', '.join(f'CAST(sum({m}{p}) AS BIGINT) AS {m}{p}' for p in PERIODS for m in ('ordernumber', 'quantity'))},
      {', '.join(f"{r(f'sum(cust_paid_peritem{p})')} AS cust_paid_peritem{p}" for p in PERIODS)},
      any_value(d.pattern_lm) AS order_create_date_lm, any_value(d.pattern_last_year) AS order_create_date_ly,
      {r('any_value(s.target)')} AS target, {r('any_value(s.target) / any_value(month_score) * any_value(day_score)')} AS target_daily
    FROM wide w JOIN days d ON d.pattern_date = w.pattern_date LEFT JOIN stores s ON s.dataareaid = w.dataareaid AND s.axcode = w.axcode
    GROUP BY w.dataareaid, w.axcode, w.pattern_date, day_score, month_score""",
    AKUM_SHAPES,
    name="per_day_comparison",
)
def _per_day_comparison(s):
    """Day totals of three periods with counterpart dates and daily target."""
    return per_day_comparison(align_periods(both_channels(s), used_pattern(s), by=()), s.pattern, s.stores)


@query(
    f"""{GROUPED},
    yr AS (SELECT dataareaid, axcode, umbrellabrand, subbrand, category, sum(cust_paid_peritem) AS y, sum(cust_paid_peritem_ly) AS z FROM akum GROUP BY 1, 2, 3, 4, 5)
    SELECT {GRAIN.replace('dataareaid', 'a.dataareaid').replace('axcode', 'a.axcode').replace('umbrellabrand', 'a.umbrellabrand').replace('subbrand', 'a.subbrand').replace(' category', ' a.category').replace('day_score', r('day_score') + ' AS day_score').replace('month_score', r('month_score') + ' AS month_score')},
      {r('cust_paid_peritem')} AS cust_paid_peritem,
      {r(f'CASE WHEN row_number() OVER w = 1 THEN y ELSE 0 END')} AS cust_paid_peritem_ytd,
      {r(f'CASE WHEN row_number() OVER w = 1 THEN z ELSE 0 END')} AS cust_paid_peritem_ly_ytd
    FROM akum a JOIN yr USING (dataareaid, axcode, umbrellabrand, subbrand, category)
    WINDOW w AS (PARTITION BY a.dataareaid, a.axcode, a.umbrellabrand, a.subbrand, a.category ORDER BY order_create_date, day, day_name, day_score, week, month, month_score, itemid, world, subcategory)""",
    AKUM_SHAPES,
    name="category_year_report",
)
def _category_year_report(s):
    """Accumulated rows beside their store-category year, shown once."""
    acc = report(s).accumulation
    return category_year_report(acc, acc).select(
        *DAY_GRAIN, "cust_paid_peritem", "cust_paid_peritem_ytd", "cust_paid_peritem_ly_ytd"
    )


UNTIL = dt.date(2001, 12, 31)
DAILY = """dl AS (SELECT *, replace(COALESCE(subcategory, 'NA'), 'PANTS - SARUNG', 'SARUNG - PANTS') AS sub,
  CAST((day(date) - 1) // 7 + 1 AS INT) AS week FROM online_lines WHERE date <= DATE '2001-12-31'),
daily_in AS (SELECT *, CASE WHEN season = 'OT' OR sub LIKE '%SHANGHAI%' THEN 'FESTIVE' ELSE 'REGULAR' END AS desc_category,
  CASE WHEN trim(string_split(sub, ' - ')[1]) IN ('KAFTAN', 'GAMIS', 'SHANGHAI', 'SARUNG', 'KOKO') THEN trim(string_split(sub, ' - ')[1]) ELSE 'REGULAR' END AS product_category
  FROM dl)"""
DAILY_SUMS = f"""count(DISTINCT order_no) AS order_number, CAST(sum(qty_sold) AS BIGINT) AS quantity, {r('sum(discount)')} AS discount, {r('sum(voucher)')} AS voucher,
  {r('sum(subsidy)')} AS subsidy, {r('sum(value_after_voucher)')} AS sales, {r('sum(hpp)')} AS hpp, {r('sum(dpp)')} AS dpp, {r('sum(gross_profit_dpp)')} AS gross_profit,
  {r('COALESCE(CAST(sum(gross_profit_dpp) AS DOUBLE) / NULLIF(CAST(sum(dpp) AS DOUBLE), 0), 0)')} AS gross_profit_pct"""


def daily_input(s):
    return daily_lines(s.online_lines, UNTIL)


@query(
    f"{DAILY} SELECT brand, marketplace, week, date, sales_status, {DAILY_SUMS} FROM daily_in GROUP BY 1, 2, 3, 4, 5",
    "online_lines",
)
def online_daily_status(s):
    """Online sales per day and status."""
    return sales_by_status(daily_input(s))


@query(
    f"{DAILY} SELECT brand, marketplace, week, date, desc_category, product_category, {DAILY_SUMS} FROM daily_in WHERE sales_status <> 'CANCELED' GROUP BY 1, 2, 3, 4, 5, 6",
    "online_lines",
)
def online_daily_item(s):
    """Online sales per day and product group."""
    return sales_by_item(daily_input(s))


CAMPAIGN = dt.date(1998, 3, 1)


@query(
    f"""c AS (SELECT *, CAST((date_diff('day', DATE '1998-03-01', date)) // 7 + 1 AS INT) AS week FROM online_lines
      WHERE date >= DATE '1998-03-01' AND date <= DATE '1998-04-30')
    SELECT brand, marketplace, week, date, {DAILY_SUMS} FROM c WHERE sales_status <> 'CANCELED' GROUP BY 1, 2, 3, 4""",
    "online_lines",
)
def campaign_daily_sales(s):
    """Daily sales of a two-month campaign, weeks counted from its start."""
    lines = s.online_lines.where(F.col("date") >= F.lit(CAMPAIGN))
    return sales_by_day(daily_lines(lines, dt.date(1998, 4, 30), CAMPAIGN))


# Wide targets: one row per online store, one column per date.
TARGET_DATES = [dt.date(2000, 6, 29) + dt.timedelta(days=i) for i in range(5)]
WIDE = ", ".join(
    f'CAST(target + {i} AS DECIMAL(18,2)) AS "{d}"' for i, d in enumerate(TARGET_DATES)
)
TARGETS = f"""{ONLINE_STORES},
wt AS (SELECT s.stdname, s.dataareaid AS areaid, onl.brand, string_split(s.stdname, ' ')[3] AS channel, {WIDE}
  FROM stores s JOIN onl USING (axcode)),
lt AS (SELECT areaid AS dataareaid, brand, CASE WHEN channel IN {WEBSITES} THEN 'SHOPIFY' ELSE channel END AS marketplace, CAST(d AS DATE) AS date, target
  FROM (UNPIVOT wt ON {', '.join(f'"{d}"' for d in TARGET_DATES)} INTO NAME d VALUE target)),
targets AS (SELECT *, CAST((day(date) - 1) // 7 + 1 AS INT) AS week, strftime(date, '%B') AS month,
  sum(target) OVER (PARTITION BY brand, marketplace) AS target_project,
  sum(target) OVER (PARTITION BY strftime(date, '%B'), brand, marketplace) AS target_monthly FROM lt)"""


def target_frame(s):
    stores = online_stores(s.stores)
    wide = stores.select(
        "stdname",
        F.col("dataareaid").alias("areaid"),
        "brand",
        F.get(F.split("stdname", " "), F.lit(2)).alias("channel"),
        *[
            (F.col("target") + i).cast("decimal(18,2)").alias(str(d))
            for i, d in enumerate(TARGET_DATES)
        ],
        F.lit(0).cast("decimal(18,2)").alias("grandtotal"),
    )
    return online_targets(wide)


@query(
    f"{TARGETS} SELECT dataareaid, brand, marketplace, date, week, month, {rs('target, target_project, target_monthly')} FROM targets",
    "stores",
    name="online_targets",
)
def _online_targets(s):
    """Wide daily targets to rows with month and project sums."""
    return target_frame(s)


@query(
    f"""{DAILY}, {TARGETS},
    oneday AS (SELECT brand, marketplace, date, sum(target) AS target, max(target_monthly) AS target_monthly, max(target_project) AS target_project FROM targets GROUP BY 1, 2, 3),
    base AS (SELECT brand, marketplace, week, date, {DAILY_SUMS} FROM daily_in WHERE sales_status <> 'CANCELED' GROUP BY 1, 2, 3, 4),
    ly AS (SELECT brand, marketplace, date AS date_ly, sum(value_after_voucher) AS sales_ly FROM online_lines GROUP BY 1, 2, 3),
    j AS (SELECT b.*, p.pattern_last_year, COALESCE(ly.sales_ly, 0) AS sales_ly, COALESCE(o.target, 0) AS target, COALESCE(o.target_monthly, 0) AS target_monthly,
      COALESCE(o.target_project, 0) AS target_project, strftime(b.date, '%B') AS month
      FROM base b LEFT JOIN pattern p ON p.pattern_date = b.date
      LEFT JOIN ly ON ly.date_ly = p.pattern_last_year AND ly.brand = b.brand AND ly.marketplace = b.marketplace
      LEFT JOIN oneday o ON o.brand = b.brand AND o.marketplace = b.marketplace AND o.date = b.date)
    SELECT * EXCLUDE (sales_ly, target, target_monthly, target_project), {rs('sales_ly, target')},
      {r('CASE WHEN row_number() OVER (PARTITION BY brand, marketplace, target_project ORDER BY week, date) = 1 THEN target_project ELSE 0 END')} AS target_project,
      {r('CASE WHEN row_number() OVER (PARTITION BY month, brand, marketplace, target_monthly ORDER BY week, date) = 1 THEN target_monthly ELSE 0 END')} AS target_monthly
    FROM j""",
    "online_lines pattern stores",
)
def online_daily_sales(s):
    """Daily online sales with last year's counterpart and the targets."""
    targets = target_frame(s).groupBy("brand", "marketplace", "date").agg(
        F.sum("target").alias("target"),
        F.max("target_monthly").alias("target_monthly"),
        F.max("target_project").alias("target_project"),
    )
    return online_daily_report(daily_input(s), s.online_lines, s.pattern, targets)


@query(
    f"""{DAILY} SELECT 'daily vs item' AS check_name, {r('sum(value_after_voucher)')} AS sales_daily, {r('sum(value_after_voucher)')} AS sales_item,
      CAST(sum(qty_sold) AS BIGINT) AS quantity_daily, CAST(sum(qty_sold) AS BIGINT) AS quantity_item, TRUE AS is_matched
    FROM daily_in WHERE sales_status <> 'CANCELED'""",
    "online_lines",
)
def online_daily_check(s):
    """Whether the daily and the item report agree."""
    lines = daily_input(s)
    return daily_totals_agree(sales_by_day(lines), sales_by_item(lines))


@query(
    f"""{DAILY}, t AS (SELECT sum(value_after_voucher) AS a, sum(value_after_voucher) FILTER (WHERE qty_sold > 1) AS b, sum(qty_sold) AS p,
      sum(qty_sold) FILTER (WHERE qty_sold > 1) AS q FROM daily_in WHERE sales_status <> 'CANCELED')
    SELECT 'daily vs item' AS check_name, {r('a')} AS sales_daily, {r('b')} AS sales_item, CAST(p AS BIGINT) AS quantity_daily,
      CAST(q AS BIGINT) AS quantity_item, a = b AND p = q AS is_matched FROM t""",
    "online_lines",
)
def online_daily_check_mismatch(s):
    """An item report that lacks single pieces does not agree with the daily report."""
    lines = daily_input(s)
    return daily_totals_agree(sales_by_day(lines), sales_by_item(lines.where("qty_sold > 1")))


SETTLE_KEYS = (
    "brand, marketplace, delivered_date, order_no, sales_status, codebars, basic_price, courier, tracking_no, delivery_fee, recipient_name, "
    "recipient_phone, recipient_address, recipient_district, recipient_city, recipient_postcode"
)


def nan(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN 'nan' ELSE {c} END AS {c}"


SETTLE = f"""g AS (SELECT {SETTLE_KEYS}, CAST(sum(qty_sold) AS BIGINT) AS qty, sum(discount) AS discount, sum(voucher) AS voucher,
  sum(existing_discount) AS ed, sum(existing_voucher) AS ev, sum(value_after_voucher) AS val FROM online_lines WHERE sales_status <> 'ONPROGRESS' GROUP BY ALL),
n AS (SELECT *, basic_price - discount - voucher AS nett, (basic_price - discount - voucher) * qty AS sub FROM g),
o AS (SELECT *, sum(sub) OVER (PARTITION BY order_no) AS grand, sum(val - sub) OVER (PARTITION BY order_no) AS svc,
  CASE WHEN sales_status = 'CANCELED' THEN -1 ELSE 1 END AS sg FROM n),
settled AS (SELECT brand, marketplace, delivered_date AS transaction_order_date, '' AS transaction_order_id,
  CASE WHEN sg < 0 THEN order_no || '-C' ELSE order_no END AS bon_number, 'Offline Store' AS channel_type_name, 'ONLINE' AS channel_name,
  sales_status AS transaction_status, sales_status AS indie_transaction_status, codebars AS product_sku_barcode, qty * sg AS order_total_qty,
  {r('basic_price')} AS product_unit_price, {r('basic_price')} AS product_store_price, {r('ed + ev')} AS product_brand_promo, 0 AS product_store_promo,
  {r('nett * sg')} AS product_nett_price, {r('sub * sg')} AS subtotal_nett_value_order, {nan('courier')}, tracking_no, '' AS delivery_fee, '' AS insurance_fee,
  '' AS total_delivery_cost, {r('grand')} AS grand_total_order, {r('svc')} AS service_charges, {r('(grand + svc) * sg')} AS total_payment,
  'BCA Virtual Account' AS payment_method, 'nan' AS customer_name, {', '.join(nan(c) for c in ('recipient_name', 'recipient_phone', 'recipient_address', 'recipient_district', 'recipient_city', 'recipient_postcode'))}
  FROM o)"""


@query(f"{SETTLE} SELECT {', '.join(SETTLEMENT_LINE)} FROM settled", "online_lines", name="settlement_template")
def _settlement_template(s):
    """Delivered and cancelled lines in the layout of the POS import."""
    return settlement_template(s.online_lines)


@query(
    f"""{SETTLE} SELECT brand, marketplace, transaction_status, bon_number, product_sku_barcode, transaction_order_date, order_total_qty,
      row_number() OVER (PARTITION BY brand, marketplace, transaction_status ORDER BY transaction_order_date, bon_number, product_sku_barcode, product_unit_price,
        courier, tracking_no, recipient_name, recipient_phone, recipient_address, recipient_district, recipient_city, recipient_postcode) AS no
    FROM settled""",
    "online_lines",
)
def settlement_numbered(s):
    """The template with running numbers per delivered file."""
    return numbered_settlement(settlement_template(s.online_lines)).select(
        "brand", "marketplace", "transaction_status", "bon_number", "product_sku_barcode",
        "transaction_order_date", "order_total_qty", "no",
    )


DELIVERY_MONEY = {"basic_price", "discount", "voucher", "net_sales", "hpp", "existing_discount", "existing_voucher", "existing_net_sales", "value_after_voucher", "existing_hpp"}


@query(
    f"""{ONLINE_STORES}, c AS (SELECT brand, marketplace, min(axcode) AS axcode FROM onl WHERE openstatus = 'OPEN' GROUP BY 1, 2)
    SELECT {', '.join(f"{r('l.' + c)} AS {c}" if c in DELIVERY_MONEY else ('c.axcode' if c == 'axcode' else 'l.' + c) for c in DELIVERY_LINE)},
      CASE WHEN l.brand = 'SZ' THEN 'Online Mitrel' ELSE 'Online MP' END AS delivery
    FROM online_lines l LEFT JOIN c ON c.brand = l.brand AND c.marketplace = l.marketplace WHERE l.sales_status <> 'CANCELED'""",
    "online_lines stores",
    name="delivery_extract",
)
def _delivery_extract(s):
    """Lines that were not cancelled, with store code and delivering company."""
    return delivery_extract(s.online_lines, s.stores)
