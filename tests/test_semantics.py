"""Null, rounding, ordering and parsing rules the driver tables cannot show (they hold no NULL)."""

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import functions as F

from lapak.functions import dates, numbers, text
from lapak.functions.columns import (
    camel_to_snake,
    col_or,
    columns_of_type,
    conform,
    drop_matching,
    fill_by_type,
    report_title,
)
from lapak.functions.values import (
    differs,
    first_match,
    is_in,
    map_values,
    nan_to_null,
    not_in,
    replace_values,
    sum0,
)
from lapak.operators.accumulating import promo_sales, unified_sales, valid_sales
from lapak.operators.aggregating import group_sum, running_total, split_sums
from lapak.operators.dedup import derepeat, first_per_key, latest_per_key, number_rows
from lapak.operators.joining import attach_totals, full_outer, keep_facts, with_leading_zero_retry


def one(df, column):
    return df.select(column.alias("x")).collect()[0].x


def test_not_equal_keeps_null(frame):
    df = frame("k string", [("a",), ("b",), (None,)])
    assert df.where(differs("k", "a")).count() == 2
    assert df.where(not_in("k", ["a"])).count() == 2
    assert df.where(is_in("k", ["a"])).count() == 1


def test_valid_sales_keeps_unknown(frame):
    df = frame(
        "istransaction string, issettled boolean, status_order int, channel string",
        [(None, None, None, None), ("1", True, 6, "SHOWROOM"), ("0", True, 6, "S"), ("1", False, 6, "S"),
         ("1", True, 7, "S"), ("1", True, 5, "ONLINE")],
    )
    assert valid_sales(df).count() == 2


def test_outer_join_matches_null_keys(frame):
    left = frame("k string, a int", [(None, 1), ("x", 2)])
    right = frame("k string, b int", [(None, 3), ("y", 4)])
    rows = {(r.k, r.a, r.b) for r in full_outer(left, right, ["k"]).collect()}
    assert rows == {(None, 1, 3), ("x", 2, None), ("y", None, 4)}


def test_group_drops_null_keys_and_sums_nothing_to_zero(frame):
    df = frame("k string, v int", [("a", None), ("a", None), (None, 5)])
    assert [tuple(r) for r in group_sum(df, ["k"], "v").collect()] == [("a", 0)]


def test_nan_becomes_null(frame):
    df = frame("v double", [(math.nan,), (1.0,)])
    assert df.select(nan_to_null("v").alias("v")).agg(F.sum("v")).collect()[0][0] == 1.0


def test_division_by_zero(frame):
    df = frame("a double, b double, n double", [(1.0, 0.0, None)])
    assert one(df, numbers.ratio("a", "b")) is None
    assert one(df, numbers.safe_ratio("a", "b")) == 0.0
    assert one(df, numbers.safe_ratio("n", "a")) == 0.0


def test_half_even_rounding(frame):
    df = frame("v decimal(10,3)", [(Decimal(x),) for x in ("0.5", "1.5", "2.5", "2.675", "0.285")])
    assert [int(r.x) for r in df.select(numbers.round_even("v").alias("x")).collect()][:3] == [0, 2, 2]
    assert [str(r.x) for r in df.select(numbers.round_even("v", 2).alias("x")).collect()][3:] == ["2.68", "0.28"]


def test_bad_text_becomes_null(frame):
    df = frame("t string", [("nope",)])
    assert one(df, dates.parse_date("t", "dd/MM/yyyy", "yyyy-MM-dd")) is None
    assert one(df, numbers.try_money("t")) is None
    assert one(df, text.whole_number("t")) is None
    assert one(df, text.part_of("t", " ", 2)) is None


def test_title_case(frame):
    df = frame("t string", [("dki-JAKARTA o'neil 3abc",)])
    assert one(df, text.title_case("t")) == "Dki-Jakarta O'Neil 3Abc"


def test_literal_separators(frame):
    df = frame("t string", [("123.0|x",)])
    assert one(df, text.part_of("t", ".", 0)) == "123"
    assert one(df, text.part_of("t", "|", 1)) == "x"


def test_currency(frame):
    df = frame("t string", [("IDR 1.234.000",), ("90",), (None,)])
    assert [r.x for r in df.select(text.whole_number("t", "IDR ").alias("x")).collect()] == [1234000, 90, None]


def test_phone(frame):
    df = frame("t string", [("+62 812-345-6789",), ("8123456789",), ("0812",), (None,), ("62",)])
    got = [r.x for r in df.select(text.phone("t").alias("x")).collect()]
    assert got == ["08123456789", "08123456789", "*******", "*******", "*******"]


def test_postcode_and_address(frame):
    df = frame("p string, a string", [("'12340.0", "Jalan 1 \nBlok\n2 ")])
    assert one(df, text.postcode("p")) == "12340"
    assert one(df, text.clean_address("a")) == "Jalan 1 Blok, 2"


def test_zero_toggle_and_unquote(frame):
    df = frame("t string, q string", [("012", '="A1"')])
    assert one(df, text.zero_toggle("t")) == "12"
    assert one(df, text.zero_toggle(F.lit("12"))) == "012"
    assert one(df, text.unquote("q")) == "A1"


def test_prefix_zero_of_null_is_null(frame):
    assert one(frame("t string", [(None,)]), F.concat(F.lit("0"), "t")) is None


def test_latest_row_uses_the_given_order(frame):
    rows = [("a", 1, 10), ("a", 2, 5), ("a", 2, 7), ("a", None, 99), (None, 1, 1)]
    df = frame("k string, v int, id int", rows)
    assert {(r.k, r.id) for r in latest_per_key(df, ["k"], ["v", "id"]).collect()} == {("a", 7), (None, 1)}
    assert {(r.k, r.id) for r in first_per_key(df, ["k"], ["v", "id"]).collect()} == {("a", 10), (None, 1)}


def test_derepeat_with_and_without_spread(frame):
    rows = [("s1", d, i, 5.0) for d in (1, 2, 3) for i in (1, 2)] + [("s2", 1, 1, None), ("s2", 1, 2, 7.0)]
    df = frame("s string, d int, i int, t double", rows)
    for spread in ([], ["d"]):
        out = derepeat(df, {"t": ["s"]}, ["s", "d", "i"], spread)
        kept = {(r.s, r.d, r.i): r.t for r in out.collect()}
        assert kept.pop(("s1", 1, 1)) == 5.0
        assert kept.pop(("s2", 1, 1)) is None
        assert set(kept.values()) == {0.0}
    by_value = derepeat(df, {"t": ["s", "t"]}, ["s", "d", "i"], ["d"])
    assert sorted(r.t for r in by_value.where("t > 0").collect()) == [5.0, 7.0]


def test_numbers_are_consecutive_within_groups(frame):
    df = frame("g string, v int", [("a" if i % 3 else "b", i) for i in range(500)])
    out = number_rows(df, ["v"], ["g"]).collect()
    for g in "ab":
        mine = sorted((r.v, r.no) for r in out if r.g == g)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


def test_map_and_replace(frame):
    df = frame("k int, s string", [(6, "x"), (9, None)])
    assert [r.x for r in df.select(map_values("k", {6: "Finish"}).alias("x")).collect()] == ["Finish", None]
    assert [r.x for r in df.select(replace_values("s", {"x": "y"}).alias("x")).collect()] == ["y", None]


def test_null_condition_takes_the_default(frame):
    df = frame("v int", [(None,)])
    assert one(df, first_match([(F.col("v") < 100, "low")], "else")) == "else"


def test_dates(frame):
    df = frame("d date", [(dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),), (dt.date(2024, 3, 8),)])
    assert [r.x for r in df.select(dates.week_label("d").alias("x")).collect()] == ["Week 5", "Week 1", "Week 2"]
    assert [r.x for r in df.select(dates.day_score("d").alias("x")).collect()] == [1.0, 1.5, 1.5]
    start = dates.project_day("d", dt.date(2024, 2, 28))
    assert [r.x for r in df.select(start.alias("x")).collect()] == [2, 3, 10]


def test_rebuild_months():
    assert dates.rebuild_months(dt.date(2024, 1, 1)) == [dt.date(2023, 12, 1)]
    assert dates.rebuild_months(dt.date(2024, 1, 5)) == [dt.date(2023, 12, 1), dt.date(2024, 1, 1)]
    assert dates.rebuild_months(dt.date(2024, 1, 6)) == [dt.date(2024, 1, 1)]
    assert dates.rebuild_months(dt.date(2024, 1, 19), late_until=19)[0] == dt.date(2023, 12, 1)
    assert dates.drop_months(dt.date(2024, 1, 31), {"2023-12", "2024-01"}) == ["2024-01"]
    assert dates.drop_months(dt.date(2024, 1, 9), {"2023-12"}) == ["2023-12"]
    assert dates.reference_date(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)


def test_in_month_covers_december(frame):
    df = frame("d date", [(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),)])
    assert df.where(dates.in_month("d", dt.date(2023, 12, 5))).count() == 1


def test_names():
    assert camel_to_snake("StorePosID") == "store_pos_id"
    assert camel_to_snake("camelCase2Name") == "camel_case2_name"
    assert report_title("cust_paid_peritem_ly", {"cust_paid_peritem": "sales", "_ly": "_last_year"}) == "Sales Last Year"


def test_whole_frame_edits(frame):
    df = frame("a int, b string, c_drop string, d double", [(None, None, "x", None)])
    row = fill_by_type(df, 0, "?").collect()[0]
    assert (row.a, row.b, row.d) == (0, "?", 0.0)
    assert drop_matching(df, "_drop").columns == ["a", "b", "d"]
    assert one(df, col_or(df, "zz", 3)) == 3
    assert conform(df, ["b", "zz"]).columns == ["b", "zz"]
    from pyspark.sql import types as T

    assert columns_of_type(df, T.NumericType) == ["a", "d"]


def test_leading_zero_retry_prefers_the_exact_code(frame):
    dim = frame("code string, item string", [("012", "twelve"), ("12", "other"), ("077", "seven")])
    facts = frame("sku string", [("12",), ("012",), ("77",), ("5",), (None,)])
    got = {r.sku: r.item for r in with_leading_zero_retry(facts, "sku", dim, "code").collect()}
    assert got == {"12": "other", "012": "twelve", "77": "seven", "5": None, None: None}


def test_attach_totals_groups_null_keys(frame):
    df = frame("k string, v int", [("a", 1), ("a", 2), (None, 3), (None, 4)])
    got = sorted((r.v, r.t) for r in attach_totals(df, ["k"], {"t": F.sum("v")}).collect())
    assert got == [(1, 3), (2, 3), (3, 7), (4, 7)]


def test_keep_facts_refuses_silent_collisions(frame):
    left, right = frame("k int, v int", [(1, 1)]), frame("k int, v int", [(1, 2)])
    try:
        keep_facts(left, right, ["k"])
        raise AssertionError
    except ValueError:
        pass
    assert keep_facts(left, right, ["k"], suffix="_r").columns == ["k", "v", "v_r"]


def test_split_and_running_sums(frame):
    df = frame("k string, m int, v int, c string", [("a", 1, 5, "x"), ("a", 2, 7, None), ("a", 2, 1, "x")])
    row = split_sums(df, ["k"], ["v"], F.col("c") == "x", "_x").collect()[0]
    assert (row.v, row.v_x) == (13, 6)
    run = running_total(df, ["k"], "m", {"v": "total"}).orderBy("m").collect()
    assert [r.total for r in run] == [5, 13]


def test_unified_sales_falls_back_to_the_scanned_code(frame):
    rows = [("mpr", "1", dt.date(2024, 1, 1), "undetected", "099", "o1", 1, 10.0, 1.0),
            ("mpr", "1", dt.date(2024, 1, 1), "Undetected", None, "o1", 1, 10.0, 1.0),
            ("mpr", "1", dt.date(2024, 1, 1), "099", "099", "o1", 2, 5.0, 1.0),
            ("mpr", None, dt.date(2024, 1, 1), "099", "099", "o2", 2, 5.0, 1.0)]
    schema = "dataareaid string, axcode string, order_create_date date, codebars string, productdata_barcode string, ordernumber string, quantity int, cust_paid_peritem double, hpp_total double"
    got = {r.codebars: (r.ordernumber, r.quantity) for r in unified_sales(frame(schema, rows)).collect()}
    assert got == {"099": (1, 3), "Undetected": (1, 1)}


def test_sum0(frame):
    assert frame("v int", [(None,)]).agg(sum0("v")).collect()[0][0] == 0


def test_promo_flag(frame):
    stores = frame(
        "dataareaid string, channel string, brand string, groupstore string, axcode string, stdname string, sqm double, sssg string, so_dept_head string, area_head string, city_head string",
        [("mpr", "c", "b", "g", "1", "n", 1.0, "s", "h", "a", "c")],
    )
    lines = frame(
        "dataareaid string, axcode string, order_create_date date, promocode string, remarks string, cust_paid_peritem double",
        [("mpr", "1", dt.date(2024, 1, 1), "regular", "r", 1.0), ("mpr", "9", dt.date(2024, 1, 1), "P1", "r", 1.0)],
    )
    assert {r.promocode: (r.is_promo, r.stdname) for r in promo_sales(lines, stores).collect()} == {
        "regular": (0, "n"),
        "P1": (1, None),
    }
