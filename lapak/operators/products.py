"""Product master: active items, cost repair, barcode matching, refresh of sales lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fill_by_type
from ..functions.values import is_in
from .dedup import first_per_key, latest_per_key
from .joining import absent_from, best_per_code, keep_facts

# Fixed values.
COMPANIES = ("mpr", "mgl")
SECOND_COMPANY_BRANDS = ("SZ",)
PARTNER_BRANDS = ("Minimal", "Mens top", "Menstop", "MOC", "Moc", "Manzone", "Edwin", "Due")
PARTNER_COST_FACTOR = "1.03"
MARGIN_GROUP = "CSG"
MARGIN_RATE = 0.3

# Version order of a pulled row, oldest first.
PULL_ORDER = ("pulldate", "modifieddatetime", "recid")

MATCHED_ATTRIBUTES = (
    "itemid", "umbrellabrand", "alucode", "season", "world", "category", "subcategory",
    "pricecategory", "yearmonth", "hpp", "basicprice",
)


# Attributes a line takes from the current master, and the ending of their names until it has taken them.
REFRESHED_ATTRIBUTES = (
    "variantnumber", "itemid", "umbrellabrand", "subbrand", "alucode", "season", "yearmonth",
    "world", "category", "subcategory", "hpp", "basicprice",
)
REFRESHED = "__new"


def online_company(brand: Column) -> Column:
    """Company that owns an online brand."""
    return F.when(is_in(brand, SECOND_COMPANY_BRANDS), F.lit("mgl")).otherwise(F.lit("mpr"))


def current_products(products: DataFrame, order: Sequence[str] = PULL_ORDER) -> DataFrame:
    """Latest current row per company and barcode."""
    current = products.where("pullstatus = 'Current'")
    return latest_per_key(current, ["dataareaid", "codebars"], order)


def current_products_two_stage(
    products: DataFrame, order: Sequence[str] = PULL_ORDER
) -> DataFrame:
    """Latest current row per variant, then per barcode, within each company."""
    current = products.where("pullstatus = 'Current'")
    by_variant = latest_per_key(current, ["dataareaid", "variantnumber"], order)
    return latest_per_key(by_variant, ["dataareaid", "codebars"], order)


def report_products(products: DataFrame, columns: Sequence[str], order: Sequence[str] = PULL_ORDER) -> DataFrame:
    """First current row per company and barcode, as used by the accumulation report."""
    current = products.where("pullstatus = 'Current'")
    return first_per_key(current, ["codebars", "dataareaid"], order).select(*columns)


def active_items(items: DataFrame, stops: DataFrame, order: Sequence[str]) -> DataFrame:
    """Legacy items without a stop flag, last row per company and barcode."""
    flagged = keep_facts(items, stops, ["dataareaid", "itemid"])
    flagged = flagged.fillna({"stopped": 0, "recid": 101010101, "inventdimid": ""})
    return latest_per_key(flagged.where("stopped = 0"), ["dataareaid", "codebars"], order)


def repair_cost(products: DataFrame, legacy: DataFrame, order: Sequence[str] = PULL_ORDER) -> DataFrame:
    """Fill a zero cost of current products.

    First from the legacy item table; a second-company product of a partner brand whose cost
    is still zero takes the first company's cost plus 3 %. Other rows pass unchanged.
    """
    legacy_cost = latest_per_key(legacy, ["dataareaid", "codebars"], order).select(
        "dataareaid", "codebars", F.col("hpp").alias("hppax")
    )
    first_company = (
        first_per_key(
            products.where("pullstatus = 'Current' AND dataareaid = 'mpr'"), ["codebars"], order
        )
        .select("codebars", F.lit("mgl").alias("dataareaid"), F.col("hpp").alias("hpp_inplace"))
    )
    joined = keep_facts(
        keep_facts(products, legacy_cost, ["dataareaid", "codebars"]),
        first_company,
        ["dataareaid", "codebars"],
    )
    current = F.coalesce(F.col("pullstatus") == "Current", F.lit(False))
    hppax = F.when(current, F.coalesce("hppax", F.lit(0))).otherwise(F.lit(0))
    partner = (
        current & (F.col("dataareaid") == "mgl") & is_in("umbrellabrand", PARTNER_BRANDS)
    )
    raised = F.coalesce(F.col("hpp_inplace"), F.lit(0)) * F.lit(PARTNER_COST_FACTOR).cast("decimal(4,2)")
    cost_type = products.schema["hpp"].dataType
    repaired = F.when(current & (F.col("hpp") == 0), hppax).otherwise(F.col("hpp"))
    return (
        joined.withColumn("hppax", hppax.cast(cost_type))
        .withColumn("hpp", repaired.cast(cost_type))
        .withColumn(
            "hpp",
            F.when(partner & (F.col("hpp") == 0), raised).otherwise(F.col("hpp")).cast(cost_type),
        )
        .drop("hpp_inplace")
    )


def _listed(dimension: DataFrame, company: str, entries: list[tuple[int, Column]]) -> DataFrame:
    """Rows of one company, listed under each look-up code with its rank.

    An item without a cost only wins where no other entry has one.
    """
    penalty = F.when(F.col("hpp").isNull(), F.lit(100)).otherwise(F.lit(0))
    listing = F.array(
        *[F.struct(code.alias("look_up"), (penalty + rank).alias("rank")) for rank, code in entries]
    )
    return dimension.where(F.col("dataareaid") == company).select(
        "codebars", *MATCHED_ATTRIBUTES, F.inline(listing)
    )


def match_online_codes(lines: DataFrame, items: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Attach product attributes to online lines by their seller code.

    Second-company brands try, in this order: its SKU code, its barcode, the first company's
    barcode, then both barcodes with the leading zero toggled. Other brands try the barcode and
    the barcode with a zero in front; their code column takes the code that was looked for.
    The whole cascade is turned into one look-up table, ranked per code, so the lines are
    joined (and at most shuffled) once and never multiplied.

    With ``products`` the look-up table meets that master, not the lines: they come with what
    ``refresh_online`` would look up by their code.
    """
    code = F.col("codebars")
    # Codes that toggle to this barcode: the stripped form, and the form with one zero more.
    shorter = F.when(code.startswith("0"), F.substr(code, F.lit(2)))
    shorter = F.when(~shorter.startswith("0"), shorter)
    longer = F.concat(F.lit("0"), code)
    unprefixed = F.when(code.startswith("0"), F.substr(code, F.lit(2)))
    unprefixed = F.when(~unprefixed.startswith("0"), unprefixed)
    cascade = _listed(
        items, "mgl", [(1, F.col("alucode")), (2, code), (4, shorter), (4, longer)]
    ).unionByName(_listed(items, "mpr", [(3, code), (5, shorter), (5, longer)]))
    plain = _listed(items, "mpr", [(1, code), (2, unprefixed)])
    table = best_per_code(cascade).withColumn("company", F.lit("mgl")).unionByName(
        best_per_code(plain).withColumn("company", F.lit("mpr"))
    )
    if products is not None:
        master = _refreshing(products)
        table = _with_master(table, master)
    lines = lines.withColumn("company", online_company(F.col("brand")))
    matched = keep_facts(lines, table, {"company": "company", "barcode": "look_up"})
    second = F.col("company") == "mgl"
    tried = F.when(F.col("barcode").startswith("0"), F.col("barcode")).otherwise(
        F.concat(F.lit("0"), F.col("barcode"))
    )
    plain_code = F.coalesce(F.col("codebars"), tried)
    matched = matched.withColumns(
        {
            "codebars": F.when(second, F.col("codebars")).otherwise(plain_code),
            "barcode": F.when(second, F.col("barcode")).otherwise(plain_code),
        }
    )
    if products is not None:
        matched = _without_code(matched, master)
    return matched.drop("company")


def _refreshing(products: DataFrame) -> DataFrame:
    """The current master's attributes per company and barcode, under the names ``refresh_online`` reads."""
    master = current_products_two_stage(products).withColumn("yearmonth", F.to_date("monthyear"))
    return master.select(
        "dataareaid", "codebars", *[F.col(n).alias(n + REFRESHED) for n in REFRESHED_ATTRIBUTES]
    )


def _with_master(table: DataFrame, master: DataFrame) -> DataFrame:
    """A look-up table of online codes with the master's attributes of each entry's barcode.

    A first-company code that no item is listed under is looked for in the master as it is or with
    a zero in front, so the master's barcodes are listed under these codes too.
    """
    found = keep_facts(table, master, {"company": "dataareaid", "codebars": "codebars"}, null_safe=False)
    code = F.col("codebars")
    bare = F.substr(code, F.lit(2))
    listing = F.array(code, F.when(~bare.startswith("0"), bare))
    others = master.where((F.col("dataareaid") == COMPANIES[0]) & code.startswith("0"))
    others = others.select(F.col("dataareaid").alias("company"), F.explode(listing).alias("look_up"), *[n + REFRESHED for n in REFRESHED_ATTRIBUTES])
    others = others.where(F.col("look_up").isNotNull())
    unlisted = absent_from(others, table, ["company", "look_up"])
    return found.unionByName(unlisted, allowMissingColumns=True)


def _without_code(lines: DataFrame, master: DataFrame) -> DataFrame:
    """Lines without a barcode take the master's row without one, at most one per company."""
    nameless = master.where(F.col("codebars").isNull() & is_in("dataareaid", COMPANIES)).drop("codebars")
    nameless = nameless.withColumnsRenamed({n + REFRESHED: n + "__none" for n in REFRESHED_ATTRIBUTES})
    missing = F.col("codebars").isNull()
    keyed = lines.withColumn("__of", F.when(missing, F.col("company")))
    joined = keep_facts(keyed, nameless, {"__of": "dataareaid"}, bounded=True)
    taken = {
        n + REFRESHED: F.when(missing, F.col(n + "__none")).otherwise(F.col(n + REFRESHED)) for n in REFRESHED_ATTRIBUTES
    }
    return joined.withColumns(taken).drop("__of", *[n + "__none" for n in REFRESHED_ATTRIBUTES])


def refresh_online(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Replace the attributes of online lines by the current master's, per company.

    A zero master cost keeps the line's cost; the cost of the line is recomputed. Lines that were
    matched together with the master bring its attributes and are not joined again.
    """
    names = REFRESHED_ATTRIBUTES
    if names[0] + REFRESHED not in lines.columns:
        lines = lines.withColumn("dataareaid", online_company(F.col("brand")))
        lines = keep_facts(lines, _refreshing(products), ["dataareaid", "codebars"]).drop("dataareaid")
    new = {n: F.col(n + REFRESHED) for n in names}
    cost = F.when(new["hpp"] == 0, F.col("hpp")).otherwise(new["hpp"])
    return (
        lines.withColumns(new | {"hpp": cost})
        .withColumn("existing_hpp", F.col("hpp") * F.col("qty_sold"))
        .drop(*[n + REFRESHED for n in names])
    )


def refresh_cost(lines: DataFrame, legacy: DataFrame) -> DataFrame:
    """Zero costs of lines take the legacy table's cost of the same company and barcode."""
    cost = first_per_key(legacy, ["dataareaid", "codebars"], ["itemid"]).select(
        "dataareaid", "codebars", F.col("hpp").alias("hpp_inplace")
    )
    joined = keep_facts(lines, cost, ["dataareaid", "codebars"])
    old = F.coalesce("hpp_inplace", F.lit(0))
    return joined.withColumn("hpp", F.when(F.col("hpp") == 0, old).otherwise(F.col("hpp"))).drop(
        "hpp_inplace"
    )


def refresh_pos(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Replace the attributes of POS lines by the current master's.

    Missing numbers become 0 and missing text ``undetected``; the cost is 0 where a margin
    cost exists, and the total cost is recomputed.
    """
    names = [
        "itemid", "alucode", "articlecode", "itemname", "hpp", "umbrellabrand", "subbrand",
        "department", "style", "world", "category", "subcategory", "size_", "season",
        "yearmonth", "basicprice", "saleprice", "codebars",
    ]
    master = (
        current_products_two_stage(products)
        .withColumn("yearmonth", F.to_date("monthyear"))
        .withColumnRenamed("size", "size_")
    )
    master = master.select(
        "dataareaid", F.col("codebars").alias("__code"), *[F.col(n).alias(f"{n}__new") for n in names]
    )
    joined = keep_facts(
        lines, master, {"dataareaid": "dataareaid", "productdata_barcode": "__code"}
    )
    joined = fill_by_type(joined, 0, "undetected")
    cost = F.when(F.col("hpp__new") == 0, F.col("hpp")).otherwise(F.col("hpp__new"))
    updated = {n: F.col(f"{n}__new") for n in names if n != "hpp"} | {"hpp": cost}
    refreshed = joined.withColumns(updated).drop(*[f"{n}__new" for n in names])
    no_cost = (F.col("hpp") != 0) & (F.col("cost_of_margin") != 0)
    return refreshed.withColumn(
        "hpp", F.when(no_cost, F.lit(0)).otherwise(F.col("hpp"))
    ).withColumn("hpp_total", cost_per_unit(F.col("hpp"), F.col("cost_of_margin"), F.col("quantity")))


# Three cost definitions are in use side by side; each keeps its own name.


def cost_line_plus_margin(hpp: Column, margin_cost: Column, quantity: Column) -> Column:
    return hpp.cast("double") * quantity + margin_cost


def cost_per_unit(hpp: Column, margin_cost: Column, quantity: Column) -> Column:
    return (hpp.cast("double") + margin_cost) * quantity


def cost_margin_first(hpp: Column, margin_cost: Column, quantity: Column) -> Column:
    """The margin cost alone where both costs exist."""
    both = (hpp != 0) & (margin_cost != 0)
    return F.when(both, margin_cost * quantity).otherwise(cost_per_unit(hpp, margin_cost, quantity))


def cost_of_margin(lines: DataFrame, brand_margins: DataFrame) -> DataFrame:
    """Margin rate and margin cost by company.

    Second company: rate of the brand times the line value. First company: 30 % of the paid
    value for categories of the consignment group.
    """
    rates = brand_margins.select(
        F.col("brand_name").alias("umbrellabrand"), F.col("cost_of_margin").alias("brand_margin")
    )
    joined = keep_facts(lines, rates, ["umbrellabrand"])
    second = F.col("dataareaid") == "mgl"
    consigned = F.coalesce(F.col("category").contains(MARGIN_GROUP), F.lit(False))
    margin = F.when(second, F.coalesce("brand_margin", F.lit(0.0))).otherwise(
        F.when(consigned, F.lit(MARGIN_RATE)).otherwise(F.lit(0.0))
    )
    value = F.when(second, F.col("order_product_total").cast("double")).otherwise(
        F.col("cust_paid_peritem")
    )
    return (
        joined.withColumn("margin", margin)
        .withColumn("cost_of_margin", F.when(F.col("margin") != 0, value * F.col("margin")).otherwise(F.lit(0.0)))
        .drop("brand_margin")
    )
