"""Staging frames at the (month, region) grain.

Raw facts are collapsed before they meet a key that may be hot. Line items become one row per
order, orders one row per (customer, month), and only these meet the customer dimension, so a
customer holding a third of all orders contributes one row per month to that join. The same
holds for suppliers. The one raw join left is line item to part: both sides may be large, so
no side is hinted, and adaptive execution splits a hot part key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiocast.functions.dates import month_no, ym_of_no
from regiocast.functions.exact import guarded_ratio, hundredths, units_to_double, wide_sum
from regiocast.sources.tables import Tables

CATEGORIES = ["economy", "large", "medium", "promo", "small", "standard"]
POPULATION = {"res_pop": "A", "work_pop": "N", "visit_pop": "R"}
PRIORITIES = {
    "rental_count": "1-URGENT", "new_contract_count": "2-HIGH", "campaign_count": "3-MEDIUM",
    "cs_calls": "4-NOT SPECIFIED", "cancel_count": "5-LOW",
}
BANDS = {
    "pop_0_19": ["FURNITURE"], "pop_20_39": ["BUILDING", "AUTOMOBILE"],
    "pop_40_59": ["HOUSEHOLD"], "pop_60_plus": ["MACHINERY"],
    "pop_30_49": ["BUILDING", "HOUSEHOLD"], "pop_male": ["AUTOMOBILE", "MACHINERY"],
}


def _when_sum(condition, value):
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("bigint")))


LINE_SUMS = ["lines", "qty", *POPULATION, "net", *CATEGORIES]
ORDER_SUMS = ["orders", "total", "rental_total", *PRIORITIES]
SUPPLY_SUMS = ["lines", "qty", "price", "retail"]
FACT_SUMS = [*LINE_SUMS, "price", "retail"]


def line_facts(lines: DataFrame, part: DataFrame) -> DataFrame:
    """Both sides of the mart from one pass over line items and one join with the parts.

    Every line counts twice, tagged by ``side``: for its order (``key``, no month) and for its
    supplier and ship month. The tagged rows are aggregated together, so there is one exchange by
    part (none where parts are broadcast) and one by (side, key, m). A line whose part is unknown
    counts in no category and has no list price.
    """
    narrow = lines.select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_returnflag",
        month_no("l_shipdate").alias("ship"), hundredths("l_quantity").alias("qty"),
        hundredths("l_extendedprice").alias("price"),
        (hundredths("l_extendedprice") * (F.lit(100) - hundredths("l_discount"))).alias("net"))
    parts = part.select("p_partkey", "p_type", hundredths("p_retailprice").alias("retail"))
    joined = narrow.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    by_order = F.struct(
        F.lit("order").alias("side"), F.col("l_orderkey").alias("key"),
        F.lit(None).cast("int").alias("m"), F.lit(1).cast("bigint").alias("lines"), "qty",
        *[F.when(F.col("l_returnflag") == flag, F.col("qty")).otherwise(zero).alias(name)
          for name, flag in POPULATION.items()], "net",
        *[F.when(F.col("p_type") == c.upper(), F.col("net")).otherwise(zero).alias(c)
          for c in CATEGORIES], none.alias("price"), none.alias("retail"))
    by_supplier = F.struct(
        F.lit("supplier").alias("side"), F.col("l_suppkey").alias("key"),
        F.col("ship").cast("int").alias("m"), F.lit(1).cast("bigint").alias("lines"), "qty",
        *[none.alias(c) for c in [*POPULATION, "net", *CATEGORIES]], "price", "retail")
    return (joined.select(F.inline(F.array(by_order, by_supplier)))
            .groupBy("side", "key", "m").agg(*[F.sum(c).alias(c) for c in FACT_SUMS]))


def facts_by_order(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("side") == "order").select(
        F.col("key").alias("l_orderkey"), *LINE_SUMS)


def facts_by_supplier(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("side") == "supplier").select(
        F.col("key").alias("l_suppkey"), "m", *SUPPLY_SUMS)


def order_lines(t: Tables, categories: bool = True) -> DataFrame:
    """One row per order: line count, quantities by return flag, net sales, and with
    ``categories`` net sales by category, which alone need the parts. A line whose part is
    unknown counts in no category."""
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_returnflag",
        hundredths("l_quantity").alias("qty"),
        (hundredths("l_extendedprice") * (F.lit(100) - hundredths("l_discount"))).alias("net"))
    sums = [F.count(F.lit(1)).alias("lines"), F.sum("qty").alias("qty"),
            *[_when_sum(F.col("l_returnflag") == flag, F.col("qty")).alias(name)
              for name, flag in POPULATION.items()],
            F.sum("net").alias("net")]
    if not categories:
        return lines.groupBy("l_orderkey").agg(*sums)
    parts = t.part.select("p_partkey", "p_type")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .groupBy("l_orderkey")
        .agg(*sums,
             *[_when_sum(F.col("p_type") == c.upper(), F.col("net")).alias(c)
               for c in CATEGORIES])
    )


def narrow_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey", "o_custkey", month_no("o_orderdate").alias("m"),
        hundredths("o_totalprice").alias("total"), "o_orderpriority")


def order_measures() -> list:
    """What the orders of a group add up to."""
    return [F.count(F.lit(1)).alias("orders"), F.sum("total").alias("total"),
            _when_sum(F.col("o_orderpriority") == PRIORITIES["rental_count"],
                      F.col("total")).alias("rental_total"),
            *[F.count(F.when(F.col("o_orderpriority") == p, 1)).alias(name)
              for name, p in PRIORITIES.items()]]


def customer_months(t: Tables, with_lines: bool = True, categories: bool = True,
                    lines: DataFrame | None = None) -> DataFrame:
    """One row per (customer, month) with everything its orders add up to. ``lines``: sums per
    order, where they exist already."""
    orders = narrow_orders(t.orders)
    measures = order_measures()
    if with_lines:
        lines = order_lines(t, categories) if lines is None else lines
        orders = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        measures += [F.sum(c).alias(c)
                     for c in ["lines", "qty", *POPULATION, "net",
                               *(CATEGORIES if categories else [])]]
    return orders.groupBy("o_custkey", "m").agg(*measures)


def by_region(t: Tables, by_code: DataFrame, counts: list[str],
              sums: list[str]) -> DataFrame:
    """(m, code) sums to (m, region). Many codes may belong to one region; a region that
    holds most of the rows meets the dimension as one row per month and code."""
    regions = t.nation.select("n_nationkey", F.col("n_name").alias("region"))
    return (
        by_code.join(regions, F.col("code") == F.col("n_nationkey"))
        .groupBy("m", "region")
        .agg(F.max("code").alias("region_code"), *[F.sum(c).alias(c) for c in counts],
             *[F.sum(c).alias(c) for c in sums])
    )


def customer_activity(t: Tables, with_lines: bool = True, categories: bool = True,
                      months: DataFrame | None = None) -> DataFrame:
    """(month, customer region) frame behind population, sales, asset, demographic and
    telecom staging: one pass over the facts for all of them. Without ``categories`` the
    parts are not read. ``months``: rows of :func:`customer_months`, where they exist already."""
    split = CATEGORIES if categories else []
    customers = t.customer.select(
        "c_custkey", "c_nationkey", hundredths("c_acctbal").alias("balance"), "c_mktsegment")
    sums = ["orders", "total", "rental_total", *PRIORITIES]
    if with_lines:
        sums += ["lines", "qty", *POPULATION, "net", *split]
    if months is None:
        months = customer_months(t, with_lines, categories)
    by_code = (
        months.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("m", F.col("c_nationkey").alias("code"))
        .agg(F.count(F.lit(1)).alias("customers"),
             wide_sum(F.col("balance") * F.col("orders")).alias("balance"),
             *[wide_sum(c).alias(c) for c in sums],
             *[F.count(F.when(F.col("c_mktsegment").isin(segments), 1)).alias(band)
               for band, segments in BANDS.items()])
    )
    grouped = by_region(t, by_code, ["customers", *BANDS], ["balance", *sums])

    def whole(c):
        return F.col(c).cast("bigint").alias(c)

    out = [ym_of_no("m").alias("ym"), "region", "region_code", "m"]
    if with_lines:
        out += [
            *[units_to_double(c, 2).alias(c) for c in POPULATION],
            units_to_double("qty", 2).alias("total_pop"),
            units_to_double("net", 4).alias("total_sales"),
            *[units_to_double(c, 4).alias(f"{c}_sales") for c in split],
            F.col("lines").cast("bigint").alias("total_tx_count")]
    out += [
        "customers",
        (units_to_double("total", 2) / F.col("orders").cast("double")).alias("avg_income"),
        (units_to_double("balance", 2) / F.col("orders").cast("double")).alias("avg_asset"),
        F.col("orders").cast("bigint").alias("move_in"),
        *[whole(c) for c in PRIORITIES],
        units_to_double("rental_total", 2).alias("rental_amount"),
        *BANDS]
    return grouped.select(*out)


def supplier_months(t: Tables) -> DataFrame:
    """One row per (supplier, ship month)."""
    lines = t.lineitem.select(
        "l_suppkey", "l_partkey", month_no("l_shipdate").alias("m"),
        hundredths("l_quantity").alias("qty"),
        hundredths("l_extendedprice").alias("price"))
    parts = t.part.select("p_partkey", hundredths("p_retailprice").alias("retail"))
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .groupBy("l_suppkey", "m")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("qty").alias("qty"),
             F.sum("price").alias("price"), F.sum("retail").alias("retail"))
    )


def supplier_activity(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """(ship month, supplier region) frame behind price, outflow and commercial staging.

    ``rows``: rows of :func:`supplier_months`, where they exist already.
    A supplier opens in a month when it was not active in the month before, and closes in the
    month after its last consecutive active one. Windows run per supplier over months.
    """
    w = Window.partitionBy("l_suppkey").orderBy("m")
    if rows is None:
        rows, last = supplier_months(t), t.lineitem.agg(F.max(month_no("l_shipdate"))).scalar()
    else:
        last = rows.agg(F.max("m")).scalar()
    months = rows.select(
        "*",
        (F.col("m") - F.min("m").over(w)).alias("tenure"),
        F.when(F.lag("m").over(w) == F.col("m") - 1, 0).otherwise(1).alias("opened"),
        F.when(F.lead("m").over(w) == F.col("m") + 1, 0).otherwise(1).alias("closes"))
    zero = F.lit(0).cast("bigint")
    active = F.struct(
        F.col("m"), F.lit(1).alias("active"), "opened", F.lit(0).alias("closed"),
        F.col("tenure"), F.lit(0).alias("closed_tenure"), "lines", "qty", "price", "retail")
    closing = F.struct(
        (F.col("m") + 1).alias("m"), F.lit(0).alias("active"), F.lit(0).alias("opened"),
        F.lit(1).alias("closed"), F.lit(0).alias("tenure"),
        (F.col("tenure") + 1).alias("closed_tenure"),
        zero.alias("lines"), zero.alias("qty"), zero.alias("price"), zero.alias("retail"))
    changes = months.select(
        "l_suppkey",
        F.inline(F.when(F.col("closes") == 1, F.array(active, closing))
                 .otherwise(F.array(active))))
    suppliers = t.supplier.select("s_suppkey", "s_nationkey")
    counts = ["active", "opened", "closed", "tenure", "closed_tenure"]
    sums = ["lines", "qty", "price", "retail"]
    by_code = (
        changes.filter(F.col("m") <= last)
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("m", F.col("s_nationkey").alias("code"))
        .agg(*[F.sum(c).alias(c) for c in counts], *[wide_sum(c).alias(c) for c in sums])
    )
    g = by_region(t, by_code, counts, sums)
    retained = (F.col("active") - F.col("opened")).cast("double")
    return g.select(
        ym_of_no("m").alias("ym"), "region", "m",
        guarded_ratio(units_to_double("retail", 2), F.col("lines").cast("double"))
        .alias("avg_sale_price"),
        guarded_ratio(units_to_double("price", 2), units_to_double("qty", 2))
        .alias("avg_price_per_unit"),
        F.when(F.col("active") > 0, units_to_double("qty", 2)).alias("total_households"),
        F.col("lines").cast("bigint").alias("move_out"),
        F.col("active").cast("bigint").alias("active_stores"),
        F.when(F.col("opened") >= F.col("closed"), "growing").otherwise("stagnant")
        .alias("commercial_status"),
        guarded_ratio(retained * F.lit(100.0), F.col("active").cast("double"), 0.0)
        .alias("stability_score"),
        guarded_ratio(F.col("tenure").cast("double"), F.col("active").cast("double"))
        .alias("avg_operating_months"),
        guarded_ratio(F.col("closed_tenure").cast("double"), F.col("closed").cast("double"))
        .alias("avg_closure_months"),
        F.col("opened").cast("bigint").alias("store_open_cnt"),
        F.col("closed").cast("bigint").alias("store_close_cnt"),
        (F.col("opened") - F.col("closed")).cast("bigint").alias("net_store_change"),
        F.when(F.col("closed") > F.col("opened"), 1).otherwise(0).alias("closure_risk_flag"),
        F.when((F.col("opened") + F.col("closed")) * 2 > F.col("active"), 1).otherwise(0)
        .alias("dynamic_zone_flag"))


def shares(a: DataFrame) -> DataFrame:
    """Age-band shares on the 0-1 scale next to the band counts."""
    total = F.col("customers").cast("double")
    return a.withColumns({
        "age_20_39_share": F.col("pop_20_39").cast("double") / total,
        "family_30_49_share": F.col("pop_30_49").cast("double") / total,
        "senior_60p_share": F.col("pop_60_plus").cast("double") / total,
        "male_ratio": F.col("pop_male").cast("double") / total,
    })


def stage_population(t: Tables) -> DataFrame:
    a = customer_activity(t, categories=False).filter(F.col("total_tx_count").isNotNull())
    return a.select("ym", "region", *POPULATION, "total_pop")


def stage_card_sales(t: Tables) -> DataFrame:
    a = customer_activity(t).filter(F.col("total_tx_count").isNotNull())
    return a.select("ym", "region", "total_sales", *[f"{c}_sales" for c in CATEGORIES],
                    "total_tx_count")


def stage_totals(t: Tables) -> DataFrame:
    """Total sales alone, without a look at the parts."""
    a = customer_activity(t, categories=False).filter(F.col("total_tx_count").isNotNull())
    return a.select("ym", "region", "total_sales", "total_tx_count")


def stage_assets(t: Tables) -> DataFrame:
    return customer_activity(t, with_lines=False).select(
        "ym", "region", "customers", "avg_income", "avg_asset")


def stage_prices(t: Tables) -> DataFrame:
    return (supplier_activity(t).filter(F.col("active_stores") > 0)
            .select("ym", "region", "avg_sale_price", "avg_price_per_unit", "total_households"))


def stage_movement(t: Tables) -> DataFrame:
    """Inflow by customer region, outflow by supplier region; a missing side counts as 0."""
    inflow = customer_activity(t, with_lines=False).select("ym", "region", "move_in")
    outflow = (supplier_activity(t).filter(F.col("active_stores") > 0)
               .select("ym", "region", "move_out"))
    both = inflow.join(outflow, ["ym", "region"], "full_outer")
    zero = F.lit(0).cast("bigint")
    return both.select(
        "ym", "region",
        F.coalesce("move_in", zero).alias("move_in"),
        F.coalesce("move_out", zero).alias("move_out"),
        (F.coalesce("move_in", zero) - F.coalesce("move_out", zero)).alias("net_move"))


def stage_demographics(t: Tables) -> DataFrame:
    return shares(customer_activity(t, with_lines=False)).select(
        "ym", "region", F.col("customers").alias("total_resident"),
        "pop_0_19", "pop_20_39", "pop_40_59", "pop_60_plus",
        "age_20_39_share", "family_30_49_share", "senior_60p_share", "male_ratio")


def stage_commercial(t: Tables) -> DataFrame:
    return supplier_activity(t).select(
        "ym", "region", "commercial_status", "stability_score", "avg_operating_months",
        "avg_closure_months", "store_open_cnt", "store_close_cnt", "net_store_change",
        "closure_risk_flag", "dynamic_zone_flag")


def telecom_columns(a: DataFrame) -> DataFrame:
    from regiocast.functions.exact import rounded_int_ratio
    return a.withColumns({
        "contract_count": F.col("move_in"),
        "marketing_score": rounded_int_ratio("rental_count", "move_in", 4),
    })


def stage_telecom(t: Tables) -> DataFrame:
    return telecom_columns(customer_activity(t, with_lines=False)).select(
        "ym", "region", "contract_count", "new_contract_count", "cancel_count", "rental_count",
        "rental_amount", "marketing_score", "campaign_count", "cs_calls")
