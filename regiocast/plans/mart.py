"""Feature marts at the (month, region) grain: base, extended, and with the service signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiocast.functions.dates import month_no
from regiocast.functions.exact import guarded_ratio, pct_change, rounded_int_ratio, weighted_sum
from regiocast.plans import fixed
from regiocast.plans.calendar import order_calendar
from regiocast.plans.indices import VISITS, visitor_indices
from regiocast.plans.staging import (CATEGORIES, POPULATION, PRIORITIES, customer_activity,
                                     customer_months, facts_by_order, facts_by_supplier,
                                     line_facts, shares, supplier_activity, telecom_columns)
from regiocast.session import scratch_path
from regiocast.sources.sinks import replace_table
from regiocast.sources.tables import Tables

KEY = ["ym", "region"]

BASE_COLUMNS = [
    *KEY, "total_pop", *POPULATION, "total_sales", *[f"{c}_sales" for c in CATEGORIES],
    "total_tx_count", "customers", "avg_income", "avg_asset", "avg_sale_price",
    "avg_price_per_unit", "total_households", "move_in", "move_out", "net_move",
    "sales_per_pop", "price_to_asset_ratio", "prev_sales", "prev_pop", "sales_chg_pct",
    "pop_chg_pct", "price_chg_pct",
]
EXTENDED_COLUMNS = [
    *BASE_COLUMNS, "holiday_days", "long_weekend_cnt", "business_days", "total_resident",
    "pop_0_19", "pop_20_39", "pop_40_59", "pop_60_plus", "age_20_39_share",
    "family_30_49_share", "senior_60p_share", "male_ratio", "domestic_visitor_idx",
    "foreign_visitor_idx", "tourism_spend_idx", "tourism_demand_idx", "commercial_status",
    "stability_score", "avg_operating_months", "avg_closure_months", "store_open_cnt",
    "store_close_cnt", "net_store_change", "closure_risk_flag", "dynamic_zone_flag",
    "next_month_holidays", "prev_month_holidays", "pre_holiday_flag", "post_holiday_flag",
    "young_consumer_idx", "market_health_score", "rental_signal_v2",
]
# of the extended mart, what orders, their lines and customers give: no part and no supplier
SALES_COLUMNS = [
    *KEY, "total_pop", *POPULATION, "total_sales", "total_tx_count", "customers", "avg_income",
    "avg_asset", "move_in", "sales_per_pop", "prev_sales", "prev_pop", "sales_chg_pct",
    "pop_chg_pct", "holiday_days", "long_weekend_cnt", "business_days", "total_resident",
    "pop_0_19", "pop_20_39", "pop_40_59", "pop_60_plus", "age_20_39_share",
    "family_30_49_share", "senior_60p_share", "male_ratio", "domestic_visitor_idx",
    "foreign_visitor_idx", "tourism_spend_idx", "tourism_demand_idx", "next_month_holidays",
    "prev_month_holidays", "pre_holiday_flag", "post_holiday_flag", "young_consumer_idx",
]
SIGNAL_COLUMNS = [
    *EXTENDED_COLUMNS, "contract_count", "new_contract_count", "cancel_count", "rental_count",
    "rental_amount", "marketing_score", "campaign_count", "cs_calls", "rental_signal",
    "rental_conversion_rate",
]


def left_join_all(spine: DataFrame, sources: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Left join sources with unique keys onto the spine; the row count never changes."""
    for frame, keys in sources:
        spine = spine.join(frame, keys, "left")
    return spine


def add_ratios(df: DataFrame) -> DataFrame:
    """Sales per head (0 without heads, NULL without sales) and price to asset ratio."""
    return df.withColumns({
        "sales_per_pop": guarded_ratio("total_sales", "total_pop", 0.0),
        "price_to_asset_ratio": guarded_ratio("avg_sale_price", "avg_asset"),
    })


def add_changes(df: DataFrame) -> DataFrame:
    """Previous row and percent change of sales, population and price per region.

    The previous row is the previous month present. All columns share one window, hence one
    exchange and one sort; a partition holds one row per month of a region.
    """
    w = Window.partitionBy("region").orderBy("ym")
    return df.withColumns({
        "prev_sales": F.lag("total_sales").over(w),
        "prev_pop": F.lag("total_pop").over(w),
        "_prev_price": F.lag("avg_sale_price").over(w),
    }).withColumns({
        "sales_chg_pct": pct_change("total_sales", "prev_sales"),
        "pop_chg_pct": pct_change("total_pop", "prev_pop"),
        "price_chg_pct": pct_change("avg_sale_price", "_prev_price"),
    }).drop("_prev_price")


def add_strict_changes(df: DataFrame, value: str) -> DataFrame:
    """Change against the calendar month before; NULL where that month is absent."""
    w = Window.partitionBy("region").orderBy("ym")
    consecutive = F.months_between(F.to_date(F.concat("ym", F.lit("01")), "yyyyMMdd"),
                                   F.to_date(F.concat(F.lag("ym").over(w), F.lit("01")),
                                             "yyyyMMdd")) == 1
    before = F.when(consecutive, F.lag(value).over(w))
    return df.withColumn("_before", before).withColumn(
        f"{value}_strict_chg_pct",
        F.when(F.col("_before") > 0,
               (F.col(value) - F.col("_before")) / F.col("_before") * 100.0)).drop("_before")


def wide_activity(t: Tables) -> DataFrame:
    """Spine of the marts: customer side left-joined with the supplier side.

    Line items are read and joined with their parts once; the sums per order and per supplier and
    month are written in the shared folder, and both sides start from them.
    """
    facts = replace_table(line_facts(t.lineitem, t.part), scratch_path(t.spark, "line-facts"))
    return both_sides(
        customer_activity(t, months=customer_months(t, lines=facts_by_order(facts))),
        supplier_activity(t, facts_by_supplier(facts)))


def activity_for(t: Tables, columns: Sequence[str]) -> DataFrame:
    """:func:`wide_activity`, or where ``columns`` of the marts need neither parts nor suppliers
    its customer side alone; the other columns are null there, and nothing asked for reads them."""
    if not set(columns) <= set(SALES_COLUMNS):
        return wide_activity(t)
    none = {c: "string" if c == "commercial_status" else "double" for c in (
        "avg_sale_price", "avg_price_per_unit", "total_households", "move_out", "net_move",
        "commercial_status", "stability_score", "avg_operating_months", "avg_closure_months",
        "store_open_cnt", "store_close_cnt", "net_store_change", "closure_risk_flag",
        "dynamic_zone_flag", *[f"{c}_sales" for c in CATEGORIES])}
    return customer_activity(t, categories=False).filter(
        F.col("total_tx_count").isNotNull()).withColumns(
        {c: F.lit(None).cast(kind) for c, kind in none.items()})


def both_sides(customers: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The join uses the month number both sides were grouped by, so it needs no new exchange."""
    spine = customers.filter(F.col("total_tx_count").isNotNull())
    zero = F.lit(0).cast("bigint")
    return (
        left_join_all(spine, [(suppliers.drop("ym"), ["m", "region"])])
        .withColumn("move_out", F.coalesce("move_out", zero))
        .withColumn("net_move", F.col("move_in") - F.col("move_out"))
    )


def base_columns(wide: DataFrame, columns: Sequence[str] = BASE_COLUMNS) -> DataFrame:
    return add_changes(add_ratios(wide)).select(*columns)


def base_mart(t: Tables, columns: Sequence[str] = BASE_COLUMNS) -> DataFrame:
    """``columns``: those that are used; what only others need is not read."""
    return base_columns(activity_for(t, columns), columns)


def add_holiday_flags(df: DataFrame) -> DataFrame:
    """Holidays of the next and previous row of a region, and flags for two or more."""
    w = Window.partitionBy("region").orderBy("ym")
    return df.withColumns({
        "next_month_holidays": F.lead("holiday_days").over(w),
        "prev_month_holidays": F.lag("holiday_days").over(w),
    }).withColumns({
        flag: F.when(F.col(c) >= fixed.HOLIDAY_FLAG_MIN, 1).otherwise(0)
        for flag, c in [("pre_holiday_flag", "next_month_holidays"),
                        ("post_holiday_flag", "prev_month_holidays")]
    })


def add_interactions(df: DataFrame) -> DataFrame:
    """Young-consumer index, market health and the tourism-weighted movement signal."""
    zero = F.lit(0.0)
    return df.withColumns({
        "young_consumer_idx": F.coalesce(
            F.col("age_20_39_share") * F.col("tourism_demand_idx") / 100.0, zero),
        "market_health_score": F.coalesce(
            F.col("stability_score")
            * (F.lit(1.0) - F.col("closure_risk_flag") * F.lit(fixed.CLOSURE_PENALTY)), zero),
        "rental_signal_v2": F.coalesce(
            (F.col("net_move") + F.col("net_store_change")) * F.col("tourism_demand_idx")
            / 100.0, zero),
    })


def _extended(t: Tables, columns: Sequence[str]) -> DataFrame:
    first_month = t.orders.agg(F.min(month_no("o_orderdate"))).scalar()
    wide = left_join_all(activity_for(t, columns), [(order_calendar(t), ["ym"])])
    wide = shares(wide).withColumn("total_resident", F.col("customers"))
    wide = visitor_indices(wide, first_month)
    return add_interactions(add_holiday_flags(add_changes(add_ratios(wide))))


def extended_mart(t: Tables, columns: Sequence[str] = EXTENDED_COLUMNS) -> DataFrame:
    """``columns``: those that are used; what only others need is not read."""
    return _extended(t, columns).select(*columns)


def add_service_signal(df: DataFrame) -> DataFrame:
    """Composite rental signal and rentals per incoming move."""
    return df.withColumns({
        "rental_signal": weighted_sum(fixed.SIGNAL_WEIGHTS),
        "rental_conversion_rate": rounded_int_ratio(
            F.coalesce("rental_count", F.lit(0)), "move_in", 4),
    })


def signal_mart(t: Tables) -> DataFrame:
    return add_service_signal(telecom_columns(_extended(t, SIGNAL_COLUMNS))).select(*SIGNAL_COLUMNS)


def stage_tourism(t: Tables) -> DataFrame:
    """Visitor indices for every region and month of the order calendar (dense spine)."""
    from regiocast.operators.spine import dense_months
    first_month = t.orders.agg(F.min(month_no("o_orderdate"))).scalar()
    regions = t.nation.select(F.col("n_name").alias("region")).distinct()
    measured = customer_activity(t, categories=False).select("m", "region", *VISITS.values())
    spine = dense_months(regions, t.orders, "o_orderdate").join(measured, ["m", "region"], "left")
    return visitor_indices(spine.fillna(0.0, list(VISITS.values())), first_month).select(
        "ym", "region", *VISITS, "tourism_demand_idx")
