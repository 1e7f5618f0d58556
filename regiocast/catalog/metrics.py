"""Metric queries over related tables, with statements that join and add up plainly."""

from regiocast.catalog.oracle import sql
from regiocast.catalog.registry import register
from regiocast.plans import forecast as fc, mart
from regiocast.plans.metrics import shop_catalogue
from regiocast.session import cut_lineage

PLACE = """FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey"""
NET = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28,6))"

MART_TOTALS = """total_pop res_pop work_pop visit_pop total_sales economy_sales large_sales
 medium_sales promo_sales small_sales standard_sales total_tx_count customers total_households
 move_in move_out net_move total_resident pop_0_19 pop_20_39 pop_40_59 pop_60_plus store_open_cnt
 store_close_cnt net_store_change contract_count new_contract_count cancel_count rental_count
 rental_amount campaign_count cs_calls""".split()
MART_MEANS = """avg_income avg_asset avg_sale_price avg_price_per_unit sales_per_pop
 price_to_asset_ratio sales_chg_pct pop_chg_pct price_chg_pct holiday_days long_weekend_cnt
 business_days age_20_39_share family_30_49_share senior_60p_share male_ratio domestic_visitor_idx
 foreign_visitor_idx tourism_spend_idx tourism_demand_idx stability_score avg_operating_months
 avg_closure_months closure_risk_flag dynamic_zone_flag young_consumer_idx market_health_score
 rental_signal_v2 marketing_score rental_signal rental_conversion_rate""".split()


@register("metrics_across_tables", "M1 C10 C1", f"""
 WITH o AS (SELECT n_name AS region, c_mktsegment AS segment,
   CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS order_value, count(*) AS orders
   {PLACE} WHERE strftime(o_orderdate, '%Y%m') >= '199701' GROUP BY ALL),
 l AS (SELECT n_name AS region, c_mktsegment AS segment, CAST(sum({NET}) AS DOUBLE) AS net_sales,
   CAST(sum({NET}) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned_sales, count(*) AS lines
   {PLACE} JOIN lineitem ON l_orderkey = o_orderkey
   WHERE strftime(o_orderdate, '%Y%m') >= '199701' GROUP BY ALL)
 SELECT o.region, o.segment, order_value, orders, order_value / orders AS value_per_order,
  order_value / (SELECT sum(CAST(order_value AS DECIMAL(28,4)))::DOUBLE FROM o)
   AS order_value_share, net_sales, returned_sales / nullif(net_sales, 0) AS return_rate,
  coalesce(lines, 0) / orders AS lines_per_order
 FROM o LEFT JOIN l ON o.region IS NOT DISTINCT FROM l.region
  AND o.segment IS NOT DISTINCT FROM l.segment""")
def metrics_across_tables(t):
    """Orders and line items side by side; an order's value counts once, not once a line."""
    return shop_catalogue(t).query(
        ["order volume", "orders", "value_per_order", "share of orders", "discounted sales",
         "returns", "lines_per_order"], by=["district", "market segment"],
        where={"order month": lambda m: m >= "199701"})


@register("metrics_by_brand_and_supplier", "M1 C10", f"""
 SELECT p_brand AS brand, n_name AS supplier_region, CAST(sum({NET}) AS DOUBLE) AS net_sales,
  count(*) AS lines, CAST(sum({NET}) FILTER (l_returnflag = 'R') AS DOUBLE)
   / nullif(CAST(sum({NET}) AS DOUBLE), 0) AS return_rate
 FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
 GROUP BY ALL""")
def metrics_by_brand_and_supplier(t):
    """Two branches of relationships from one table."""
    return shop_catalogue(t).query(["net_sales", "lines", "return_rate"],
                                   by=["brand", "region of the supplier"])


@register("mart_metrics_by_region", "M1", sql("mart3", f"""
 SELECT region, {", ".join(f"CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE) AS {c}"
                           for c in MART_TOTALS)},
  {", ".join(f"CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE) / nullif(count({c}), 0) AS {c}"
             for c in MART_MEANS)}
 FROM mart3 WHERE ym >= '199901' GROUP BY 1"""))
def mart_metrics_by_region(t):
    """Every measure of the mart, totals and means, by region."""
    found = shop_catalogue(t, lambda: mart.signal_mart(t), MART_TOTALS + MART_MEANS)
    return found.query(MART_TOTALS + MART_MEANS, by=["region"],
                       where={"month": lambda m: m >= "199901"})


@register("metrics_mart_and_forecast", "M1 D1", sql("mart1 forecast", """
 SELECT * FROM (WITH m AS (SELECT region, CAST(sum(CAST(total_sales AS DECIMAL(28,6))) AS DOUBLE) AS total_sales
   FROM mart1 GROUP BY 1),
 f AS (SELECT series AS region, CAST(sum(CAST(forecast AS DECIMAL(28,6))) AS DOUBLE)
   AS next_forecast FROM forecast GROUP BY 1)
 SELECT coalesce(m.region, f.region) AS region, total_sales, next_forecast, next_forecast
   / (SELECT sum(CAST(next_forecast AS DECIMAL(28,4)))::DOUBLE FROM f) AS forecast_share
 FROM m FULL JOIN f ON m.region = f.region)"""))
def metrics_mart_and_forecast(t):
    """Past sales of the mart beside the forecast and its share."""
    sales = cut_lineage(mart.base_mart(t, ["ym", "region", "total_sales"]))  # for both
    through = fc.complete_through(t.orders, "o_orderdate")
    found = shop_catalogue(t, lambda: sales, ["total_sales"],
                           lambda: fc.forecast(fc.training_frame(sales, through=through)))
    return found.query(["total_sales", "outlook", "share of the outlook"], by=["region"])
