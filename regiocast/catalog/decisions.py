"""Shares, budgets, scenarios, alerts, context records, metrics and verified questions."""

from pyspark.sql import functions as F

from regiocast.catalog.forecasts import training
from regiocast.catalog.oracle import rounded, sql
from regiocast.catalog.registry import register
from regiocast.plans import decide, exog, forecast as fc, mart, semantic
from regiocast.session import cut_lineage

BUDGET = 50000000.0


def complete(t):
    return fc.complete_through(t.orders, "o_orderdate")


def result(t):
    return fc.forecast(training(t))


@register("next_month_share", "D1 B2", sql("next_month", """
 SELECT series, ts, forecast, lower_bound, upper_bound, share, share_pct FROM next_month"""))
def next_month_share(t):
    return decide.next_month_share(result(t))


@register("horizon_share", "D1 G13 E6 T2", sql("mean_share", """
 SELECT region, forecast, share, rank() OVER (ORDER BY forecast DESC NULLS LAST)
  AS priority_rank FROM mean_share"""))
def horizon_share(t):
    return decide.horizon_share(result(t))


@register("budget_split", "D2", sql("split", "SELECT * FROM split"))
def budget_split(t):
    return decide.budget_split(result(t), BUDGET)


@register("budget_split_json", "D2 A13 S13", sql("split", """
 SELECT region, '{"total_budget":50000000,"region":"' || region || '","share_pct":'
  || CAST(share_pct AS DECIMAL(6,1)) || ',"budget":' || CAST(budget AS BIGINT) || '}' AS payload
 FROM split"""))
def budget_split_json(t):
    return decide.split_json(decide.budget_split(result(t), BUDGET), BUDGET)


@register("channel_split", "D3 E8", sql("newest1", """
 SELECT region, ym, move_in, total_sales, net_move, sales_per_pop, avg_asset, channel,
  CAST(round(CAST(50000000 AS DECIMAL(20,2)) * pct / 100, 0) AS BIGINT) AS budget
 FROM newest1, (VALUES ('digital_capture',25), ('partner_referrals',20), ('b2b_outreach',15),
  ('experiential_offer',15), ('installation_buffer',15), ('test_reserve',10)) c(channel, pct)"""))
def channel_split(t):
    return decide.channel_split(mart.base_mart(t), BUDGET)


def scenarios(t):
    """Two plans over all regions: an even one and one graded by the region code."""
    regions = t.nation.select(F.col("n_name").alias("region"), "n_nationkey")
    return regions.select("region", F.inline(F.array(
        F.struct(F.lit("even").alias("scenario"), F.lit(4.0).alias("pct")),
        F.struct(F.lit("graded").alias("scenario"),
                 (F.col("n_nationkey") % 3 * 2 + 2).cast("double").alias("pct")))))


@register("scenario_projection", "D4", sql("mean_forecast", f"""
 SELECT scenario, region, pct, forecast AS forecast_demand,
  {rounded("pct / 100 * 50000000", 0)} AS budget,
  {rounded("forecast * (pct / 100) * 0.001::DOUBLE", 0)} AS expected_contracts
 FROM (SELECT n_name AS region, unnest(['even','graded']) AS scenario,
   unnest([4.0::DOUBLE, (n_nationkey % 3 * 2 + 2)::DOUBLE]) AS pct FROM nation)
 LEFT JOIN mean_forecast USING (region)"""))
def scenario_projection(t):
    return decide.scenario_projection(scenarios(t), result(t), BUDGET)


@register("plan_comparison", "D5", sql("next_month", """
 SELECT region, plan_pct, user_pct, plan_pct / 100 * 50000000 AS plan_budget,
  user_pct / 100 * 50000000 AS user_budget, user_pct - plan_pct AS deviation,
  CASE WHEN abs(user_pct - plan_pct) > 15 THEN
   CASE WHEN user_pct < plan_pct THEN 'under' ELSE 'over' END ELSE 'ok' END AS flag
 FROM (SELECT n_name AS region, coalesce(share_pct,
   round(100.0 / (SELECT count(*) FROM nation), 1))::DOUBLE AS plan_pct,
   (n_nationkey % 3 * 10)::DOUBLE AS user_pct FROM nation LEFT JOIN next_month
   ON series = n_name)"""))
def plan_comparison(t):
    regions = t.nation.select(F.col("n_name").alias("region"), "n_nationkey")
    user = regions.select("region", (F.col("n_nationkey") % 3 * 10).cast("double").alias("pct"))
    plan = decide.next_month_share(result(t)).select(F.col("series").alias("region"),
                                                     F.col("share_pct").alias("pct"))
    return decide.compare_plan(regions.select("region"), plan, user, BUDGET)


@register("region_insights", "D6", sql("newest3", """
 SELECT region, CAST(len(hits) AS INTEGER) AS signals, region || ': ' || CASE WHEN len(hits) = 0
  THEN 'steady overall' ELSE array_to_string(hits, ' | ') END AS insight
 FROM (SELECT region, list_filter([
   CASE WHEN net_move > 0 THEN 'inflow lead' END, CASE WHEN net_move < 0 THEN 'outflow lead' END,
   CASE WHEN sales_chg_pct > 3 THEN 'sales rising' END,
   CASE WHEN sales_chg_pct < -3 THEN 'sales falling' END,
   CASE WHEN tourism_demand_idx > 120 THEN 'tourism strong' END,
   CASE WHEN stability_score < 50 THEN 'stores unstable' END,
   CASE WHEN stability_score > 80 THEN 'stores stable' END], lambda x: x IS NOT NULL) AS hits
  FROM newest3)"""))
def region_insights(t):
    return decide.insights(decide.latest_snapshot(
        mart.signal_mart(t),
        ["net_move", "sales_chg_pct", "tourism_demand_idx", "stability_score"]))


@register("context_records", "D7 S15")
def context_records(t):
    """Grounding JSON of every region: allocation, snapshot, top features, four groups.

    All three parts come from one mart, written once.
    """
    ready = cut_lineage(mart.signal_mart(t))
    return decide.context_json(
        decide.next_month_share(fc.forecast(fc.training_frame(ready, through=complete(t)))),
        decide.latest_snapshot(ready),
        exog.feature_importance(exog.panel(ready, through=complete(t))))


@register("latest_snapshot", "D8 E8 B13", sql("newest3", """
 SELECT region, ym, move_in, move_out, net_move, total_pop, total_sales, avg_asset,
  avg_sale_price, age_20_39_share, senior_60p_share, tourism_demand_idx, foreign_visitor_idx,
  stability_score, net_store_change, holiday_days, rental_count, rental_conversion_rate,
  cs_calls, rental_signal FROM newest3"""))
def latest_snapshot(t):
    return decide.latest_snapshot(mart.signal_mart(t))


@register("snapshot_kpis", "D9 G11", sql("newest1", """
 SELECT count(region) AS regions, max(ym) AS latest_ym, CAST(sum(net_move) AS BIGINT)
  AS net_move, CAST(sum(CAST(total_sales AS DECIMAL(28,4))) AS DOUBLE) AS total_sales
 FROM newest1"""))
def snapshot_kpis(t):
    return decide.snapshot_kpis(decide.latest_snapshot(mart.base_mart(t)))


@register("metric_query", "M1", sql("mart3", """
 SELECT region, CAST(sum(CAST(total_sales AS DECIMAL(28,4))) AS DOUBLE) AS total_sales,
  CAST(sum(CAST(total_sales AS DECIMAL(28,4))) AS DOUBLE)
   / CAST(sum(CAST(total_pop AS DECIMAL(28,4))) AS DOUBLE) AS sales_per_pop,
  CAST(sum(net_move) AS BIGINT) AS net_move,
  CAST(sum(CAST(avg_income AS DECIMAL(28,6))) AS DOUBLE) / count(avg_income) AS avg_income,
  sum(rental_count)::DOUBLE / sum(move_in)::DOUBLE AS conversion_rate
 FROM mart3 WHERE ym >= '199901' GROUP BY 1"""))
def metric_query(t):
    """Metrics named by synonym, grouped by region under a month filter."""
    return semantic.run_metrics(
        {"mart": mart.signal_mart(t)},
        ["revenue", "spending per head", "migration", "income", "conversion"],
        by=["region"], where=F.col("ym") >= "199901")


@register("top_region_next_month", "V1 L2", sql("next_month", f"""
 SELECT series AS region, {rounded("forecast / 10000", 1)} AS forecast_10k,
  {rounded("share_pct", 1)} AS share_pct FROM next_month
 ORDER BY forecast DESC NULLS LAST, series LIMIT 1"""))
def top_region_next_month(t):
    return semantic.top_region(result(t))


@register("share_of_all_regions", "V2", sql("next_month", f"""
 SELECT series AS region, {rounded("forecast / 10000", 1)} AS forecast_10k,
  {rounded("share_pct", 1)} AS share_pct FROM next_month"""))
def share_of_all_regions(t):
    return semantic.share_all(result(t))


@register("why_one_region_leads", "V3 B1 B5", sql("current2", f"""
 SELECT region, {rounded("total_sales / 10000", 1)} AS sales_10k, total_pop,
  {rounded("sales_per_pop", 0)} AS sales_per_pop, visit_pop,
  {rounded("tourism_demand_idx", 1)} AS tourism_demand_idx
 FROM current2 WHERE region IN ('NATION_5','NATION_8','NATION_13')"""))
def why_one_region_leads(t):
    used = ["ym", "region", "total_sales", "total_pop", "sales_per_pop", "visit_pop",
            "tourism_demand_idx"]
    return semantic.why_higher(mart.extended_mart(t, used), ["NATION_5", "NATION_8", "NATION_13"],
                               complete(t))


@register("sales_per_business_day", "V4 B6", sql("current2", f"""
 SELECT region, {rounded("total_sales / 10000", 1)} AS sales_10k, holiday_days, business_days,
  {rounded("total_sales / nullif(business_days, 0) / 10000", 2)} AS daily_sales_10k
 FROM current2"""))
def sales_per_business_day(t):
    used = ["ym", "region", "total_sales", "holiday_days", "business_days"]
    return semantic.sales_per_business_day(mart.extended_mart(t, used), complete(t))


@register("sales_trend", "V6 B4", sql("mart1", f"""
 SELECT ym, region, {rounded("total_sales / 10000", 1)} AS sales_10k,
  {rounded("sales_chg_pct", 1)} AS change_pct FROM mart1
 WHERE ym > (SELECT strftime(strptime(max(ym) || '01','%Y%m%d') - INTERVAL 3 MONTH,'%Y%m')
  FROM mart1)"""))
def sales_trend(t):
    return semantic.sales_trend(mart.base_mart(t, ["ym", "region", "total_sales", "sales_chg_pct"]))


@register("net_migration", "V7 B8", sql("mart1 complete", """
 SELECT region, net_move, move_in, move_out,
  CASE WHEN net_move > 0 THEN 'inflow lead' ELSE 'outflow lead' END AS verdict
 FROM mart1 WHERE ym = (SELECT max(ym) FROM mart1 WHERE ym <= (SELECT ym FROM complete))"""))
def net_migration(t):
    return semantic.net_migration(mart.base_mart(t), complete(t))


@register("price_comparison", "V8 B11", sql("mart1 complete", f"""
 SELECT region, {rounded("avg_price_per_unit", 0)} AS price_per_unit,
  {rounded("avg_sale_price", 1)} AS sale_price,
  {rounded("price_to_asset_ratio", 2)} AS price_to_asset
 FROM mart1 WHERE ym = (SELECT max(ym) FROM mart1 WHERE ym <= (SELECT ym FROM complete))"""))
def price_comparison(t):
    return semantic.price_comparison(mart.base_mart(t), complete(t))


@register("youth_and_sales", "V9", sql("current2", f"""
 SELECT region, {rounded("age_20_39_share * 100", 1)} AS young_pct,
  {rounded("total_sales / 10000", 1)} AS sales_10k,
  {rounded("economy_sales / 10000", 2)} AS economy_10k FROM current2"""))
def youth_and_sales(t):
    return semantic.youth_and_sales(mart.extended_mart(t), complete(t))


@register("region_interval", "V10 F15", sql("forecast", f"""
 SELECT series AS region, ts, {rounded("forecast / 10000", 1)} AS forecast_10k,
  {rounded("lower_bound / 10000", 1)} AS lower_bound_10k,
  {rounded("upper_bound / 10000", 1)} AS upper_bound_10k,
  {rounded("(upper_bound - lower_bound) / nullif(forecast, 0) * 100", 1)} AS width_pct
 FROM forecast WHERE series IN ('NATION_1','NATION_2')"""))
def region_interval(t):
    return semantic.region_interval(result(t), ["NATION_1", "NATION_2"])
