"""Staging frames, calendar, indices and feature marts."""

from pyspark.sql import functions as F

from regiocast.catalog.oracle import sql
from regiocast.catalog.registry import register
from regiocast.functions.dates import calendar_month, month_no
from regiocast.operators.spine import dense_months
from regiocast.plans import calendar, indices, mart, staging


def _stage(name, covers, build, cte):
    register(name, covers, sql(cte, f"SELECT * FROM {cte}"))(build)


_stage("stage_population", "A1 C1 G1 G2", staging.stage_population, "population")
_stage("stage_card_sales", "A1 C1 G1", staging.stage_card_sales, "card_sales")
_stage("stage_assets", "C1 G3", staging.stage_assets, "assets")
register("stage_prices", "G3 G4 S1", sql("sup_activity", """
 SELECT ym, region, avg_sale_price, avg_price_per_unit, total_households FROM sup_activity
 WHERE active_stores > 0"""))(staging.stage_prices)
_stage("stage_movement", "X13 C8", staging.stage_movement, "movement")
_stage("stage_demographics", "X4 S12", staging.stage_demographics, "demographics")
_stage("stage_tourism", "X5 X6 C5 S10", mart.stage_tourism, "tourism")
_stage("stage_commercial", "C4", staging.stage_commercial, "commercial")
_stage("stage_telecom", "C4 X12", staging.stage_telecom, "telecom")
_stage("calendar_features", "A3 X2", calendar.order_calendar, "calendar")
_stage("base_mart", "X1 C2 B6 E1 E3", mart.base_mart, "mart1")
_stage("extended_mart", "X3 X8 X9 X10 C3 C4 B10 E2", mart.extended_mart, "mart2")
_stage("signal_mart", "X11 X12 B7 B10", mart.signal_mart, "mart3")


@register("seasonal_flow", "X5 S10", sql("months", """
 SELECT ym, n_name AS region, CAST(move_in AS BIGINT) AS move_in,
  CAST(move_out AS BIGINT) AS move_out, CAST(move_in - move_out AS BIGINT) AS net_move FROM (
  SELECT ym, n_name,
   (orders * [85,95,125,110,105,95,90,85,120,110,100,90][mm] * (100 + (yy - 1995) * 2) * 2 + 10000)
    // 20000 AS move_in,
   (customers * [85,95,125,110,105,95,90,85,120,110,100,90][mm] * (100 + (yy - 1995) * 2) * 2
    + 10000) // 20000 AS move_out
  FROM months CROSS JOIN (
   SELECT n_name, count(*) AS orders, count(DISTINCT c_custkey) AS customers
   FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
   GROUP BY 1))"""))
def seasonal_flow(t):
    """Base level x season x yearly growth per region and month, net of two rounded flows."""
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    base = (per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_nationkey")
            .agg(F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("customers"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("region"))
            .agg(F.sum("orders").alias("base_in"), F.sum("customers").alias("base_out")))
    year = F.substring("ym", 1, 4).cast("int")
    spine = dense_months(base, t.orders, "o_orderdate")
    return spine.select(
        "ym", "region",
        indices.seasonal_flow(F.col("base_in"), year, calendar_month("ym")).alias("move_in"),
        indices.seasonal_flow(F.col("base_out"), year, calendar_month("ym")).alias("move_out"),
    ).withColumn("net_move", F.col("move_in") - F.col("move_out"))


@register("cyclic_terms", "X7 S9", sql("act_orders months", """
 SELECT ym, region, i, CAST(round(CAST(sin(i * 0.5) AS DECIMAL(18,9)), 6) AS DOUBLE) AS sin_half,
  CAST(round(CAST(cos(i) AS DECIMAL(18,9)), 6) AS DOUBLE) AS cos_full,
  CASE WHEN i % 12 < 6 THEN 'growing' ELSE 'stagnant' END AS half_year,
  CASE WHEN i % 4 = 0 THEN 1 ELSE 0 END AS quarter_flag, abs(move_in - customers) AS repeat_orders
 FROM (SELECT CAST(i AS INTEGER) AS i, ym FROM months) JOIN act_orders USING (ym)"""))
def cyclic_terms(t):
    """Sine and cosine of the month index, half-year and four-month flags."""
    first = t.orders.agg(F.min(month_no("o_orderdate"))).scalar()
    a = staging.customer_activity(t, with_lines=False).withColumn("i", F.col("m") - first)

    def rounded(c):
        return F.round(c.cast("decimal(18,9)"), 6).cast("double")

    return a.select(
        "ym", "region", "i", rounded(F.sin(F.col("i") * 0.5)).alias("sin_half"),
        rounded(F.cos(F.col("i").cast("double"))).alias("cos_full"),
        F.when(F.col("i") % 12 < 6, "growing").otherwise("stagnant").alias("half_year"),
        F.when(F.col("i") % 4 == 0, 1).otherwise(0).alias("quarter_flag"),
        F.abs(F.col("move_in") - F.col("customers")).alias("repeat_orders"))


@register("age_band_shares", "X4", sql("demographics", """
 SELECT ym, region, age_20_39_share * 100 AS young_pct, family_30_49_share * 100 AS family_pct,
  senior_60p_share * 100 AS senior_pct, male_ratio FROM demographics"""))
def age_band_shares(t):
    """Shares on the percent scale, converted once."""
    d = staging.stage_demographics(t)
    return d.select("ym", "region", (F.col("age_20_39_share") * 100).alias("young_pct"),
                    (F.col("family_30_49_share") * 100).alias("family_pct"),
                    (F.col("senior_60p_share") * 100).alias("senior_pct"), "male_ratio")


@register("strict_month_change", "E3", sql("card_sales", """
 SELECT c.ym, c.region, c.total_sales,
  CASE WHEN p.total_sales > 0 THEN (c.total_sales - p.total_sales) / p.total_sales * 100 END
   AS total_sales_strict_chg_pct
 FROM card_sales c LEFT JOIN card_sales p ON c.region = p.region AND p.ym = strftime(
  strptime(c.ym || '01', '%Y%m%d') - INTERVAL 1 MONTH, '%Y%m')"""))
def strict_month_change(t):
    """Change against the calendar month before, NULL across a gap."""
    return mart.add_strict_changes(
        staging.stage_totals(t).select("ym", "region", "total_sales"), "total_sales")
