"""Window functions, ranking and top-k."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from regiocast.catalog.oracle import sql
from regiocast.catalog.registry import register
from regiocast.functions.dates import month_no, ym_of_no
from regiocast.operators.spine import dense_months
from regiocast.operators.topk import top_k_per_group, top_k_with_fallback
from regiocast.operators.windows import (day_and_id, forward_fill, global_rank, global_row_number,
                                         latest_per_key, share_of_total)
from regiocast.plans import staging
from regiocast.plans.calendar import order_calendar


@register("lag_lead", "E1 E2", sql("act_orders", """
 SELECT ym, region, move_in, lag(move_in) OVER w AS prev_in, lead(move_in) OVER w AS next_in
 FROM act_orders WINDOW w AS (PARTITION BY region ORDER BY ym)"""))
def lag_lead(t):
    w = Window.partitionBy("region").orderBy("ym")
    return staging.customer_activity(t, with_lines=False).select(
        "ym", "region", "move_in", F.lag("move_in").over(w).alias("prev_in"),
        F.lead("move_in").over(w).alias("next_in"))


@register("month_index", "E4", """
 SELECT ym, row_number() OVER (ORDER BY ym) - 1 AS i FROM (
  SELECT DISTINCT strftime(o_orderdate,'%Y%m') AS ym FROM orders)""")
def month_index(t):
    """Numbering over distinct months only: bounded by the calendar, never by the facts."""
    months = t.orders.select(month_no("o_orderdate").alias("m")).distinct()
    return months.select(ym_of_no("m").alias("ym"),
                         (F.row_number().over(Window.orderBy("m")) - 1).cast("bigint").alias("i"))


@register("key_numbering", "E5", """
 SELECT c_name, row_number() OVER (ORDER BY c_name) AS rn FROM (
  SELECT DISTINCT c_name FROM customer)""")
def key_numbering(t):
    """Numbers keys in order without one global sort task."""
    return global_row_number(t.customer.select("c_name").distinct(), "rn", F.col("c_name").asc())


@register("global_ranking", "E6", """
 SELECT c_custkey, orders, rank() OVER (ORDER BY orders DESC NULLS LAST) AS rnk FROM (
  SELECT o_custkey AS c_custkey, count(*) AS orders FROM orders GROUP BY 1)""")
def global_ranking(t):
    """Heavily tied values: ranks are computed on the distinct values."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"))
    return global_rank(per_customer, "rnk", "orders")


@register("share_of_total", "E7", """
 SELECT c_custkey, value, value / CAST(sum(CAST(value AS DECIMAL(28,4))) OVER () AS DOUBLE)
  AS share FROM (SELECT o_custkey AS c_custkey,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1)""")
def share_of_all(t):
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return share_of_total(per_customer, "value", "share")


@register("latest_row_per_key", "E8", """
 SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1""")
def latest_row_per_key(t):
    """The status, one letter, travels as its code point, so that the aggregate hashes."""
    o = t.orders.select("o_custkey", "o_orderkey", F.ascii("o_orderstatus").alias("status"),
                        day_and_id("o_orderdate", "o_orderkey").alias("place"))
    return latest_per_key(o, ["o_custkey"], "place").select(
        "o_custkey", "o_orderkey", F.char("status").alias("o_orderstatus"))


@register("first_value_baseline", "E9 E10", sql("act_orders", """
 SELECT ym, region, move_in, first_value(move_in) OVER w AS baseline,
  move_in - first_value(move_in) OVER w AS vs_baseline, move_in - lag(move_in) OVER w AS step
 FROM act_orders WINDOW w AS (PARTITION BY region ORDER BY ym)"""))
def first_value_baseline(t):
    w = Window.partitionBy("region").orderBy("ym")
    a = staging.customer_activity(t, with_lines=False)
    return a.select("ym", "region", "move_in", F.first("move_in").over(w).alias("baseline"),
                    (F.col("move_in") - F.first("move_in").over(w)).alias("vs_baseline"),
                    (F.col("move_in") - F.lag("move_in").over(w)).alias("step"))


@register("forward_fill", "E11", sql("act_orders months", """
 SELECT ym, region, last_value(customers IGNORE NULLS) OVER (PARTITION BY region ORDER BY ym)
  AS customers FROM (SELECT m.ym, n_name AS region,
   CASE WHEN i % 3 = 0 THEN customers END AS customers
  FROM months m CROSS JOIN nation LEFT JOIN act_orders a ON a.ym = m.ym AND a.region = n_name)"""))
def filled_quarters(t):
    """Quarterly values carried to every month of the dense spine."""
    first = t.orders.agg(F.min(month_no("o_orderdate"))).scalar()
    regions = t.nation.select(F.col("n_name").alias("region")).distinct()
    spine = dense_months(regions, t.orders, "o_orderdate")
    a = staging.customer_activity(t, with_lines=False).select("ym", "region", "customers")
    quarterly = spine.join(a, ["ym", "region"], "left").withColumn(
        "customers", F.when((F.col("m") - first) % 3 == 0, F.col("customers")))
    return forward_fill(quarterly, ["region"], "ym", ["customers"]).select(
        "ym", "region", "customers")


@register("top_orders", "L1", """
 SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15""")
def top_orders(t):
    return (t.orders.select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(15))


@register("top_month", "L2", """
 SELECT strftime(o_orderdate,'%Y%m') AS ym, count(*) AS orders FROM orders GROUP BY 1
 ORDER BY orders DESC, ym LIMIT 1""")
def top_month(t):
    g = t.orders.groupBy(month_no("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("orders"))
    return g.orderBy(F.col("orders").desc(), "m").limit(1).select(ym_of_no("m").alias("ym"),
                                                                  "orders")


@register("top_customers_per_segment", "L3", """
 SELECT c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (
  PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) <= 5""")
def top_customers_per_segment(t):
    c = t.customer.select("c_mktsegment", "c_custkey", "c_acctbal")
    return top_k_per_group(c, ["c_mktsegment"], 5, F.col("c_acctbal").desc(), F.col("c_custkey"))


@register("top_k_with_fallback", "L4", """
 WITH c AS (SELECT CASE WHEN n_name = 'NATION_5' THEN 'ALL' ELSE n_name END AS scope, c_custkey,
   c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey),
 best AS (SELECT * FROM c QUALIFY row_number() OVER (
  PARTITION BY scope ORDER BY c_acctbal DESC, c_custkey) <= 3)
 SELECT n_name AS scope, scope AS source_scope, c_custkey, c_acctbal FROM nation JOIN best
  ON best.scope = CASE WHEN n_name IN (SELECT scope FROM best) THEN n_name ELSE 'ALL' END""")
def scoped_top_k(t):
    """Rows of one nation are filed under ALL; that nation then falls back to ALL."""
    c = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .select(F.when(F.col("n_name") == "NATION_5", "ALL").otherwise(F.col("n_name"))
                 .alias("scope"), "c_custkey", "c_acctbal"))
    scopes = t.nation.select(F.col("n_name").alias("scope"))
    return top_k_with_fallback(c, scopes, "scope", "ALL", 3, F.col("c_acctbal").desc(),
                               F.col("c_custkey"))


@register("holiday_neighbours", "X3 E2", sql("calendar", """
 SELECT ym, holiday_days, CASE WHEN lead(holiday_days) OVER (ORDER BY ym) >= 2 THEN 1 ELSE 0 END
  AS pre_holiday_flag, CASE WHEN lag(holiday_days) OVER (ORDER BY ym) >= 2 THEN 1 ELSE 0 END
  AS post_holiday_flag FROM calendar"""))
def holiday_neighbours(t):
    """Flags on the calendar itself; the window spans months only."""
    w = Window.orderBy("ym")
    c = order_calendar(t)
    return c.select("ym", "holiday_days",
                    F.when(F.lead("holiday_days").over(w) >= 2, 1).otherwise(0)
                    .alias("pre_holiday_flag"),
                    F.when(F.lag("holiday_days").over(w) >= 2, 1).otherwise(0)
                    .alias("post_holiday_flag"))
