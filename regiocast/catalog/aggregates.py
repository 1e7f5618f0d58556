"""Aggregations, pivots and set operations."""

from pyspark.sql import functions as F

from regiocast.catalog.oracle import rounded, sql
from regiocast.catalog.registry import register
from regiocast.functions.dates import month_no, ym_of_no
from regiocast.functions.exact import hundredths, round_half_up, units_to_double
from regiocast.operators.reshape import append, pivot_max
from regiocast.operators.windows import day_and_id, first_per_key
from regiocast.plans import mart, staging


@register("grouped_sums", "G1 G2", """
 SELECT l_returnflag, l_linestatus, count(*) AS n,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))))
   AS DOUBLE) AS net FROM lineitem GROUP BY 1, 2""")
def grouped_sums(t):
    """Six groups over all lines: added per group and month first, then in wide decimals, so a
    huge group can neither overflow nor sit in one task."""
    per_month = t.lineitem.groupBy("l_returnflag", "l_linestatus",
                                   month_no("l_shipdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(hundredths("l_quantity")).alias("qty"),
        F.sum(hundredths("l_extendedprice")).alias("price"),
        F.sum(hundredths("l_extendedprice") * (100 - hundredths("l_discount"))).alias("net"))
    return per_month.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("n").alias("n"),
        units_to_double(F.sum(F.col("qty").cast("decimal(20,0)")), 2).alias("qty"),
        units_to_double(F.sum(F.col("price").cast("decimal(20,0)")), 2).alias("price"),
        units_to_double(F.sum(F.col("net").cast("decimal(20,0)")), 4).alias("net"))


@register("month_key_groups", "G4 S1", """
 SELECT strftime(l_shipdate,'%Y%m') AS ym, count(*) AS lines,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price
 FROM lineitem GROUP BY 1""")
def month_key_groups(t):
    g = t.lineitem.groupBy(month_no("l_shipdate").alias("m")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(hundredths("l_extendedprice")).alias("price"))
    return g.select(ym_of_no("m").alias("ym"), "lines",
                    (units_to_double("price", 2) / F.col("lines")).alias("avg_price"))


@register("coverage_profile", "G5", sql("mart1", """
 SELECT region, min(ym) AS start_ym, max(ym) AS end_ym, count(*) AS months
 FROM mart1 GROUP BY 1"""))
def coverage_profile(t):
    return mart.base_mart(t).groupBy("region").agg(
        F.min("ym").alias("start_ym"), F.max("ym").alias("end_ym"),
        F.count(F.lit(1)).alias("months"))


@register("non_null_counts", "G6", sql("mart3", """
 SELECT count(*) AS total_rows, count(rental_count) AS has_rental,
  count(rental_signal) AS has_signal, count(avg_closure_months) AS has_closure FROM mart3"""))
def non_null_counts(t):
    return mart.signal_mart(t).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count("rental_count").alias("has_rental"),
        F.count("rental_signal").alias("has_signal"),
        F.count("avg_closure_months").alias("has_closure"))


@register("rounded_averages", "G7 B3", sql("mart3", f"""
 SELECT region, count(*) AS months,
  {rounded("CAST(sum(CAST(rental_signal AS DECIMAL(24,6))) AS DOUBLE) / count(*)", 2)}
   AS avg_signal,
  {rounded("sum(rental_count)::DOUBLE / count(rental_count)", 1)} AS avg_rental
 FROM mart3 WHERE ym >= '199901' GROUP BY 1"""))
def rounded_averages(t):
    recent = mart.signal_mart(t).filter(F.col("ym") >= "199901")
    signal = F.sum(F.col("rental_signal").cast("decimal(24,6)")).cast("double")
    return recent.groupBy("region").agg(
        F.count(F.lit(1)).alias("months"),
        round_half_up(signal / F.count(F.lit(1)), 2).alias("avg_signal"),
        round_half_up(F.sum("rental_count").cast("double") / F.count("rental_count"), 1)
        .alias("avg_rental"))


@register("metric_pivot", "G8 G9", """
 SELECT event_type AS series, max(value) FILTER (WHERE day <= 10) AS early,
  max(value) FILTER (WHERE day BETWEEN 11 AND 20) AS middle,
  max(value) FILTER (WHERE day > 20) AS late
 FROM (SELECT event_type, value, day(ts) AS day FROM events) GROUP BY 1""")
def metric_pivot(t):
    """Long metric rows to one wide row per series, labels matched without case."""
    day = F.dayofmonth("ts")
    long = t.events.select(
        F.col("event_type").alias("series"), "value",
        F.when(day <= 10, "Early").when(day <= 20, "MIDDLE").otherwise("late").alias("metric"))
    return pivot_max(long, ["series"], "metric", "value",
                     {"early": "early", "middle": "middle", "late": "late"})


@register("distinct_keys", "G10", """
 SELECT DISTINCT strftime(o_orderdate,'%Y%m') AS ym, o_orderstatus FROM orders""")
def distinct_keys(t):
    return t.orders.select(month_no("o_orderdate").alias("m"), "o_orderstatus").distinct().select(
        ym_of_no("m").alias("ym"), "o_orderstatus")


@register("distinct_count_kpi", "G11 D9", """
 SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderdate) AS days,
  count(*) AS orders FROM orders""")
def distinct_count_kpi(t):
    """Exact distinct counts as group-by then count; no set is ever held in one task."""
    customers = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    days = t.orders.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n"))
    return customers.agg(F.count(F.lit(1)).alias("customers"), F.sum("n").alias("orders")).select(
        "customers", days.agg(F.count(F.lit(1))).scalar().alias("days"), "orders")


@register("structs_to_json", "G12 S13", """
 SELECT r_name, '[' || string_agg('{"nation":"' || n_name || '","customers":' || n || '}', ','
  ORDER BY n_name) || ']' AS nations FROM (
  SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2) GROUP BY 1""")
def structs_to_json(t):
    """Array of objects per group in a fixed order; the collected rows are already one per
    nation, so the array is as long as the dimension."""
    per_nation = (t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
                  .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                  .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    item = F.struct(F.col("n_name").alias("nation"), "customers")
    return per_nation.groupBy("r_name").agg(
        F.to_json(F.sort_array(F.collect_list(item))).alias("nations"))


@register("share_of_average", "G13 E6 E7", sql("act_orders", """
 SELECT region, avg_in, avg_in / CAST(sum(CAST(avg_in AS DECIMAL(28,4))) OVER () AS DOUBLE)
  AS share, rank() OVER (ORDER BY avg_in DESC NULLS LAST) AS rnk
 FROM (SELECT region, CAST(sum(move_in) AS DOUBLE) / count(*) AS avg_in FROM act_orders
  GROUP BY 1)"""))
def share_of_average(t):
    from regiocast.operators.windows import global_rank, share_of_total
    avg = (staging.customer_activity(t, with_lines=False).groupBy("region")
           .agg((F.sum("move_in").cast("double") / F.count(F.lit(1))).alias("avg_in")))
    return global_rank(share_of_total(avg, "avg_in", "share"), "rnk", "avg_in")


@register("mean_ratio_error", "G14", sql("act_orders", """
 SELECT region, count(prev) AS pairs,
  CAST(sum(CAST(abs(move_in - prev) / nullif(move_in, 0)::DOUBLE AS DECIMAL(18,9))) AS DOUBLE)
   / count(prev) AS mape FROM (SELECT region, move_in,
   lag(move_in) OVER (PARTITION BY region ORDER BY ym) AS prev FROM act_orders) GROUP BY 1"""))
def mean_ratio_error(t):
    """Mean absolute ratio error of the naive last-value forecast."""
    from pyspark.sql import Window
    w = Window.partitionBy("region").orderBy("ym")
    a = staging.customer_activity(t, with_lines=False).withColumn("prev",
                                                                  F.lag("move_in").over(w))
    error = F.when(F.col("move_in") != 0, F.abs(F.col("move_in") - F.col("prev")).cast("double")
                   / F.col("move_in").cast("double")).cast("decimal(18,9)")
    return a.groupBy("region").agg(
        F.count("prev").alias("pairs"),
        (F.sum(error).cast("double") / F.count("prev")).alias("mape"))


@register("row_count_report", "G15 Q1 U2", """
 SELECT 'orders' AS name, count(*) AS n, count(*) > 0 AS ok FROM orders
 UNION ALL SELECT 'lineitem', count(*), count(*) > 0 FROM lineitem
 UNION ALL SELECT 'customer', count(*), count(*) > 0 FROM customer
 UNION ALL SELECT 'part', count(*), count(*) > 0 FROM part
 UNION ALL SELECT 'supplier', count(*), count(*) > 0 FROM supplier
 UNION ALL SELECT 'events', count(*), count(*) > 0 FROM events
 UNION ALL SELECT 'documents', count(*), count(*) > 0 FROM documents""")
def row_count_report(t):
    """Counts come from footers; one row per table with a non-empty gate."""
    names = ["orders", "lineitem", "customer", "part", "supplier", "events", "documents"]
    return append([
        t.read(n).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(n).alias("name"), "n", (F.col("n") > 0).alias("ok")) for n in names])


@register("first_row_per_group", "G16", """
 SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  min(o_orderdate)::DATE AS day FROM orders GROUP BY 1""")
def first_row_per_group(t):
    o = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return first_per_key(o, ["o_custkey"], day_and_id("day", "o_orderkey"))


@register("null_padded_union", "U1", sql("act_orders sup_activity", """
 SELECT ym, region, move_in, CAST(NULL AS BIGINT) AS move_out FROM act_orders UNION ALL
 SELECT ym, region, NULL, move_out FROM sup_activity WHERE active_stores > 0"""))
def null_padded_union(t):
    inflow = staging.customer_activity(t, with_lines=False).select("ym", "region", "move_in")
    outflow = (staging.supplier_activity(t).filter(F.col("active_stores") > 0)
               .select("ym", "region", "move_out"))
    return append([inflow, outflow])
