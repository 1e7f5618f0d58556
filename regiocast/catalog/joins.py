"""Joins: existence, coverage, last known slice, full outer."""

from pyspark.sql import functions as F

from regiocast.catalog.oracle import sql
from regiocast.catalog.registry import register
from regiocast.functions.dates import month_no
from regiocast.operators.reshape import overlay
from regiocast.operators.spine import dense_months
from regiocast.operators.windows import latest_per_key
from regiocast.plans import mart, staging
from regiocast.plans.calendar import order_calendar
from regiocast.session import cut_lineage


@register("dimension_join", "C1", """
 SELECT r_name, n_name, count(*) AS customers,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 GROUP BY ALL""")
def dimension_join(t):
    """Aggregate by the foreign key first, then look up the names."""
    return (t.customer.groupBy("c_nationkey")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("r_name", "n_name", "customers", "balance"))


@register("spine_left_join", "C2", sql("population card_sales assets sup_activity", """
 SELECT ym, region, total_pop, total_sales, customers, avg_asset, avg_sale_price
 FROM population LEFT JOIN card_sales USING (ym, region) LEFT JOIN assets USING (ym, region)
 LEFT JOIN sup_activity USING (ym, region)"""))
def spine_left_join(t):
    """Population spine, each source joined by its unique key; all four come from one pass over
    the line items and one over the orders, written once as (month, region) rows."""
    facts = cut_lineage(staging.line_facts(t.lineitem, t.part))
    customers = cut_lineage(staging.customer_activity(
        t, months=staging.customer_months(t, lines=staging.facts_by_order(facts))))
    suppliers = staging.supplier_activity(t, staging.facts_by_supplier(facts))
    with_lines = customers.filter(F.col("total_tx_count").isNotNull())
    key = mart.KEY
    return mart.left_join_all(
        with_lines.select(*key, "total_pop"),
        [(with_lines.select(*key, "total_sales"), key),
         (customers.select(*key, "customers", "avg_asset"), key),
         (suppliers.filter(F.col("active_stores") > 0).select(*key, "avg_sale_price"), key)])


@register("calendar_join", "C3", sql("act_orders calendar", """
 SELECT ym, region, move_in, holiday_days, business_days
 FROM act_orders LEFT JOIN calendar USING (ym)"""))
def calendar_join(t):
    a = staging.customer_activity(t, with_lines=False)
    return mart.left_join_all(a, [(order_calendar(t), ["ym"])]).select(
        "ym", "region", "move_in", "holiday_days", "business_days")


@register("dense_spine", "C5", sql("act_orders months", """
 SELECT m.ym, n_name AS region, coalesce(move_in, 0) AS move_in
 FROM months m CROSS JOIN nation LEFT JOIN act_orders a ON a.ym = m.ym AND a.region = n_name"""))
def dense_spine(t):
    """Every region in every month, absent cells filled with 0."""
    regions = t.nation.select(F.col("n_name").alias("region")).distinct()
    spine = dense_months(regions, t.orders, "o_orderdate").drop("m")
    a = staging.customer_activity(t, with_lines=False).select("ym", "region", "move_in")
    return spine.join(a, ["ym", "region"], "left").select(
        "ym", "region", F.coalesce("move_in", F.lit(0).cast("bigint")).alias("move_in"))


@register("last_known_slice", "C6", sql("act_orders months", """
 SELECT m.ym, n_name AS region, l.customers AS last_customers FROM months m
 CROSS JOIN (SELECT DISTINCT n_name FROM nation)
 LEFT JOIN (SELECT region, arg_max(customers, ym) AS customers FROM act_orders GROUP BY 1) l
  ON l.region = n_name
 WHERE m.i >= (SELECT max(i) FROM months) - 7"""))
def last_known_slice(t):
    """Latest values per region attached to the last eight months of the spine; a region without
    facts keeps its rows."""
    a = staging.customer_activity(t, with_lines=False)
    last = latest_per_key(a.select("region", "ym", "customers"), ["region"], "ym").select(
        "region", F.col("customers").alias("last_customers"))
    regions = t.nation.select(F.col("n_name").alias("region")).distinct()
    spine = dense_months(regions, t.orders, "o_orderdate")
    newest = t.orders.agg(F.date_format(F.add_months(F.max("o_orderdate"), -7), "yyyyMM")).scalar()
    return spine.filter(F.col("ym") >= newest).join(last, "region", "left").select("ym", "region", "last_customers")


@register("overlay_full_outer", "C8 F13 G9", sql("act_orders sup_activity", """
 SELECT coalesce(a.ym, s.ym) AS ym, a.v AS "in", s.v AS out FROM
 (SELECT ym, CAST(sum(move_in) AS BIGINT) AS v FROM act_orders GROUP BY 1) a FULL JOIN
 (SELECT ym, CAST(sum(move_out) AS BIGINT) AS v FROM sup_activity GROUP BY 1) s ON a.ym = s.ym"""))
def overlay_full_outer(t):
    """Two monthly totals side by side; months known to one side only are kept."""
    inflow = (staging.customer_activity(t, with_lines=False).groupBy("ym")
              .agg(F.sum("move_in").cast("bigint").alias("in")))
    outflow = (staging.supplier_activity(t).groupBy("ym")
               .agg(F.sum("move_out").cast("bigint").alias("out")))
    return inflow.join(outflow, "ym", "full_outer")


@register("customers_with_urgent_orders", "C9", """
 SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def customers_with_urgent_orders(t):
    keys = (t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
            .select(F.col("o_custkey").alias("c_custkey")).distinct())
    return t.customer.select("c_custkey", "c_mktsegment").join(keys, "c_custkey", "left_semi")


@register("orders_without_lines", "C9 C10", """
 SELECT o_orderkey, o_orderdate::DATE AS day FROM orders
 WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_lines(t):
    keys = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")).join(
        keys, "o_orderkey", "left_anti")


@register("rolling_cutoffs", "C11", sql("act_orders", """
 SELECT region, CAST(k AS INTEGER) AS fold, count(*) AS months,
  CAST(sum(move_in) AS BIGINT) AS seen FROM act_orders, (SELECT max(ym) AS hi FROM act_orders), generate_series(1, 6) g(k)
 WHERE ym <= strftime(strptime(hi || '01','%Y%m%d') - to_months(CAST(k AS INTEGER)),'%Y%m')
 GROUP BY 1, 2"""))
def rolling_cutoffs(t):
    """History known at each of six cutoffs: every row names the folds it belongs to, so the
    inequality join becomes a generator and an aggregation."""
    hi = t.orders.agg(F.max(month_no("o_orderdate"))).scalar()
    a = staging.customer_activity(t, with_lines=False)
    known = a.withColumn("age", hi - F.col("m")).filter(F.col("age") >= 1)
    folds = F.sequence(F.lit(1), F.least(F.lit(6), F.col("age")))
    return (known.select("region", "move_in", F.explode(folds).alias("fold"))
            .groupBy("region", "fold")
            .agg(F.count(F.lit(1)).alias("months"), F.sum("move_in").alias("seen")))
