"""Sources, sinks, projections, filters and scalar functions."""

from pyspark.sql import functions as F

from regiocast.catalog.oracle import rounded, sql
from regiocast.catalog.registry import register
from regiocast.functions import text
from regiocast.functions.dates import first_day, month_no, shift_ym, ym_of, ym_of_no
from regiocast.functions.exact import hundredths, round_half_up, units_to_double
from regiocast.operators.reshape import append
from regiocast.operators.spine import horizon
from regiocast.operators.windows import latest_per_key
from regiocast.plans import fixed, mart, staging
from regiocast.session import scratch_path
from regiocast.sources.sinks import as_json, replace_table, write_json
from regiocast.sources.tables import empty_like, first_usable, present, with_standard_names


def monthly_orders(t):
    """Orders and value per month: the small relation several queries start from."""
    return (t.orders.groupBy(month_no("o_orderdate").alias("m"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 units_to_double(F.sum(hundredths("o_totalprice")), 2).alias("value"))
            .select(ym_of_no("m").alias("ym"), "orders", "value"))


MONTHLY = """SELECT strftime(o_orderdate,'%Y%m') AS ym, count(*) AS orders,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1"""


@register("table_scan", "A1", """
 SELECT o_orderstatus, count(*) AS n, min(o_orderdate)::DATE AS first_day,
  max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1""")
def table_scan(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").cast("date").alias("first_day"),
        F.max("o_orderdate").cast("date").alias("last_day"))


@register("materialised_table", "A2 A14", f"SELECT * FROM ({MONTHLY})")
def materialised_table(t):
    return replace_table(monthly_orders(t), scratch_path(t.spark, "monthly"))


@register("literal_dimension", "A4 S10", f"""
 SELECT ym, orders, s.season, orders * 100.0::DOUBLE / s.season AS adjusted FROM ({MONTHLY}) m
 JOIN (VALUES (1,85),(2,95),(3,125),(4,110),(5,105),(6,95),(7,90),(8,85),(9,120),(10,110),
  (11,100),(12,90)) s(mm, season) ON CAST(substr(ym, 5, 2) AS INTEGER) = s.mm""")
def literal_dimension(t):
    """Twelve literal rows (fixed size, hence broadcast) joined to the months."""
    seasons = t.spark.createDataFrame(
        list(enumerate(fixed.SEASON_MOVING, start=1)), "mm int, season int")
    months = monthly_orders(t).withColumn("mm", F.substring("ym", 5, 2).cast("int"))
    return months.join(F.broadcast(seasons), "mm").select(
        "ym", "orders", "season", (F.col("orders") * 100.0 / F.col("season")).alias("adjusted"))


@register("horizon_rows", "A5 C7 S3", """
 SELECT n_name AS region, last_ds, CAST(h AS INTEGER) AS step,
  (last_ds + to_months(CAST(h AS INTEGER)))::DATE AS ds
 FROM (SELECT n_name, max(date_trunc('month', o_orderdate))::DATE AS last_ds FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
  generate_series(1, 3) g(h)""")
def horizon_rows(t):
    last = (t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_nationkey").agg(F.max("last").alias("last"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("region"))
            .agg(F.trunc(F.max("last").cast("date"), "month").alias("last_ds")))
    return horizon(last, "last_ds", fixed.HORIZON)


@register("empty_typed_union", "A6", """
 SELECT o_orderpriority AS series, count(*) AS n, CAST(NULL AS DOUBLE) AS score
 FROM orders GROUP BY 1""")
def empty_typed_union(t):
    """A typed table without rows keeps the shape when real rows are appended."""
    empty = empty_like(t.spark, "series string, n bigint, score double")
    rows = t.orders.groupBy(F.col("o_orderpriority").alias("series")).agg(
        F.count(F.lit(1)).alias("n"))
    return append([empty, rows])


@register("appended_results", "A7", """
 SELECT 'status' AS model_name, o_orderstatus AS series, count(*) AS n FROM orders GROUP BY 2
 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2
 UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM orders
  JOIN customer ON o_custkey = c_custkey GROUP BY 2""")
def appended_results(t):
    """Results of several models appended under one declared schema, from one scan."""
    per_customer = t.orders.groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"))
    joined = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return (joined.select("n", F.inline(F.array(*[
                F.struct(F.lit(m).alias("model_name"), F.col(c).alias("series"))
                for m, c in [("status", "o_orderstatus"), ("priority", "o_orderpriority"),
                             ("segment", "c_mktsegment")]])))
            .groupBy("model_name", "series").agg(F.sum("n").alias("n")))


@register("stored_view", "A8", f"SELECT ym, value FROM ({MONTHLY}) WHERE orders > 100")
def stored_view(t):
    monthly_orders(t).createOrReplaceTempView("monthly_orders")
    return t.spark.sql("SELECT ym, value FROM monthly_orders WHERE orders > 100")


@register("guarded_update", "A9", sql("demographics", """
 SELECT ym, region,
  CASE WHEN age_20_39_share < 1 THEN age_20_39_share * 100 ELSE age_20_39_share END
   AS age_20_39_share,
  CASE WHEN senior_60p_share < 1 THEN senior_60p_share * 100 ELSE senior_60p_share END
   AS senior_60p_share FROM demographics"""))
def guarded_update(t):
    """Rescale only values below one; a second run changes nothing that is at least one."""
    d = staging.stage_demographics(t).select("ym", "region", "age_20_39_share",
                                             "senior_60p_share")
    return d.withColumns({
        c: F.when(F.col(c) < 1, F.col(c) * 100).otherwise(F.col(c))
        for c in ["age_20_39_share", "senior_60p_share"]})


@register("compatible_names", "A10 B12", f"""
 SELECT ym, ym AS standard_year_month, orders, orders AS total_tx_count, value FROM ({MONTHLY})""")
def compatible_names(t):
    return monthly_orders(t).select("ym", F.col("ym").alias("standard_year_month"), "orders",
                                    F.col("orders").alias("total_tx_count"), "value")


@register("first_usable_source", "A11", """
 SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def first_usable_source(t):
    """The newest mart is absent, so the next candidate with rows answers."""
    df = first_usable(t.spark, [f"{t.path}/signal_mart.parquet", f"{t.path}/orders.parquet"])
    return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@register("standard_names", "A12", f"""
 SELECT ym, 'ALL' AS series, 'ORDERS' AS error_metric, orders AS metric_value FROM ({MONTHLY})""")
def standard_names(t):
    raw = monthly_orders(t).select("ym", F.lit("ORDERS").alias("metric"),
                                   F.col("orders").alias("value"))
    return with_standard_names(raw, {"metric": "error_metric", "value": "metric_value"},
                               {"series": "ALL"}).select(
        "ym", "series", "error_metric", "metric_value")


@register("json_result", "A13 S13", f"""
 SELECT ym, '{{"orders":' || orders || ',"peak":' || (orders >= 200) || '}}' AS payload
 FROM ({MONTHLY})""")
def json_result(t):
    """One JSON object per month, written as JSON lines and read back."""
    path = scratch_path(t.spark, "json")
    rows = monthly_orders(t).select("ym", "orders", (F.col("orders") >= 200).alias("peak"))
    write_json(as_json(rows, ["ym"]), path)
    return t.spark.read.schema("ym string, payload string").json(path)


REGION_LIST = ["NATION_3", "NATION_7", "NATION_11"]


@register("in_list_filter", "B1", """
 SELECT n_name AS region, count(*) AS customers FROM customer
 JOIN nation ON c_nationkey = n_nationkey
 WHERE n_name IN ('NATION_3','NATION_7','NATION_11') GROUP BY 1""")
def in_list_filter(t):
    """The list filters the dimension; the fact side meets only the listed keys."""
    wanted = t.nation.filter(F.col("n_name").isin(REGION_LIST))
    return (t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
            .join(wanted, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("region"), F.col("n").alias("customers")))


@register("month_range_filter", "B3", f"SELECT * FROM ({MONTHLY}) WHERE ym >= '199901'")
def month_range_filter(t):
    """Date predicate on the raw column, so that it reaches the scan."""
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    return (recent.groupBy(month_no("o_orderdate").alias("m"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 units_to_double(F.sum(hundredths("o_totalprice")), 2).alias("value"))
            .select(ym_of_no("m").alias("ym"), "orders", "value"))


@register("last_months_filter", "B4", f"""
 WITH m AS ({MONTHLY}) SELECT * FROM m WHERE ym > (SELECT strftime(
  strptime(max(ym) || '01','%Y%m%d') - INTERVAL 3 MONTH, '%Y%m') FROM m)""")
def last_months_filter(t):
    """Exactly the last three months; the bound is a one-row subquery."""
    newest = t.orders.agg(F.max(ym_of("o_orderdate")).alias("ym"))
    bound = newest.select(shift_ym("ym", -3)).scalar()
    return monthly_orders(t).filter(F.col("ym") > bound)


@register("latest_period_filter", "B5", sql("act_orders", """
 SELECT ym, region, move_in, customers FROM act_orders
 WHERE ym = (SELECT max(ym) FROM act_orders)"""))
def latest_period_filter(t):
    newest = t.orders.agg(F.max(month_no("o_orderdate"))).scalar()
    a = staging.customer_activity(t, with_lines=False)
    return a.filter(F.col("m") == newest).select("ym", "region", "move_in", "customers")


@register("threshold_bands", "B9", sql("mart3", """
 SELECT ym, region, rental_signal, CASE WHEN rental_signal > 50 THEN 'strong'
  WHEN rental_signal > 20 THEN 'normal' ELSE 'weak' END AS band FROM mart3"""))
def threshold_bands(t):
    s = F.col("rental_signal")
    return mart.signal_mart(t).select(
        "ym", "region", s, F.when(s > fixed.SIGNAL_STRONG, "strong")
        .when(s > fixed.SIGNAL_NORMAL, "normal").otherwise("weak").alias("band"))


@register("unit_scaling", "B11", f"""
 SELECT ym, {rounded("value / 10000", 1)} AS value_10k,
  {rounded("value / 100000000", 2)} AS value_100m FROM ({MONTHLY})""")
def unit_scaling(t):
    return monthly_orders(t).select(
        "ym", round_half_up(F.col("value") / 10000, 1).alias("value_10k"),
        round_half_up(F.col("value") / 100000000, 2).alias("value_100m"))


@register("column_subset", "B13", f"SELECT ym, orders FROM ({MONTHLY})")
def column_subset(t):
    return present(monthly_orders(t), ["ym", "is_peak_holiday", "orders"])


@register("month_dates", "S1 S2 S3 S4", f"""
 SELECT ym, strptime(ym || '01','%Y%m%d')::DATE AS ds,
  strptime(ym || '01','%Y%m%d')::TIMESTAMP AS ts,
  strftime(strptime(ym || '01','%Y%m%d') + INTERVAL 3 MONTH,'%Y%m') AS ym_plus_3,
  CAST(month(strptime(ym || '01','%Y%m%d')) AS INTEGER) AS mm,
  CAST(date_diff('day', DATE '1995-01-01', strptime(ym || '01','%Y%m%d')::DATE) AS INTEGER)
   AS day_no, orders FROM ({MONTHLY})""")
def month_dates(t):
    ds = first_day("ym")
    return monthly_orders(t).select(
        "ym", ds.alias("ds"), ds.cast("timestamp_ntz").alias("ts"),
        shift_ym("ym", 3).alias("ym_plus_3"), F.month(ds).alias("mm"),
        F.datediff(ds, F.lit("1995-01-01").cast("date")).alias("day_no"), "orders")


@register("refresh_stamp", "S6", """
 SELECT event_type AS component, count(*) AS events, TIMESTAMP '2024-02-01' AS generated_at
 FROM events GROUP BY 1""")
def refresh_stamp(t, as_of=None):
    """``as_of`` stands for the clock, so that a run can be repeated."""
    stamp = F.lit(as_of or "2024-02-01").cast("timestamp_ntz")
    return (t.events.groupBy(F.col("event_type").alias("component"))
            .agg(F.count(F.lit(1)).alias("events")).withColumn("generated_at", stamp))


@register("string_functions", "S7", """
 SELECT p_type, count(*) AS parts, upper(left(p_type, 3)) AS code,
  replace(substr(p_type, 2, 4), 'A', '-') AS infix, p_type || '/' || lower(p_type) AS label
 FROM part GROUP BY 1""")
def string_functions(t):
    p = F.col("p_type")
    return t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("parts")).select(
        "p_type", "parts", F.upper(F.left(p, F.lit(3))).alias("code"),
        F.replace(F.substring(p, 2, 4), F.lit("A"), F.lit("-")).alias("infix"),
        F.concat(p, F.lit("/"), F.lower(p)).alias("label"))


@register("clean_labels", "S8", """
 SELECT CASE WHEN role = 'system' THEN 'ALL' ELSE role END AS series, count(*) AS n
 FROM conversations GROUP BY 1""")
def clean_labels(t):
    """Quoted labels lose their quotes; textual and real nulls fall into ALL."""
    raw = t.conversations.select(
        F.when((F.col("role") == "system") & (F.col("turn") % 2 == 0), F.lit(" null "))
        .when(F.col("role") != "system", F.concat(F.lit('"'), "role", F.lit('" ')))
        .alias("series"))
    return raw.groupBy(text.clean_label("series").alias("series")).agg(
        F.count(F.lit(1)).alias("n"))


@register("null_rules", "S11 S12", """
 SELECT c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 0) AS INTEGER) AS balance,
  coalesce(nullif(c_mktsegment, 'MACHINERY'), 'OTHER') AS segment,
  CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side FROM customer""")
def null_rules(t):
    """Round before the cast: a bare cast would truncate."""
    return t.customer.select(
        "c_custkey",
        F.round(F.col("c_acctbal").cast("decimal(18,2)"), 0).cast("int").alias("balance"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("MACHINERY")), F.lit("OTHER"))
        .alias("segment"),
        F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("side"))


@register("tolerant_parse", "S14", """
 SELECT event_type, count(*) AS n, count(TRY_CAST(json_extract_string(props,'$.k') AS INTEGER))
  AS parsed, CAST(sum(TRY_CAST(json_extract_string(props,'$.k') AS INTEGER)) AS BIGINT) AS total,
  count(TRY_CAST(event_type AS DOUBLE)) AS numeric_types FROM events GROUP BY 1""")
def tolerant_parse(t):
    """Values that do not parse become NULL instead of failing the job."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count(k).alias("parsed"),
        F.sum(k).cast("bigint").alias("total"),
        F.count(F.col("event_type").try_cast("double")).alias("numeric_types"))


@register("finite_values", "S15", """
 SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)::BIGINT AS good,
  count(*) AS n FROM events GROUP BY 1""")
def finite_values(t):
    """NaN and infinities become NULL before they reach JSON or a count."""
    raw = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.groupBy("user_id").agg(
        F.count(text.finite(raw)).alias("good"), F.count(F.lit(1)).alias("n"))


@register("embedded_json", "S16", """
 SELECT event_id, TRY_CAST(json_extract_string(props,'$.k') AS INTEGER) AS k FROM events""")
def embedded_json(t):
    """First to last brace of free text, parsed."""
    prose = F.concat(F.lit("Result "), "event_type", F.lit(":\n"), "props", F.lit("\n(end)"))
    parsed = F.from_json(text.outer_braces(prose), "k int")
    return t.events.select("event_id", parsed["k"].alias("k"))


@register("display_formats", "S17", f"""
 SELECT ym, format('{{:,}}', orders) AS orders_text,
  printf('%.1f%%', {rounded("orders / 100.0", 1)}) AS pct_text FROM ({MONTHLY})""")
def display_formats(t):
    return monthly_orders(t).select("ym", text.thousands("orders").alias("orders_text"),
                                    text.percent(F.col("orders") / 100.0).alias("pct_text"))
