"""Streaming refresh and freshness queries."""

from pyspark.sql import functions as F

from regiocast.catalog.oracle import sql
from regiocast.catalog.registry import register
from regiocast.operators.reshape import append
from regiocast.plans import mart
from regiocast.plans.build import Build
from regiocast.session import scratch_path
from regiocast.streaming import refresh as rf
from regiocast.streaming.mart_store import MartStore, mart_store

ORDERS = """SELECT strftime(o_orderdate,'%Y%m') AS ym, o_orderpriority AS series,
 count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
 FROM orders GROUP BY 1, 2"""


@register("stream_daily_activity", "T1", """
 SELECT ts::DATE AS day, event_type, count(*) AS events,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY 1, 2""")
def stream_daily_activity(t):
    return rf.daily_activity(t.spark, t.path)


@register("stream_downstream_shares", "T2", f"""
 SELECT series, value, value / CAST(sum(CAST(value AS DECIMAL(28,4))) OVER () AS DOUBLE) AS share
 FROM (SELECT series, CAST(sum(CAST(value AS DECIMAL(28,4))) AS DOUBLE) AS value
  FROM ({ORDERS}) GROUP BY 1)""")
def stream_downstream_shares(t):
    return rf.order_refresh(t.spark, t.path).read_shares()


@register("stream_month_upsert", "T3", f"SELECT series, orders, value, ym FROM ({ORDERS})")
def stream_month_upsert(t):
    return rf.order_refresh(t.spark, t.path).read()


@register("incremental_equals_full", "T4", f"SELECT ym, series, true AS same FROM ({ORDERS})")
def incremental_equals_full(t):
    full = rf.merge_partials(rf.order_partials(t.orders))
    return rf.compare(rf.order_refresh(t.spark, t.path).read(), full, ["ym", "series"])


@register("component_freshness", "T5 T6 S5 U2", """
 SELECT component, last_refresh, refreshes,
  date_diff('second', last_refresh, now_) - CASE WHEN
   (epoch_us(now_) - epoch_us(last_refresh)) // 1000000
    < date_diff('second', last_refresh, now_) THEN 1 ELSE 0 END AS lag_seconds,
  CASE WHEN (epoch_us(now_) - epoch_us(last_refresh)) // 1000000 > 600 THEN 'LATE' ELSE 'OK' END
   AS state
 FROM (SELECT component, max(ts) AS last_refresh, count(*) AS refreshes FROM (
   SELECT event_type AS component, ts FROM events UNION ALL
   SELECT 'signup-users', ts FROM events WHERE event_type = 'signup') GROUP BY 1),
  (SELECT max(ts) AS now_ FROM events)""")
def component_freshness(t):
    """Events stand for the refresh log; a derived component is appended to it."""
    log = t.events.select(F.col("event_type").alias("component"),
                          F.col("ts").alias("refreshed_at"))
    derived = (t.events.filter(F.col("event_type") == "signup")
               .select(F.lit("signup-users").alias("component"),
                       F.col("ts").alias("refreshed_at")))
    return rf.freshness(append([log, derived]), 600)


@register("stream_windowed_activity", "T7", """
 SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, event_type, count(*) AS events,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY 1, 2""")
def stream_windowed_activity(t):
    return rf.windowed_activity(t.spark, t.path)


@register("full_build_log", "A2 A8 T1 T5 Q1", sql(
    "mart3 train forecast next_month target ladder wide_metrics panel", """
 SELECT 'signal_mart' AS component, count(*) AS row_count FROM mart3
 UNION ALL SELECT 'forecast_results', count(*) FROM forecast
 UNION ALL SELECT 'actual_vs_forecast',
  (SELECT count(*) FROM train) + (SELECT count(*) FROM forecast)
 UNION ALL SELECT 'backtest_predictions', count(*) FROM ladder
 UNION ALL SELECT 'evaluation_metrics', 3 * count(*) FROM wide_metrics
 UNION ALL SELECT 'model_summary', count(*) FROM wide_metrics
 UNION ALL SELECT 'best_model', count(DISTINCT series) FROM wide_metrics
 UNION ALL SELECT 'feature_importance', 10 * count(DISTINCT series) FROM train
 UNION ALL SELECT 'exog_forecast', 3 * count(DISTINCT series) FROM panel
 UNION ALL SELECT 'ablation_results', 5 * count(DISTINCT series) FROM target
 UNION ALL SELECT 'ablation_summary', 5 * count(DISTINCT series) FROM target
 UNION ALL SELECT 'allocation', count(*) FROM next_month"""))
def full_build_log(t):
    """All tables written from the raw data; the log names each with its row count."""
    build = Build(t, scratch_path(t.spark, "build")).run()
    return build.log().select("component", "row_count")


@register("incremental_base_mart", "T1 T3 X1 C2", sql("mart1", f"""
 SELECT {", ".join(mart.BASE_COLUMNS)} FROM mart1"""))
def incremental_base_mart(t):
    """The base mart from the streams of orders and line items, merged batch by batch."""
    return mart_store(t).read()


@register("incremental_mart_equals_full", "T4", sql("mart1", """
 SELECT ym, region, true AS same FROM mart1"""))
def incremental_mart_equals_full(t):
    """Every column of the refreshed mart against the mart computed from the raw tables; line
    items come before their orders here."""
    store = MartStore(t, scratch_path(t.spark, "mart-store")).create().run(
        t.path, ("lineitem", "orders"))
    return rf.compare(store.read(), mart.base_mart(t), mart.KEY)


@register("downstream_region_shares", "T2", sql("mart1", """
 SELECT region, total_sales, total_sales / CAST(sum(CAST(total_sales AS DECIMAL(28,4))) OVER ()
   AS DOUBLE) AS share
 FROM (SELECT region, CAST(sum(CAST(total_sales AS DECIMAL(38,4))) AS DOUBLE) AS total_sales
  FROM mart1 GROUP BY 1)"""))
def downstream_region_shares(t):
    """Shares of all sales, committed in the same version as the mart they come from."""
    return mart_store(t).read("shares")


@register("health_report", "T5 T6", """
 SELECT component, component_type, last_refresh_time,
  CASE WHEN component_type = 'DOWNSTREAM' THEN 'DOWNSTREAM' ELSE '600 seconds' END AS target_lag,
  lag_seconds, CASE WHEN lag_seconds > 600 THEN 'LATE' ELSE 'OK' END AS refresh_state,
  CASE WHEN rows_ > 0 THEN 'SUCCEEDED' ELSE 'EMPTY' END AS task_state,
  CASE WHEN component_type = 'MODEL' THEN 'v' || refreshes END AS model_version
 FROM (SELECT *, CAST(floor((epoch_us(now_) - epoch_us(last_refresh_time)) / 1000000.0) AS BIGINT)
    AS lag_seconds
  FROM (SELECT event_type AS component, CASE event_type WHEN 'purchase' THEN 'MODEL'
     WHEN 'signup' THEN 'DOWNSTREAM' ELSE 'MART' END AS component_type,
    max(ts) AS last_refresh_time, count(*) AS refreshes,
    arg_max(CAST(floor(value) AS BIGINT), ts) AS rows_ FROM events GROUP BY 1, 2),
   (SELECT max(ts) AS now_ FROM events))""")
def health_report(t):
    """Events stand for the refresh log: type as component, whole value as rows written."""
    kind = (F.when(F.col("event_type") == "purchase", "MODEL")
            .when(F.col("event_type") == "signup", "DOWNSTREAM").otherwise("MART"))
    log = t.events.select(F.col("event_type").alias("component"), kind.alias("component_type"),
                          F.floor("value").cast("bigint").alias("row_count"),
                          F.col("ts").alias("refreshed_at"))
    return rf.health_rows(log, 600)
