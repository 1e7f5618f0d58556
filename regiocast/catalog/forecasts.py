"""Training frames, forecasts, backtests, importance and model comparison."""

from pyspark.sql import functions as F

from regiocast.catalog.oracle import sql
from regiocast.catalog.registry import register
from regiocast.operators.reshape import overlay
from regiocast.plans import backtest as bt
from regiocast.plans import fixed, forecast as fc, staging
from regiocast.session import cut_lineage


def training(t):
    return fc.training_frame(staging.stage_totals(t),
                             through=fc.complete_through(t.orders, "o_orderdate"))


def ladder(t):
    return bt.backtest(training(t), models=bt.LADDER)


def ladder_metrics(t):
    return bt.evaluation_metrics(ladder(t), ["model_name", "series"])


def ladder_wide(t):
    return bt.wide_metrics(ladder_metrics(t), ["model_name", "series"])


@register("training_frame", "F1 B2 S2", sql("train", "SELECT * FROM train"))
def training_frame(t):
    return training(t)


@register("trend_season_fit", "F2", sql("fitted", """
 SELECT series, CAST(n AS BIGINT) AS n, last_ds, CASE WHEN seasonal THEN 'season'
  WHEN txx > 0 THEN 'trend' ELSE 'level' END AS model, mean, trend_slope, slope, level, sigma
 FROM fitted"""))
def trend_season_fit(t):
    return fc.fit(training(t), ["series"]).drop("season")


@register("forecast_results", "F3 F4", sql("forecast", "SELECT * FROM forecast"))
def forecast_results(t):
    return fc.forecast(training(t))


@register("backtest_predictions", "F6 C11", sql("ladder", "SELECT * FROM ladder"))
def backtest_predictions(t):
    return ladder(t)


@register("evaluation_metrics", "F6", sql("wide_metrics fold_sd", """
 SELECT model_name, series, unnest(['MAPE','SMAPE','MAE']) AS error_metric,
  unnest([mape, smape, mae]) AS metric_value,
  unnest([mape_sd, smape_sd, mae_sd]) AS standard_deviation, NULL::VARCHAR AS logs
 FROM wide_metrics JOIN fold_sd USING (model_name, series)"""))
def evaluation_metrics(t):
    return ladder_metrics(t)


@register("metrics_wide", "G8 F8", sql("wide_metrics", "SELECT * FROM wide_metrics"))
def metrics_wide(t):
    return ladder_wide(t)


@register("model_summary", "F9 E9 E10", sql("model_summary", "SELECT * FROM model_summary"))
def model_summary(t):
    return bt.model_summary(ladder_wide(t), {m: i for i, m in enumerate(bt.LADDER, start=1)})


@register("best_model", "F10", sql("wide_metrics", """
 SELECT series, arg_min(model_name, (mape, model_name)) AS best_model, min(mape) AS best_mape
 FROM wide_metrics GROUP BY 1"""))
def best_model(t):
    return bt.best_model(ladder_wide(t))


@register("first_last_improvement", "F11", sql("wide_metrics", """
 SELECT series, a AS first_mape, c AS last_mape,
  CASE WHEN a > 0 THEN (a - c) / a * 100 END AS improve_pct FROM (
  SELECT series, max(mape) FILTER (WHERE model_name = 'MODEL_A') AS a,
   max(mape) FILTER (WHERE model_name = 'MODEL_C') AS c FROM wide_metrics GROUP BY 1)"""))
def first_last_improvement(t):
    return bt.first_last_improvement(ladder_wide(t))


@register("actual_and_forecast", "F12 U1", sql("train forecast", """
 SELECT ds, series, y AS actual, CAST(NULL AS DOUBLE) AS forecast_val,
  CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound FROM train
 UNION ALL SELECT ts, series, NULL, forecast, lower_bound, upper_bound FROM forecast"""))
def actual_and_forecast(t):
    train = training(t)
    return fc.actual_and_forecast(train, fc.forecast(train))


OVERLAY = ["NATION_0", "NATION_1", "NATION_2"]


@register("forecast_overlay", "F13 G9 C8", sql("train forecast", """
 SELECT ds, max(y) FILTER (WHERE series = 'NATION_0' ) AS "NATION_0_actual",
  max(y) FILTER (WHERE series = 'NATION_1') AS "NATION_1_actual",
  max(y) FILTER (WHERE series = 'NATION_2') AS "NATION_2_actual",
  max(f) FILTER (WHERE series = 'NATION_0') AS "NATION_0_forecast",
  max(f) FILTER (WHERE series = 'NATION_1') AS "NATION_1_forecast",
  max(f) FILTER (WHERE series = 'NATION_2') AS "NATION_2_forecast"
 FROM (SELECT ds, series, y, NULL AS f FROM train UNION ALL
  SELECT ts, series, NULL, forecast FROM forecast) GROUP BY ds"""))
def forecast_overlay(t):
    """Wide columns for the compared series; dates of any series are kept."""
    train = training(t)
    both = fc.actual_and_forecast(train, fc.forecast(train))
    return overlay(both, "ds", "series", "actual", "forecast_val", OVERLAY)


@register("forecast_accuracy", "F14 V5", sql("ladder", """
 SELECT series, checks, mape * 100 AS error_pct, 1.0::DOUBLE - mape AS accuracy FROM (
  SELECT series, count(*) AS checks,
   CAST(sum(CAST(abs(actual - forecast) / actual AS DECIMAL(18,9))) AS DOUBLE) / count(*)
    AS mape FROM ladder WHERE model_name = 'MODEL_C' GROUP BY 1)"""))
def forecast_accuracy(t):
    """Accuracy from the backtest, where actual and forecast meet on one row."""
    return bt.accuracy(bt.backtest(training(t)))


@register("interval_width", "F15 V10", sql("forecast", """
 SELECT series, ts, forecast, lower_bound, upper_bound,
  (upper_bound - lower_bound) / nullif(forecast, 0) * 100 AS width_pct FROM forecast"""))
def interval_width(t):
    f = fc.forecast(training(t))
    return f.withColumn("width_pct", F.when(
        F.col("forecast") != 0,
        (F.col("upper_bound") - F.col("lower_bound")) / F.col("forecast")) * 100.0)


def exog_panel(t):
    from regiocast.plans import exog, mart
    return exog.panel(mart.extended_mart(t),
                      through=fc.complete_through(t.orders, "o_orderdate"))


@register("future_exog_frame", "X14 C6 A5", sql("panel", """
 SELECT series, f.ds, CAST(count(*) FILTER (WHERE h AND NOT w) AS INTEGER) AS holiday_days,
  CAST(sum(long) AS INTEGER) AS long_weekend_cnt,
  CAST(count(*) FILTER (WHERE NOT h AND NOT w) AS INTEGER) AS business_days,
  any_value(age_20_39_share) AS age_20_39_share, any_value(senior_60p_share)
  AS senior_60p_share, any_value(family_30_49_share) AS family_30_49_share,
  any_value(tourism_demand_idx) AS tourism_demand_idx, any_value(foreign_visitor_idx)
  AS foreign_visitor_idx, any_value(stability_score) AS stability_score,
  any_value(net_store_change) AS net_store_change
 FROM (SELECT p.*, (p.ds + to_months(CAST(k AS INTEGER)))::DATE AS fds
  FROM (SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY series ORDER BY ds DESC) = 1)
   p, generate_series(1, 3) g(k)) x, LATERAL (SELECT x.fds AS ds) f
 JOIN (SELECT d, w, h, CASE WHEN o AND NOT lag(o) OVER z AND lead(o) OVER z
    AND lead(o, 2) OVER z THEN 1 ELSE 0 END AS long
   FROM (SELECT d::DATE AS d, dayofweek(d) IN (0, 6) AS w, strftime(d,'%m%d') IN
     ('0101','0301','0505','0606','0815','1003','1009','1225') AS h,
     dayofweek(d) IN (0, 6) OR strftime(d,'%m%d') IN
     ('0101','0301','0505','0606','0815','1003','1009','1225') AS o
    FROM (SELECT unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2003-01-31',
     INTERVAL 1 DAY)) AS d)) WINDOW z AS (ORDER BY d)) c
  ON date_trunc('month', c.d) = f.ds GROUP BY series, f.ds"""))
def future_exog_frame(t):
    from regiocast.plans import exog
    from regiocast.plans.calendar import order_calendar
    return exog.future_exog(exog_panel(t), order_calendar(t, extra_months=fixed.HORIZON))


@register("exog_forecast", "F5")
def exog_forecast(t):
    """Ridge on within-month Gram matrices; checked against a direct solve in the tests."""
    from regiocast.plans import exog
    from regiocast.plans.calendar import order_calendar
    train = cut_lineage(exog_panel(t))
    future = exog.future_exog(train, order_calendar(t, extra_months=fixed.HORIZON))
    return exog.exog_forecast(train, future)


@register("feature_importance", "F7", sql("importance", "SELECT * FROM importance"))
def feature_importance(t):
    from regiocast.plans import exog
    return exog.feature_importance(exog_panel(t))


@register("ablation_results", "F8 A7")
def ablation_results(t):
    """Five nested feature sets scored on the same folds; checked by brute force in tests."""
    from regiocast.plans import exog
    return exog.ablation_wide(exog_panel(t))


@register("ablation_summary", "F8 F9")
def ablation_summary(t):
    from regiocast.plans import exog
    order = {m: i for i, m in enumerate(exog.STEPS, start=1)}
    return bt.model_summary(exog.ablation_wide(exog_panel(t)), order)
