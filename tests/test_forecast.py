import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from regiocast.plans import backtest as bt
from regiocast.plans import exog
from regiocast.plans import forecast as fc


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


def series(spark, name, values):
    return spark.createDataFrame([(name, month(i), float(v)) for i, v in enumerate(values)],
                                 "series string, ds date, y double")


SEASON = [3, -1, 4, 1, -5, 9, 2, -6, 5, 3, -5, 8]


def exact_values(n):
    return [100 + 2 * i + SEASON[i % 12] for i in range(n)]


def test_exact_recovery_over_the_year_end(spark):
    train = series(spark, "A", exact_values(36))
    rows = fc.forecast(train).orderBy("ts").collect()
    assert [r["ts"] for r in rows] == [month(36), month(37), month(38)]
    want = exact_values(39)[36:]
    for r, v in zip(rows, want):
        assert abs(r["forecast"] - v) < 1e-6
        assert r["lower_bound"] <= r["forecast"] <= r["upper_bound"]


def test_exact_series_has_no_error(spark):
    p = bt.backtest(series(spark, "A", exact_values(48)))
    metrics = {r["error_metric"]: r["metric_value"]
               for r in bt.evaluation_metrics(p, ["series"]).collect()}
    assert all(v < 1e-6 for v in metrics.values())
    assert p.count() == 18


def test_fit_equals_least_squares(spark):
    rng = np.random.default_rng(1)
    y = np.round(np.array(exact_values(40)) + rng.normal(0, 5, 40), 2)
    row = fc.fit(series(spark, "A", y), ["series"]).collect()[0]
    t = np.array([(2020 - 1970) * 12 + i for i in range(40)], float)
    x = np.zeros((40, 13))
    x[:, 0] = t
    x[np.arange(40), 1 + np.arange(40) % 12] = 1
    beta, res, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert abs(row["slope"] - beta[0]) < 1e-7
    assert np.allclose(row["season"], beta[1:], atol=1e-4)
    assert abs(row["sigma"] - np.sqrt(res[0] / 27)) < 1e-6


@pytest.mark.parametrize("n, expected", [(1, 100.0), (2, 104.0), (5, 110.0)])
def test_short_history_falls_back(spark, n, expected):
    train = series(spark, "A", [100 + 2 * i for i in range(n)])
    r = fc.forecast(train, periods=1).collect()[0]
    assert abs(r["forecast"] - expected) < 1e-6
    assert (r["lower_bound"] is None) == (n < 3)


def test_training_filter_drops_null_and_zero(spark):
    m = spark.createDataFrame([("202401", "A", None), ("202402", "A", 0.0), ("202403", "A", 5.0)],
                              "ym string, region string, total_sales double")
    assert [r["ds"] for r in fc.training_frame(m).collect()] == [dt.date(2024, 3, 1)]


def test_folds_use_only_the_past(spark):
    train = series(spark, "A", range(1, 31))
    known, target = bt.split_folds(train, 4, 3)
    last = {r["fold"]: r["m"] for r in known.groupBy("fold").agg(F.max("ds").alias("m")).collect()}
    aims = {}
    for r in target.collect():
        aims.setdefault(r["fold"], []).append(r["ds"])
    for fold in range(1, 5):
        assert last[fold] == month(29 - 2 - fold)
        assert sorted(aims[fold]) == [month(29 - 2 - fold + h) for h in (1, 2, 3)]


def summary_input(spark):
    rows = [(f"MODEL_{m}", s, v, v, v) for s, vals in
            {"A": [10.0, 8.0, 8.0, 6.0, 5.0], "B": [0.0, 1.0, 0.5, 0.5, 2.0]}.items()
            for m, v in zip("ABCDE", vals)]
    return spark.createDataFrame(rows, "model_name string, series string, mape double,"
                                 " smape double, mae double")


def test_model_summary_and_best_model(spark):
    order = {f"MODEL_{m}": i for i, m in enumerate("ABCDE", start=1)}
    rows = {(r["series"], r["model_name"]): r
            for r in bt.model_summary(summary_input(spark), order).collect()}
    assert rows["A", "MODEL_A"]["improve_vs_baseline"] == 0.0
    assert rows["A", "MODEL_A"]["step_improve"] is None
    assert rows["A", "MODEL_E"]["improve_pct_vs_baseline"] == 50.0
    assert rows["A", "MODEL_B"]["step_improve_pct"] == 20.0
    assert rows["B", "MODEL_B"]["improve_pct_vs_baseline"] is None  # baseline 0
    best = {r["series"]: r["best_model"] for r in bt.best_model(summary_input(spark)).collect()}
    assert best == {"A": "MODEL_E", "B": "MODEL_A"}
    gain = {r["series"]: r["improve_pct"]
            for r in bt.first_last_improvement(summary_input(spark)).collect()}
    assert gain == {"A": 50.0, "B": None}


def test_metric_names_match_without_case(spark):
    long = spark.createDataFrame([("A", "mape", 1.0), ("A", "SMAPE", 2.0), ("A", "Mae", 3.0)],
                                 "series string, error_metric string, metric_value double")
    assert bt.wide_metrics(long, ["series"]).collect()[0].asDict() == {
        "series": "A", "mape": 1.0, "smape": 2.0, "mae": 3.0}


def exog_rows(spark, n=48, names=("A", "B")):
    rng = np.random.default_rng(7)
    rows = []
    for s in names:
        x = rng.normal(0, 1, (n, 3)).round(6)
        x[:, 2] = 4.0  # constant: must be dropped
        y = 500 + 3 * np.arange(n) + np.array(SEASON)[np.arange(n) % 12] + 20 * x[:, 0] - 7 * x[:, 1]
        rows += [(s, month(i), float(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(
        rows, "series string, ds date, y double, x1 double, x2 double, x3 double")


def test_exog_fit_equals_direct_ridge(spark):
    df = exog_rows(spark)
    features = ["x1", "x2", "x3"]
    ridge = 2.0
    got = {r["series"]: r for r in exog.fit_exog(df, ["series"], features,
                                                 {"FULL": features}, ridge).collect()}
    for s in ("A", "B"):
        p = df.filter(F.col("series") == s).orderBy("ds").toPandas()
        n = len(p)
        mm = np.arange(n) % 12
        v = np.column_stack([[(2020 - 1970) * 12 + i for i in range(n)], p["x1"], p["x2"], p["y"]])
        v = v - np.array([[v[mm == m, j].mean() for j in range(4)] for m in range(12)])[mm]
        scale = np.sqrt((v[:, :3] ** 2).sum(0))
        z = v[:, :3] / scale
        a = z.T @ z + np.diag([0, ridge / n, ridge / n])
        beta = np.linalg.solve(a, z.T @ v[:, 3]) / scale
        assert np.allclose(got[s]["coef"], [*beta, 0.0], rtol=1e-6, atol=1e-6)


def test_exog_forecast_without_penalty_is_exact(spark):
    df = exog_rows(spark, 51)
    train, future = df.filter(F.col("ds") < month(48)), df.filter(F.col("ds") >= month(48))
    out = exog.exog_forecast(train, future.drop("y"), ["x1", "x2"], ridge=0.0)
    joined = out.join(future.withColumnRenamed("ds", "ts"), ["series", "ts"]).collect()
    assert len(joined) == 6
    assert all(abs(r["forecast"] - r["y"]) < 1e-5 for r in joined)


def test_exog_forecast_needs_its_future_columns(spark):
    df = exog_rows(spark, 24)
    with pytest.raises(ValueError, match="x2"):
        exog.exog_forecast(df, df.select("series", "ds", "x1"), ["x1", "x2"])


def test_ablation_base_model_equals_plain_backtest(spark):
    df = exog_rows(spark)
    steps = {"MODEL_A": [], "MODEL_B": ["x1"], "MODEL_C": ["x1", "x2"]}
    wide = {(r["model_name"], r["series"]): r for r in exog.ablation_wide(
        df, steps=steps, features=["x1", "x2"], known=["x1", "x2"]).collect()}
    assert wide["MODEL_A", "A"]["feature_set"] == "no features"
    assert wide["MODEL_C", "A"]["feature_set"] == "x1, x2"
    plain = bt.wide_metrics(bt.evaluation_metrics(bt.backtest(df), ["series"]), ["series"])
    for r in plain.collect():
        assert abs(wide["MODEL_A", r["series"]]["mape"] - r["mape"]) < 1e-4
        assert (wide["MODEL_C", r["series"]]["mape"] < wide["MODEL_B", r["series"]]["mape"]
                < wide["MODEL_A", r["series"]]["mape"])


def test_ablation_carries_features_that_are_not_known_ahead(spark):
    """x is 0 up to the last cutoff and 100 behind it: with carried values the target months are
    predicted as if x were still 0."""
    start = 12 * 20
    rows = [("S", dt.date(2000 + i // 12, i % 12 + 1, 1), 50.0 + (i % 7), float(i % 2))
            for i in range(start)]
    df = spark.createDataFrame(rows, "series string, ds date, y double, x double")
    got = exog.carried_features(df, 6, 3, ["x"]).collect()
    assert {r["fold"]: r["x"] for r in got} == {
        k: float((start - 1 - (k + 2)) % 2) for k in range(1, 7)}
    gap = df.filter("ds <> date'2019-07-01'")  # a missing month: the row before it stands in
    again = {r["fold"]: r["x"] for r in exog.carried_features(gap, 6, 3, ["x"]).collect()}
    assert set(again) == set(range(1, 7))


def test_running_sums_equal_sums_of_every_fold(spark):
    rows = [(s, dt.date(2001 + i // 12, i % 12 + 1, 1), float((i * 37 + len(s)) % 91 + 1))
            for s, n in [("long", 60), ("ten", 10), ("three", 3), ("one", 1)] for i in range(n)
            if not (s == "long" and i % 11 == 4)]
    df = spark.createDataFrame(rows, "series string, ds date, y double")
    known, target = bt.split_folds(df, 6, 3)
    want = {tuple(r) for r in fc.month_sums(known, ["series", "fold"]).select(
        "series", "fold", "mm", "n", "st", "stt", "sy", "sty", "syy", "last_ds").collect()}
    sums = bt.fold_sums(df, 6, 3)
    got = sums.select("series", "fold", "mm", "n", "st", "stt", "sy", "sty", "syy", "last_ds")
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_short_series_keep_their_rows(spark):
    df = spark.createDataFrame(
        [("short", dt.date(2020, m, 1), 5.0 + m) for m in (1, 2, 3)]
        + [("long", dt.date(2018 + i // 12, i % 12 + 1, 1), 10.0 + i) for i in range(30)],
        "series string, ds date, y double")
    predictions = bt.backtest(df)
    short = predictions.filter("series = 'short'").collect()
    assert short and all(r["forecast"] is None for r in short)
    long = bt.evaluation_metrics(predictions.withColumn("model_name", F.lit("M")),
                                 ["model_name", "series"])
    metrics = {(r["series"], r["error_metric"]): r for r in long.collect()}
    assert len(metrics) == 6
    assert metrics["short", "MAPE"]["metric_value"] is None
    assert metrics["short", "MAPE"]["logs"] == bt.NO_HISTORY
    assert metrics["long", "MAPE"]["logs"] is None
    best = {r["series"]: r["best_model"] for r in bt.best_model(
        bt.wide_metrics(long, ["model_name", "series"])).collect()}
    assert best == {"short": None, "long": "M"}


def test_values_beyond_eighteen_digits(spark):
    """The same series times 2**80 has the same shape: every result is scaled by it exactly."""
    rows = [("S", dt.date(2010 + i // 12, i % 12 + 1, 1), float(1000 + 3 * i + (i % 12) ** 2))
            for i in range(48)]
    small = spark.createDataFrame(rows, "series string, ds date, y double")
    factor = 2.0 ** 80
    large = small.withColumn("y", F.col("y") * factor)
    for a, b in zip(fc.forecast(small).orderBy("ts").collect(),
                    fc.forecast(large).orderBy("ts").collect()):
        assert abs(b["forecast"] / factor - a["forecast"]) < 1e-6 * a["forecast"]
        assert abs(b["upper_bound"] / factor - a["upper_bound"]) < 1e-5 * a["upper_bound"]
    x = small.withColumns({"x1": F.col("y") * 1e20, "x2": F.month("ds").cast("double")})
    plain = small.withColumns({"x1": F.col("y"), "x2": F.month("ds").cast("double")})
    got, want = ([(r["feature_name"], round(r["importance_score"], 9)) for r in
                  exog.feature_importance(d, ["x1", "x2"]).orderBy("rank").collect()]
                 for d in (x, plain))
    assert got == want
    wild = spark.createDataFrame(
        [("S", "M", 1, 1e-12, 1e6), ("S", "M", 1, 2.0, 1.0)],
        "series string, model_name string, fold int, actual double, forecast double")
    found = {r["error_metric"]: r["metric_value"] for r in bt.evaluation_metrics(
        wild, ["model_name", "series"]).collect()}
    assert found["MAPE"] > 1e19 and found["SMAPE"] < 200


def test_importance_shares(spark):
    rows = exog.feature_importance(exog_rows(spark), ["x1", "x2", "x3"]).collect()
    for s in ("A", "B"):
        own = sorted((r for r in rows if r["series"] == s), key=lambda r: r["rank"])
        assert abs(sum(r["importance_score"] for r in own) - 1) < 1e-9
        assert own[-1]["feature_name"] == "x3" and own[-1]["importance_score"] == 0.0


def test_future_frame_rolls_over_december(spark):
    df = exog_rows(spark, 48).withColumns({"holiday_days": F.lit(3.0)})
    cal = spark.createDataFrame([("202401", 2), ("202402", 0)], "ym string, holiday_days int")
    out = exog.future_exog(df, cal, 3, ["holiday_days", "x1"]).filter("series = 'A'")
    rows = [(r["ds"], r["holiday_days"]) for r in out.orderBy("ds").collect()]
    assert rows == [(dt.date(2024, 1, 1), 2), (dt.date(2024, 2, 1), 0), (dt.date(2024, 3, 1), 1)]
