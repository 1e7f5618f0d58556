"""Forecast with exogenous features, feature importance and nested feature-set ablation.

Spark reduces every series to its Gram matrix: counts, sums and cross products per calendar
month, all models sharing one pass. What is left per series is a dozen numbers by a dozen, so
the ridge solve runs batched in numpy inside ``mapInPandas``, without a further shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocast.functions.exact import exact_double
from regiocast.operators.windows import latest_per_key
from regiocast.plans import fixed
from regiocast.plans.backtest import evaluation_metrics, split_folds, wide_metrics
from regiocast.plans.forecast import future_frame, interval, time_index, training_frame
from regiocast.session import cut_lineage

HOLIDAY = ["holiday_days", "long_weekend_cnt", "business_days"]
DEMOGRAPHIC = ["age_20_39_share", "senior_60p_share", "family_30_49_share"]
TOURISM = ["tourism_demand_idx", "foreign_visitor_idx"]
COMMERCIAL = ["stability_score", "net_store_change"]
FEATURES = HOLIDAY + DEMOGRAPHIC + TOURISM + COMMERCIAL
STEPS = {
    "MODEL_A": [], "MODEL_B": HOLIDAY, "MODEL_C": HOLIDAY + DEMOGRAPHIC,
    "MODEL_D": HOLIDAY + DEMOGRAPHIC + TOURISM, "MODEL_E": FEATURES,
}
CALENDAR_DEFAULTS = {"holiday_days": 1, "long_weekend_cnt": 0, "business_days": 21}


def panel(mart: DataFrame, features: list[str] = FEATURES,
          through: Column | None = None) -> DataFrame:
    """Training frame with the features as doubles, unknown values as 0; no month after
    ``through``."""
    train = training_frame(mart, exog=features, through=through)
    return train.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})


def gram(rows: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Per key a dense 12-month block of (count, sums, upper cross products) of
    (time, features, y)."""
    names = ["_t", *features, "y"]
    d = rows.withColumns({"_t": time_index("ds").cast("double"), "_mm": F.month("ds")})
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    per_month = d.groupBy(*keys, "_mm").agg(F.array(
        F.count(F.lit(1)).cast("double"), *[F.sum(c) for c in names],
        *[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).alias("_block"))
    width = 1 + len(names) + len(pairs)
    blocks = per_month.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_mm", "_block"))).alias("_by_month"))
    dense = F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(12)),
        lambda m: F.coalesce(F.try_element_at("_by_month", m),
                             F.array_repeat(F.lit(0.0), width))))
    return blocks.select(*keys, dense.alias("gram"))


def solve_blocks(blocks: np.ndarray, size: int, models: dict[str, list[int]],
                 ridge: float) -> dict[str, dict[str, np.ndarray]]:
    """Ridge solution of every model for a batch of dense month blocks (batch, 12, width)."""
    n = blocks[:, :, 0]
    sums = blocks[:, :, 1:1 + size]
    upper = np.triu_indices(size)
    cross = np.zeros((*blocks.shape[:2], size, size))
    cross[:, :, upper[0], upper[1]] = blocks[:, :, 1 + size:]
    cross[:, :, upper[1], upper[0]] = blocks[:, :, 1 + size:]
    total_n = n.sum(1)
    total_s = sums.sum(1)
    total_q = cross.sum(1)
    safe = np.where(n > 0, n, 1.0)
    within = (cross - sums[..., :, None] * sums[..., None, :] / safe[..., None, None]).sum(1)
    plain = total_q - total_s[:, :, None] * total_s[:, None, :] / total_n[:, None, None]
    seasonal = ((n > 0).sum(1) == 12) & (total_n > 12)
    g = np.where(seasonal[:, None, None], within, plain)
    raw = np.einsum("bii->bi", total_q)
    out = {}
    for name, chosen in models.items():
        cols = [0, *chosen]
        a = g[:, cols][:, :, cols]
        b = g[:, cols, size - 1]
        diag = np.einsum("bii->bi", a)
        live = diag > 1e-10 * np.maximum(raw[:, cols], 1e-300)
        scale = np.where(live, np.sqrt(np.where(live, diag, 1.0)), 1.0)
        keep = live[:, :, None] & live[:, None, :]
        corr = np.where(keep, a / (scale[:, :, None] * scale[:, None, :]), 0.0)
        penalty = np.where(np.arange(len(cols)) == 0, 0.0, ridge)[None, :] / total_n[:, None]
        eye = np.eye(len(cols))[None]
        corr = corr * (1 - eye) + eye * (1.0 + penalty)[:, None, :]
        rhs = np.where(live, b / scale, 0.0)
        z = np.linalg.solve(corr, rhs[..., None])[..., 0]
        beta = np.where(live, z / scale, 0.0)
        coef = np.zeros((len(blocks), size - 1))
        coef[:, cols] = beta
        means = sums / safe[..., None]
        season = means[:, :, -1] - np.einsum("bmi,bi->bm", means[:, :, :-1], coef)
        season[~seasonal] = np.nan
        level = (total_s[:, -1] - (total_s[:, :-1] * coef).sum(1)) / total_n
        rss = g[:, -1, -1] - 2 * (beta * b).sum(1) + np.einsum("bi,bij,bj->b", beta, a, beta)
        dof = total_n - np.where(seasonal, 12, 1) - live.sum(1)
        sigma = np.where(dof > 0, np.sqrt(np.maximum(rss, 0) / np.maximum(dof, 1)), np.nan)
        out[name] = {"coef": coef, "season": season, "level": level, "sigma": sigma,
                     "seasonal": seasonal}
    return out


def fit_exog(rows: DataFrame, keys: list[str], features: list[str],
             models: dict[str, list[str]], ridge: float = fixed.RIDGE) -> DataFrame:
    """(keys, model_name, coef, season, level, sigma) for all models from one Gram matrix."""
    size = len(features) + 2
    width = 1 + size + size * (size + 1) // 2
    columns = {m: [1 + features.index(c) for c in chosen] for m, chosen in models.items()}
    g = gram(rows, keys, features)
    fields = {f.name: f.dataType.simpleString() for f in g.schema.fields}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            blocks = np.stack(pdf["gram"].to_numpy()).reshape(len(pdf), 12, width)
            for model, r in solve_blocks(blocks, size, columns, ridge).items():
                part = pdf[keys].copy()
                part["model_name"] = model
                part["coef"] = list(r["coef"])
                part["season"] = [s if ok else None
                                  for s, ok in zip(r["season"], r["seasonal"])]
                part["level"] = r["level"]
                part["sigma"] = [None if np.isnan(s) else float(s) for s in r["sigma"]]
                yield part

    schema = ", ".join([f"{k} {fields[k]}" for k in keys] + [
        "model_name string", "coef array<double>", "season array<double>", "level double",
        "sigma double"])
    return g.mapInPandas(run, schema)


def predict_exog(ds: str, features: list[str]) -> Column:
    """Level of the calendar month (or overall) plus coefficients times features."""
    x = F.array(time_index(ds).cast("double"), *[F.col(c).cast("double") for c in features])
    dot = F.aggregate(F.zip_with("coef", x, lambda c, v: c * v), F.lit(0.0), lambda a, v: a + v)
    return F.coalesce(F.element_at("season", F.month(ds)), F.col("level")) + dot


def exog_forecast(train: DataFrame, future: DataFrame, features: list[str] = FEATURES,
                  ridge: float = fixed.RIDGE) -> DataFrame:
    """Forecast for the rows of ``future``, which must hold every feature of the model."""
    missing = [c for c in features if c not in future.columns]
    if missing:
        raise ValueError(f"future frame lacks exogenous columns {missing}")
    params = fit_exog(train, ["series"], features, {"FULL": features}, ridge)
    joined = future.join(params, "series")
    return interval(joined.withColumn("forecast", predict_exog("ds", features))).select(
        "series", F.col("ds").alias("ts"), "forecast", "lower_bound", "upper_bound")


def future_exog(train: DataFrame, calendar: DataFrame, periods: int = fixed.HORIZON,
                features: list[str] = FEATURES) -> DataFrame:
    """Exogenous values for the months after each series."""
    known = {c: CALENDAR_DEFAULTS[c] for c in features if c in CALENDAR_DEFAULTS}
    carried = [c for c in features if c not in known]
    last = latest_per_key(train.select("series", F.col("ds").alias("last_ds"), *carried),
                          ["series"], "last_ds")
    return future_frame(last, calendar, periods, known).select("series", "ds", *features)


def carried_features(train: DataFrame, folds: int, horizon: int,
                     features: list[str]) -> DataFrame:
    """(series, fold, features): the last values known at the cutoff of every fold.

    A row stands for the folds whose cutoff lies at or behind it, but before the next row.
    """
    w = Window.partitionBy("series").orderBy("ds")
    t = time_index("ds")
    newest = F.max(t).over(Window.partitionBy("series"))
    aged = train.withColumns({"_age": newest - t, "_next": newest - F.lead(t).over(w)})
    first = F.greatest(F.lit(1), F.coalesce(F.col("_next") - (horizon - 2), F.lit(1)))
    last = F.least(F.lit(folds), F.col("_age") - (horizon - 1))
    return (aged.withColumns({"_lo": first, "_hi": last}).filter("_lo <= _hi")
            .select("series", F.explode(F.sequence("_lo", "_hi")).alias("fold"), *features))


def ablation(train: DataFrame, folds: int = 6, horizon: int = fixed.HORIZON,
             steps: dict[str, list[str]] | None = None,
             features: list[str] = FEATURES, known: list[str] | None = None) -> DataFrame:
    """(model_name, series, error_metric, ...) of nested feature sets, one job for all.

    As in a forecast, only the features ``known`` ahead (those of the calendar by default) have
    their real values in the months that are predicted; the others keep their last ones.
    """
    known = list(CALENDAR_DEFAULTS) if known is None else known
    held = [c for c in features if c not in known]
    rows, target = split_folds(train, folds, horizon)
    params = fit_exog(rows, ["series", "fold"], features, steps or STEPS)
    if held:
        target = target.drop(*held).join(
            carried_features(train, folds, horizon, held), ["series", "fold"])
    joined = target.join(params, ["series", "fold"])
    predictions = joined.select("model_name", "series", "fold", F.col("y").alias("actual"),
                                predict_exog("ds", features).alias("forecast"))
    return evaluation_metrics(predictions, ["model_name", "series"])


def ablation_wide(train: DataFrame, **options) -> DataFrame:
    """One row per model and series, with the features that the model was given."""
    steps = options.get("steps") or STEPS
    wide = wide_metrics(ablation(train, **options), ["model_name", "series"])
    return wide.withColumn("feature_set", F.coalesce(*[
        F.when(F.col("model_name") == name, ", ".join(chosen) or "no features")
        for name, chosen in steps.items()]))


def feature_importance(train: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """(series, rank, feature_name, importance_score): share of the absolute correlation.

    The correlations come from exact sums, one aggregation for all series and features.
    """
    def exact(c: str, digits: int) -> Column:
        # correlations do not depend on the scale, so values beyond 18 digits are scaled down
        limit = 10.0 ** (18 - digits) / 2
        top = F.max(F.abs(F.col(c).cast("double"))).over(Window.partitionBy("series"))
        scale = F.when(top > limit, F.pow(F.lit(2.0), F.ceil(F.log2(top / limit)))).otherwise(1.0)
        return (F.col(c).cast("double") / scale).cast(f"decimal(18,{digits})").alias(c)

    d = train.select("series", exact("y", 4), *[exact(c, 6) for c in features])
    sums = d.groupBy("series").agg(
        F.count(F.lit(1)).cast("double").alias("n"), exact_double(F.sum("y")).alias("sy"),
        exact_double(F.sum(F.col("y") * F.col("y"))).alias("syy"),
        *[e for c in features for e in (
            exact_double(F.sum(c)).alias(f"s_{c}"),
            exact_double(F.sum(F.col(c) * F.col(c))).alias(f"ss_{c}"),
            exact_double(F.sum(F.col("y") * F.col(c))).alias(f"sy_{c}"))])
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")

    def strength(c: str) -> Column:
        vx = F.col("n") * F.col(f"ss_{c}") - F.col(f"s_{c}") * F.col(f"s_{c}")
        cov = F.col("n") * F.col(f"sy_{c}") - F.col("sy") * F.col(f"s_{c}")
        return F.when((vx > 0) & (vy > 0), F.abs(cov) / (F.sqrt(vx) * F.sqrt(vy))).otherwise(0.0)

    total = strength(features[0])
    for c in features[1:]:
        total = total + strength(c)
    rows = sums.withColumn("_total", total).select(
        "series", "_total", F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature_name"), strength(c).alias("_s"))
            for c in features])))
    w = Window.partitionBy("series").orderBy(F.col("importance_score").desc_nulls_last(),
                                             "feature_name")
    scored = rows.withColumn("importance_score",
                             F.when(F.col("_total") > 0, F.col("_s") / F.col("_total")))
    return scored.select("series", F.row_number().over(w).alias("rank"), "feature_name",
                         "importance_score")
