"""Rolling-origin evaluation, metric tables and model comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocast.operators.reshape import pivot_max
from regiocast.plans import fixed
from regiocast.plans.forecast import fit_sums, predict, rows_for_sums, time_index
from regiocast.session import cut_lineage

LADDER = {"MODEL_A": "mean", "MODEL_B": "trend", "MODEL_C": "season"}
NO_HISTORY = "no forecast to compare: no month before the cutoffs, or actual values of zero"
METRICS = {"MAPE": "mape", "SMAPE": "smape", "MAE": "mae"}


def _aged(train: DataFrame) -> DataFrame:
    age = (F.max(time_index("ds")).over(Window.partitionBy("series"))
           - time_index("ds")).alias("age")
    return train.select("*", age)


def _per_fold(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """A copy of each row for the folds from ``first`` to ``last``."""
    return (rows.withColumns({"_lo": first, "_hi": last}).filter(F.col("_lo") <= F.col("_hi"))
            .withColumn("fold", F.explode(F.sequence(F.col("_lo"), F.col("_hi"))))
            .drop("_lo", "_hi", "age"))


def fold_targets(train: DataFrame, folds: int, horizon: int) -> DataFrame:
    """The ``horizon`` months behind the cutoff of every fold, whose cutoff leaves
    horizon + fold - 1 months."""
    return _per_fold(_aged(train), F.greatest(F.lit(1), F.col("age") + 2 - horizon),
                     F.least(F.lit(folds), F.col("age") + 1))


def split_folds(train: DataFrame, folds: int, horizon: int) -> tuple[DataFrame, DataFrame]:
    """Training and target rows per fold, for models that need the rows of each fold.

    Each row lists the folds it belongs to, so cutoffs need no inequality join. The panel is
    monthly, hence a series holds few rows and a row at most ``folds`` copies. It is written
    once, because both results start from it.
    """
    train = cut_lineage(train)
    known = _per_fold(_aged(train), F.lit(1),
                      F.least(F.lit(folds), F.col("age") - (horizon - 1)))
    return known, fold_targets(train, folds, horizon)


def fold_sums(train: DataFrame, folds: int, horizon: int) -> DataFrame:
    """Sums per (series, fold, calendar month) as running sums, one row each.

    A row of a calendar month holds the sums of all its years so far. It stands for the folds
    whose cutoff lies at or behind it, but before the next year's row, so a fold takes up at most
    twelve rows however long a series is, and no row of the history is repeated.
    """
    w = Window.partitionBy("series", "mm").orderBy("ds")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows_for_sums(train, ["series"])
    newest = F.max("t").over(Window.partitionBy("series"))
    sums = rows.withColumn("_newest", newest).select(
        "series", "mm", F.count(F.lit(1)).over(so_far).alias("n"), F.sum("t").over(so_far).alias("st"),
        F.sum(F.col("t") * F.col("t")).over(so_far).alias("stt"),
        F.sum("y").over(so_far).alias("sy"), F.sum(F.col("y") * F.col("td")).over(so_far).alias("sty"),
        F.sum(F.col("y") * F.col("y")).over(so_far).alias("syy"), F.col("ds").alias("last_ds"),
        "scale", (F.col("_newest") - F.col("t")).alias("age"),
        (F.col("_newest") - F.lead("t").over(w)).alias("_next"))
    # fold k needs age >= horizon + k - 1
    return _per_fold(sums, F.greatest(F.lit(1).cast("bigint"), F.coalesce(
        F.col("_next") - (horizon - 2), F.lit(1))),
        F.least(F.lit(folds).cast("bigint"), F.col("age") - (horizon - 1))).withColumn(
        "fold", F.col("fold").cast("int")).drop("_next")


def backtest(train: DataFrame, folds: int = 6, horizon: int = fixed.HORIZON,
             models: dict[str, str] | None = None) -> DataFrame:
    """(series, fold, ds, actual, model_name, forecast) for every fold and step ahead.

    A series without a month before a cutoff keeps the rows of that fold, without a forecast.
    """
    models = models or {"MODEL_C": "season"}
    train = cut_lineage(train.select("series", "ds", "y"))
    params = fit_sums(fold_sums(train, folds, horizon), ["series", "fold"])
    joined = fold_targets(train, folds, horizon).join(params, ["series", "fold"], "left")
    rows = F.inline(F.array(*[
        F.struct(F.lit(name).alias("model_name"), predict("ds", kind).alias("forecast"))
        for name, kind in models.items()]))
    return joined.select("series", "fold", "ds", F.col("y").alias("actual"), rows)


def evaluation_metrics(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Long table: key, error_metric, metric_value, standard_deviation over folds, logs.

    A key without any forecast keeps its rows, without values; ``logs`` says why.
    """
    gap = F.abs(F.col("actual") - F.col("forecast"))
    errors = predictions.select(
        *keys, "fold",
        (F.when(F.col("actual") != 0, gap / F.abs("actual")) * 100.0)
        .cast("decimal(38,6)").alias("MAPE"),
        F.when(F.abs("actual") + F.abs("forecast") != 0,
               gap * 200.0 / (F.abs("actual") + F.abs("forecast")))
        .cast("decimal(38,6)").alias("SMAPE"),
        gap.cast("decimal(38,6)").alias("MAE"))
    per_fold = errors.groupBy(*keys, "fold").agg(
        *[F.sum(m).alias(m) for m in METRICS], *[F.count(m).alias(f"{m}_n") for m in METRICS])

    def mean(m: str) -> Column:
        return F.sum(m).cast("double") / F.when(F.sum(f"{m}_n") > 0, F.sum(f"{m}_n"))

    def fold_value(m: str) -> Column:
        return F.col(m).cast("double") / F.when(F.col(f"{m}_n") > 0, F.col(f"{m}_n"))

    def add(values: Column, term=lambda x: x) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + term(x))

    def sd(m: str) -> Column:
        # one value per fold, added in fold order
        values = F.filter(F.transform("_folds", lambda f: f[m]), lambda x: x.isNotNull())
        k = F.size(values)
        mean_value = F.col(f"_mean_{m}")
        return F.when(k > 1, F.sqrt(
            add(values, lambda x: (x - mean_value) * (x - mean_value)) / (k - 1)))

    def fold_mean(m: str) -> Column:
        values = F.filter(F.transform("_folds", lambda f: f[m]), lambda x: x.isNotNull())
        return F.when(F.size(values) > 0, add(values) / F.size(values))

    wide = per_fold.groupBy(*keys).agg(
        *[mean(m).alias(m) for m in METRICS],
        F.sort_array(F.collect_list(F.struct(
            "fold", *[fold_value(m).alias(m) for m in METRICS]))).alias("_folds"))
    wide = wide.withColumns({f"_mean_{m}": fold_mean(m) for m in METRICS}).withColumns(
        {f"{m}_sd": sd(m) for m in METRICS})
    return wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("error_metric"), F.col(m).alias("metric_value"),
                 F.col(f"{m}_sd").alias("standard_deviation"),
                 F.when(F.col(m).isNull(), NO_HISTORY).alias("logs")) for m in METRICS])))


def wide_metrics(long: DataFrame, keys: list[str]) -> DataFrame:
    return pivot_max(long, keys, "error_metric", "metric_value", METRICS)


def model_summary(results: DataFrame, order: dict[str, int]) -> DataFrame:
    """Improvement of each model against the first and the previous one, per series.

    ``results`` is wide (model_name, series, mape, smape, mae). A window holds one row per
    model of a series.
    """
    w = Window.partitionBy("series").orderBy("model_order")
    rank = F.coalesce(*[F.when(F.col("model_name") == name, F.lit(i))
                        for name, i in order.items()])
    r = results.withColumn("model_order", rank).withColumns({
        "baseline_mape": F.first("mape").over(w), "prev_mape": F.lag("mape").over(w)})

    def relative(before: str) -> Column:
        return F.when(F.col(before) > 0,
                      (F.col(before) - F.col("mape")) / F.col(before) * 100.0)

    return r.select(
        "model_name", "series", "model_order", "mape", "smape", "mae",
        (F.col("baseline_mape") - F.col("mape")).alias("improve_vs_baseline"),
        relative("baseline_mape").alias("improve_pct_vs_baseline"),
        (F.col("prev_mape") - F.col("mape")).alias("step_improve"),
        relative("prev_mape").alias("step_improve_pct"))


def best_model(results: DataFrame) -> DataFrame:
    """Model with the smallest MAPE per series, the earlier name on a tie; none without a MAPE."""
    order = F.when(F.col("mape").isNotNull(), F.struct("mape", "model_name"))
    return results.groupBy("series").agg(
        F.min_by("model_name", order).alias("best_model"),
        F.min("mape").alias("best_mape"))


def first_last_improvement(results: DataFrame) -> DataFrame:
    """MAPE of the first and last model by name and the relative gain in percent."""
    g = results.groupBy("series").agg(
        F.min_by("mape", "model_name").alias("first_mape"),
        F.max_by("mape", "model_name").alias("last_mape"), F.count(F.lit(1)).alias("models"))
    return g.filter(F.col("models") >= 2).select(
        "series", "first_mape", "last_mape",
        F.when(F.col("first_mape") > 0, (F.col("first_mape") - F.col("last_mape"))
               / F.col("first_mape") * 100.0).alias("improve_pct"))


def accuracy(predictions: DataFrame) -> DataFrame:
    """Mean error percent and accuracy 1 - MAPE per series; zero actuals are left out."""
    ratio = F.when(F.col("actual") != 0,
                   F.abs(F.col("actual") - F.col("forecast")) / F.col("actual")).cast(
        "decimal(38,9)")
    g = predictions.groupBy("series").agg(
        F.count(F.lit(1)).alias("checks"),
        (F.sum(ratio).cast("double") / F.when(F.count(ratio) > 0, F.count(ratio))).alias("mape"))
    return g.select("series", "checks", (F.col("mape") * 100.0).alias("error_pct"),
                    (F.lit(1.0) - F.col("mape")).alias("accuracy"))


