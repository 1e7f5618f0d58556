"""Multi-series forecast: linear trend plus calendar-month levels, fitted by aggregation.

All series are fitted in one job from exact sums per (series, calendar month). With a full
seasonal history the trend is the within-month regression slope (the joint least-squares
solution of trend and month effects); with less it is the plain slope; a single point repeats
its value. A fitted row is small and fixed in size, so there is no per-series Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocast.functions.dates import first_day
from regiocast.functions.exact import exact_double
from regiocast.operators.reshape import append
from regiocast.operators.spine import horizon as add_horizon
from regiocast.plans import fixed
from regiocast.session import cut_lineage

EPOCH_MONTH = 1970 * 12


def time_index(ds: str | Column) -> Column:
    """Months since January 1970."""
    return F.year(ds) * 12 + F.month(ds) - 1 - EPOCH_MONTH


def complete_through(dates: DataFrame, date: str) -> Column:
    """Last month (yyyyMM) whose last day is covered by the facts, as a scalar of a plan."""
    newest = dates.agg(F.max(F.col(date).cast("date")).alias("d"))
    return newest.select(F.date_format(
        F.when(F.col("d") == F.last_day("d"), F.col("d")).otherwise(F.add_months("d", -1)),
        "yyyyMM").alias("ym")).scalar()


def training_frame(mart: DataFrame, series: str = "region", y: str = "total_sales",
                   exog: list[str] | None = None, through: Column | None = None) -> DataFrame:
    """(series, ds, y, exogenous...) with a positive, known target.

    Months after ``through``, of which only some days are known yet, take no part.
    """
    if through is not None:
        mart = mart.filter(F.col("ym") <= through)
    return (mart.filter(F.col(y).isNotNull() & (F.col(y) > 0))
            .select(F.col(series).alias("series"), first_day("ym").alias("ds"),
                    F.col(y).cast("double").alias("y"), *(exog or [])))


LIMIT = 1e14  # values above are scaled down by a power of two per series, see ``rows_for_sums``
SUMS = ["n", "st", "stt", "sy", "sty", "syy"]


def rows_for_sums(train: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ds, mm, t, td, y, scale): y as an exact decimal of y / scale.

    ``scale`` is 1 as long as the largest value of a series fits into 18 digits with four
    decimals; above, it is a power of two, so that only digits beyond a double's own are lost.
    """
    top = F.max(F.abs(F.col("y").cast("double"))).over(Window.partitionBy(*keys))
    scale = F.when(top > LIMIT / 2, F.pow(F.lit(2.0), F.ceil(F.log2(top / (LIMIT / 2))))
                   ).otherwise(1.0)
    return train.withColumn("scale", scale).select(
        *keys, "ds", F.month("ds").alias("mm"), time_index("ds").cast("bigint").alias("t"),
        time_index("ds").cast("bigint").cast("decimal(10,0)").alias("td"),
        (F.col("y").cast("double") / F.col("scale")).cast("decimal(18,4)").alias("y"), "scale")


def month_sums(train: DataFrame, keys: list[str]) -> DataFrame:
    """Exact sums of every key and calendar month."""
    return rows_for_sums(train, keys).groupBy(*keys, "mm").agg(
        F.count(F.lit(1)).alias("n"), F.sum("t").alias("st"),
        F.sum(F.col("t") * F.col("t")).alias("stt"), F.sum("y").alias("sy"),
        F.sum(F.col("y") * F.col("td")).alias("sty"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.max("ds").alias("last_ds"), F.max("scale").alias("scale"))


def fit(train: DataFrame, keys: list[str]) -> DataFrame:
    """One row of parameters per key from a frame with ``ds`` (first of month) and ``y``."""
    return fit_sums(month_sums(train, keys), keys)


def fit_sums(months: DataFrame, keys: list[str]) -> DataFrame:
    """One row of parameters per key from the sums of its calendar months. ``model`` says what
    its history allows: season, trend, or the level of a single month."""
    whole = ["n", "st", "stt"]
    exact = ["sy", "sty", "syy"]
    power = {"sy": F.col("scale"), "sty": F.col("scale"), "syy": F.col("scale") * F.col("scale")}
    entry = F.struct("mm", *[F.col(c).cast("double").alias(c) for c in whole],
                     *[(exact_double(c) * power[c]).alias(c) for c in exact])
    totals = months.groupBy(*keys).agg(
        *[F.sum(c).cast("double").alias(c) for c in whole],
        *[(exact_double(F.sum(c)) * (F.max("scale") if c != "syy" else
                                     F.max("scale") * F.max("scale"))).alias(c) for c in exact],
        F.max("last_ds").alias("last_ds"), F.sort_array(F.collect_list(entry)).alias("months"))

    def within(a: str, b: str, ab: str) -> Column:
        # added in calendar order, so the result does not depend on arrival order
        return F.aggregate("months", F.lit(0.0),
                           lambda acc, m: acc + (m[ab] - m[a] * m[b] / m["n"]))

    def total(a: str, b: str, ab: str) -> Column:
        return F.col(ab) - F.col(a) * F.col(b) / F.col("n")

    stats = totals.withColumns({
        "wxx": within("st", "st", "stt"), "wxy": within("st", "sy", "sty"),
        "wyy": within("sy", "sy", "syy"), "txx": total("st", "st", "stt"),
        "txy": total("st", "sy", "sty"), "tyy": total("sy", "sy", "syy"),
        "mean": F.col("sy") / F.col("n"),
    }).withColumn("seasonal", (F.size("months") == 12) & (F.col("n") > 12) & (F.col("wxx") > 0))
    slopes = stats.withColumns({
        "trend_slope": F.when(F.col("txx") > 0, F.col("txy") / F.col("txx")).otherwise(0.0),
        "slope": F.when(F.col("seasonal"), F.col("wxy") / F.when(
            F.col("wxx") > 0, F.col("wxx"))),
    }).withColumn("slope", F.coalesce("slope", "trend_slope"))
    dof = F.when(F.col("seasonal"), F.col("n") - 13).otherwise(F.col("n") - 2)
    rss = F.when(F.col("seasonal"), F.col("wyy") - F.col("slope") * F.col("wxy")).otherwise(
        F.col("tyy") - F.col("slope") * F.col("txy"))
    level = (F.col("sy") - F.col("trend_slope") * F.col("st")) / F.col("n")
    season = F.when(F.col("seasonal"), F.transform(
        "months", lambda m: (m["sy"] - F.col("slope") * m["st"]) / m["n"]))
    return slopes.select(
        *keys, F.col("n").cast("bigint").alias("n"), "last_ds",
        F.when(F.col("seasonal"), "season").when(F.col("txx") > 0, "trend").otherwise("level")
        .alias("model"), "mean", "trend_slope", "slope",
        level.alias("level"), season.alias("season"),
        F.when(dof > 0, F.sqrt(F.greatest(rss, F.lit(0.0)) / dof)).alias("sigma"))


def predict(ds: str | Column, model: str = "season") -> Column:
    """Value at a date from the columns of :func:`fit`.

    ``mean`` and ``trend`` are the simpler models used as steps of a comparison.
    """
    t = time_index(ds).cast("double")
    if model == "mean":
        return F.col("mean")
    trend = F.col("level") + F.col("trend_slope") * t
    if model == "trend":
        return trend
    return F.when(F.col("season").isNotNull(),
                  F.element_at("season", F.month(ds)) + F.col("slope") * t).otherwise(trend)


def interval(df: DataFrame, value: str = "forecast", sigma: str = "sigma") -> DataFrame:
    half = F.lit(fixed.Z_95) * F.col(sigma)
    return df.withColumns({"lower_bound": F.col(value) - half,
                           "upper_bound": F.col(value) + half})


def forecast(train: DataFrame, periods: int = fixed.HORIZON) -> DataFrame:
    """(series, ts, forecast, lower_bound, upper_bound) for the months after the panel's last.

    All series are forecast for the same months: one that ended earlier than others is carried
    on to them, so that shares of a month are shares of every series.
    """
    fitted = cut_lineage(fit(train, ["series"]))  # a row per series
    as_of = fitted.agg(F.max("last_ds")).scalar()
    ahead = add_horizon(fitted.withColumn("last_ds", as_of), "last_ds", periods, out="ts")
    return interval(ahead.withColumn("forecast", predict("ts"))).select(
        "series", "ts", "forecast", "lower_bound", "upper_bound")


def actual_and_forecast(train: DataFrame, result: DataFrame) -> DataFrame:
    """History and forecast in one frame, the other side NULL."""
    return append([
        train.select("ds", "series", F.col("y").alias("actual")),
        result.select(F.col("ts").alias("ds"), "series",
                      F.col("forecast").alias("forecast_val"), "lower_bound", "upper_bound")])


def future_frame(last: DataFrame, calendar: DataFrame, periods: int,
                 calendar_columns: dict[str, int]) -> DataFrame:
    """Exogenous values ahead: calendar columns are known (default where the calendar ends),
    everything else keeps its last value. ``last`` has series, last_ds and the other columns."""
    ahead = add_horizon(last, "last_ds", periods).withColumn(
        "ym", F.date_format("ds", "yyyyMM"))
    joined = ahead.join(calendar.select("ym", *calendar_columns), "ym", "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) for c, v in calendar_columns.items()}).drop("ym")
