"""From forecasts and marts to shares, budgets, comparisons, alerts and context records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.functions.exact import round_half_up
from regiocast.functions.text import finite
from regiocast.operators.windows import global_rank, latest_per_key, share_of_total
from regiocast.plans import fixed
from regiocast.session import cut_lineage


def next_month_share(forecast: DataFrame) -> DataFrame:
    """Share (0-1) and share_pct (0-100) of each series in the first month ahead of the panel.

    Forecasts start behind the panel's last month for every series alike, so the first month
    holds all of them; of a frame made otherwise, the first month that all series reach is taken.

    The forecast is needed three times (first month, total, rows) and is small, so it is
    written once instead of running the pipeline below it again.
    """
    forecast = cut_lineage(forecast)
    first = forecast.groupBy("series").agg(F.min("ts").alias("ts")).agg(F.max("ts")).scalar()
    month = forecast.filter(F.col("ts") == first)
    shared = share_of_total(month, "forecast", "share")
    return shared.withColumns({
        "share": F.coalesce("share", F.lit(0.0)),
        "share_pct": F.coalesce(F.col("share") * 100.0, F.lit(0.0))})


def horizon_average(forecast: DataFrame) -> DataFrame:
    """(region, forecast): mean over the horizon."""
    mean = F.sum(F.col("forecast").cast("decimal(28,4)")).cast("double") / F.count("forecast")
    return forecast.groupBy(F.col("series").alias("region")).agg(mean.alias("forecast"))


def horizon_share(forecast: DataFrame) -> DataFrame:
    """Share of the mean forecast with its rank."""
    mean = cut_lineage(horizon_average(forecast))
    return global_rank(share_of_total(mean, "forecast", "share"), "priority_rank", "forecast")


def budget_split(forecast: DataFrame, budget: float) -> DataFrame:
    """Budget by forecast share: share to one decimal, money to whole units."""
    s = share_of_total(cut_lineage(horizon_average(forecast)), "forecast", "_share")
    return s.select("region", "forecast",
                    round_half_up(F.col("_share") * 100.0, 1).alias("share_pct"),
                    round_half_up(F.col("_share") * budget, 0).alias("budget"))


def split_json(split: DataFrame, budget: float) -> DataFrame:
    """One JSON record per region, so that any number of regions can be written out."""
    return split.select("region", F.to_json(F.struct(
        F.lit(int(budget)).cast("bigint").alias("total_budget"), "region",
        F.col("share_pct").cast("decimal(6,1)").alias("share_pct"),
        F.col("budget").cast("bigint").alias("budget"))).alias("payload"))


def channel_split(mart: DataFrame, budget: float,
                  channels: list[tuple[str, int]] = fixed.CHANNELS) -> DataFrame:
    """Budget per channel for every region next to the latest figures it rests on."""
    basis = ["move_in", "total_sales", "net_move", "sales_per_pop", "avg_asset"]
    latest = latest_per_key(mart.select("region", "ym", *basis), ["region"], "ym")
    rows = F.inline(F.array(*[
        F.struct(F.lit(name).alias("channel"),
                 F.round(F.lit(budget).cast("decimal(20,2)") * pct / 100, 0).cast("bigint")
                 .alias("budget"))
        for name, pct in channels]))
    return latest.select("region", "ym", *basis, rows)


def scenario_projection(scenarios: DataFrame, forecast: DataFrame, budget: float,
                        rate: float = fixed.CONVERSION_RATE) -> DataFrame:
    """Budget and expected contracts for many scenarios (scenario, region, pct) at once.

    A region without a forecast keeps its budget; its expected contracts are unknown (null).
    """
    f = horizon_average(forecast)
    return scenarios.join(f, "region", "left").select(
        "scenario", "region", "pct", F.col("forecast").alias("forecast_demand"),
        round_half_up(F.col("pct") / 100.0 * budget, 0).alias("budget"),
        round_half_up(F.col("forecast") * (F.col("pct") / 100.0) * rate, 0)
        .alias("expected_contracts"))


def compare_plan(regions: DataFrame, plan: DataFrame, user: DataFrame, budget: float,
                 default_pct: float | None = None,
                 limit: float = fixed.DEVIATION_LIMIT) -> DataFrame:
    """User percentages against the plan; a deviation above the limit is flagged. A region
    without a plan has an equal part of all regions, to one decimal, unless a default is given."""
    equal = regions.agg(F.round(F.lit(100.0) / F.count(F.lit(1)), 1)).scalar()
    default = equal if default_pct is None else F.lit(default_pct)
    joined = (regions.join(plan.select("region", F.col("pct").alias("plan_pct")), "region", "left")
              .join(user.select("region", F.col("pct").alias("user_pct")), "region", "left")
              .withColumns({"plan_pct": F.coalesce("plan_pct", default),
                            "user_pct": F.coalesce("user_pct", F.lit(0.0))}))
    gap = F.col("user_pct") - F.col("plan_pct")
    return joined.select(
        "region", "plan_pct", "user_pct", (F.col("plan_pct") / 100.0 * budget).alias("plan_budget"),
        (F.col("user_pct") / 100.0 * budget).alias("user_budget"), gap.alias("deviation"),
        F.when(F.abs(gap) > limit, F.when(gap < 0, "under").otherwise("over")).otherwise("ok")
        .alias("flag"))


def insights(latest: DataFrame) -> DataFrame:
    """Rule-based signals per region joined into one line."""
    move, chg = F.col("net_move"), F.col("sales_chg_pct")
    tourism, stable = F.col("tourism_demand_idx"), F.col("stability_score")
    rules = [
        (move > 0, "inflow lead"), (move < 0, "outflow lead"),
        (chg > fixed.SALES_MOVE_PCT, "sales rising"),
        (chg < -fixed.SALES_MOVE_PCT, "sales falling"),
        (tourism > fixed.TOURISM_HIGH, "tourism strong"),
        (stable < fixed.STABILITY_LOW, "stores unstable"),
        (stable > fixed.STABILITY_HIGH, "stores stable")]
    hits = F.filter(F.array(*[F.when(c, F.lit(label)) for c, label in rules]),
                    lambda x: x.isNotNull())
    return latest.select(
        "region", F.size(hits).alias("signals"),
        F.concat(F.col("region"), F.lit(": "),
                 F.when(F.size(hits) == 0, "steady overall")
                 .otherwise(F.concat_ws(" | ", hits))).alias("insight"))


SNAPSHOT = ["move_in", "move_out", "net_move", "total_pop", "total_sales", "avg_asset",
            "avg_sale_price", "age_20_39_share", "senior_60p_share", "tourism_demand_idx",
            "foreign_visitor_idx", "stability_score", "net_store_change", "holiday_days",
            "rental_count", "rental_conversion_rate", "cs_calls", "rental_signal"]


def latest_snapshot(mart: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Newest row per region, restricted to the columns the mart really has."""
    wanted = [c for c in (columns or SNAPSHOT) if c in mart.columns]
    return latest_per_key(mart.select("region", "ym", *wanted), ["region"], "ym")


def snapshot_kpis(latest: DataFrame) -> DataFrame:
    """Number of regions and totals of the newest rows; one row per region goes in."""
    return latest.agg(
        F.count("region").alias("regions"), F.max("ym").alias("latest_ym"),
        F.sum("net_move").cast("bigint").alias("net_move"),
        F.sum(F.col("total_sales").cast("decimal(28,4)")).cast("double").alias("total_sales"))


def context_json(shares: DataFrame, latest: DataFrame, importance: DataFrame,
                 top: int = 5) -> DataFrame:
    """One grounded JSON record per region, all regions in one job.

    ``shares``: series, forecast, share_pct. ``importance``: series, rank, feature_name,
    importance_score; only the top ranks are collected, so a list has at most ``top`` items.
    """
    features = (importance.filter(F.col("rank") <= top).groupBy(F.col("series").alias("region"))
                .agg(F.sort_array(F.collect_list(F.struct("rank", "feature_name",
                                                          "importance_score"))).alias("_top")))
    alloc = shares.select(F.col("series").alias("region"), finite("forecast").alias("forecast"),
                          finite("share_pct").alias("share_pct"))
    doubles = {n for n, kind in latest.dtypes if kind == "double"}

    def value(c):
        return finite(c).alias(c) if c in doubles else F.col(c)

    snapshot = F.struct(*[value(c) for c in latest.columns if c != "region"])

    def group(**fields):
        parts = [value(c).alias(name) for name, c in fields.items() if c in latest.columns]
        return F.struct(*parts) if parts else F.lit(None)

    base = latest.join(alloc, "region", "left").join(features, "region", "left")
    return base.select("region", F.to_json(F.struct(
        F.col("region").alias("scope"),
        F.struct("forecast", "share_pct").alias("next_month_allocation"),
        snapshot.alias("latest_snapshot"), F.col("_top").alias("top_features"),
        group(holiday_count="holiday_days").alias("holiday"),
        group(young_adult_share="age_20_39_share", senior_share="senior_60p_share")
        .alias("demographics"),
        group(tourism_demand="tourism_demand_idx", foreign_visitor="foreign_visitor_idx")
        .alias("tourism"),
        group(stability_score="stability_score", net_store_change="net_store_change")
        .alias("commercial_stability"))).alias("context"))
