"""Metric catalogue and verified business questions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.functions.dates import shift_ym
from regiocast.functions.exact import round_half_up
from regiocast.plans.decide import next_month_share
from regiocast.session import cut_lineage


def _total(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(28,4)")).cast("double")


def _mean(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(28,6)")).cast("double") / F.count(c)


def _ratio(a: str, b: str) -> Column:
    return F.when(_total(b) != 0, _total(a) / _total(b))


@dataclass(frozen=True)
class Metric:
    table: str
    build: Callable[[], Column]
    synonyms: tuple[str, ...]
    comment: str


METRICS: dict[str, Metric] = {
    "total_pop": Metric("mart", lambda: _total("total_pop"),
                        ("population", "people"), "Total population"),
    "res_pop": Metric("mart", lambda: _total("res_pop"), ("residents",), "Resident population"),
    "work_pop": Metric("mart", lambda: _total("work_pop"), ("workers", "commuters"),
                       "Working population"),
    "visit_pop": Metric("mart", lambda: _total("visit_pop"), ("visitors",),
                        "Visiting population"),
    "total_sales": Metric("mart", lambda: _total("total_sales"),
                          ("sales", "revenue", "spending"), "Card sales"),
    "total_tx_count": Metric("mart", lambda: F.sum("total_tx_count"),
                             ("transactions",), "Transactions"),
    "economy_sales": Metric("mart", lambda: _total("economy_sales"), ("economy",),
                            "Sales in the economy category"),
    "promo_sales": Metric("mart", lambda: _total("promo_sales"), ("promo",),
                          "Sales in the promo category"),
    "customers": Metric("mart", lambda: F.sum("customers"), ("clients",),
                        "Active customers, added over months"),
    "avg_income": Metric("mart", lambda: _mean("avg_income"), ("income",), "Mean income"),
    "avg_asset": Metric("mart", lambda: _mean("avg_asset"), ("assets", "wealth"), "Mean assets"),
    "avg_sale_price": Metric("mart", lambda: _mean("avg_sale_price"), ("price", "housing"),
                             "Mean sale price"),
    "net_move": Metric("mart", lambda: F.sum("net_move"), ("migration", "moves"),
                       "Net movement"),
    "move_in": Metric("mart", lambda: F.sum("move_in"), ("arrivals",), "Incoming moves"),
    "move_out": Metric("mart", lambda: F.sum("move_out"), ("departures",), "Outgoing moves"),
    "sales_per_pop": Metric("mart", lambda: _ratio("total_sales", "total_pop"),
                            ("spending per head",), "Sales per head"),
    "tourism_demand_idx": Metric("mart", lambda: _mean("tourism_demand_idx"), ("tourism",),
                                 "Tourism demand index"),
    "stability_score": Metric("mart", lambda: _mean("stability_score"), ("stability",),
                              "Store stability"),
    "rental_count": Metric("mart", lambda: F.sum("rental_count"), ("rentals",), "Rentals"),
    "conversion_rate": Metric("mart", lambda: _ratio("rental_count", "move_in"),
                              ("conversion",), "Rentals per incoming move"),
    "next_forecast": Metric("forecast", lambda: _total("forecast"), ("forecast", "outlook"),
                            "Forecast"),
    "mean_error_pct": Metric("backtest", lambda: _mean("error_pct"), ("accuracy", "error"),
                             "Mean absolute error in percent"),
}


def resolve(term: str) -> str:
    """Metric name of a name or synonym."""
    term = term.strip().lower()
    if term in METRICS:
        return term
    for name, metric in METRICS.items():
        if term in metric.synonyms:
            return name
    raise KeyError(term)


def synonym_rows() -> list[tuple[str, str]]:
    return [(s, name) for name, m in METRICS.items() for s in (name, *m.synonyms)]


def run_metrics(frames: dict[str, DataFrame], metrics: list[str], by: list[str],
                where: Column | None = None) -> DataFrame:
    """Metrics (names or synonyms of one table) by dimensions under a filter."""
    names = [resolve(m) for m in metrics]
    tables = {METRICS[n].table for n in names}
    if len(tables) != 1:
        raise ValueError(f"metrics of several tables in one query: {sorted(tables)}")
    df = frames[tables.pop()]
    if where is not None:
        df = df.filter(where)
    return df.groupBy(*by).agg(*[METRICS[n].build().alias(n) for n in names])


SCALE = 10000.0


def _newest(mart: DataFrame, through: Column | None) -> DataFrame:
    """Rows of the newest month up to ``through``, the last complete one; of the newest at all
    where that is not given. The mart is read twice, so it is written once first."""
    mart = cut_lineage(mart if through is None else mart.filter(F.col("ym") <= through))
    return mart.filter(F.col("ym") == mart.agg(F.max("ym")).scalar())


def share_all(forecast: DataFrame) -> DataFrame:
    return next_month_share(forecast).select(
        F.col("series").alias("region"),
        round_half_up(F.col("forecast") / SCALE, 1).alias("forecast_10k"),
        round_half_up("share_pct", 1).alias("share_pct"))


def top_region(forecast: DataFrame) -> DataFrame:
    best = next_month_share(forecast).orderBy(F.col("forecast").desc_nulls_last(), "series").limit(1)
    return best.select(F.col("series").alias("region"),
                       round_half_up(F.col("forecast") / SCALE, 1).alias("forecast_10k"),
                       round_half_up("share_pct", 1).alias("share_pct"))


def why_higher(mart: DataFrame, regions: list[str],
               through: Column | None = None) -> DataFrame:
    return _newest(mart, through).filter(F.col("region").isin(regions)).select(
        "region", round_half_up(F.col("total_sales") / SCALE, 1).alias("sales_10k"),
        "total_pop", round_half_up("sales_per_pop", 0).alias("sales_per_pop"), "visit_pop",
        round_half_up("tourism_demand_idx", 1).alias("tourism_demand_idx"))


def sales_per_business_day(mart: DataFrame, through: Column | None = None) -> DataFrame:
    daily = F.when(F.col("business_days") > 0, F.col("total_sales") / F.col("business_days"))
    return _newest(mart, through).select(
        "region", round_half_up(F.col("total_sales") / SCALE, 1).alias("sales_10k"),
        "holiday_days", "business_days", round_half_up(daily / SCALE, 2).alias("daily_sales_10k"))


def sales_trend(mart: DataFrame, n_months: int = 3) -> DataFrame:
    """Exactly the last n months; the change is already a percentage."""
    mart = cut_lineage(mart)
    bound = mart.agg(F.max("ym").alias("ym")).select(shift_ym("ym", -n_months)).scalar()
    return mart.filter(F.col("ym") > bound).select(
        "ym", "region", round_half_up(F.col("total_sales") / SCALE, 1).alias("sales_10k"),
        round_half_up("sales_chg_pct", 1).alias("change_pct"))


def net_migration(mart: DataFrame, through: Column | None = None) -> DataFrame:
    return _newest(mart, through).select(
        "region", "net_move", "move_in", "move_out",
        F.when(F.col("net_move") > 0, "inflow lead").otherwise("outflow lead").alias("verdict"))


def price_comparison(mart: DataFrame, through: Column | None = None) -> DataFrame:
    return _newest(mart, through).select(
        "region", round_half_up("avg_price_per_unit", 0).alias("price_per_unit"),
        round_half_up("avg_sale_price", 1).alias("sale_price"),
        round_half_up("price_to_asset_ratio", 2).alias("price_to_asset"))


def youth_and_sales(mart: DataFrame, through: Column | None = None) -> DataFrame:
    return _newest(mart, through).select(
        "region", round_half_up(F.col("age_20_39_share") * 100.0, 1).alias("young_pct"),
        round_half_up(F.col("total_sales") / SCALE, 1).alias("sales_10k"),
        round_half_up(F.col("economy_sales") / SCALE, 2).alias("economy_10k"))


def region_interval(forecast: DataFrame, regions: list[str]) -> DataFrame:
    f = forecast.filter(F.col("series").isin(regions))
    width = F.when(F.col("forecast") != 0, (F.col("upper_bound") - F.col("lower_bound"))
                   / F.col("forecast") * 100.0)
    return f.select(F.col("series").alias("region"), "ts",
                    *[round_half_up(F.col(c) / SCALE, 1).alias(f"{c}_10k")
                      for c in ["forecast", "lower_bound", "upper_bound"]],
                    round_half_up(width, 1).alias("width_pct"))
