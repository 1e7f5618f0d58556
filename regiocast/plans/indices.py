"""Indices of measured quantities, and season levels in whole-number arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocast.functions.exact import int_div, round_half_up
from regiocast.plans import fixed


def _pick(values: list[int], index: Column) -> Column:
    """Entry of a small fixed list by zero-based index."""
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]),
                        (index + 1).cast("int"))


def season(values: list[int], month: Column) -> Column:
    """Seasonal multiplier (hundredths) of a calendar month 1-12."""
    return _pick(values, month - 1)


VISITS = {"domestic_visitor_idx": "visit_pop", "foreign_visitor_idx": "work_pop",
          "tourism_spend_idx": "total_sales"}


def visitor_indices(df: DataFrame, first_month: Column, key: str = "region") -> DataFrame:
    """Visiting population, working population and sales as indices of the region's base period,
    and their mean as the demand index, each to one decimal.

    The base period is the first ``BASE_MONTHS`` months from ``first_month``; its monthly mean is
    100. A region without a value in it has no index. ``df`` holds a row per region and month
    ``m`` with the three measures.
    """
    w = Window.partitionBy(key)
    base = {name: F.sum(F.when(F.col("m") < first_month + fixed.BASE_MONTHS, F.col(c).cast(
        "decimal(28,4)"))).over(w).cast("double") / float(fixed.BASE_MONTHS)
        for name, c in VISITS.items()}
    raw = df.withColumns({f"_{name}": F.when(base[name] > 0, F.col(c) * 100.0 / base[name])
                          for name, c in VISITS.items()})
    mean = sum((F.col(f"_{name}") for name in list(VISITS)[1:]), F.col(f"_{next(iter(VISITS))}"))
    return raw.withColumns({
        **{name: round_half_up(f"_{name}", 1) for name in VISITS},
        "tourism_demand_idx": round_half_up(mean / float(len(VISITS)), 1),
    }).drop(*[f"_{name}" for name in VISITS])


def seasonal_flow(base: Column, year: Column, month: Column) -> Column:
    """base * season * (1 + (year - base year) * growth), rounded half up to whole units."""
    units = base.cast("bigint") * season(fixed.SEASON_MOVING, month) * (
        F.lit(100).cast("bigint") + (year - fixed.FLOW_BASE_YEAR) * fixed.FLOW_GROWTH)
    return int_div(units * 2 + 10000, 20000)
