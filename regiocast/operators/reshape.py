"""Long to wide, wide to long, appended frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_max(df: DataFrame, keys: list[str], name: str, value: str,
              labels: dict[str, str]) -> DataFrame:
    """One column per listed label (matched without case); no scan for the labels."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.upper(F.col(name)) == label.upper(), F.col(value))).alias(out)
        for label, out in labels.items()])


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str,
            value: str) -> DataFrame:
    """One row per key and column, the value as double."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, columns, name, value)


def append(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def overlay(df: DataFrame, key: str, series: str, actual: str, forecast: str,
            names: list[str]) -> DataFrame:
    """Wide actuals and wide forecasts by date, full-outer joined."""
    def wide(value, suffix):
        known = df.filter(F.col(value).isNotNull())
        return known.groupBy(key).agg(*[
            F.max(F.when(F.col(series) == n, F.col(value))).alias(f"{n}_{suffix}") for n in names])
    return wide(actual, "actual").join(wide(forecast, "forecast"), key, "full_outer")
