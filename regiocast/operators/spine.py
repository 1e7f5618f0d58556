"""Dense month spines and horizons, produced by generators instead of cross joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.functions.dates import month_no, ym_of_no


def dense_months(keys: DataFrame, facts: DataFrame, date: str) -> DataFrame:
    """Every key in every month between the first and the last fact."""
    lo = facts.agg(F.min(month_no(date))).scalar()
    hi = facts.agg(F.max(month_no(date))).scalar()
    return (keys.withColumn("m", F.explode(F.sequence(lo, hi)))
                .withColumn("ym", ym_of_no("m")))


def horizon(df: DataFrame, last: str, periods: int, step: str = "step",
            out: str = "ds") -> DataFrame:
    """Repeat each row for the next ``periods`` months after its date ``last``."""
    return (df.withColumn(step, F.explode(F.sequence(F.lit(1), F.lit(periods))))
              .withColumn(out, F.add_months(F.col(last), F.col(step))))
