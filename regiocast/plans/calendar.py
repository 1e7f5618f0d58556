"""Calendar features derived from dates, holidays and weekends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.functions.dates import ym_of
from regiocast.plans.fixed import FIXED_HOLIDAYS


def is_holiday(d: Column, month_days: list[str], dates: list[str]) -> Column:
    hit = F.date_format(d, "MMdd").isin(month_days)
    if dates:
        hit = hit | F.date_format(d, "yyyyMMdd").isin(dates)
    return hit


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def calendar_features(bounds: DataFrame, month_days: list[str] = FIXED_HOLIDAYS,
                      dates: list[str] | None = None) -> DataFrame:
    """Per month: weekday holidays, long weekends, business days.

    ``bounds`` holds one row ``(lo, hi)``. Whether a day is off depends on the day alone, so a
    long weekend (three or more days off in a row, counted in the month where it starts) is
    recognised from the day and its neighbours; no window over dates is needed, and none is
    lost at the edges.
    """
    dates = dates or []

    def off(shift: int) -> Column:
        day = F.date_add("d", shift)
        return is_weekend(day) | is_holiday(day, month_days, dates)

    days = bounds.select(
        F.explode(F.sequence(F.trunc("lo", "month"), F.last_day("hi"))).alias("d"))
    weekday = ~is_weekend(F.col("d"))
    holiday = is_holiday(F.col("d"), month_days, dates)
    return (
        days.groupBy(ym_of("d").alias("ym"))
        .agg(F.count(F.when(weekday & holiday, 1)).cast("int").alias("holiday_days"),
             F.count(F.when(~off(-1) & off(0) & off(1) & off(2), 1)).cast("int")
             .alias("long_weekend_cnt"),
             F.count(F.when(weekday & ~holiday, 1)).cast("int").alias("business_days"))
    )


def order_calendar(t, extra_months: int = 0) -> DataFrame:
    """Calendar over the months of the orders, optionally continued past the last one."""
    bounds = t.orders.agg(
        F.min("o_orderdate").cast("date").alias("lo"),
        F.add_months(F.max("o_orderdate").cast("date"), extra_months).alias("hi"))
    return calendar_features(bounds)
