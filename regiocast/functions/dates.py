"""Month keys. ``ym`` is a six-digit string, ``m`` a running month number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiocast.functions.exact import col, int_div


def month_no(date: str | Column) -> Column:
    """Running month number of a date or timestamp."""
    return F.year(col(date)) * F.lit(12) + F.month(col(date)) - F.lit(1)


def ym_of_no(m: str | Column) -> Column:
    """Month key of a running month number."""
    m = col(m).cast("int")
    return F.lpad((int_div(m, 12) * 100 + F.pmod(m, F.lit(12)) + 1).cast("string"), 6, "0")


def no_of_ym(ym: str | Column) -> Column:
    ym = col(ym)
    return (F.substring(ym, 1, 4).cast("int") * F.lit(12)
            + F.substring(ym, 5, 2).cast("int") - F.lit(1))


def ym_of(date: str | Column) -> Column:
    return F.date_format(col(date), "yyyyMM")


def first_day(ym: str | Column) -> Column:
    return F.to_date(F.concat(col(ym), F.lit("01")), "yyyyMMdd")


def shift_ym(ym: str | Column, months: int | Column) -> Column:
    return F.date_format(F.add_months(first_day(ym), months), "yyyyMM")


def calendar_month(ym: str | Column) -> Column:
    return F.substring(col(ym), 5, 2).cast("int")
