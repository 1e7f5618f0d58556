"""Arithmetic whose result does not depend on row order or on the engine.

Money and quantities are exact to two decimals, so they are added as whole hundredths in
``bigint`` (codegen-friendly) and turned into ``double`` once, after the last sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(20,0)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: str | Column, b: int | Column) -> Column:
    """Whole-number division."""
    return F.call_function("div", col(a), b if isinstance(b, Column) else F.lit(b))


def hundredths(c: str | Column) -> Column:
    """Two-decimal double as whole hundredths."""
    return F.rint(col(c) * F.lit(100)).cast("bigint")


def wide_sum(c: str | Column) -> Column:
    """Sum of already aggregated integers in a decimal, out of reach of bigint overflow."""
    return F.sum(col(c).cast(WIDE))


def units_to_double(c: str | Column, digits: int) -> Column:
    """Whole units of 10**-digits as double: one correctly rounded division."""
    return col(c).cast("double") / F.lit(float(10 ** digits))


def exact_double(c: str | Column) -> Column:
    """Wide decimal to double as whole part plus fraction, so that no scale digit is lost."""
    return (F.floor(col(c)).cast("double")
            + F.pmod(col(c), F.lit(1).cast("decimal(1,0)")).cast("double"))


def guarded_ratio(num: str | Column, den: str | Column, otherwise: object = None) -> Column:
    """``num / den`` where ``den > 0``, else ``otherwise`` (NULL numerator stays NULL)."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(otherwise))


def pct_change(now: str | Column, before: str | Column) -> Column:
    """Percent change; 0 where there is no positive previous value."""
    return F.when(col(before) > 0,
                  (col(now) - col(before)) / col(before) * F.lit(100.0)).otherwise(F.lit(0.0))


def weighted_sum(weights: dict[str, float]) -> Column:
    """Sum of ``coalesce(column, 0) * weight`` in the given order."""
    total = None
    for name, weight in weights.items():
        term = F.coalesce(F.col(name), F.lit(0)).cast("double") * F.lit(float(weight))
        total = term if total is None else total + term
    return total


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round a double through a decimal, so that ties do not depend on the binary form."""
    return F.round(col(c).cast("decimal(24,6)"), digits).cast("double")


def rounded_int_ratio(num: str | Column, den: str | Column, digits: int) -> Column:
    """Non-negative integer ratio rounded half up in whole-number arithmetic."""
    scale = 10 ** digits
    num, den = col(num).cast("bigint"), col(den).cast("bigint")
    units = int_div(num * F.lit(2 * scale) + den, den * 2)
    return F.when(den > 0, units.cast("double") / F.lit(float(scale)))
