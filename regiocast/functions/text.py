"""Text helpers that stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiocast.functions.exact import col, round_half_up


def tokens(text: str | Column) -> Column:
    """Lower-case words (letters of any script) of the whole text, cut at everything else."""
    return F.array_remove(F.split(F.lower(col(text)), r"[^\p{L}]+"), "")


def clean_label(c: str | Column, fallback: str = "ALL") -> Column:
    """Strip blanks and double quotes; NULL, empty and textual nulls become ``fallback``."""
    bare = F.trim(F.regexp_replace(F.trim(col(c)), '"', ""))
    return F.when(bare.isNull() | F.upper(bare).isin("", "NULL", "NONE", "NAN"),
                  F.lit(fallback)).otherwise(bare)


def outer_braces(text: str | Column) -> Column:
    """Span from the first opening to the last closing brace, NULL if there is none."""
    span = F.regexp_extract(col(text), r"(?s)(\{.*\})", 1)
    return F.when(span != "", span)


def finite(c: str | Column) -> Column:
    """NaN and infinities to NULL."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def thousands(c: str | Column, digits: int = 0) -> Column:
    return F.format_number(col(c), digits)


def percent(c: str | Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", round_half_up(c, digits))
