"""Column helpers shared by the operators: words, lines, lower case, folds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"  # what separates words, and nothing else does
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Maximal runs of characters other than blank and U+0009 to U+000D; null text: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal digits, modulo ``n``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0)).cast("int")
