"""Line-first cleaning: judge every line, drop the failures, reject what loses too much text.

A line with words fails when one of three rules says so:

* punctuation: half of its words or more carry a run of symbols (two of ``#*$%&|<>!?=_~^``),
  or its symbols make up 30 % of its characters;
* navigation: three or more stand-alone separators (``|``, ``>``, ``»``, ``·``, ``•``) that
  make up a fifth of its words;
* boilerplate: at most 300 characters and one of the phrases in ``BOILERPLATE``.

A document goes when its base figures fail, or when the failed lines hold more than
``max_lost`` of its words. Everything is column arithmetic on the row, so nothing is shuffled
and a hot source or a group of copies changes nothing.

Null or empty text has no words, so its base figures fail and it is not kept; very long texts
are judged whole; repeated rows are judged alike, each for itself; an empty table gives an
empty result; other columns of the input, whatever their names, are neither read nor returned.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.llm.text import SPACE, words

WINDOW = 5
BASE_SYMBOLS = "#*$%&|<>"
SYMBOL_RUN = r"[#*$%&|<>!?=_~^]{2}"
SEPARATORS = "|>»·•"
SEPARATOR = r"(?<![^\x20\x09-\x0D])[|>»·•](?![^\x20\x09-\x0D])"
BOILERPLATE = (
    "licensed under", "all rights reserved", "copyright ©", "terms of use", "terms of service",
    "privacy policy", "cookie", "enable javascript", "lorem ipsum", "click here", "sign in",
    "sign up", "subscribe")


def let(value: Column, kind: str, then) -> Column:
    """``then(value)`` with the value computed once, wherever the optimizer moves it: a lambda
    must not look at an expression outside, or it is evaluated again for every element."""
    return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, x: then(x))


def window_hashes(w: Column) -> Column:
    """64-bit hash of every 5-word window; null below six words, where none can repeat."""
    return let(w, "array<bigint>", lambda x: F.when(F.size(x) > WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(x) - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(x, i + k) for k in range(WINDOW)]))))


def repeated_words(h: Column) -> Column:
    """Words inside windows that stand twice or more in the text, first ones included.

    Without two equal hashes the count is 0 at once; otherwise the starts of repeated windows
    are sorted and their stretches added up.
    """
    def starts(s: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(s, lambda p, k: (p["x"] == F.get(s, k - 1)["x"])
                     | F.coalesce(p["x"] == F.get(s, k + 1)["x"], F.lit(False))),
            lambda p: p["i"]))

    def covered(s: Column) -> Column:
        return F.aggregate(F.transform(s, lambda p, k: F.least(
            F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda a, x: a + x)

    def counted(x: Column) -> Column:
        pairs = F.sort_array(F.transform(x, lambda v, i: F.struct(v.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(x)) < F.size(x), let(
            pairs, "int", lambda s: let(starts(s), "int", covered))).otherwise(0)

    return let(h, "int", counted)


def line_fails(line: Column) -> Column:
    """One of the three rules holds for a line; cheap tests come before the patterns."""
    def without(chars: str) -> Column:
        return F.length(line) - F.length(F.translate(line, chars, ""))

    n = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    stock = F.aggregate(F.array(F.lower(line)), F.lit(False), lambda _, x: reduce(
        or_, [F.contains(x, F.lit(phrase)) for phrase in BOILERPLATE]))
    return ((line.rlike("[#*$%&|<>!?=_~^]")
             & ((F.regexp_count(line, F.lit(SYMBOL_RUN)) * 2 >= n)
                | (without("#*$%&|<>!?=_~^") * 10 >= F.length(line) * 3)))
            | (line.rlike(f"[{SEPARATORS}]") & (F.regexp_count(line, F.lit(SEPARATOR)) >= 3)
               & (F.regexp_count(line, F.lit(SEPARATOR)) * 5 >= n))
            | ((F.length(line) <= 300) & stock))


def clean_documents(docs: DataFrame, max_lost: float = 0.5, carry: bool = False) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: base figures, line figures, verdict, cleaned text.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines and n_failed_lines (lines with words), lost_words, kept, clean_text (the lines that
    passed, in order; null text gives null), and with ``carry`` the whole input row as ``row``.
    """
    row = [F.struct("*").alias("row")] if carry else []
    kept = ["row"] if carry else []
    body = docs.select("doc_id", F.col("text"), *row,
                       F.coalesce(F.col("text"), F.lit("")).alias("body"))
    split = body.select("doc_id", "text", "body", *kept, words(F.col("body")).alias("w"),
                        F.split("body", "\n").alias("lines"))
    # line and verdict stand in one struct: a lambda never looks into another array
    judged = split.select("doc_id", "text", "body", "w", *kept, window_hashes(F.col("w")).alias("h"),
                          F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
                          .alias("full"),
                          F.transform("lines", lambda x: F.struct(
                              x.alias("line"), line_fails(x).alias("fails"))).alias("marked"))
    cut = judged.select(
        "*", F.filter("marked", lambda x: x["fails"]).alias("failed"),
        F.filter("marked", lambda x: ~x["fails"]).alias("passed"))
    figures = cut.select(
        "doc_id", "text", "passed", *kept,
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.translate("body", SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", BASE_SYMBOLS, ""))).cast("bigint")
        .alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(repeated_words(F.col("h")), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size("full").cast("bigint").alias("n_lines"),
        F.size("failed").cast("bigint").alias("n_failed_lines"),
        F.aggregate("failed", F.lit(0), lambda a, x: a + F.regexp_count(
            x["line"], F.lit(r"[^\x20\x09-\x0D]+"))).cast("bigint").alias("lost_words"))
    base_failed = ((F.col("n_words") < 10)
                   | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return figures.withColumn("base_failed", base_failed).select(
        *kept, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_lines", "n_failed_lines", "lost_words",
        (~F.col("base_failed") & (F.col("lost_words") <= max_lost * F.col("n_words")))
        .alias("kept"),
        F.when(F.col("text").isNotNull(), F.array_join(
            F.transform("passed", lambda x: x["line"]), "\n")).alias("clean_text"))
