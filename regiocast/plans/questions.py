"""Question routing, scope rule, and validation of structured answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.functions.exact import col
from regiocast.functions.text import outer_braces, tokens


@dataclass(frozen=True)
class Category:
    """A question category, the metric that answers it, and the words that point to it.

    The order of the list of categories is the priority on equal hits.
    """
    name: str
    metric: str
    terms: tuple[str, ...]
    needs_region: bool = True


def _one_of(terms):
    return lambda word: word.isin(list(terms))


def route(questions: DataFrame, text: str, categories: list[Category]) -> DataFrame:
    """Category with the most term hits per question, ``none`` without hits.

    Everything happens inside the row: no explode, no shuffle.
    """
    words = questions.withColumn("_words", tokens(text))
    hits = [F.size(F.filter("_words", _one_of(c.terms))) for c in categories]
    scored = F.array(*[
        F.struct(h.alias("hits"), F.lit(-i).alias("order"), F.lit(c.name).alias("category"),
                 F.lit(c.metric).alias("metric")) for i, (c, h) in enumerate(
            zip(categories, hits))])
    best = words.withColumn("_best", F.array_max(scored))
    found = F.col("_best.hits") > 0
    return best.withColumns({
        "hits": F.col("_best.hits"),
        "category": F.when(found, F.col("_best.category")).otherwise("none"),
        "metric": F.when(found, F.col("_best.metric")),
    }).drop("_words", "_best")


def _spaced(words: Column) -> Column:
    """Words with a blank of their own on either side."""
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def phrase_pattern(terms: list[str]) -> str:
    """One alternation over all terms, longest first: of several that start at a word the longest
    is taken, and its words are used up. Terms hold letters, digits, underscores and blanks."""
    known = sorted({" ".join(t.lower().split()) for t in terms}, key=lambda t: (-len(t), t))
    return " (" + "|".join(t.replace(" ", "  ") for t in known) + ") "


def route_phrases(questions: DataFrame, text: str, categories: list[Category]) -> DataFrame:
    """As ``route``, with terms of one or more words, matched from left to right.

    Adds ``phrases``, the terms found. Null text finds nothing. All inside the row.
    """
    words = F.regexp_extract_all(F.lower(col(text)), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    pattern = phrase_pattern([t for c in categories for t in c.terms])
    found = F.transform(F.regexp_extract_all(_spaced(words), F.lit(pattern), F.lit(1)),
                        lambda p: F.replace(p, F.lit("  "), F.lit(" ")))
    scored = F.array(*[
        F.struct(F.size(F.filter("phrases", _one_of([t.lower() for t in c.terms]))).alias("hits"),
                 F.lit(-i).alias("order"), F.lit(c.name).alias("category"),
                 F.lit(c.metric).alias("metric")) for i, c in enumerate(categories)])
    best = questions.withColumn(
        "phrases", F.coalesce(found, F.array().cast("array<string>"))).withColumn(
        "_best", F.array_max(scored))
    hit = F.col("_best.hits") > 0
    return best.withColumns({
        "hits": F.col("_best.hits"),
        "category": F.when(hit, F.col("_best.category")).otherwise("none"),
        "metric": F.when(hit, F.col("_best.metric")),
    }).drop("_best")


def _joined(words: str, n: int):
    return lambda i: F.array_join(F.slice(words, i, n), " ")


def scope_rule(routed: DataFrame, text: str, regions: DataFrame, keys: list[str],
               categories: list[Category]) -> DataFrame:
    """Mark questions that name no region and are not about a comparison.

    Region names are matched as runs of words (letters, digits and underscores), as long as the
    longest name: "New York" is found in "why new york?".
    """
    def words(c: Column) -> Column:
        return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))

    names = regions.select(F.array_join(words(F.col("region")), " ").alias("_word"),
                           F.size(words(F.col("region"))).alias("_n")).distinct()
    longest = names.agg(F.max("_n")).first()[0] or 0
    runs = [F.when(F.size("_w") >= n, F.transform(
        F.sequence(F.lit(1), F.size("_w") - n + 1),
        _joined("_w", n)))
        .otherwise(F.array().cast("array<string>")) for n in range(1, longest + 1)]
    asked = routed.select(*keys, words(col(text)).alias("_w"))
    found = F.array_distinct(F.flatten(F.array(*runs))) if runs else F.col("_w")
    named = (asked.select(*keys, F.explode(found).alias("_word"))
             .join(names, "_word", "left_semi").select(*keys).distinct()
             .withColumn("names_region", F.lit(True)))
    free = [c.name for c in categories if not c.needs_region]
    return routed.join(named, keys, "left").withColumns({
        "names_region": F.coalesce("names_region", F.lit(False)),
    }).withColumn("needs_clarification",
                  ~F.col("names_region") & ~F.col("category").isin(free))


ANSWER = ("answer string, recommended_region string, allocation_pct double, "
          "drivers array<string>, risk string, next_action string")


def parse_answers(raw: DataFrame, text: str) -> DataFrame:
    """Six answer fields from JSON inside free text; other text becomes the answer itself."""
    span = outer_braces(text)
    parsed = raw.withColumn("_a", F.from_json(span, ANSWER))
    ok = F.col("_a.answer").isNotNull()
    return parsed.withColumns({
        "parsed": F.coalesce(ok, F.lit(False)),
        "answer": F.coalesce("_a.answer", F.trim(col(text))),
        "recommended_region": F.when(ok, F.col("_a.recommended_region")).otherwise("-"),
        "allocation_pct": F.when(ok, F.col("_a.allocation_pct")),
        "drivers": F.coalesce("_a.drivers", F.array().cast("array<string>")),
        "risk": F.coalesce("_a.risk", F.lit("")),
        "next_action": F.coalesce("_a.next_action", F.lit("")),
    }).drop("_a")
