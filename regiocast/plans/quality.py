"""Data-quality gates: grain, keys, coverage, scale, terms, links, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.operators.reshape import append


def missing_cells(spine: DataFrame, frame: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of the dense spine the frame lacks."""
    return spine.select(*keys).join(frame.select(*keys).distinct(), keys, "left_anti")


def grain_report(frame: DataFrame, spine: DataFrame, keys: list[str]) -> DataFrame:
    """Actual, distinct and expected row counts of a frame against its dense spine."""
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    expected = spine.agg(F.count(F.lit(1))).scalar()
    got = per_key.agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("key_count"))
    return got.withColumn("expected", expected).withColumns({
        "missing": F.col("expected") - F.col("key_count"),
        "complete": F.col("row_count") == F.col("expected")})


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    return (frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def orphans(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent row and how many child rows carry each.

    The child is reduced to distinct keys first, so a hot key is one row in the join.
    """
    keys = child.groupBy(F.col(foreign).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(key).distinct(), key, "left_anti")


def coverage(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null count and percentage per column, from one aggregation."""
    row = frame.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    return row.select("_n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null"))
        for c in columns]))).select(
        "column_name", F.col("_n").alias("total_rows"), "non_null",
        F.when(F.col("_n") > 0, F.col("non_null") * 100.0 / F.col("_n")).alias("pct"))


def scale_check(frame: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Observed minimum and maximum against the declared range."""
    row = frame.agg(*[e for c in ranges for e in (
        F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}"))])
    rows = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(float(lo)).alias("declared_min"),
                 F.lit(float(hi)).alias("declared_max"), F.col(f"lo_{c}").alias("observed_min"),
                 F.col(f"hi_{c}").alias("observed_max"))
        for c, (lo, hi) in ranges.items()])))
    return rows.withColumn("in_range", (F.col("observed_min") >= F.col("declared_min"))
                           & (F.col("observed_max") <= F.col("declared_max")))


def forbidden_terms(docs: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """How many documents contain each term, ignoring case; terms without hits report 0."""
    low = F.lower(F.col(text))
    row = docs.agg(*[F.count(F.when(F.contains(low, F.lit(term.lower())), 1)).alias(f"t{i}")
                     for i, term in enumerate(terms)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(term).alias("term"), F.col(f"t{i}").alias("documents"))
        for i, term in enumerate(terms)])))


def bare_url(url):
    """URL without query, fragment and closing slash."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/$", "")


def link_targets(pages: DataFrame) -> DataFrame:
    """Distinct link targets, resolved on the host of their page, with the number of links."""
    origin = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    links = pages.select(origin.alias("origin"), F.explode(
        F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))).alias("href"))
    target = F.when(F.col("href").rlike("^https?://"), F.col("href")).when(
        F.col("href").startswith("/"), F.concat("origin", "href"))
    return (links.select(bare_url(target).alias("target")).filter(F.col("target").isNotNull())
            .groupBy("target").agg(F.count(F.lit(1)).alias("links")))


def broken_links(pages: DataFrame) -> DataFrame:
    """Targets no page answers to. Both sides hold distinct URLs, so no URL is hot."""
    known = pages.select(bare_url(F.col("url")).alias("target")).distinct()
    return link_targets(pages).join(known, "target", "left_anti")


def contract_violations(tables: dict[str, DataFrame],
                        rules: list[tuple[str, str, int]]) -> DataFrame:
    """Rules (table, column, minimum length): rows where the value is missing or too short."""
    reports = []
    for name, df in tables.items():
        own = [(c, n) for table, c, n in rules if table == name]
        if not own:
            continue
        row = df.agg(F.count(F.lit(1)).alias("_n"), *[
            F.count(F.when(F.col(c).isNull() | (F.length(F.col(c).cast("string")) < n), 1))
            .alias(f"r{i}") for i, (c, n) in enumerate(own)])
        reports.append(row.select("_n", F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.lit(n).alias("min_length"), F.col(f"r{i}").alias("violations"))
            for i, (c, n) in enumerate(own)]))).select(
            "table_name", "column_name", "min_length", F.col("_n").alias("checked"),
            "violations", (F.col("violations") == 0).alias("ok")))
    return append(reports)
