"""Top-k operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


PRUNED_BY_SPARK = 1000  # default of spark.sql.optimizer.windowGroupLimitThreshold
SLICES = 64


def top_k_per_group(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """First k rows per key, for any k; before a key's rows meet, they are cut to k in each of
    ``SLICES`` slices of it, and below a threshold of Spark's also in each task."""
    if k > PRUNED_BY_SPARK:
        sliced = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = (df.withColumn("_slice", F.spark_partition_id() % SLICES)
              .withColumn("_rn", F.row_number().over(sliced))
              .filter(F.col("_rn") <= k).drop("_rn", "_slice"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def top_k_with_fallback(df: DataFrame, scopes: DataFrame, scope: str, fallback: str, k: int,
                        *order: Column) -> DataFrame:
    """Top k per wanted scope; a scope without rows gets the rows of ``fallback``."""
    best = top_k_per_group(df, [scope], k, *order)
    wanted = scopes.select(scope).distinct()
    own = best.join(wanted, scope, "left_semi").withColumn("source_scope", F.col(scope))
    # the fallback's k rows are one value of a subquery, so no rows meet on its key
    rest = [c for c in best.columns if c != scope]
    rows = best.filter(F.col(scope) == fallback).agg(
        F.collect_list(F.struct(*rest)).alias("rows")).scalar()
    missing = wanted.join(best.select(scope).distinct(), scope, "left_anti")
    borrowed = missing.select(scope, F.inline(rows)).withColumn("source_scope", F.lit(fallback))
    return own.unionByName(borrowed)
