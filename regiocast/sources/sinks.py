"""Sinks: replaceable tables, partition overwrite, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write the query result over ``path`` and read it back."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions that occur in ``df``; repeating the write is harmless.

    The rebalance hint brings the rows of a partition together, so that it becomes few files,
    and still splits a partition that is too large for one task.
    """
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def as_json(df: DataFrame, keep: list[str], name: str = "payload") -> DataFrame:
    """Keep the key columns, pack the rest into one JSON object (NULL fields are left out)."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*rest)).alias(name))
