"""Window-style operators that never pull a whole data set into one task.

``latest_per_key`` and ``first_per_key`` are partial aggregations, by hash where they can be. Global numbering and ranking
go through a range partitioning: each task numbers its own slice, and only one count per slice
is combined centrally, so the central part is bounded by the number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocast.session import cut_lineage


_FIXED = (T.BooleanType, T.IntegralType, T.FractionalType, T.DateType, T.TimestampType,
          T.TimestampNTZType)


def day_and_id(day: str, ident: str) -> Column:
    """A date and a ``bigint`` as one decimal that sorts like the pair; NULL if either is."""
    wide = F.lit("1" + "0" * 20).cast("decimal(21,0)")  # beyond twice any bigint
    return (F.unix_date(F.col(day).cast("date")).cast("decimal(10,0)") * wide
            + F.col(ident).cast("decimal(20,0)"))


def _picked(df: DataFrame, keys: list[str], order: str | Column, pick) -> DataFrame:
    """One row per key. Aggregate buffers of fixed width are updated in place, in a hash table;
    wider ones (strings, structs) make Spark sort the rows below the partial aggregate, so they
    are packed into a struct only where they occur."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.select(*keys, *rest, (F.col(order) if isinstance(order, str) else order)
                     .alias("_order"))
    kinds = {f.name: f.dataType for f in rows.schema}
    if all(isinstance(kinds[c], _FIXED) for c in [*rest, "_order"]):
        # equal orders: every column sees the same rows in the same sequence and keeps the same one
        return rows.groupBy(*keys).agg(*[pick(F.col(c), "_order").alias(c) for c in rest])
    return (rows.groupBy(*keys).agg(pick(F.struct(*rest), "_order").alias("_row"))
            .select(*keys, "_row.*"))


def latest_per_key(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """Row with the greatest ``order`` per key, combined in the tasks; without a sort where all
    columns and the order have a fixed width (see ``day_and_id``)."""
    return _picked(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """Row with the smallest ``order`` per key, as ``latest_per_key``."""
    return _picked(df, keys, order, F.min_by)


def _slices(df: DataFrame, *order: Column) -> DataFrame:
    """Range-partitioned, sorted, with a slice number and the position inside the slice.

    The frame is checkpointed because the slice bounds come from sampling and must be the same
    for every later use.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = ordered.withColumn("_id", F.monotonically_increasing_id())
    return cut_lineage(tagged).withColumns({
        "_slice": F.shiftright("_id", 33),
        "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    })


def _offsets(sliced: DataFrame, weight: Column) -> DataFrame:
    """Weight of all earlier slices; one row per slice, so the window is bounded."""
    w = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return (sliced.groupBy("_slice").agg(F.sum(weight).alias("_w"))
            .select("_slice", F.coalesce(F.sum("_w").over(w), F.lit(0)).alias("_before")))


def global_row_number(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """1-based position of every row in the total order (make the order unique)."""
    sliced = _slices(df, *order)
    offsets = _offsets(sliced, F.lit(1).cast("bigint"))
    return (sliced.join(F.broadcast(offsets), "_slice")
            .withColumn(name, (F.col("_before") + F.col("_pos") + 1).cast("bigint"))
            .drop("_slice", "_pos", "_id", "_before"))


def global_rank(df: DataFrame, name: str, value: str) -> DataFrame:
    """Rank by ``value`` from high to low, ties equal, NULL last.

    Works on distinct values and their counts, so even a value shared by a third of all rows
    is one row in the numbering; the rank then joins back on the value.
    """
    order = F.col(value).desc_nulls_last()
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    sliced = _slices(counts, order)
    offsets = _offsets(sliced, F.col("_n"))
    inside = Window.partitionBy("_slice").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, -1)
    ranks = (sliced.join(F.broadcast(offsets), "_slice")
             .select(F.col(value).alias("_value"),
                     (F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1)
                     .cast("bigint").alias(name)))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """value / sum(value) with the total as a one-row subquery instead of a global window.

    The total is added up in a decimal, so it does not depend on row order.
    """
    total = df.agg(F.sum(F.col(value).cast("decimal(28,4)")).cast("double")).scalar()
    return df.withColumn(name, F.when(total != 0, F.col(value) / total))


def forward_fill(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Carry the last non-null value forward inside each key."""
    w = (Window.partitionBy(*keys).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
