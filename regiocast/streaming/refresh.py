"""Incremental refresh with Structured Streaming.

Each micro-batch is reduced to partial sums per month before anything is stored. The partials
are written under the batch id, so a repeated batch overwrites itself, and only the months a
batch touches are rebuilt. State therefore grows with months, not with rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.functions.dates import month_no, ym_of_no
from regiocast.functions.exact import hundredths, units_to_double
from regiocast.operators.windows import latest_per_key, share_of_total
from regiocast.session import scratch_path
from regiocast.sources.sinks import replace_partitions
from regiocast.sources.tables import SCHEMAS


def file_stream(spark: SparkSession, path: str, table: str,
                files_per_trigger: int | None = None) -> DataFrame:
    """Stream over the files of a table; the pattern matches a file or a directory of files."""
    reader = spark.readStream.schema(SCHEMAS[table])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{path}/{table}*.parquet")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> None:
    """Process everything available now through ``sink`` and stop."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


PARTIAL = "series string, orders bigint, cents decimal(38,0), ym string, batch_id bigint"
MART = "series string, orders bigint, value double, ym string"


def order_partials(orders: DataFrame) -> DataFrame:
    """Mergeable sums per (month, series)."""
    return (orders.groupBy(month_no("o_orderdate").alias("m"),
                           F.col("o_orderpriority").alias("series"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.sum(hundredths("o_totalprice").cast("decimal(20,0)")).cast("decimal(38,0)")
                 .alias("cents"))
            .select("series", "orders", "cents", ym_of_no("m").alias("ym")))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partial sums to the mart row of each (month, series)."""
    return (partials.groupBy("ym", "series")
            .agg(F.sum("orders").alias("orders"), F.sum("cents").alias("cents"))
            .select("series", "orders", units_to_double("cents", 2).alias("value"), "ym"))


@dataclass
class OrderRefresh:
    """Monthly order mart kept up to date from a stream, with a dependent share table."""
    spark: SparkSession
    root: str

    @property
    def partials(self) -> str:
        return f"{self.root}/partials"

    @property
    def mart(self) -> str:
        return f"{self.root}/mart"

    @property
    def shares(self) -> str:
        return f"{self.root}/shares"

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Idempotent step: store the partials of this batch, rebuild the touched months,
        then the table that depends on them."""
        own = order_partials(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        replace_partitions(own, self.partials, ["batch_id", "ym"])
        stored = self.spark.read.schema(PARTIAL).parquet(self.partials)
        touched = stored.filter(F.col("batch_id") == batch_id).select("ym").distinct()
        rebuilt = merge_partials(stored.join(touched, "ym", "left_semi"))
        replace_partitions(rebuilt, self.mart, ["ym"])
        self.refresh_shares()

    def refresh_shares(self) -> None:
        totals = self.read().groupBy("series").agg(
            F.sum(F.col("value").cast("decimal(28,4)")).cast("double").alias("value"))
        share_of_total(totals, "value", "share").write.mode("overwrite").parquet(self.shares)

    def read(self) -> DataFrame:
        return self.spark.read.schema(MART).parquet(self.mart)

    def read_shares(self) -> DataFrame:
        return self.spark.read.schema("series string, value double, share double").parquet(
            self.shares)

    def run(self, path: str, files_per_trigger: int | None = None) -> OrderRefresh:
        stream = file_stream(self.spark, path, "orders", files_per_trigger)
        run_available(stream, self.apply, f"{self.root}/checkpoint")
        return self


def order_refresh(spark: SparkSession, path: str) -> OrderRefresh:
    return OrderRefresh(spark, scratch_path(spark, "order-refresh")).run(path)


def compare(incremental: DataFrame, full: DataFrame, keys: list[str]) -> DataFrame:
    """Per key whether the incremental table equals the full recomputation."""
    values = [c for c in full.columns if c not in keys]
    i = incremental.select(*keys, F.struct(*values).alias("_i"))
    f = full.select(*keys, F.struct(*values).alias("_f"))
    return i.join(f, keys, "full_outer").select(
        *keys, F.col("_i").eqNullSafe(F.col("_f")).alias("same"))


DAILY = "day date, event_type string, events bigint, cents decimal(38,0)"


def daily_sums(events: DataFrame) -> DataFrame:
    """Mergeable sums per day and type."""
    return (events.groupBy(F.col("ts").cast("date").alias("day"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(hundredths("value").cast("decimal(20,0)")).cast("decimal(38,0)")
                 .alias("cents")))


def daily_activity(spark: SparkSession, path: str,
                   files_per_trigger: int | None = None) -> DataFrame:
    """Events per day and type, refreshed from the stream.

    The sums of a batch are added to those of the batch before and written as one of two tables in
    turn, so a repeated batch gives the same table. State is a row per day and type; it needs no
    state store, which would commit a file per shuffle partition and batch.
    """
    root = scratch_path(spark, "daily-activity")
    last = -1

    def table(batch_id: int) -> DataFrame:
        return spark.read.schema(DAILY).parquet(f"{root}/table-{batch_id % 2}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        nonlocal last
        rows = daily_sums(batch)
        if batch_id:
            rows = table(batch_id - 1).unionByName(rows).groupBy("day", "event_type").agg(
                F.sum("events").alias("events"),
                F.sum("cents").cast("decimal(38,0)").alias("cents"))
        rows.write.mode("overwrite").parquet(f"{root}/table-{batch_id % 2}")
        last = batch_id

    run_available(file_stream(spark, path, "events", files_per_trigger), sink,
                  f"{root}/checkpoint")
    return table(last).select("day", "event_type", "events",
                              units_to_double("cents", 2).alias("value"))


def windowed_activity(spark: SparkSession, path: str, window: str = "1 hour",
                      lateness: str = "2 hours") -> DataFrame:
    """Tumbling event-time windows with a watermark.

    Update mode stores each changed window under its batch id; the newest version of a window
    is its result, so windows the watermark has not passed yet are present as well.
    """
    stream = file_stream(spark, path, "events").withColumn("at", F.col("ts").cast("timestamp"))
    agg = (stream.withWatermark("at", lateness)
           .groupBy(F.window("at", window), "event_type")
           .agg(F.count(F.lit(1)).alias("events"),
                F.sum(hundredths("value").cast("decimal(20,0)")).alias("_v"))
           .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                   "event_type", "events", "_v"))
    root = scratch_path(spark, "windowed-activity")

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("window_start", "event_type", "events",
                            units_to_double("_v", 2).alias("value"),
                            F.lit(batch_id).cast("bigint").alias("batch_id"))
        replace_partitions(rows, f"{root}/table", ["batch_id"])

    run_available(agg, sink, f"{root}/checkpoint", mode="update")
    stored = spark.read.schema(
        "window_start timestamp_ntz, event_type string, events bigint, value double,"
        " batch_id bigint").parquet(f"{root}/table")
    return latest_per_key(stored, ["window_start", "event_type"], "batch_id").drop("batch_id")


def freshness(log: DataFrame, target_seconds: int, as_of=None) -> DataFrame:
    """Latest refresh per component, its lag in seconds and whether it meets the target.

    ``log`` has component and refreshed_at; ``as_of`` defaults to the newest entry.
    """
    now = log.agg(F.max("refreshed_at")).scalar() if as_of is None else F.lit(as_of)
    latest = log.groupBy("component").agg(F.max("refreshed_at").alias("last_refresh"),
                                          F.count(F.lit(1)).alias("refreshes"))
    lag = F.timestamp_diff("SECOND", F.col("last_refresh"), now)
    return latest.withColumn("lag_seconds", lag).withColumn(
        "state", F.when(F.col("lag_seconds") > target_seconds, "LATE").otherwise("OK"))


def health_rows(log: DataFrame, target_seconds: int, as_of=None) -> DataFrame:
    """A row per component: type, last refresh, target lag, refresh and task state, and for a
    model its version, which counts its refreshes.

    ``log`` has component, component_type, row_count and refreshed_at. A downstream component has
    no lag of its own: its target is that of what it depends on. The task state is that of the
    newest run, which is EMPTY when it wrote no rows.
    """
    newest = log.groupBy("component").agg(
        F.max_by("component_type", "refreshed_at").alias("component_type"),
        F.max_by("row_count", "refreshed_at").alias("_rows"))
    fresh = freshness(log, target_seconds, as_of).select(
        F.col("component").alias("_c"), F.col("last_refresh").alias("last_refresh_time"),
        "refreshes", "lag_seconds", F.col("state").alias("refresh_state"))
    kind = F.col("component_type")
    return newest.join(fresh, F.col("component") == F.col("_c")).select(
        "component", "component_type", "last_refresh_time",
        F.when(kind == "DOWNSTREAM", "DOWNSTREAM").otherwise(f"{target_seconds} seconds")
        .alias("target_lag"), "lag_seconds", "refresh_state",
        F.when(F.col("_rows") > 0, "SUCCEEDED").otherwise("EMPTY").alias("task_state"),
        F.when(kind == "MODEL", F.concat(F.lit("v"), F.col("refreshes"))).alias("model_version"))
