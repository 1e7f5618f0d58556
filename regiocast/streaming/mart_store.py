"""The feature mart kept up to date from order and line-item streams, with its dependent shares.

A micro-batch is reduced to mergeable sums before anything is stored:

* ``customer``: per (customer, month) what its orders and their lines add up to;
* ``supplier``: per (supplier, ship month) lines, quantities, prices;
* ``keys``: customer and month of every order seen, for lines that come later;
* ``waiting``: line sums of orders not seen yet. When the order comes, they move to ``customer``
  and leave here by their negative.

All four are added up by key, so batches may come late and in any order. The sums of a batch are
a delta; after ``COMPACT`` deltas they are merged with the base into a new base. Only the months a
batch touches are aggregated again on the customer side; the supplier side, where a late line may
move a supplier's first month, starts from the supplier months. The mart has a row per month and
region, and its shares are written with it.

A step becomes visible by one manifest row, written last: number, merged batches per stream, and
where base, deltas, mart and shares of this version lie. A batch that is in the marks already is
skipped, one that failed before its manifest is simply repeated. Readers pin a version; the
folders a version points to are not touched again before ``KEEP`` further versions, and they are
reused in turn, so their number does not depend on the number of batches. One writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.operators.reshape import append
from regiocast.operators.windows import share_of_total
from regiocast.plans import mart
from regiocast.plans.staging import (LINE_SUMS, ORDER_SUMS, SUPPLY_SUMS, customer_activity,
                                     facts_by_order, facts_by_supplier, line_facts, narrow_orders,
                                     order_measures, supplier_activity)
from regiocast.session import scratch_path
from regiocast.sources.sinks import replace_table
from regiocast.sources.tables import Tables
from regiocast.streaming.refresh import file_stream, run_available

COMPACT = 8
KEEP = 4
MANIFEST = "version bigint, body string, refreshed_at timestamp_ntz"


def _bigints(names: list[str]) -> str:
    return ", ".join(f"{c} bigint" for c in names)


STATE = {
    "customer": (["o_custkey", "m"], [*ORDER_SUMS, *LINE_SUMS],
                 f"o_custkey bigint, m int, {_bigints([*ORDER_SUMS, *LINE_SUMS])}"),
    "supplier": (["l_suppkey", "m"], SUPPLY_SUMS,
                 f"l_suppkey bigint, m int, {_bigints(SUPPLY_SUMS)}"),
    "keys": (["o_orderkey", "o_custkey", "m"], [], "o_orderkey bigint, o_custkey bigint, m int"),
    "waiting": (["l_orderkey"], LINE_SUMS, f"l_orderkey bigint, {_bigints(LINE_SUMS)}"),
}


@dataclass(frozen=True)
class Version:
    """What a manifest row says."""
    number: int = 0
    marks: tuple[tuple[str, int], ...] = ()
    base: int = -1  # generation of the base; -1: none yet
    deltas: tuple[int, ...] = ()

    def merged(self, stream: str) -> int:
        return dict(self.marks).get(stream, -1)


@dataclass
class MartStore:
    """State, mart and shares below ``root``; dimensions come from ``tables``."""
    tables: Tables
    root: str

    @property
    def spark(self) -> SparkSession:
        return self.tables.spark

    # ------------------------------------------------------------------ manifest
    def _commit(self, v: Version) -> None:
        body = json.dumps({"number": v.number, "marks": v.marks, "base": v.base,
                           "deltas": v.deltas})
        (self.spark.range(1).select(
            F.lit(v.number).cast("bigint").alias("version"), F.lit(body).alias("body"),
            F.current_timestamp().cast("timestamp_ntz").alias("refreshed_at"))
         .coalesce(1).write.mode("overwrite")
         .parquet(f"{self.root}/manifest/slot={v.number % (2 * KEEP)}"))

    def create(self) -> MartStore:
        """An empty store: version 0 without rows."""
        self._commit(Version())
        return self

    def versions(self) -> DataFrame:
        """The newest manifest rows."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest").select(
            "version", "body", "refreshed_at")

    def current(self) -> Version:
        row = self.versions().orderBy(F.desc("version")).first()
        body = json.loads(row["body"])
        return Version(body["number"], tuple(map(tuple, body["marks"])), body["base"],
                       tuple(body["deltas"]))

    # ------------------------------------------------------------------ state
    def _base(self, generation: int) -> str:
        return f"{self.root}/base-{generation % 3}"

    def _delta(self, number: int) -> str:
        return f"{self.root}/delta-{number % (2 * COMPACT + KEEP)}"

    def state(self, v: Version, name: str) -> DataFrame:
        """Base and deltas of a state table, not added up yet."""
        folders = [self._base(v.base)] * (v.base >= 0) + [self._delta(n) for n in v.deltas]
        schema = STATE[name][2]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{f}/{name}" for f in folders])

    def merged(self, v: Version, name: str, where=None, together: str | None = None) -> DataFrame:
        """A state table added up by key. ``together``: key column whose rows go to one task, for
        a join by that column behind it; base and deltas are added up each, so few meet there."""
        keys, sums, _ = STATE[name]
        rows = self.state(v, name)
        rows = rows if where is None else rows.filter(where)
        rows = rows if together is None else rows.repartition(together)
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]) if sums \
            else rows.distinct()

    def _orders(self, batch: DataFrame, v: Version) -> dict[str, DataFrame]:
        orders = narrow_orders(batch)
        # repeated rows leave where keys are read, so the first batch moves none of them
        keys = orders.select("o_orderkey", "o_custkey", "m")
        none = [F.lit(None).cast("bigint").alias(c) for c in LINE_SUMS]
        zero = [F.lit(0).cast("bigint").alias(c) for c in ORDER_SUMS]
        own = orders.groupBy("o_custkey", "m").agg(*order_measures()).select(
            "o_custkey", "m", *ORDER_SUMS, *none)
        if not v.number:
            return {"customer": own, "keys": keys}
        came = self.merged(v, "waiting").filter(F.col("lines") != 0).join(
            keys.distinct(), F.col("l_orderkey") == F.col("o_orderkey"))
        moved = came.groupBy("o_custkey", "m").agg(
            *[F.sum(c).alias(c) for c in LINE_SUMS]).select("o_custkey", "m", *zero, *LINE_SUMS)
        # a row whose lines add up to zero is gone, whatever its other sums
        gone = [F.lit(None).cast("bigint").alias(c) for c in LINE_SUMS if c != "lines"]
        return {"customer": own.unionByName(moved), "keys": keys,
                "waiting": came.select("l_orderkey", (-F.col("lines")).alias("lines"), *gone)}

    def _lines(self, batch: DataFrame, v: Version) -> dict[str, DataFrame]:
        facts = replace_table(line_facts(batch, self.tables.part),
                              scratch_path(self.spark, "line-facts"))
        frames = {"supplier": facts_by_supplier(facts)}
        by_order = facts_by_order(facts)
        if not v.number:
            return {**frames, "waiting": by_order}
        low, high = by_order.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
        # files are sorted by order, so these bounds skip pages
        keys = self.merged(v, "keys", F.col("o_orderkey").between(low or 0, high or 0),
                           "o_orderkey")
        match = F.col("l_orderkey") == F.col("o_orderkey")
        # the wide rows are shuffled for the orders seen only; those not seen are mostly few
        late = replace_table(by_order.select("l_orderkey").join(keys, match, "left_anti"),
                             scratch_path(self.spark, "late-orders"))
        zero = [F.lit(0).cast("bigint").alias(c) for c in ORDER_SUMS]
        return {**frames,
                "customer": by_order.join(keys, match).groupBy("o_custkey", "m").agg(
                    *[F.sum(c).alias(c) for c in LINE_SUMS]).select(
                    "o_custkey", "m", *zero, *LINE_SUMS),
                "waiting": by_order.join(
                    late.select(F.col("l_orderkey").alias("late")),
                    F.col("l_orderkey").eqNullSafe(F.col("late")), "left_semi")}

    def _write_state(self, folder: str, frames: dict[str, DataFrame]) -> None:
        for name, (keys, _, schema) in STATE.items():
            rows = frames.get(name)
            rows = self.spark.createDataFrame([], schema) if rows is None else rows
            first = "m" if "m" in keys and name != "keys" else keys[0]
            # sorted files let a filter skip pages; a range exchange would move every row again
            (rows.sortWithinPartitions(first, keys[0])
             .write.mode("overwrite").parquet(f"{folder}/{name}"))

    def _compacted(self, v: Version) -> Version:
        """Base and deltas merged into the next base; orders that came are no longer waited for."""
        frames = {name: self.merged(v, name) for name in STATE}
        frames["waiting"] = frames["waiting"].filter(F.col("lines") != 0)
        self._write_state(self._base(v.base + 1), frames)
        return replace(v, base=v.base + 1, deltas=())

    # ------------------------------------------------------------------ steps
    def apply(self, stream: str, batch: DataFrame, batch_id: int) -> None:
        """Merge a batch of ``orders`` or ``lineitem`` and refresh mart and shares. A repeated
        batch changes nothing."""
        v = self.current()
        if batch_id <= v.merged(stream):
            return
        number = v.number + 1
        delta = self._delta(number)
        self._write_state(delta, self._orders(batch, v) if stream == "orders"
                          else self._lines(batch, v))
        new = Version(number, tuple(sorted({**dict(v.marks), stream: batch_id}.items())), v.base,
                      (*v.deltas, number))
        self._refresh(v, new)
        if len(new.deltas) >= COMPACT:
            new = self._compacted(new)
        self._commit(new)

    def _slot(self, v: Version, name: str) -> str:
        return f"{self.root}/version-{v.number % (KEEP + 1)}/{name}"

    def _refresh(self, old: Version, new: Version) -> None:
        """Touched months again, the others from the version before; then what depends on them."""
        schema = STATE["customer"][2]
        touched = [r["m"] for r in self.spark.read.schema(schema).parquet(
            f"{self._delta(new.number)}/customer").select("m").distinct().collect()]  # months
        again = customer_activity(self.tables, months=self.merged(
            new, "customer", F.col("m").isin(touched), "o_custkey"))
        if old.number:
            kept = self.spark.read.schema(again.schema).parquet(self._slot(old, "activity"))
            again = append([kept.filter(~F.col("m").isin(touched)), again])
        again.write.mode("overwrite").parquet(self._slot(new, "activity"))
        activity = self.spark.read.schema(again.schema).parquet(self._slot(new, "activity"))
        suppliers = supplier_activity(self.tables, self.merged(new, "supplier"))
        table = mart.base_columns(mart.both_sides(activity, suppliers))
        table.write.mode("overwrite").parquet(self._slot(new, "mart"))
        shares = region_shares(self.spark.read.schema(table.schema).parquet(
            self._slot(new, "mart")))
        shares.write.mode("overwrite").parquet(self._slot(new, "shares"))

    def read(self, name: str = "mart", v: Version | None = None) -> DataFrame:
        """``mart`` or ``shares`` of a version, the current one by default."""
        v = v or self.current()
        if not v.number:
            raise ValueError("nothing merged yet")
        return self.spark.read.parquet(self._slot(v, name))

    def run(self, path: str, streams: tuple[str, ...] = ("orders", "lineitem"),
            files_per_trigger: int | None = None) -> MartStore:
        """Takes up everything that the streams hold by now, one stream after the other."""
        for stream in streams:
            run_available(file_stream(self.spark, path, stream, files_per_trigger),
                          lambda batch, n, s=stream: self.apply(s, batch, n),
                          f"{self.root}/checkpoint-{stream}")
        return self


def region_shares(table: DataFrame) -> DataFrame:
    """Sales per region over all months and their share."""
    totals = table.groupBy("region").agg(
        F.sum(F.col("total_sales").cast("decimal(38,4)")).cast("double").alias("total_sales"))
    return share_of_total(totals, "total_sales", "share")


def mart_store(t: Tables, name: str = "mart-store") -> MartStore:
    """A fresh store that has taken up all orders and line items of ``t``."""
    return MartStore(t, scratch_path(t.spark, name)).create().run(t.path)
