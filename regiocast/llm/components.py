"""Connected components of an edge table: spanning forests, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.session import cut_lineage

TASK_EDGES = 100_000  # edges that a task holds at once


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges ``u - v`` and the least node that each one is connected with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, root = at[:len(u)], at[len(u):], np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def forests(pairs: DataFrame, all_nodes: bool = False) -> DataFrame:
    """Rows (u, v) that connect what ``pairs (u, v)`` connect, fewer than nodes for each task's
    ``TASK_EDGES`` edges: each node with the least one that it reaches there; with ``all_nodes``
    the least ones with themselves too."""
    most = TASK_EDGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def forest() -> pa.RecordBatch:
            nodes, roots = spanning(*(np.concatenate(x) for x in zip(*held)))
            keep = (nodes != roots) | all_nodes
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes[keep]), pa.array(roots[keep])], ["u", "v"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("u", "v")))
            n += batch.num_rows
            if n > most:
                yield forest()
                held, n = [], 0
        if n:
            yield forest()

    return pairs.mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges (a, b)``; root: the component's least node.

    Each task first replaces its edges by a spanning forest of them. Where ``TASK_EDGES`` or fewer
    edges are left, one more task of that bounded size ends the job; a larger table goes on in
    rounds of stars over all tasks.
    """
    pairs = cut_lineage(forests(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    if pairs.count() <= TASK_EDGES:
        return cut_lineage(forests(pairs.coalesce(1), all_nodes=True)).select(
            F.col("u").alias("node"), F.col("v").alias("root"))
    roots = by_stars(pairs).select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def by_stars(edges: DataFrame) -> DataFrame:
    """Rows (u, v): every node of ``edges (u, v)``, v less than u, but the least of its component
    with that least one.

    Each round hangs the neighbours of a node on the least node it knows; the number of rounds
    grows with the logarithm of the longest path. Minima are pre-aggregated before the shuffle,
    and the joins on a node are plain equality joins, which adaptive execution splits when a
    node has very many neighbours. Nothing is collected but one checksum a round.
    """
    pairs = cut_lineage(edges.distinct())
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = cut_lineage(large.join(low, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).distinct())
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if now == before:
            return pairs
        before = now
