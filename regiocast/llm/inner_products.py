"""Exact top-k by inner product: norm-sorted blocks, rotated partial sums, residual bounds.

All vectors are turned by the eigenvectors of their Gram matrix (the right singular vectors of
the whole table), so that most of a product lies in the first coordinates. Candidates are dealt
by descending length into blocks. Every query first meets the block of the longest candidates,
which gives it a threshold, its k-th best score so far. After that a (query block, candidate
block) pair is worked on only if some query's length times the block's greatest length reaches
its threshold; inside, partial sums over the first ``head`` turned coordinates, then four times
as many, plus the Cauchy-Schwarz bound of the rest decide which queries and candidates go on. What
is left gets its exact integer products as one matrix product per slice of candidates.
Thresholds rise during a task, and a bound carries a margin for rounding, so nothing that
belongs to the result is pruned.

Candidates and queries travel as packed blocks of bounded size; queries meet candidate blocks
through an equality join on the block number. Hits are reduced to k per query within a task
before they are shuffled.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part;
shorter vectors count as padded with zeros; components are floor(scale * x), held within +-2^53. A repeated id is every
time a candidate of the others, never of itself; as a query the smallest of its vectors asks.
Scores are exact; one beyond 64 bits is cut to the nearest 64-bit number after ranking. An empty
table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocast.session import cut_lineage

BLOCK = 4096  # candidates or queries in a packed block
HELD = 2.0 ** 53
SLICE = 1024  # candidates of a block that are compared at a time
LIMITS = -(1 << 63), (1 << 63) - 1


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                         & (F.abs(x) < float("inf")))


def unpack(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<f8").reshape(-1, width)


def pack_blocks(rows: DataFrame, scale: int, width: int) -> DataFrame:
    """Rows (id, vector) of a partition as packed blocks: ids and integer components."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if not len(frame):
                continue
            sizes = frame["vector"].map(len).to_numpy()
            matrix = np.zeros((len(frame), width))
            matrix[np.arange(width) < sizes[:, None]] = np.clip(np.floor(np.concatenate(
                [np.asarray(v, dtype=np.float64) for v in frame["vector"]]) * scale), -HELD, HELD)
            for lo in range(0, len(frame), BLOCK):
                part = matrix[lo:lo + BLOCK]
                norms = np.sqrt(np.einsum("ij,ij->i", part, part))
                order = np.argsort(-norms, kind="stable")
                yield pd.DataFrame({
                    "ids": [frame["id"].to_numpy(dtype="<i8")[lo:lo + BLOCK][order].tobytes()],
                    "matrix": [part[order].astype("<f8").tobytes()],
                    "longest": [float(norms.max())]})

    return rows.select("id", "vector").mapInPandas(
        pack, "ids binary, matrix binary, longest double")


def gram_rotation(blocks: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first, from one width x width matrix."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in batches:
            for raw in frame["matrix"]:
                m = unpack(raw, width)
                m = m / max(1.0, np.abs(m).max(initial=0.0))
                total += m.T @ m
        yield pd.DataFrame({"i": np.arange(width), "row": list(total)})

    sums = blocks.select("matrix").mapInPandas(partial, "i int, row array<double>").select(
        "i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((width, width))
    for r in sums.collect():  # width squared numbers
        gram[r.i, r.j] = r.x
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    return vectors[:, np.argsort(-values, kind="stable")]


def survivors(q: np.ndarray, c: np.ndarray, rotation: np.ndarray, head: int,
              low: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query positions, candidate positions, mask of pairs) that may still reach ``low``.

    Candidates come longest first, in slices; the caller raises ``low`` between slices. Partial
    sums grow by four times the coordinates at a time, and a query or candidate without a pair
    left is dropped before the next ones are added.
    """
    turned_q, turned_c = q @ rotation, c @ rotation
    q_norm, c_norm = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    q_low = q_norm * (1 + 1e-9) + 1e-6
    widths = [head]
    while widths[-1] * 4 < q.shape[1]:
        widths.append(widths[-1] * 4)
    rest = [(np.linalg.norm(turned_q[:, w:], axis=1), np.linalg.norm(turned_c[:, w:], axis=1))
            for w in widths]
    for lo in range(0, len(c), SLICE):
        rows = np.flatnonzero(q_low * c_norm[lo] + 1e-6 >= low)
        if not len(rows):
            return
        cols = np.arange(lo, min(lo + SLICE, len(c)))
        partial, before = np.zeros((len(rows), len(cols))), 0
        for w, (q_rest, c_rest) in zip(widths, rest):
            partial += turned_q[rows, before:w] @ turned_c[cols, before:w].T
            before = w
            # bound of the rest and of rounding, as one product of two narrow matrices
            room = np.column_stack([q_rest[rows], 1e-9 * q_norm[rows], 1e-6 - low[rows]]) \
                @ np.column_stack([c_rest[cols], c_norm[cols], np.ones(len(cols))]).T \
                if np.isfinite(low[rows]).all() else np.where(
                    np.isfinite(low[rows]), 1e-6 - low[rows], np.inf)[:, None] + np.outer(
                    q_rest[rows], c_rest[cols]) + 1e-9 * np.outer(q_norm[rows], c_norm[cols])
            mask = partial + room >= 0
            live_rows, live_cols = mask.any(axis=1), mask.any(axis=0)
            if not live_rows.all() or not live_cols.all():
                kept = np.ix_(live_rows, live_cols)
                rows, cols, mask, partial = rows[live_rows], cols[live_cols], mask[kept], partial[kept]
            if not len(rows):
                break
        if len(rows):
            yield rows, cols, mask


def best_exact(q: np.ndarray, c: np.ndarray, asked_ids: np.ndarray, ids: np.ndarray, k: int,
               low: np.ndarray, rotation: np.ndarray, head: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query positions, ids, scores) of the k best of each query, where every product of integers
    is exact in doubles: one matrix product per slice, then only pairs that enter a list."""
    scores = np.full((len(q), k), -np.inf)
    named = np.full((len(q), k), LIMITS[1], dtype=np.int64)
    for rows, cols, mask in survivors(q, c, rotation, head, low):
        product = q[rows] @ c[cols].T
        enters = mask & (asked_ids[rows][:, None] != ids[cols][None, :])
        last, last_id = scores[rows, -1][:, None], named[rows, -1][:, None]
        enters &= (product >= low[rows][:, None]) & ((product > last) | (
            (product == last) & (ids[cols][None, :] < last_id)))
        crowded = np.flatnonzero(enters.sum(axis=1) > 4 * k)
        if len(crowded):  # of many that enter, all below the k-th of them go at once
            held = np.where(enters[crowded], product[crowded], -np.inf)
            enters[crowded] &= held >= np.partition(held, -k, axis=1)[:, -k][:, None]
        at_q, at_c = np.nonzero(enters)
        if not len(at_q):
            continue
        touched = np.unique(at_q)
        owner = np.concatenate([at_q, np.repeat(touched, k)])
        score = np.concatenate([product[at_q, at_c], scores[rows[touched]].ravel()])
        name = np.concatenate([ids[cols[at_c]], named[rows[touched]].ravel()])
        order = np.lexsort((name, -score, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        taken = order[place < k]  # every touched query has at least k entries here
        scores[rows[touched]] = score[taken].reshape(-1, k)
        named[rows[touched]] = name[taken].reshape(-1, k)
        low[rows[touched]] = np.maximum(low[rows[touched]], scores[rows[touched], -1])
    at, _ = found = np.nonzero(np.isfinite(scores))
    return at, named[found], scores[found].astype(np.int64)


def best_wide(q: np.ndarray, c: np.ndarray, asked_ids: np.ndarray, ids: np.ndarray, k: int,
              low: np.ndarray, rotation: np.ndarray, head: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``best_exact`` for components too large for doubles, in Python's integers."""
    lists: list[list[tuple[int, int]]] = [[] for _ in q]
    for rows, cols, mask in survivors(q, c, rotation, head, low):
        for i, pairs in zip(rows, mask):
            mine = [int(x) for x in q[i]]
            fresh = [(-sum(x * int(y) for x, y in zip(mine, c[j])), int(ids[j]))
                     for j in cols[pairs] if ids[j] != asked_ids[i]]
            lists[i] = sorted(lists[i] + fresh)[:k]
            if len(lists[i]) == k:
                last = float(-lists[i][-1][0])
                low[i] = max(low[i], last - abs(last) * 1e-12)
    return (np.repeat(np.arange(len(q)), [len(x) for x in lists]),
            np.array([name for x in lists for _, name in x], dtype=np.int64),
            np.array([-score for x in lists for score, _ in x], dtype=object))


def top_products(vectors: DataFrame, query: Column, k: int = 5, scale: int = 256,
                 head: int = 16) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for each row of ``vectors (vec_id, embedding)`` that
    ``query`` selects, against every other row; ties go to the smaller vec_id."""
    good = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("id"),
        F.col("embedding").cast("array<double>").alias("vector"), query.alias("asks"))
    width, n = good.agg(F.max(F.size("vector")), F.count(F.lit(1))).first()
    result = "query_id bigint, vec_id bigint, score string"
    if not width:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    parts = max(1, -(-n // BLOCK))
    by_length = good.select("id", "vector").repartitionByRange(
        parts, length.desc(), F.hash("id"))  # equal lengths are dealt over several blocks
    blocks = cut_lineage(pack_blocks(by_length, scale, width).withColumn(
        "block", F.monotonically_increasing_id()))
    asking = good.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    asked = cut_lineage(pack_blocks(asking.repartition(max(1, parts // 8), "id"), scale, width)
                        .withColumn("block_id", F.monotonically_increasing_id()))
    longest = blocks.select("block", "longest").orderBy(F.desc("longest"), "block").first()[0]
    rotation = gram_rotation(blocks, width)
    head = min(head, width)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples():
                hits = pair_hits(row)
                if len(hits):
                    yield hits

    def pair_hits(row) -> pd.DataFrame:
        asked_ids = np.frombuffer(row.query_ids, "<i8")
        ids = np.frombuffer(row.ids, "<i8")
        q, c = unpack(row.query_matrix, width), unpack(row.matrix, width)
        low = (np.full(len(q), -np.inf) if row.floors is None
               else np.frombuffer(row.floors, "<f8").copy())
        largest = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * width
        best = best_exact if largest < HELD else best_wide
        at, names, scores = best(q, c, asked_ids, ids, k, low, rotation, head)
        return pd.DataFrame({"query_id": asked_ids[at], "vec_id": names,
                             "score": [str(int(x)) for x in scores]})

    def meet(queries: DataFrame, targets: DataFrame) -> DataFrame:
        return queries.join(targets, "block").mapInPandas(search, result)

    def ranked(hits: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(
            F.desc(F.col("score").cast("decimal(38,0)")), "vec_id")
        return hits.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)

    queries = asked.select(F.col("ids").alias("query_ids"), F.col("matrix").alias("query_matrix"))
    first = cut_lineage(ranked(meet(
        queries.select("*", F.lit(None).cast("binary").alias("floors"),
                       F.lit(longest).cast("bigint").alias("block")),
        F.broadcast(blocks.where(F.col("block") == longest)))))  # one block: BLOCK * width numbers

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples():
                ids = np.frombuffer(row.ids, "<i8")
                yield pd.DataFrame({"block_id": row.block_id, "pos": np.arange(len(ids)),
                                    "query_id": ids,
                                    "norm": np.linalg.norm(unpack(row.matrix, width), axis=1)})

    def floors_packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield pd.DataFrame({"block_id": frame["block_id"], "block": frame["block"],
                                "floors": [np.asarray(x, "<f8").tobytes() for x in frame["lows"]]})

    # what each query already has, and the least length that a block needs to add to it
    floors = first.where(F.col("rank") == k).select(
        "query_id", F.col("score").cast("double").alias("floor"))
    none = F.lit(float("-inf"))
    per_block = asked.select("block_id", "ids", "matrix").mapInPandas(
        listed, "block_id bigint, pos int, query_id bigint, norm double").join(
        floors, "query_id", "left").groupBy("block_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "floor"))),
                    lambda x: F.coalesce(x["floor"], none)).alias("lows"),
        F.min(F.coalesce(F.col("floor") / F.greatest("norm", F.lit(1e-300)), none))
        .alias("needs"))
    reach = blocks.where(F.col("block") != longest).agg(
        F.collect_list(F.struct("longest", "block")).alias("all"))  # two numbers per block
    wanted = per_block.withColumn("all", reach.scalar()).select(
        "block_id", "lows", "needs", F.explode("all").alias("b")).where(
        F.col("b.longest") * (1 + 1e-9) + 1e-6 >= F.col("needs")).select(
        "block_id", "lows", F.col("b.block").alias("block"))
    more = meet(wanted.mapInPandas(floors_packed, "block_id bigint, block bigint, floors binary")
                .join(asked.select("block_id", F.col("ids").alias("query_ids"),
                                   F.col("matrix").alias("query_matrix")), "block_id")
                .select("query_ids", "query_matrix", "floors", "block"), blocks)
    score = F.col("score").cast("decimal(38,0)")
    return ranked(first.select("query_id", "vec_id", "score").unionByName(more)).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
        F.greatest(F.least(score, F.lit(LIMITS[1])), F.lit(LIMITS[0])).cast("bigint")
        .alias("score"))
