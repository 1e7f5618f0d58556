"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of equal token count. Slot ``i`` gets the golden-ratio point
``x_i = i * 2654435769 mod 2^32``; the cumulative targets of the sources cut [0, 2^32) into one
interval each, and the interval that holds ``x_i`` names the slot's source. The ``k``-th slot of
a source takes block ``k mod blocks`` of that source, where the source's documents, shuffled by
the MD5 of their id, are laid end to end and cut into blocks of the slot's size. Any stretch of
the schedule is therefore close to the target weights, and a rerun gives the same mix.

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating, and share the whole
size of the table; none gets more than ``max_repeats`` times its size, and the excess is shared
again by weight (solved in closed form over the sources).

Nothing runs over a whole source in one task: ranks and running sizes are taken inside chunks
of slots and inside hash buckets of a source's documents, and one total per chunk or bucket is
added up. Only per-source and per-bucket totals meet in a small window.

Null or empty texts have size 0 and take 0; a null source is a source of its own; very long
texts span several blocks; repeated rows each count; an empty table, or one without words,
gives an empty or all-zero result; other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiocast.llm.text import word_count
from regiocast.session import cut_lineage

GOLDEN = 2654435769  # 2^32 over the golden ratio
CIRCLE = 1 << 32
CELLS = 4096  # equal parts of the circle, to find a slot's interval by an equality
CHUNK = 1 << 16  # slots ranked together


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   max_repeats: int = 3) -> DataFrame:
    """Per source: source, n_docs, source_size, target, from_x and to_x on the circle.

    With the sources in order of ``cap / weight``, those are capped whose ratio stays below the
    level at which the rest of the total, shared by weight, fills everything behind them.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = per_source.select(
        "*", F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
        .cast("bigint").alias("weight"),
        (F.lit(max_repeats) * F.col("source_size")).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    levels = weighed.select(
        "*", (F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left_size"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"))
    free = levels.select(
        "*", (F.col("cap") * F.col("left_weight") >= F.col("left_size") * F.col("weight"))
        .alias("free"))
    # the first free source in order of ratio sets the level for all behind it
    level = free.select(
        "*", F.min(F.when(F.col("free"), F.struct(
            F.col("cap") / F.col("weight"), F.col("source").isNull(), "source",
            "left_size", "left_weight"))).over(everything).alias("at"))
    targets = level.select(
        "source", "n_docs", "source_size",
        F.when(F.col("free"), F.col("at.left_size") * F.col("weight") / F.col("at.left_weight"))
        .otherwise(F.col("cap").cast("double")).alias("target"))
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    whole = F.floor("target")
    edges = targets.select(  # whole words: sums do not depend on their order
        "*", F.floor(F.sum(whole).over(running) / F.nullif(F.sum(whole).over(everything), F.lit(0))
                     * CIRCLE).alias("to_x"))
    last = F.lead(F.lit(1)).over(in_order).isNull()
    return edges.select(
        "source", "n_docs", "source_size", "target",
        F.coalesce(F.lag("to_x").over(in_order), F.lit(0)).cast("bigint").alias("from_x"),
        F.when(last, F.lit(CIRCLE)).otherwise(F.coalesce("to_x", F.lit(0))).cast("bigint")
        .alias("to_x"))


def slot_schedule(spark, targets: DataFrame, n_slots: int, block: int,
                  max_repeats: int = 3) -> DataFrame:
    """Rows (slot, source, epoch, block_no): which block of which source fills each slot.

    A source's slots beyond ``max_repeats`` rounds of its blocks stay unfilled (the schedule can
    exceed a capped target by a few slots).
    """
    cells = targets.where("to_x > from_x").select(
        "source", "from_x", "to_x", F.ceil(F.col("source_size") / block).alias("blocks"),
        F.explode(F.sequence(F.floor(F.col("from_x") / (CIRCLE // CELLS)),
                             F.floor((F.col("to_x") - 1) / (CIRCLE // CELLS)))).alias("cell"))
    points = spark.range(n_slots).select(
        F.col("id").alias("slot"), (F.col("id") % (1 << 31) * GOLDEN % CIRCLE).alias("x"))
    placed = points.withColumn("cell", F.floor(F.col("x") / (CIRCLE // CELLS))).join(
        cells, "cell").where("x >= from_x AND x < to_x").select(
        "slot", "source", "blocks", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = placed.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(F.col("source").alias("s"), F.col("chunk").alias("c"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = placed.join(starts, placed.source.eqNullSafe(starts.s)
                         & (placed.chunk == starts.c)).select(
        "slot", "source", "blocks", (F.col("first") - 1 + F.row_number().over(
            Window.partitionBy("source", "chunk").orderBy("slot"))).alias("rank"))
    return ranked.select(
        "slot", "source", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"),
        (F.col("rank") % F.col("blocks")).alias("block_no")).where(F.col("epoch") < max_repeats)


def shuffled_spans(sizes: DataFrame, per_bucket: int, n_docs: int) -> DataFrame:
    """Rows of ``sizes`` with start and stop in their source's shuffled line of tokens."""
    digits = 1
    while 16 ** digits * per_bucket < n_docs and digits < 8:
        digits += 1
    hashed = sizes.select("doc_id", "source", "size", F.coalesce(
        F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit("")).alias("h")).withColumn(
        "bucket", F.substring("h", 1, digits))
    totals = hashed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    return hashed.join(starts, hashed.source.eqNullSafe(starts.s)
                       & (hashed.bucket == starts.b)).select(
        "doc_id", "source", "size", (F.col("first") + F.sum("size").over(inside)).alias("stop")
    ).withColumn("start", F.col("stop") - F.col("size"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3,
                  max_block: int = 4096, blocks_of_smallest: int = 2000,
                  per_bucket: int = 20_000) -> DataFrame:
    """Per row of ``docs (doc_id, text, source)``: doc_id, size, source_size, target, taken.

    A slot holds a ``blocks_of_smallest``-th of the smallest positive target, at most
    ``max_block`` words. ``taken`` counts the words of the document inside the blocks that the
    schedule takes, repeats included; it is never above ``max_repeats * size``.
    """
    spark = docs.sparkSession
    sizes = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = cut_lineage(source_targets(sizes, weights, max_repeats))
    total, smallest, n_docs = targets.agg(
        F.sum("source_size"), F.min(F.when(F.col("target") > 0, F.col("target"))),
        F.sum("n_docs")).first()
    block = int(min(max_block, max(1, (smallest or 0) // blocks_of_smallest)))
    n_slots = -(-(total or 0) // block)
    slots = slot_schedule(spark, targets, n_slots, block, max_repeats)
    times = slots.groupBy(F.col("source").alias("s"), "block_no").agg(
        F.count(F.lit(1)).alias("times"))
    spans = shuffled_spans(sizes.where("size > 0"), per_bucket, n_docs or 0)
    cut = spans.select("*", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))).alias("block"))
    taken = cut.join(times, cut.source.eqNullSafe(times.s) & (cut.block == times.block_no),
                     "left").groupBy("source", "start", "stop", "doc_id", "size").agg(
        F.sum(F.coalesce("times", F.lit(0)) * (
            F.least(F.col("stop"), (F.col("block") + 1) * block)
            - F.greatest(F.col("start"), F.col("block") * block))).alias("taken"))
    rows = taken.select("doc_id", "source", "size", "taken").unionByName(
        sizes.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("bigint")
                                       .alias("taken")))
    out = targets.select(F.col("source").alias("s"), "source_size", "target")
    return rows.join(out, rows.source.eqNullSafe(out.s)).select(
        "doc_id", "size", "source_size", "target", "taken")
