"""Token ids of documents in coded files, in ascending doc_id order, and their way back.

Writing deals the documents by ranges of doc_id, sorts every range, encodes the texts and cuts
the ids of a range into blocks of ``range_coder.BLOCK``. A file is a Parquet file of such blocks,
so it is committed by Spark, lies in any store Spark can write to, and a task that is lost is
written again. A row holds

    part, block_no   range and position of the block in it
    n_ids            ids in the block
    doc_ids, sizes   the documents that start in the block, and how many ids each has in all
    data             the coded block, see ``range_coder``

Reading sorts the blocks of a range, decodes many in step, and puts the documents together
again; memory holds a stretch of blocks and the document at hand.

Null or empty text is the end id alone; a document may span any number of blocks; rows with one
doc_id are ordered by their text; a null doc_id comes first; an empty table gives files without
blocks; other columns are neither read nor written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiocast.llm import range_coder
from regiocast.llm.ngram_join import texts_in
from regiocast.llm.tokens import coder

FIELDS = ["part", "block_no", "n_ids", "doc_ids", "sizes", "data"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
         pa.binary()]
SCHEMA = ("part bigint, block_no bigint, n_ids bigint, doc_ids array<bigint>, "
          "sizes array<bigint>, data binary")


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
              parts: int | None = None) -> None:
    """Writes the ids of ``docs (doc_id, text)``, each followed by ``end_id``, below ``path``."""
    size, together = range_coder.BLOCK, range_coder.LANES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, block_no = coder("word", tokenizer), TaskContext.get().partitionId(), 0
        held, n_held = [], 0  # ids not yet in a block
        starts: list[tuple[int, int | None, int]] = []  # position, doc_id, size

        def blocks(last: bool):
            nonlocal held, n_held, starts, block_no
            ids = np.concatenate(held) if held else np.zeros(0, "<u4")
            n = -(-len(ids) // size) if last else len(ids) // size
            cut = [ids[i * size:(i + 1) * size] for i in range(n)]
            owners: list[list] = [[] for _ in cut]
            later = []
            for at, doc, count in starts:
                if at // size < n:
                    owners[at // size].append((doc, count))
                else:
                    later.append((at - n * size, doc, count))
            columns = [[part] * n, range(block_no, block_no + n), [len(c) for c in cut],
                       [[d for d, _ in o] for o in owners], [[c for _, c in o] for o in owners],
                       range_coder.encode_blocks(cut)]
            held, starts, block_no = [ids[n * size:]], later, block_no + n
            n_held = len(held[0])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, TYPES)], FIELDS)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for lo, texts in texts_in(batch, "text", 256):
                for doc, raw in zip(names[lo:], code.encode([t or "" for t in texts])):
                    ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
                    starts.append((n_held, doc, len(ids)))
                    held.append(ids)
                    n_held += len(ids)
                if n_held >= size * together:
                    yield blocks(False)
        if n_held:
            yield blocks(True)

    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ranged = (ordered.repartitionByRange(parts, "doc_id") if parts
              else ordered.repartitionByRange("doc_id"))
    ranged.sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers); with ``with_ids`` also its
    ids, as bytes of that form."""
    together = range_coder.LANES
    files = spark.read.schema(SCHEMA).parquet(path)
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64()] * 5 + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, 0  # range at hand, ids of it given out so far
        waiting: list[tuple] = []  # documents whose ids are not all decoded: doc_id, size
        left = np.zeros(0, "<u4")

        def documents(rows: list[dict]):
            nonlocal part, at, waiting, left
            out = []
            for row, ids in zip(rows, range_coder.decode_blocks([r["data"] for r in rows])):
                if row["part"] != part:
                    if waiting or len(left):
                        raise range_coder.CorruptBlock("a range ends inside a document")
                    part, at = row["part"], 0
                waiting += zip(row["doc_ids"], row["sizes"])
                chunks.append(ids)
                left_n = len(left) + sum(map(len, chunks))
                if waiting and left_n >= waiting[0][1]:
                    left = np.concatenate([left, *chunks])
                    chunks.clear()
                    used = 0
                    while waiting and len(left) - used >= waiting[0][1]:
                        doc, n = waiting.pop(0)
                        raw = left[used:used + n].tobytes()
                        out.append((part, doc, at, n, zlib.crc32(raw), raw)[:len(names)])
                        used, at = used + n, at + n
                    left = left[used:]
            return pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)

        chunks: list[np.ndarray] = []
        rows: list[dict] = []
        for batch in batches:
            rows += batch.select(["part", "doc_ids", "sizes", "data"]).to_pylist()
            while len(rows) >= together:
                yield documents(rows[:together])
                rows = rows[together:]
        if rows:
            yield documents(rows)
        if waiting or len(left) or chunks:
            raise range_coder.CorruptBlock("the files end inside a document")

    decoded = files.repartition("part").sortWithinPartitions("part", "block_no").mapInArrow(
        run, "part bigint, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
             + (", ids binary" if with_ids else ""))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(  # a row per range
        F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return decoded.join(firsts, decoded.part == firsts.p).select(
        "doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)
