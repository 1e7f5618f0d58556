"""Packing token ids of documents into sequences by order-preserving dynamic programming.

The documents of a task stand one behind the other in their order, each with an end id. A cut
may fall behind a document (free), behind a sentence (``sentence_penalty``) or, inside a stretch
without such a place, behind every ``grid``-th id (``truncation_penalty``). With ``p`` the
position of a candidate, the least cost of reaching candidate ``j`` is

    cost(j) = penalty(j) + min over p(i) in [p(j) - capacity, p(j)) of cost(i) + padding,
    padding = capacity - (p(j) - p(i)),

so the minimum is one of ``cost(i) + p(i)`` over a window that only moves forward: a monotone
queue gives it in constant time on average. Every id lies in exactly one piece.

Tasks pack their own rows, in segments of about ``SEGMENT`` ids, so nothing is shuffled, memory
is bounded, and a task that runs again on another executor gives the same pieces. A segment ends
in one sequence that may be short; its length is not padded where it is a power of two.

Null or empty text gives the end id alone; a text longer than a sequence, however long, is cut
like any other; repeated rows and repeated doc_ids are packed each; an empty table gives an empty
result; other columns are neither read nor returned.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from regiocast.llm.tokens import KEEP, coder

SEGMENT = 1 << 21


def best_cuts(at: np.ndarray, penalty: np.ndarray, capacity: int) -> np.ndarray:
    """Cut positions, first and last included, of least padding plus penalties.

    ``at``: ascending candidates from 0, no two further apart than ``capacity``; ``penalty[k]``
    is that of ``at[k]``. Of equal costs the longer sequence wins.
    """
    places, fines = at.tolist(), penalty.tolist()
    back = [0] * len(places)
    queue = deque([(0, 0, 0.0)])  # position, candidate, cost + position; costs ascend
    for j in range(1, len(places)):
        p = places[j]
        while queue[0][0] < p - capacity:
            queue.popleft()
        _, back[j], least = queue[0]
        key = least + capacity + fines[j]  # = cost(j) + p
        while queue and queue[-1][2] > key:
            queue.pop()
        queue.append((p, j, key))
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(places[j])
        j = back[j]
    return np.array([0, *reversed(cuts)], dtype=np.int64)


def candidates(ids: np.ndarray, doc_ends: np.ndarray, opens: np.ndarray, closes: np.ndarray,
               grid: int, sentence_penalty: float, truncation_penalty: float):
    """Places where a sequence may end, with what it costs to end it there."""
    follows = closes[ids[:-1]] & opens[ids[1:]]
    good = np.union1d(np.flatnonzero(follows) + 1, doc_ends)
    starts = np.concatenate([[0], good[:-1]])
    extra = (good - starts - 1) // grid  # in stretches longer than the grid
    first = np.repeat(starts, extra)
    step = np.arange(len(first)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    at = np.concatenate([[0], good, first + step * grid])
    fine = np.concatenate([[0.0], np.full(len(good), sentence_penalty),
                           np.full(len(first), truncation_penalty)])
    order = np.argsort(at, kind="stable")
    at, fine = at[order], fine[order]
    fine[np.searchsorted(at, doc_ends)] = 0.0
    return at, fine


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024,
                   sentence_penalty: float = 1.0, truncation_penalty: float = 12.0,
                   grid: int = 32, with_ids: bool = False,
                   keep_words: int = KEEP) -> DataFrame:
    """Pieces of the ids of ``docs (doc_id, text)``, gapless inside each sequence.

    Columns: doc_id, start (ids of the document before the piece), length, ids_crc32 (over
    little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset, and with ``with_ids``
    the piece's ids themselves as bytes. ``tokenizer``: path of a byte-level vocabulary;
    ``keep_words``: words whose ids a worker remembers (about 200 bytes each).
    """
    if not 0 < grid <= capacity:
        raise ValueError("the grid must not be wider than a sequence")
    fields = docs.select("doc_id").schema
    schema = (f"doc_id {fields[0].dataType.simpleString()}, start bigint, length bigint, "
              "ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
              + (", ids binary" if with_ids else ""))
    end = int(end_id).to_bytes(4, "little")

    def packed(names: list, kind: pa.DataType, raw: list[bytes], first_sequence: int, code):
        data = b"".join(raw)
        ids = np.frombuffer(data, dtype="<u4")
        sizes = np.array([len(r) // 4 for r in raw], dtype=np.int64)
        ends = np.cumsum(sizes)
        cuts = best_cuts(*candidates(ids, ends, code.opens, code.closes, grid,
                                     sentence_penalty, truncation_penalty), capacity)
        begins = ends - sizes
        edges = np.union1d(cuts, ends)
        start, stop = np.concatenate([[0], edges[:-1]]), edges
        keep = stop > start
        start, stop = start[keep], stop[keep]
        doc = np.searchsorted(begins, start, side="right") - 1
        sequence = np.searchsorted(cuts, start, side="right") - 1
        view = memoryview(data)
        pairs = list(zip((start * 4).tolist(), (stop * 4).tolist()))
        columns = [pa.array([names[d] for d in doc], type=kind), pa.array(start - begins[doc]),
                   pa.array(stop - start), pa.array([zlib.crc32(view[a:b]) for a, b in pairs],
                                                    type=pa.int64()),
                   pa.array(sizes[doc]), pa.array(sequence + first_sequence),
                   pa.array(start - cuts[sequence])]
        if with_ids:
            columns.append(pa.array([data[a:b] for a, b in pairs], type=pa.binary()))
        return len(cuts) - 1, columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder("byte", tokenizer, keep_words)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        names += ["ids"] * with_ids
        next_sequence = TaskContext.get().partitionId() << 40
        waiting, raw, held, kind = [], [], 0, None
        for batch in batches:
            kind = batch.column("doc_id").type
            texts = batch.column("text")
            for lo in range(0, batch.num_rows, 256):
                part = [t or "" for t in texts.slice(lo, 256).to_pylist()]
                for doc, ids in zip(batch.column("doc_id").slice(lo, 256).to_pylist(),
                                    code.encode(part)):
                    waiting.append(doc)
                    raw.append(ids + end)
                    held += len(ids) // 4 + 1
                if held >= SEGMENT:
                    n, columns = packed(waiting, kind, raw, next_sequence, code)
                    next_sequence += n
                    waiting, raw, held = [], [], 0
                    yield pa.RecordBatch.from_arrays(columns, names)
        if raw:
            yield pa.RecordBatch.from_arrays(packed(waiting, kind, raw, next_sequence, code)[1],
                                             names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
