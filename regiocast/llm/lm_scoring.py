"""Language-model scores of whole texts: a causal attention model beside a word unigram base.

Learning uses the training rows (fold other than ``held``). All of them give the counts of words
and of subword ids, and the attention model is trained on all of them: every partition trains a
copy for one pass over its rows (Adam, fixed seed) and the copies are averaged, weighted by their
tokens.

Base score: sum over words and one end of log10((c + 1) / (N + V + 1)), where c counts the word
in training tokens, N counts all of those and V the distinct ones. Word counts are added up per
task before the shuffle. The ``HOT`` most frequent words, a bounded table, are looked up where
the text is read; the others travel as (text, word hash, n) and meet their counts by an
equality join, so frequent words do not make hot keys. Words are compared by 64-bit hashes.

Subword ids are written once to the shared folder and serve counting, training and scoring.
The model's score is the log10 probability of the ids and one end (see ``attention``).

Null or empty text is the end alone; very long texts are scored whole, window by window;
repeated rows get equal scores each; an empty table gives an empty result; without training
rows N and V are 0 and all model weights stay as they start; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.llm import attention
from regiocast.llm.ngram_join import texts_in
from regiocast.llm.shingles import TOGETHER, word_hashes
from regiocast.llm.text import fold
from regiocast.llm.tokens import coder
from regiocast.session import cut_lineage, scratch_path

HOT = 4096


def hashed(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per stretch of texts: first, past the last, word hashes, and words per text."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    lo = 0
    while lo < len(raw):
        hi, held = lo + 1, len(raw[lo])
        while hi < len(raw) and held + len(raw[hi]) < TOGETHER:
            held += len(raw[hi]) + 1
            hi += 1
        yield (lo, hi, *word_hashes(raw[lo:hi]))
        lo = hi


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (hash, c) of all words of ``docs``; each task adds up its own words first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, waiting, held = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def merged():
            found, at = np.unique(np.concatenate([keys, *waiting]), return_inverse=True)
            ones = np.ones(len(at) - len(keys), np.int64)
            return found, np.bincount(at, weights=np.concatenate([sums, ones]),
                                      minlength=len(found)).astype(np.int64)

        for batch in batches:
            for _, texts in texts_in(batch, "text"):
                for _, _, words, _ in hashed(texts):
                    waiting.append(words)
                    held += len(words)
                if held > 2_000_000:
                    keys, sums = merged()
                    waiting, held = [], 0
                    if len(keys) > 3_000_000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.view(np.int64)), pa.array(sums)], ["hash", "c"])
                        keys, sums = keys[:0], sums[:0]
        keys, sums = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)],
                                         ["hash", "c"])

    return docs.select("text").mapInArrow(run, "hash bigint, c bigint").groupBy("hash").agg(
        F.sum("c").alias("c"))


def word_rows(docs: DataFrame, hot: np.ndarray, hot_counts: np.ndarray) -> DataFrame:
    """Rows (doc_id, fp, hash, n, part, known) of ``docs (doc_id, fp, text)``.

    One row with a null hash per text: its words (n), what hot words add to the logarithms
    (part) and how many they are (known). One row for each other distinct word.
    """
    order = np.argsort(hot)
    keys, logs = hot[order], np.log10(hot_counts[order] + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in texts_in(batch, "text"):
                for lo, hi, words, counts in hashed(texts):
                    owner = np.repeat(np.arange(hi - lo), counts)
                    place = np.minimum(np.searchsorted(keys, words), max(len(keys) - 1, 0))
                    is_hot = keys[place] == words if len(keys) else np.zeros(len(words), bool)
                    part = np.bincount(owner[is_hot], weights=logs[place[is_hot]],
                                       minlength=hi - lo)
                    known = np.bincount(owner[is_hot], minlength=hi - lo)
                    rest, who = words[~is_hot], owner[~is_hot]
                    sort = np.lexsort((rest, who))
                    rest, who = rest[sort], who[sort]
                    new = np.flatnonzero(np.concatenate([
                        [True] * (len(rest) > 0), (rest[1:] != rest[:-1]) | (who[1:] != who[:-1])]))
                    times = np.diff(np.append(new, len(rest)))
                    rows = at + lo + np.concatenate([np.arange(hi - lo), who[new]])
                    none = np.zeros(len(new))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(rows)),
                        batch.column("fp").take(pa.array(rows)),
                        pa.array(np.concatenate([np.zeros(hi - lo, np.int64),
                                                 rest[new].view(np.int64)]),
                                 mask=np.arange(len(rows)) < hi - lo),
                        pa.array(np.concatenate([counts, times]).astype(np.int64)),
                        pa.array(np.concatenate([part, none])),
                        pa.array(np.concatenate([known, none]).astype(np.int64))],
                        ["doc_id", "fp", "hash", "n", "part", "known"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, fp bigint, hash bigint, n bigint, part double, "
                                "known bigint")


def base_scores(docs: DataFrame, counts: DataFrame, train_docs: int) -> DataFrame:
    """Per distinct row of ``docs (doc_id, fp, text)``: doc_id, fp, n_tokens, n_known,
    train_tokens, base_score."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = total + train_docs, distinct + (train_docs > 0)
    top = counts.orderBy(F.desc("c"), "hash").limit(HOT).collect()
    hot = np.array([r.hash for r in top], dtype=np.int64)
    rows = word_rows(docs, hot.view(np.uint64), np.array([r.c for r in top], dtype=np.int64))
    parts = rows.join(counts, "hash", "left").groupBy("doc_id", "fp").agg(
        F.count(F.when(F.col("hash").isNull(), 1)).alias("m"),
        F.sum(F.when(F.col("hash").isNull(), F.col("n"))).alias("words"),
        F.sum(F.col("known") + F.when(F.col("hash").isNotNull() & F.col("c").isNotNull(),
                                      F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("part") + F.when(F.col("hash").isNotNull(), F.col("n") * F.log10(
            F.coalesce("c", F.lit(0)) + 1)).otherwise(0.0)).alias("logs"))
    # m equal rows were added up
    n_tokens = F.expr("words div m") + 1
    return parts.select(
        "doc_id", "fp", n_tokens.alias("n_tokens"),
        (F.expr("known div m") + int(train_docs > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") / F.col("m") + float(np.log10(train_docs + 1))
         - n_tokens * float(np.log10(total + distinct + 1))).alias("base_score"))


def id_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (doc_id, fp, train, ids) of ``docs (doc_id, fp, train, text)``, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder("word", tokenizer)
        kind = "<u2" if code.size < 1 << 16 else "<u4"
        for batch in batches:
            for lo, texts in texts_in(batch, "text", 256):
                ids = [np.frombuffer(x, "<u4").astype(kind).tobytes()
                       for x in code.encode([t or "" for t in texts])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, len(ids)) for c in ("doc_id", "fp", "train")]
                    + [pa.array(ids, pa.binary())], ["doc_id", "fp", "train", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    path = scratch_path(docs.sparkSession, "subword-ids")
    docs.select("doc_id", "fp", "train", "text").mapInArrow(
        run, f"doc_id {kind}, fp bigint, train boolean, ids binary").write.option(
        "compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def id_counts(ids: DataFrame, size: int) -> np.ndarray:
    """Occurrences of every id in the training rows, added up per task, then over tasks."""
    kind = "<u2" if size < 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                raw = b"".join(batch.column("ids").slice(lo, 512).to_pylist())
                total += np.bincount(np.frombuffer(raw, kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = ids.where("train").select("ids").mapInArrow(run, "id bigint, n bigint").groupBy(
        "id").agg(F.sum("n").alias("n")).collect()  # at most one row per id of the vocabulary
    out = np.zeros(size, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def train(ids: DataFrame, classes: attention.Classes, size: int) -> dict[str, np.ndarray]:
    """Model averaged over partitions, each trained for one pass over its training rows."""
    kind = "<u2" if size < 1 << 16 else "<u4"
    start = attention.fresh(classes.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(TaskContext.get().partitionId())
        adam, seen = attention.Adam({n: x.copy() for n, x in start.items()}), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                texts = [np.frombuffer(x.as_buffer(), kind)
                         for x in batch.column("ids").slice(lo, 64)]
                inputs, targets, _ = attention.windows(texts, size)
                order = rng.permutation(len(inputs))
                for at in range(0, len(order), 64):
                    some = order[at:at + 64]
                    adam.step(attention.gradients(adam.p, inputs[some], targets[some],
                                                  classes)[1])
                seen += int((targets >= 0).sum())
        if seen:
            values = attention.flat(adam.p).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values * seen),
                 pa.array(np.full(len(values), seen))], ["pos", "x", "seen"])

    rows = ids.where("train").select("ids").mapInArrow(
        run, "pos bigint, x double, seen bigint").groupBy("pos").agg(
        (F.sum("x") / F.sum("seen")).alias("x")).orderBy("pos").collect()
    return attention.shaped(np.array([r.x for r in rows])) if rows else start


def model_scores(ids: DataFrame, model: dict, classes: attention.Classes, size: int) -> DataFrame:
    kind = "<u2" if size < 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                texts = [np.frombuffer(x.as_buffer(), kind)
                         for x in batch.column("ids").slice(lo, 64)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, 64), batch.column("fp").slice(lo, 64),
                     pa.array(attention.text_scores(model, texts, classes))],
                    ["doc_id", "fp", "score"])

    name = ids.schema["doc_id"].dataType.simpleString()
    return ids.select("doc_id", "fp", "ids").mapInArrow(
        run, f"doc_id {name}, fp bigint, score double")


def score_documents(docs: DataFrame, tokenizer: str, folds: int = 7, held: int = 2) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score. ``tokenizer``: path of a vocabulary with word ends."""
    size = coder("word", tokenizer).size
    own = docs.select("doc_id", F.xxhash64("text").alias("fp"),
                      (fold(F.col("doc_id"), folds) != held).alias("train"), "text")
    ids = id_table(own, tokenizer)
    train_docs = ids.where("train").count()
    counts = cut_lineage(word_counts(own.where("train")))
    base = base_scores(own.select("doc_id", "fp", "text"), counts, train_docs)
    classes = attention.Classes(np.append(id_counts(ids, size), train_docs))
    model = train(ids, classes, size)
    scored = model_scores(ids, model, classes, size)
    base = base.withColumnsRenamed({"doc_id": "b_doc_id", "fp": "b_fp"})
    return scored.join(base, scored.doc_id.eqNullSafe(base.b_doc_id)
                       & (scored.fp == base.b_fp)).select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "n_tokens",
        "n_known", "train_tokens", "base_score", "score")
