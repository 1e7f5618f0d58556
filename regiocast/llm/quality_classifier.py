"""Quality by compression: which of two dictionaries, of good or of bad text, fits better.

Two zstandard dictionaries are built, one from good and one from bad labelled documents. A text
is compressed in pieces of ``piece`` bytes with either; the difference of the two sums, per byte
of text and per compressed byte, says which side it resembles. A logistic calibration on other
labelled documents, which also sees how far the text shrinks at all, turns the differences into
the probability of label 1.

Learning reads a bounded sample: per class at most ``max_docs`` documents and ``max_bytes`` of
text, the first that fit in order of the MD5 of their ids, one half for the dictionaries and the other
for the calibration; only rows that the caller passes as trainable take part. Scoring is one
pass over the rows, without a shuffle, on whole texts.

Null or empty text is scored as a text of no bytes; very long texts are compressed piece by
piece; repeated rows score alike; an empty table gives an empty result. Without two texts
in the sample of either class every score is the share of label 1 among the trainable rows, 0.5
if there are none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.llm.text import fold
from regiocast.session import cut_lineage


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]  # the last one is the constant
    piece: int
    level: int

    def compressors(self):
        return [zstandard.ZstdCompressor(level=self.level, dict_data=zstandard.ZstdCompressionDict(d),
                                         write_content_size=False, write_dict_id=False)
                for d in (self.good, self.bad)]

    def features(self, texts) -> np.ndarray:
        if not self.good:
            return np.zeros((len(texts), 4))
        good, bad = self.compressors()
        rows = []
        for text in texts:
            raw = (text or "").encode("utf-8", "replace")
            parts = [raw[i:i + self.piece] for i in range(0, len(raw), self.piece)]
            a = sum(len(good.compress(p)) for p in parts)
            b = sum(len(bad.compress(p)) for p in parts)
            n = max(len(raw), 1)
            rows.append(((b - a) / n, (b - a) / max(a, b, 1), min(a, b) / n, len(raw) ** -0.5
                         if raw else 1.0))
        return np.array(rows).reshape(-1, 4)

    def scores(self, texts) -> np.ndarray:
        x = (self.features(texts) - self.centre) / self.spread
        z = design(x) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def design(x: np.ndarray) -> np.ndarray:
    """Features, the products of the difference with the shrinkage, and the constant."""
    return np.column_stack([x, x[:, 0] * x[:, 2], x[:, 1] * x[:, 2], np.ones(len(x))])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.2, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the constant is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.diag([ridge] * (x.shape[1] - 1) + [1e-9])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink,
                               x.T @ (y - p) - shrink @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def build_dictionary(texts: list[str], piece: int, size: int) -> bytes:
    """Trained dictionary; the raw text where there is too little of it to train on."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    samples = [r[i:i + piece] for r in raw for i in range(0, len(r), piece)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def sample_texts(docs: DataFrame, labelled: DataFrame, quality: int, max_docs: int,
                 max_bytes: int) -> list[str]:
    """Texts of at most ``max_docs`` rows and ``max_bytes``, in order of the MD5 of their ids;
    a text that no longer fits is passed over, and those after it are still looked at.

    Chosen among (doc_id, quality, h, n) without the texts; only the chosen ids, a bounded list,
    are broadcast to fetch those.
    """
    heads = labelled.where((F.col("quality") == quality) & (F.col("n") <= max_bytes)).orderBy(
        "h", "n").limit(max_docs).collect()
    fits, total = [], 0
    for r in heads:
        if total + r.n <= max_bytes:
            fits.append(r)
            total += r.n
    if not fits:
        return []
    sized = docs.select("doc_id", F.octet_length("text").alias("n"), "text")
    ids = docs.sparkSession.createDataFrame(
        [(r.doc_id, r.n) for r in fits], sized.select("doc_id", "n").schema).distinct()
    rows = sized.join(F.broadcast(ids), ["doc_id", "n"]).select(
        F.md5(F.col("doc_id").cast("string").cast("binary")).alias("h"), "text")
    return [r.text for r in rows.orderBy("h", F.octet_length("text"), "text").limit(
        len(fits)).collect()]


def learn(docs: DataFrame, labels: DataFrame, trainable: Column, max_docs: int = 3000,
          max_bytes: int = 12_000_000, piece: int = 1024, size: int = 65536,
          level: int = 3) -> Model:
    """Model from ``docs (doc_id, text)`` and ``labels (doc_id, quality)``; ``trainable`` is a
    condition on doc_id."""
    sizes = docs.select("doc_id", F.octet_length("text").alias("n")).where(F.col("n") > 0)
    labelled = cut_lineage(sizes.join(
        labels.select("doc_id", "quality").where(trainable & F.col("quality").isin(0, 1))
        .distinct(), "doc_id").select(
        "doc_id", "quality", F.md5(F.col("doc_id").cast("string").cast("binary")).alias("h"), "n"))
    good, bad = (sample_texts(docs, labelled, q, max_docs, max_bytes) for q in (1, 0))
    if len(good) < 2 or len(bad) < 2:
        share = labelled.agg(F.avg("quality")).first()[0]
        share = 0.5 if share is None else share
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", (0.0,) * 4, (1.0,) * 4,
                     (0.0,) * 6 + (float(np.log(share / (1 - share))),), piece, level)
    model = Model(build_dictionary(good[::2], piece, size), build_dictionary(bad[::2], piece, size),
                  (0.0,) * 4, (1.0,) * 4, (0.0,) * 7, piece, level)
    x = model.features(good[1::2] + bad[1::2])
    y = np.repeat([1.0, 0.0], [len(good[1::2]), len(bad[1::2])])
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = logistic(design((x - centre) / spread), y)
    # the sample may hold the classes in another proportion than the labels do
    share = labelled.agg(F.avg("quality")).first()[0]
    weights[-1] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return Model(model.good, model.bad, tuple(centre), tuple(spread), tuple(weights), piece, level)


def score_column(model: Model):
    """Column function: text to the probability that its label is 1."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts.tolist()))
    return score


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
             folds: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out (fold 0, never learnt from), score, predicted."""
    model = learn(docs, labels, fold(F.col("doc_id"), folds) != 0)
    return docs.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"),
                       score_column(model)(F.col("text")).alias("score")).select(
        "*", (F.col("score") >= threshold).cast("int").alias("predicted"))
