"""The compression classifier against plain zstandard and a plain fit on all rows, without Spark."""

import hashlib
import zlib

import duckdb
import numpy as np
import zstandard

from conftest import SF
from regiocast.llm.quality_classifier import classify
from regiocast.sources.tables import Tables

PIECE, SIZE, LEVEL = 1024, 65536, 3


def pieces(text):
    raw = (text or "").encode()
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


def by_hand(docs, labels):
    """{doc_id: score}, learnt from labelled rows outside fold 0."""
    key = {i: hashlib.md5(str(i).encode()).hexdigest() for i in docs}
    known = {i: q for i, q in labels if i in docs and docs[i] and q in (0, 1)
             and zlib.crc32(str(i).encode()) % 5}
    ranked = {q: [docs[i] for i in sorted(known, key=key.get) if known[i] == q] for q in (1, 0)}
    assert all(2 <= len(t) <= 3000 and sum(len(x.encode()) for x in t) <= 12_000_000
               for t in ranked.values())  # the whole table is in the sample
    tools = [zstandard.ZstdCompressor(
        level=LEVEL, write_content_size=False, write_dict_id=False,
        dict_data=zstandard.train_dictionary(SIZE, [p for t in ranked[q][::2] for p in pieces(t)]))
        for q in (1, 0)]

    def features(text):
        good, bad = (sum(len(tool.compress(p)) for p in pieces(text)) for tool in tools)
        n = len((text or "").encode())
        return [(bad - good) / max(n, 1), (bad - good) / max(good, bad, 1), min(good, bad) / max(n, 1),
                1 / np.sqrt(n) if n else 1.0]

    def row(x):
        return [*x, x[0] * x[2], x[1] * x[2], 1.0]

    fit = [(features(t), q) for q in (1, 0) for t in ranked[q][1::2]]
    x, y = np.array([f for f, _ in fit]), np.array([float(q) for _, q in fit])
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.array([row((f - centre) / spread) for f in x])
    weights = np.zeros(7)
    shrink = np.array([0.2] * 6 + [1e-9])
    for _ in range(200):  # to the stationary point of the penalised likelihood
        p = 1 / (1 + np.exp(-design @ weights))
        slope = design.T @ (y - p) - shrink * weights
        weights += np.linalg.solve(design.T @ np.diag(p * (1 - p)) @ design + np.diag(shrink), slope)
    assert np.abs(slope).max() < 1e-8
    share = sum(known.values()) / len(known)
    weights[6] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return {i: 1 / (1 + np.exp(-np.dot(row((np.array(features(t)) - centre) / spread), weights)))
            for i, t in docs.items()}


def test_equals_plain_fit(spark):
    con = duckdb.connect()
    docs = dict(con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    labels = con.execute(f"SELECT DISTINCT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    want = by_hand(docs, labels)
    t = Tables(spark, SF)
    got = {r.doc_id: r for r in classify(t.documents, t.labels).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i].score - want[i]) for i in want) < 1e-6
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
