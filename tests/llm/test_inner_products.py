import numpy as np
import pytest
from pyspark.sql import functions as F

from regiocast.llm import inner_products
from regiocast.llm.inner_products import top_products


def brute(rows, k=5, scale=256):
    good = [(i, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q)[:k]
        out += [(q, r, c, -s) for r, (s, c) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block, part, wide", [(4096, 1024, True), (37, 8, True), (37, 8, False)])
def test_equals_brute_force(spark, monkeypatch, block, part, wide):
    """With and without a vector too long for doubles; blocks and slices of several sizes."""
    monkeypatch.setattr(inner_products, "BLOCK", block)
    monkeypatch.setattr(inner_products, "SLICE", part)
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(6, 8)) * [9, 5, 1, 1, .5, .1, .1, .1]
    rows = [(int(i), (base[i % 6] * rnd.choice([.2, 1, 3]) + rnd.normal(size=8) * .2).tolist())
            for i in range(300)]
    rows += [(400 + i, [1.0] + [0.0] * 7) for i in range(60)]  # ties
    rows += [(1000, None), (1001, [None] * 8), (1050, [float("nan")] * 8),
             (1100, [float("inf")] + [0.0] * 7), (1150, [0.0] * 8), (1200, [0.5, 0.25]),
             (1250, []), (None, [99.0] * 8)]
    rows += [(1201, [3e30] * 8)] if wide else []
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows],
                               "vec_id bigint, embedding array<float>, score string, rank int")
    got = top_products(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    limit = (1 << 63) - 1
    held = [(i, None if v is None else [None if x is None else x if not np.isfinite(x) else
                                        float(np.clip(x, -2.0 ** 45, 2.0 ** 45)) for x in v])
            for i, v in rows]
    want = sorted((q, r, c, max(-limit - 1, min(limit, s))) for q, r, c, s in brute(held))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_small_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [2.0]), (1, [2.0])]):
        df = spark.createDataFrame(rows, schema)
        got = top_products(df, F.col("vec_id") % 50 == 0).collect()
        assert [r.vec_id for r in got] == [1] * (len(rows) - 1 if rows else 0)


@pytest.mark.parametrize("seed", range(6))
def test_best_of_a_block(seed):
    """Both ways through a block against all products, with ties, copies, floors and no floors."""
    rnd = np.random.default_rng(seed)
    width, k = 24, 5
    c = np.floor(rnd.normal(size=(700, width)) * rnd.choice([1, 4, 30], size=(700, 1)))
    c[100:400] = c[7]  # one vector many times
    c = c[np.argsort(-np.linalg.norm(c, axis=1), kind="stable")]
    q = np.vstack([c[::20], np.zeros((1, width))])
    ids, asked = rnd.permutation(700).astype(np.int64), np.arange(36, dtype=np.int64) * 20
    rotation = np.linalg.svd(c, full_matrices=False)[2].T
    products = q @ c.T
    want = [sorted((-int(s), int(i)) for s, i in zip(row, ids) if i != mine)[:k]
            for row, mine in zip(products, asked)]
    floors = np.array([-w[-1][0] for w in want], dtype=float)
    for low in (np.full(36, -np.inf), floors, np.where(np.arange(36) % 2, floors, -np.inf)):
        for best in (inner_products.best_exact, inner_products.best_wide):
            at, names, scores = best(q, c, asked, ids, k, low.copy(), rotation, 4)
            got = [[(-int(scores[t]), int(names[t])) for t in np.flatnonzero(at == i)]
                   for i in range(36)]
            assert got == want
