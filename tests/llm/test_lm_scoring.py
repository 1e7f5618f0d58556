import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from conftest import SF
from regiocast.llm import attention
from regiocast.llm.lm_scoring import score_documents, train
from regiocast.llm.tokens import coder

WORD = public_tokenizers.path("word_bpe_49k.json")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)) + [None]


def check_base(rows, got):
    train = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(words(t))
    n, v = sum(train.values()), len(train)
    for i, t in rows:
        r = got[i]
        w = words(t)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r.n_tokens, r.train_tokens) == (len(w), n)
        assert r.n_known == sum(train[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(math.log10((train[x] + 1) / (n + v + 1))
                                                 for x in w), rel=1e-9)
        assert r.score < 0


def test_all_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = {r.doc_id: r for r in score_documents(df, WORD).collect()}
    assert len(got) == len(rows)
    check_base(rows, got)


def test_odd_documents(spark):
    rows = [(i, t) for i, t in enumerate([None, "", "A a\tB", "x" * 5000, "w " * 9000, "É é\n"] * 4)]
    df = spark.createDataFrame([(*r, 1, 2) for r in [*rows, rows[2]]],
                               "doc_id bigint, text string, n_tokens int, fp string")
    out = score_documents(df, WORD).collect()
    assert len(out) == len(rows) + 1
    assert len({(r.base_score, r.score) for r in out if r.doc_id == 2}) == 1
    got = {r.doc_id: r for r in out}
    assert all(math.isfinite(r.score) for r in out)
    rows.append(rows[2])
    check_base(rows, got)
    assert score_documents(df.limit(0), WORD).count() == 0


def small_model():
    code = coder("word", WORD)
    ids = [np.frombuffer(x, "<u4") for x in code.encode(
        ["the cat sat on the mat . " * 9, "a dog ran", "", "one two three four " * 40])]
    counts = np.bincount(np.concatenate(ids), minlength=code.size)
    classes = attention.Classes(np.append(counts, len(ids)))
    return code.size, ids, classes, attention.fresh(classes.start)


def test_probabilities_of_all_ids_add_up():
    size, ids, classes, p = small_model()
    inputs, _, _ = attention.windows(ids, size)
    z, _ = attention.forward(p, inputs, classes)
    each = np.exp(z[0, 3])[classes.of] * 10 ** classes.share
    assert each.sum() == pytest.approx(1, abs=1e-4)


def test_windows_score_each_token_once_with_its_own_context():
    size, ids, classes, p = small_model()
    for text, total in zip(ids, attention.text_scores(p, ids, classes)):
        seq = np.concatenate([[size], text, [size]]).astype(np.int64)
        want = 0.0
        for t in range(1, len(seq)):  # one token at a time, from the window of its block
            last = -(-t // attention.STRIDE) * attention.STRIDE
            seen = seq[max(0, last - attention.WINDOW):t]
            e = p["e"][classes.row[seen]].astype(float)
            far = p["far"][np.arange(len(seen))[::-1]]
            a = e[-1] @ p["q"] @ (e @ p["k"]).T / math.sqrt(attention.DIM) + far
            a = np.exp(a - a.max())
            h = np.tanh(e[-1] @ p["w1"] + (a / a.sum()) @ (e @ p["v"]) @ p["w2"] + p["b"])
            z = h @ p["u"] + p["c"]
            z = z - z.max()
            want += (z[classes.of[seq[t]]] - math.log(np.exp(z).sum())) / math.log(10)
            want += classes.share[seq[t]]
        assert total == pytest.approx(want, rel=1e-4)


def test_training_lowers_the_loss():
    size, ids, classes, p = small_model()
    inputs, targets, _ = attention.windows(ids, size)
    before = attention.gradients(p, inputs, targets, classes)[0]
    adam = attention.Adam(p)
    for _ in range(60):
        adam.step(attention.gradients(p, inputs, targets, classes)[1])
    assert attention.gradients(p, inputs, targets, classes)[0] < before / 2


def test_model_learns_from_every_training_row(spark):
    size, ids, classes, p = small_model()
    rnd = np.random.default_rng(3)
    rows = [(i, i, i % 7 != 2, rnd.choice(ids[0], 40 + i).astype("<u2").tobytes())
            for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, fp bigint, train boolean, ids binary")
    got = train(df.coalesce(1), classes, size)
    adam, rng = attention.Adam(p), np.random.default_rng(0)
    inputs, targets, _ = attention.windows(
        [np.frombuffer(r[3], "<u2") for r in rows if r[2]], size)
    order = rng.permutation(len(inputs))
    for at in range(0, len(order), 64):
        some = order[at:at + 64]
        adam.step(attention.gradients(adam.p, inputs[some], targets[some], classes)[1])
    assert np.allclose(attention.flat(got), attention.flat(adam.p), atol=1e-5)
    # one training row of any id moves the weights
    for i in (0, 1, 3, 4):
        one = train(df.where(f"doc_id = {i}"), classes, size)
        assert not np.array_equal(one["c"], attention.fresh(classes.start)["c"])


def weights_beyond_the_usual():
    size, ids, classes, p = small_model()
    rnd = np.random.default_rng(5)
    p["far"][3], p["far"][20], p["c"][2], p["c"][5] = 90, -200, 100, -300
    p["q"] *= 30
    p["u"] += rnd.normal(size=p["u"].shape).astype(np.float32) * 20
    return size, ids, classes, p


def test_scores_hold_for_large_weights():
    """No exponent is cut: scores are those of the forward pass, whatever the weights."""
    size, ids, classes, p = weights_beyond_the_usual()
    for text, total in zip(ids, attention.text_scores(p, ids, classes)):
        inputs, targets, _ = attention.windows([text], size)
        z, _ = attention.forward({n: x.astype(np.float64) for n, x in p.items()}, inputs, classes)
        on, t = targets >= 0, np.maximum(targets, 0)
        logs = np.take_along_axis(z, classes.of[t][:, :, None], axis=2)[:, :, 0] / math.log(10)
        assert total == pytest.approx((logs + classes.share[t])[on].sum(), rel=1e-3)


@pytest.mark.parametrize("model", [small_model, weights_beyond_the_usual])
def test_gradients_are_those_of_the_loss(model):
    size, ids, classes, p = model()
    inputs, targets, _ = attention.windows(ids, size)
    on, t = targets >= 0, np.maximum(targets, 0)
    wide = {n: x.astype(np.float64) for n, x in p.items()}

    def loss():
        z, _ = attention.forward(wide, inputs, classes)
        return -np.take_along_axis(z, classes.of[t][:, :, None], axis=2)[:, :, 0][on].mean()

    got, g = attention.gradients(p, inputs, targets, classes)
    assert got == pytest.approx(loss(), rel=1e-3)
    for n, x in wide.items():
        top = float(np.abs(g[n]).max())
        for at in np.argsort(-np.abs(g[n]).ravel())[:3]:
            at = np.unravel_index(at, x.shape)
            kept, by = x[at], 1e-5
            x[at] = kept + by
            up = loss()
            x[at] = kept - by
            down = loss()
            x[at] = kept
            assert (up - down) / (2 * by) == pytest.approx(float(g[n][at]), rel=2e-2, abs=1e-3 * top + 1e-6)


def test_adam_steps_the_callers_arrays_at_once():
    size, ids, classes, p = small_model()
    inputs, targets, _ = attention.windows(ids, size)
    want = {n: x.astype(np.float64) for n, x in p.items()}
    m, v = ({n: np.zeros_like(x) for n, x in want.items()} for _ in range(2))
    adam = attention.Adam(p)
    for t in range(1, 6):
        g = attention.gradients(p, inputs, targets, classes)[1]
        rate = 0.01 * math.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t) / (1 + t / 200)
        for n in want:
            m[n] += 0.1 * (g[n] - m[n])
            v[n] += 0.01 * (np.square(g[n], dtype=np.float64) - v[n])
            want[n] -= rate * m[n] / (np.sqrt(v[n]) + 1e-8)
        adam.step(g)
    assert all(np.shares_memory(adam.p[n], adam.x) and adam.p[n] is p[n] for n in p)
    assert all(np.allclose(p[n], want[n], atol=1e-4) for n in p)
