"""A small causal self-attention model over subword ids, in numpy: forward, backward, windows.

The next id is predicted in two steps: a softmax over classes of ids, from one attention head
over the window, and the id's share of its class in the training counts. Frequent ids are
classes of their own, the others form bins of equal mass. The probabilities of all ids and of
the end add up to one after every context.

A text is cut into blocks of ``STRIDE`` targets. A block's window holds the ``WINDOW`` inputs
up to its last target, so windows overlap, every target is scored once, and each sees at least
``WINDOW - STRIDE`` inputs where the text has them. Windows of many texts form one batch.
"""

from __future__ import annotations

import numpy as np

WINDOW, STRIDE = 32, 16
ROWS, DIM, HIDDEN = 1024, 16, 24  # input rows, width, width before the classes
OWN, BINS = 47, 16  # ids with a class of their own, bins for the others; the end is one more
BATCH = 256
_AT = (WINDOW - STRIDE + np.arange(STRIDE))[:, None] - np.arange(WINDOW)[None, :]  # distance
_CAUSAL = np.where(_AT >= 0, 0.0, -1e9).astype(np.float32)
_PAST = (_AT >= 0).astype(np.float32)
_FAR = np.maximum(_AT, 0)
SAFE = 60  # exponents up to here, either way, need no shift


class Classes:
    """Class of every id, log10 of its share there, and its input row, from training counts.

    ``counts[i]`` is how often id ``i`` occurs; the last entry stands for the end.
    """

    def __init__(self, counts: np.ndarray):
        n = len(counts) - 1
        order = np.argsort(-counts[:n], kind="stable")
        mass = counts[:n][order].astype(np.float64) + 1
        own = min(OWN, n)
        rest = mass[own:]
        bins = np.minimum((np.cumsum(rest) - rest) * BINS / max(rest.sum(), 1.0), BINS - 1)
        self.of = np.empty(n + 1, dtype=np.int32)
        self.of[order[:own]] = np.arange(own)
        self.of[order[own:]] = own + bins.astype(np.int32)
        self.of[n] = OWN + BINS
        weight = np.append(counts[:n].astype(np.float64) + 1, 1.0)
        total = np.bincount(self.of, weights=weight, minlength=OWN + BINS + 1)
        self.share = np.log10(weight / total[self.of])
        self.row = np.empty(n + 1, dtype=np.int32)
        self.row[order] = np.minimum(np.arange(n), ROWS - 2)
        self.row[n] = ROWS - 1
        mean = np.bincount(self.of, weights=np.append(counts[:n], max(counts[n], 1)) + 0.5,
                           minlength=OWN + BINS + 1) + 1e-3
        self.start = np.log(mean / mean.sum()).astype(np.float32)


SHAPES = {"e": (ROWS, DIM), "q": (DIM, DIM), "k": (DIM, DIM), "v": (DIM, DIM),
          "far": (WINDOW,), "w1": (DIM, HIDDEN), "w2": (DIM, HIDDEN), "b": (HIDDEN,),
          "u": (HIDDEN, OWN + BINS + 1), "c": (OWN + BINS + 1,)}


def fresh(start: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    p = {n: (rng.normal(size=s) * (0.3 if n == "e" else s[0] ** -0.5)).astype(np.float32)
         for n, s in SHAPES.items()}
    p["far"][:] = 0
    p["b"][:] = 0
    p["u"] *= 0.3
    p["c"] = start.copy()
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[n].ravel() for n in SHAPES])


def parts(values: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays that ``flat`` put together, as views."""
    out, at = {}, 0
    for n, s in SHAPES.items():
        size = int(np.prod(s))
        out[n] = values[at:at + size].reshape(s)
        at += size
    return out


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    return parts(np.asarray(values, dtype=np.float32))


def windows(texts: list[np.ndarray], end: int):
    """Inputs (-1: none), targets (-1: none) and text number of all blocks of ``texts``."""
    inputs, targets, owner = [], [], []
    for i, ids in enumerate(texts):
        seq = np.concatenate([[end], ids, [end]]).astype(np.int64)
        n = -(-(len(seq) - 1) // STRIDE)
        padded = np.full(WINDOW - STRIDE + n * STRIDE + 1, -1, dtype=np.int64)
        padded[WINDOW - STRIDE:WINDOW - STRIDE + len(seq)] = seq
        view = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE][:n]
        inputs.append(view)
        targets.append(padded[WINDOW - STRIDE + 1:][:n * STRIDE].reshape(n, STRIDE))
        owner.append(np.full(n, i))
    return np.concatenate(inputs), np.concatenate(targets), np.concatenate(owner)


def row_sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis; a product with ones is faster than a short reduction."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], np.float32)).reshape(x.shape[:-1])


def exponents(x: np.ndarray) -> np.ndarray:
    """exp of ``x`` in place, shifted by each row's maximum only where values are beyond ``SAFE``;
    gives the shifts."""
    top = np.zeros(1, np.float32)
    if not (x.max(initial=0) < SAFE and x.min(initial=0) > -SAFE):
        top = x.max(axis=1)
        x -= top[:, None]
    np.exp(x, out=x)
    return top


def attended(a: np.ndarray, far: np.ndarray, inputs: np.ndarray) -> None:
    """Products of places to weights that add up to one over what a place may see, in place."""
    first = np.flatnonzero(inputs[:, 0] < 0)  # windows with places that hold nothing
    a += far[_FAR]
    if a.max(initial=0) < SAFE and a.min(initial=0) > -SAFE:
        np.exp(a, out=a)
        a *= _PAST
        a[first] *= (inputs[first] >= 0)[:, None, :]
    else:
        a += _CAUSAL
        a[first] += np.where(inputs[first] >= 0, np.float32(0), np.float32(-1e9))[:, None, :]
        a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
    a /= row_sums(a)[:, :, None]


def squash(x: np.ndarray) -> np.ndarray:
    """tanh in place, by the exponential function, which numpy vectorises."""
    np.minimum(x, np.float32(15), out=x)
    x *= np.float32(2)
    np.exp(x, out=x)
    x += np.float32(1)
    np.divide(np.float32(-2), x, out=x)
    x += np.float32(1)
    return x


def layers(p: dict, inputs: np.ndarray, classes: Classes):
    """Class logits of every target place, one row each, with what backward needs."""
    n = len(inputs)
    rows = np.where(inputs >= 0, classes.row[inputs], 0).ravel()
    e = p["e"].take(rows, axis=0)
    eq = e.reshape(n, WINDOW, DIM)[:, WINDOW - STRIDE:].reshape(-1, DIM)
    of_all = np.concatenate([p["k"], p["v"]], axis=1)
    of_own = np.concatenate([p["q"] * np.float32(DIM ** -0.5), p["w1"]], axis=1)
    kv = (e @ of_all).reshape(n, WINDOW, 2 * DIM)
    own = eq @ of_own
    k, v, q = kv[:, :, :DIM], kv[:, :, DIM:], own.reshape(n, STRIDE, -1)[:, :, :DIM]
    a = q @ k.transpose(0, 2, 1)
    attended(a, p["far"], inputs)
    seen = (a @ v).reshape(-1, DIM)
    h = seen @ p["w2"]
    h += own[:, DIM:]
    h += p["b"]
    squash(h)
    z = h @ p["u"]
    z += p["c"]
    return z, (rows, e, eq, of_all, of_own, q, k, v, a, seen, h)


def forward(p: dict, inputs: np.ndarray, classes: Classes):
    """Log class probabilities (natural) of every target place, with what backward needs."""
    z, kept = layers(p, inputs, classes)
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(row_sums(np.exp(z)))[:, None]
    return z.reshape(len(inputs), STRIDE, -1), kept


def target_logs(p: dict, inputs: np.ndarray, classes: np.ndarray, tables: tuple) -> np.ndarray:
    """Natural log class probability of each target: ``forward`` without what learning needs.

    Projections of the 1,024 input rows are looked up in ``tables``.
    """
    rows, q, k, v, w1 = tables
    at = rows[inputs]
    own = at[:, WINDOW - STRIDE:]
    a = q.take(own, axis=0) @ k.take(at, axis=0).transpose(0, 2, 1)
    attended(a, p["far"], inputs)
    h = (a @ v.take(at, axis=0)).reshape(-1, DIM) @ p["w2"]
    h += w1.take(own, axis=0).reshape(-1, HIDDEN)
    squash(h)
    z = h @ p["u"]
    z += p["c"]
    found = z[np.arange(len(z)), classes.ravel()]
    found -= exponents(z)
    return (found - np.log(row_sums(z))).reshape(classes.shape)


def text_scores(p: dict, texts: list[np.ndarray], classes: Classes) -> np.ndarray:
    """log10 probability of each text with its end."""
    end = len(classes.of) - 1
    inputs, targets, owner = windows(texts, end)
    e = p["e"]
    tables = (np.append(classes.row, 0), e @ p["q"] * np.float32(DIM ** -0.5), e @ p["k"],
              e @ p["v"], e @ p["w1"] + p["b"])  # input -1 reads the row behind the last
    total = np.zeros(len(texts))
    for lo in range(0, len(inputs), BATCH):
        t = targets[lo:lo + BATCH]
        there = np.maximum(t, 0)
        found = target_logs(p, inputs[lo:lo + BATCH], classes.of[there], tables)
        found = np.where(t >= 0, found / np.log(10.0) + classes.share[there], 0.0)
        np.add.at(total, owner[lo:lo + BATCH], found.sum(axis=1))
    return total


def gradients(p: dict, inputs: np.ndarray, targets: np.ndarray, classes: Classes):
    """Mean loss over the targets and its gradient.

    Rows of all windows stand below each other, so that weights meet them in one product;
    products that share an operand are made together, and elementwise steps run in place.
    """
    m = len(inputs)
    z, (rows, e, eq, of_all, of_own, q, k, v, a, seen, h) = layers(p, inputs, classes)
    on = targets.ravel() >= 0
    n = max(int(on.sum()), 1)
    cls = classes.of[np.maximum(targets, 0)].ravel()
    place = np.arange(len(cls))
    found = z[place, cls]
    found -= exponents(z)
    sums = row_sums(z)
    loss = (np.log(sums) - found)[on].sum() / n
    share = (on / n).astype(np.float32)
    dz = z
    dz *= (share / sums)[:, None]
    dz[place, cls] -= share
    ones = np.ones(len(dz), np.float32)
    g = {"u": h.T @ dz, "c": ones @ dz}
    d_own = np.empty((len(dz), DIM + HIDDEN), np.float32)
    dh = dz @ p["u"].T
    h *= h
    np.subtract(np.float32(1), h, out=h)
    dh *= h
    d_own[:, DIM:] = dh
    g["w2"] = seen.T @ dh
    g["b"] = ones @ dh
    dseen = dh @ p["w2"].T
    d3 = dseen.reshape(m, STRIDE, DIM)
    ds = d3 @ v.transpose(0, 2, 1)
    ds -= row_sums(dseen * seen).reshape(m, STRIDE, 1)
    ds *= a
    g["far"] = np.bincount(_FAR.ravel(), minlength=WINDOW, weights=np.ones(
        m, np.float32) @ ds.reshape(m, -1)).astype(np.float32)
    d_all = np.empty((m, WINDOW, 2 * DIM), np.float32)
    np.matmul(ds.transpose(0, 2, 1), q, out=d_all[:, :, :DIM])
    np.matmul(a.transpose(0, 2, 1), d3, out=d_all[:, :, DIM:])
    np.matmul(ds, k, out=d_own.reshape(m, STRIDE, -1)[:, :, :DIM])
    d_all = d_all.reshape(-1, 2 * DIM)
    both = e.T @ d_all
    g["k"], g["v"] = both[:, :DIM], both[:, DIM:]
    both = eq.T @ d_own
    g["q"], g["w1"] = both[:, :DIM] * np.float32(DIM ** -0.5), both[:, DIM:]
    de = d_all @ of_all.T
    in_windows = de.reshape(m, WINDOW, DIM)
    in_windows[:, WINDOW - STRIDE:] += (d_own @ of_own.T).reshape(m, STRIDE, DIM)
    first = np.flatnonzero(inputs[:, 0] < 0)
    in_windows[first] *= (inputs[first] >= 0)[:, :, None]
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    sorted_rows = rows[order]
    new = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
    g["e"] = np.zeros_like(p["e"])
    g["e"][sorted_rows[new]] = np.add.reduceat(de.take(order, axis=0), new, axis=0)
    return loss, g


class Adam:
    """The usual running moments, held by the trainer of one shard.

    ``p`` stays the caller's dictionary; its arrays become parts of one, which is stepped at once.
    """

    def __init__(self, p: dict, rate: float = 0.01):
        self.p, self.rate, self.t = p, rate, 0
        self.x = flat(p)
        p.update(parts(self.x))
        self.m, self.v = np.zeros_like(self.x), np.zeros_like(self.x)

    def step(self, g: dict) -> None:
        self.t += 1
        rate = self.rate * (1 - 0.99 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        rate /= 1 + self.t / 200
        by = flat(g)
        move = by - self.m
        move *= np.float32(0.1)
        self.m += move
        by *= by
        by -= self.v
        by *= np.float32(0.01)
        self.v += by
        np.sqrt(self.v, out=move)
        move += np.float32(1e-8)
        np.divide(self.m, move, out=move)
        move *= np.float32(rate)
        self.x -= move
