"""Adaptive context-mixing range coder for blocks of ids, many blocks in step in numpy.

For every id, order 2 (the two ids before) and order 1 (the id before) each predict one id, the
one that last followed the same context in the block, with a confidence of 0 to 3; order 0
predicts all ids seen so far in the block by their frequencies, and an escape. The three are
mixed into one distribution: how much mass each order gets is learnt in two adaptive tables,
one looked up by both confidences and by whether the predictions agree, one by which orders
were right for the last two ids. One range coder step with 64-bit bounds codes the id; an
escape is followed by the plain 16 bits. Order 0 is brought up to date whenever the number of
ids has doubled, so that many blocks can share the sorting.

A block starts from empty tables, so it is decoded alone; it carries its count and the CRC-32 of
its ids, and a block that does not reproduce its checksum is refused. Blocks are independent, so
the lanes of an array run many of them in step.

Block: ``RCB1``, number of ids and CRC-32 of the ids (as little-endian unsigned 32-bit integers),
both unsigned 32-bit little-endian, then the coder's 32-bit words.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"RCB1"
BLOCK = 8192  # ids of a block
LANES = 1024  # blocks in step
FIRST = 128  # order 0 is first learnt from so many ids
_SLOTS = 4096  # contexts of order 1 and of order 2, by hash
_BITS = 14  # order 0 shares out 2^14
_MOST = 30_000  # an adaptive table is halved beyond this sum
_W = np.uint64(32)
_LOW32 = np.uint64(0xFFFFFFFF)
_ESCAPE = 1 << 16  # sorts behind every id


class CorruptBlock(ValueError):
    """A block's content does not match its header."""


class _Encoder:
    def __init__(self, lanes: int, longest: int):
        self.low = np.zeros(lanes, np.uint64)
        self.span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.words = np.zeros((lanes, longest * 2 + 4), np.uint32)
        self.at = np.zeros(lanes, np.int64)

    def narrow(self, lanes, step, before, freq):
        """Takes [before, before + freq) of the interval, in units of ``step``."""
        low = self.low[lanes] + step * before
        span = step * freq
        top = low >> _W
        same = top == (low + span) >> _W
        move = same | (span <= _LOW32)
        at = np.flatnonzero(move)
        if len(at):
            short = at[~same[at]]
            span[short] = (~low[short] + np.uint64(1)) & _LOW32
            self.shift(lanes[at], top[at])
            low[at] <<= _W
            span[at] <<= _W
        self.low[lanes], self.span[lanes] = low, span

    def shift(self, lanes, top):
        self.words[lanes, self.at[lanes]] = top.astype(np.uint32)
        self.at[lanes] += 1

    def finish(self) -> list[bytes]:
        rows = np.arange(len(self.low))
        self.words[rows, self.at] = (self.low >> _W).astype(np.uint32)
        self.words[rows, self.at + 1] = (self.low & _LOW32).astype(np.uint32)
        return [self.words[i, :n + 2].astype("<u4").tobytes() for i, n in enumerate(self.at)]


class _Decoder(_Encoder):
    def __init__(self, payloads: list[bytes]):
        super().__init__(len(payloads), 0)
        longest = max(len(p) // 4 for p in payloads)
        self.words = np.zeros((len(payloads), longest + 3), np.uint64)
        for i, p in enumerate(payloads):
            row = np.frombuffer(p[:len(p) // 4 * 4], "<u4")
            self.words[i, :len(row)] = row
        self.value = self.words[:, 0] << _W | self.words[:, 1]
        self.at[:] = 2
        self.last = longest + 2

    def shift(self, lanes, top):
        more = self.words[lanes, np.minimum(self.at[lanes], self.last)]
        self.value[lanes] = self.value[lanes] << _W | more
        self.at[lanes] += 1

    def place(self, lanes, step, total):
        return np.minimum((self.value[lanes] - self.low[lanes]) // step, total - np.uint64(1))


class _OrderZero:
    """Frequencies of the ids seen so far and of the escape, for every lane, out of 2^_BITS."""

    def __init__(self, ids: np.ndarray, seen: int):
        lanes = len(ids)
        own = np.arange(lanes, dtype=np.int64)[:, None] << 17
        keys, counts = np.unique(own + ids[:, :seen], return_counts=True)
        lane = keys >> 17
        distinct = np.bincount(lane, minlength=lanes)
        first = np.cumsum(distinct) - distinct
        room = (1 << _BITS) - distinct - 1
        total = seen + distinct  # the escape weighs as much as there are distinct ids
        freq = 1 + counts * room[lane] // total[lane]
        spent = np.bincount(lane, weights=freq, minlength=lanes).astype(np.int64)
        at = np.arange(len(keys)) + lane
        self.keys = np.empty(len(keys) + lanes, np.int64)
        self.freq = np.empty(len(keys) + lanes, np.int64)
        self.keys[at], self.freq[at] = keys, freq
        last = first + distinct + np.arange(lanes)
        self.keys[last] = own[:, 0] + _ESCAPE
        self.freq[last] = (1 << _BITS) - spent
        self.before = np.cumsum(self.freq) - self.freq  # lane l starts at l << _BITS
        self.escape = last

    def find(self, lanes, ids):
        """Row of each id, the escape's where it was not seen."""
        key = (lanes << 17) + ids
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[np.minimum(at, len(self.keys) - 1)] == key, at,
                        self.escape[lanes])

    def at(self, lanes, place):
        return np.searchsorted(self.before, (lanes << _BITS) + place, side="right") - 1


def _run(coder, sizes: np.ndarray, ids: np.ndarray) -> None:
    """Drives the model over all lanes; ``ids`` is read when encoding and filled when decoding."""
    decoding = isinstance(coder, _Decoder)
    n = len(sizes)
    by_confidence, by_past = np.ones((n * 32, 3), np.int64), np.ones((n * 9, 3), np.int64)
    guess = np.full((2, n * _SLOTS), -1, np.int32)
    sure = np.zeros((2, n * _SLOTS), np.int8)
    prev1, prev2, past = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    zero, learn_at = _OrderZero(ids, 0), FIRST
    lane = np.arange(n)
    known = None
    for t in range(int(sizes.max(initial=0))):
        if t == learn_at:
            zero, learn_at, known = _OrderZero(ids, t), 2 * t, None
        if not decoding and known is None:  # rows of all ids up to the next learning
            stop = min(learn_at, ids.shape[1])
            known, start = zero.find(np.repeat(np.arange(n), stop - t),
                                     ids[:, t:stop].ravel()).astype(np.int32).reshape(n, -1), t
        if t and (sizes[lane] <= t).any():
            lane = lane[sizes[lane] > t]
        a, b = prev1[lane], prev2[lane]
        slot1 = lane * _SLOTS + ((a * 40503) >> 4) % _SLOTS
        slot2 = lane * _SLOTS + ((a * 40503 + b * 30011) >> 3) % _SLOTS
        g1, g2 = guess[0][slot1], guess[1][slot2]
        n1, n2 = sure[0][slot1], sure[1][slot2]
        row1 = lane * 32 + n2 * 8 + n1 * 2 + (g1 == g2)
        row2 = lane * 9 + past[lane]
        mass = by_confidence[row1] + by_past[row2]
        e2, e1, e0 = mass[:, 0], mass[:, 1], mass[:, 2]
        both = e2 + e1
        total = ((both + e0) << _BITS).astype(np.uint64)
        step = coder.span[lane] // total
        if decoding:
            place = coder.place(lane, step, total).astype(np.int64)
            event = np.where(place < e2 << _BITS, 0, np.where(place < both << _BITS, 1, 2))
            row = zero.at(lane, np.maximum(place - (both << _BITS), 0) // e0)
        else:
            now = ids[lane, t]
            event = np.where(now == g2, 0, np.where(now == g1, 1, 2))
            row = known[lane, t - start]
        plain = event == 2
        before = np.where(plain, (both << _BITS) + e0 * (zero.before[row] - (lane << _BITS)),
                          np.where(event == 0, 0, e2 << _BITS))
        freq = np.where(plain, e0 * zero.freq[row], np.where(event == 0, e2, e1) << _BITS)
        coder.narrow(lane, step, before.astype(np.uint64), freq.astype(np.uint64))
        if decoding:
            now = np.where(plain, zero.keys[row], np.where(event == 0, g2, g1)) & 0xFFFF
        raw = np.flatnonzero(plain & (row == zero.escape[lane]))
        if len(raw):
            sub = lane[raw]
            step = coder.span[sub] >> np.uint64(16)
            if decoding:
                now[raw] = coder.place(sub, step, np.uint64(1 << 16)).astype(np.int64)
            coder.narrow(sub, step, now[raw].astype(np.uint64), np.uint64(1))
        if decoding:
            ids[lane, t] = now
        by_confidence[row1, event] += 24
        by_past[row2, event] += 8
        if t % 512 == 511:
            for table in (by_confidence, by_past):
                large = np.flatnonzero(table.sum(axis=1) > _MOST >> 1)
                table[large] = (table[large] + 1) >> 1
        past[lane] = past[lane] % 3 * 3 + event
        for order, slot, g, s in ((0, slot1, g1, n1), (1, slot2, g2, n2)):
            guess[order][slot] = now
            sure[order][slot] = np.where(g == now, np.minimum(s + 1, 3), 0)
        prev2[lane], prev1[lane] = a, now


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of at most ``BLOCK`` ids below 65,536 as self-contained bytes."""
    out: list[bytes] = []
    for lo in range(0, len(blocks), LANES):
        part = blocks[lo:lo + LANES]
        sizes = np.array([len(x) for x in part], dtype=np.int64)
        if sizes.max() > BLOCK or any(len(x) and int(x.max()) > 0xFFFF for x in part):
            raise ValueError(f"blocks hold at most {BLOCK} ids below 65536")
        ids = np.zeros((len(part), int(sizes.max())), np.int32)
        for i, x in enumerate(part):
            ids[i, :len(x)] = x
        coder = _Encoder(len(part), int(sizes.max()))
        _run(coder, sizes, ids)
        for x, words in zip(part, coder.finish()):
            raw = np.asarray(x, "<u4").tobytes()
            out.append(MAGIC + np.array([len(x), zlib.crc32(raw)], "<u4").tobytes() + words)
    return out


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block as little-endian unsigned 32-bit integers, checked."""
    out: list[np.ndarray] = []
    for lo in range(0, len(blocks), LANES):
        part = blocks[lo:lo + LANES]
        if any(len(b) < 20 or b[:4] != MAGIC for b in part):
            raise CorruptBlock("no block header")
        heads = np.array([np.frombuffer(b, "<u4", 2, 4) for b in part], dtype=np.int64)
        if heads[:, 0].max() > BLOCK:
            raise CorruptBlock("a block cannot hold that many ids")
        ids = np.zeros((len(part), int(heads[:, 0].max())), np.int32)
        _run(_Decoder([b[12:] for b in part]), heads[:, 0], ids)
        for i, (n, crc) in enumerate(heads.tolist()):
            row = ids[i, :n].astype("<u4")
            if zlib.crc32(row.tobytes()) != crc:
                raise CorruptBlock("checksum of a block does not match its ids")
            out.append(row)
    return out
