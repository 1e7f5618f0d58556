"""Word shingles of whole texts as 64-bit hashes, computed over many texts at once in numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LETTERS = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 64, size=256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}
TOGETHER = 1 << 20  # bytes hashed at once; one longer text is hashed alone


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(max(n, TOGETHER + 1), base, dtype=np.uint64)
            row[0] = 1
            _POWERS[name] = np.cumprod(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and how many words each text has."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[raw]
    opens = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    closes = np.flatnonzero(space & ~np.concatenate([[True], space[:-1]]))
    up, down = _powers(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[raw] * up)])
    hashes = mix((total[closes] - total[opens]) * down[opens]
                 + (closes - opens).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.concatenate([[0], np.searchsorted(opens, ends)]))


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased.

    With fewer words than ``size`` the whole sequence is one shingle; without words, none.
    """
    out: list[np.ndarray] = []
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    lo = 0
    while lo < len(raw):
        hi, held = lo + 1, len(raw[lo])
        while hi < len(raw) and held + len(raw[hi]) < TOGETHER:
            held += len(raw[hi]) + 1
            hi += 1
        words, counts = word_hashes(raw[lo:hi])
        chain = np.zeros(max(len(words) - size + 1, 0), dtype=np.uint64)
        for k in range(size):
            chain = mix(chain * np.uint64(_BASE) + words[k:k + len(chain)])
        at = 0
        for n in counts.tolist():
            if n >= size:
                out.append(np.unique(chain[at:at + n - size + 1]))
            elif n:
                whole = np.full(1, n, dtype=np.uint64)
                for k in range(n):
                    whole = mix(whole * np.uint64(_BASE) + words[at + k:at + k + 1])
                out.append(whole)
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += n
        lo = hi
    return out
