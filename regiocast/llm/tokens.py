"""Exact token ids of whole texts, at one tokenizer call per distinct word and worker.

Both vocabularies treat words cut at blanks and line feeds independently, so a text's ids are
the concatenation of its words' ids. A worker keeps the ids of the words it has seen (at most
``keep``; then it starts anew) and asks the tokenizer only for new ones. Texts to which the
argument does not apply - runs of white space, special token strings - are encoded directly.
"""

from __future__ import annotations

import gc
import re

import numpy as np

KEEP = 500_000
TOGETHER = 400
_OTHER_SPACE = re.compile(r"[^\S \n]")
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space for Python, symbols for the tokenizer
_LOADED: dict = {}


def coder(kind: str, path: str, keep: int = KEEP) -> WordCoder:
    """The worker's coder for a vocabulary file; its word table outlives the task."""
    key = kind, path, keep
    if key not in _LOADED:
        kinds = {"byte": ByteCoder, "word": WordEndCoder, "spans": SpanCoder}
        _LOADED[key] = kinds[kind](path, keep)
    return _LOADED[key]


def to_bytes(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class WordCoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, keep: int = KEEP):
        from tokenizers import Tokenizer

        self.keep = keep
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        self.known: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return to_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        collecting = gc.isenabled()
        gc.disable()  # the many short lists hold no cycles
        try:
            return [ids for lo in range(0, len(texts), 500)
                    for ids in self._encode(texts[lo:lo + 500])]
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        plan, fresh = [], set()
        get = self.known.get
        for text in texts:
            words = self.split(text)
            if words is None:
                plan.append(self.direct(text))
                continue
            found = list(map(get, words))
            if None in found:
                fresh.update([w for w, f in zip(words, found) if f is None])
                plan.append([words, found])
            else:
                plan.append(self.joined(words, found))
        new = {}
        if fresh:
            fresh = sorted(fresh)
            for lo in range(0, len(fresh), TOGETHER):
                new.update(self.learn(fresh[lo:lo + TOGETHER]))
            if len(self.known) + len(new) > self.keep:
                self.known.clear()
            self.known.update(new)
        return [p if not isinstance(p, list) else
                self.joined(p[0], [new[w] if f is None else f for w, f in zip(*p)])
                for p in plan]


class ByteCoder(WordCoder):
    """Byte-level vocabulary: a blank or line feed belongs to the word behind it."""

    def __init__(self, path: str, keep: int = KEEP):
        super().__init__(path, keep)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.size)]
        self.opens = np.array([n[:1] in ("Ġ", "Ċ") for n in names])  # blank, line feed
        self.closes = np.array([n[-1:] in (".", "!", "?") for n in names])
        self.skip = len(self.direct("\n"))

    def split(self, text: str) -> list[str] | None:
        """Words; one that starts a line keeps the line feed. None: encode the text directly."""
        if (not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text
                or "\n " in text or "\n\n" in text or any(s in text for s in self.special)):
            return None
        if (any(c in text for c in "\t\r\v\f" + _SEPARATORS)
                or not text.isascii() and _OTHER_SPACE.search(text)):
            return None
        return ("\n" + text.replace("\n", " \n")).split(" ")

    def joined(self, words: list[str], found: list[bytes]) -> bytes:
        return b"".join(found)[self.skip:]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Many words to a call; each opens with a blank or line feed, where the ids are cut."""
        spaced = [w if w[0] == "\n" else " " + w for w in words]
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(spaced)],
                                                        add_special_tokens=False)[0].ids, "<u4")
        cuts = (np.flatnonzero(self.opens[ids]) * 4).tolist()
        if len(cuts) != len(words):
            return {w: self.direct(s) for w, s in zip(words, spaced)}
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, cuts, cuts[1:] + [len(raw)])}


class SpanCoder(ByteCoder):
    """Character spans (start, stop) of the tokens instead of their ids, as 32-bit pairs.

    ``encode`` gives a text's ``n x 2`` array. A word's spans are kept relative to its blank or
    line feed, which no token of another word reaches.
    """

    def direct(self, text: str) -> bytes:
        got = self.tokenizer.encode(text, add_special_tokens=False).offsets
        return np.array(got, dtype="<i4").tobytes()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(raw, dtype="<i4").reshape(-1, 2)
                for raw in super()._encode(texts)]

    def joined(self, words: list[str], found: list[bytes]) -> bytes:
        sizes = np.array([len(w) + (w[:1] != "\n") for w in words])
        begins = (np.cumsum(sizes) - sizes - 1).astype("<i4")  # the first line feed is no text
        counts = np.array([len(f) for f in found]) >> 3
        spans = np.frombuffer(b"".join(found), dtype="<i4").reshape(-1, 2)
        return (spans + np.repeat(begins, counts)[:, None]).tobytes()[self.skip:]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """A letter in front, so that no word stands at the start of a text."""
        spaced = [w if w[:1] == "\n" else " " + w for w in words]
        got = self.tokenizer.encode_batch(["x" + "".join(spaced)], add_special_tokens=False)[0]
        cuts = np.flatnonzero(self.opens[np.array(got.ids)])
        if len(cuts) != len(words):
            return {w: self._alone(s) for w, s in zip(words, spaced)}
        sizes = np.array([len(w) for w in spaced])
        begins = np.cumsum(sizes) - sizes + 1
        spans = np.array(got.offsets, dtype="<i4")[cuts[0]:]
        counts = np.diff(np.append(cuts, len(got.ids)))
        raw = (spans - np.repeat(begins, counts)[:, None]).astype("<i4").tobytes()
        ends = np.cumsum(counts * 8).tolist()
        return {w: raw[a:b] for w, a, b in zip(words, [0] + ends, ends)}

    def _alone(self, word: str) -> bytes:
        got = self.tokenizer.encode("x" + word, add_special_tokens=False).offsets
        return (np.array(got[1:], dtype="<i4") - 1).astype("<i4").tobytes()


class WordEndCoder(WordCoder):
    """Vocabulary with word ends: white space is dropped and never part of a token."""

    def split(self, text: str) -> list[str] | None:
        if any(c in text for c in _SEPARATORS) or any(s in text for s in self.special):
            return None
        return text.split()

    def joined(self, words: list[str], found: list[bytes]) -> bytes:
        return b"".join(found)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        got = self.tokenizer.encode_batch([" ".join(words)], add_special_tokens=False)[0]
        at = np.array([a for a, _ in got.offsets], dtype=np.int64)
        ends = (np.searchsorted(at, np.cumsum([len(w) + 1 for w in words])) * 4).tolist()
        raw = to_bytes(got.ids)
        return {w: raw[a:b] for w, a, b in zip(words, [0] + ends, ends)}
