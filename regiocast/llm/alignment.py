"""Alignment of two tokenizers on the same bytes, by an associative monoid of fragments.

Both token sequences cut the bytes of blank + text. Offsets where both end a token cut them into
groups. A ``Fragment`` is what a range of bytes shows of this without its surroundings: the tokens
up to its first common end (open prefix: where that group starts is not known yet), the closed
groups behind, and the tokens after its last common end (open suffix). ``compose`` joins the
fragments of neighbouring ranges; it is associative, so a very long text is cut into chunks that
any tasks read, and their fragments are composed in a tree of ``FAN`` at a time. A token belongs
to the range in which it ends.

Texts of up to ``CHUNK`` bytes are one range and never leave their task. Longer ones are cut
before a single blank between two letters or digits, where both tokenizers always start a token,
and each chunk is split into ranges of ``RANGE`` bytes again. A stretch without such a place
stays one chunk, however long.

Links: pairs of tokens that end together, one for every group. Their counts over all texts come
from one aggregation by pair. The ``HOT`` most frequent pairs (a bounded table, 12 bytes each) are
looked up in the tasks; links of rarer pairs are joined with their counts. The highest count of a
B id is a table of at most the vocabulary's size.

Null and empty texts, and texts whose tokens do not give back blank + text on either side (the
mark U+2581 itself, for instance), have no tokens: zeros and an empty hash. Equal rows, null ids
and ids with several texts are rows of their own. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.llm.tokens import ByteCoder
from regiocast.session import scratch_path

CHUNK = 1 << 16
RANGE = 1 << 13
FAN = 16
WORDS = 300_000  # words whose groups a worker keeps
HOT = 500_000
TOGETHER = 1 << 18  # bytes aligned at once
B_BITS = 15  # pair code: A id << 15 | B id
_LOADED: dict = {}


class SpacedCoder(ByteCoder):
    """Ids of blank + text; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []

    def split(self, text: str) -> list[str] | None:
        units = super().split(text[1:])
        if units is not None:
            units[0] = units[0][1:]
        return units

    def joined(self, words: list[str], found: list[bytes]) -> bytes:
        return b"".join(found)


def byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the others follow from U+0100 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """A worker's two tokenizers, with the bytes and the decimal text of every id."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = SpacedCoder(path_a)
        self.words: GroupCoder | None = None  # made when first asked for
        alphabet = byte_alphabet()
        self.bytes_a = [self._entry(self.a.tokenizer.id_to_token(i) or "", alphabet)
                        for i in range(self.a.size)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(size)))]
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        # text of an id inside its list, and at the end of its group's list
        self.first_b = 2 * len(self.bytes_a)
        self.written = [b"%d%c" % (i, mark) for mark in b",|" for i in range(len(self.bytes_a))]
        self.written += [b"%d%c" % (i, mark) for mark in b",;" for i in range(size)]
        self.length_written = np.array([len(x) for x in self.written])

    @staticmethod
    def _entry(token: str, alphabet: dict[str, int]) -> bytes:
        try:
            return bytes([alphabet[c] for c in token])
        except KeyError:
            return token.encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids (A, B) of blank + each text; None without tokens or when bytes differ."""
        spaced = [" " + t for t in texts]
        of_a = self.a.encode(spaced)
        of_b = self.b.encode(texts, num_threads=1)
        out = []
        for text, raw, b in zip(spaced, of_a, of_b):
            a = np.frombuffer(raw, "<u4").astype(np.int64)
            want = text.encode("utf-8", "surrogatepass")
            same = (len(want) > 1 and b"".join([self.bytes_a[i] for i in a.tolist()]) == want
                    and b"".join([self.bytes_b[i] for i in b]) == want)
            out.append((a, np.array(b, dtype=np.int64)) if same else None)
        return out


def tokenizers(path_a: str, path_b: str) -> Pair:
    key = path_a, path_b
    if key not in _LOADED:
        _LOADED[key] = Pair(path_a, path_b)
    return _LOADED[key]


@dataclass
class Fragment:
    """Tokens of a byte range, seen without its surroundings; ids are decimal, comma-separated."""

    n_a: int = 0
    n_b: int = 0
    cut: bool = False  # is there a common end at all? without one, all tokens are prefix
    prefix_a: bytes = b""
    prefix_b: bytes = b""
    n_closed: int = 0
    closed: bytes = b""  # groups as a1,a2|b1;a3|b2
    suffix_a: bytes = b""
    suffix_b: bytes = b""
    links: bytes = b""  # pair codes, four bytes each; additive, for both ends lie in the range


def _and(x: bytes, y: bytes, by: bytes = b",") -> bytes:
    return x + by + y if x and y else x or y


def compose(parts: list[Fragment]) -> Fragment:
    """The fragment of neighbouring ranges, in order. Associative; none: the empty fragment."""
    out, closed, links = Fragment(), [], []
    for f in parts:
        out.n_a, out.n_b = out.n_a + f.n_a, out.n_b + f.n_b
        links.append(f.links)
        if not out.cut:
            out.prefix_a = _and(out.prefix_a, f.prefix_a)
            out.prefix_b = _and(out.prefix_b, f.prefix_b)
            if f.cut:
                out.cut, out.n_closed = True, f.n_closed
                closed.append(f.closed)
                out.suffix_a, out.suffix_b = f.suffix_a, f.suffix_b
        elif not f.cut:
            out.suffix_a = _and(out.suffix_a, f.prefix_a)
            out.suffix_b = _and(out.suffix_b, f.prefix_b)
        else:
            closed.append(_and(out.suffix_a, f.prefix_a) + b"|" + _and(out.suffix_b, f.prefix_b))
            closed.append(f.closed)
            out.n_closed += f.n_closed + 1
            out.suffix_a, out.suffix_b = f.suffix_a, f.suffix_b
    out.closed = b";".join([c for c in closed if c])
    out.links = b"".join(links)
    return out


def close(f: Fragment) -> tuple[int, int, int, str, bytes]:
    """(n_a, n_b, n_groups, groups_sha256, links) of a whole text's fragment."""
    if not f.cut:
        return 0, 0, 0, "", b""
    groups = _and(f.prefix_a + b"|" + f.prefix_b, f.closed, b";")
    return f.n_a, f.n_b, f.n_closed + 1, hashlib.sha256(groups).hexdigest(), f.links


class Aligned:
    """Tokens of many texts laid end to end, their common ends, and their groups in writing."""

    def __init__(self, pair: Pair, coded: list[tuple[np.ndarray, np.ndarray]]):
        self.pair = pair
        self.a, self.b = (np.concatenate([c[k] for c in coded]) for k in (0, 1))
        self.ends_a = np.cumsum(pair.length_a[self.a])
        self.ends_b = np.cumsum(pair.length_b[self.b])
        at = np.minimum(np.searchsorted(self.ends_b, self.ends_a), len(self.ends_b) - 1)
        self.last_a = np.flatnonzero(self.ends_b[at] == self.ends_a)  # last tokens of the groups
        self.last_b = at[self.last_a]
        self.codes = (self.a[self.last_a] << B_BITS | self.b[self.last_b]).astype("<u4")
        mark_a, mark_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        mark_a[self.last_a], mark_b[self.last_b] = True, True
        group_a, group_b = np.cumsum(mark_a) - mark_a, np.cumsum(mark_b) - mark_b
        # a group writes its A ids and then its B ids
        before_a = np.concatenate([[0], self.last_a + 1])
        before_b = np.concatenate([[0], self.last_b + 1])
        self.written = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        self.place_a = np.arange(len(self.a)) + before_b[group_a]
        self.written[self.place_a] = self.a + mark_a * len(pair.bytes_a)
        self.written[np.arange(len(self.b)) + before_a[np.minimum(group_b + 1, len(self.last_a))]] \
            = pair.first_b + self.b + mark_b * len(pair.bytes_b)

    def groups(self, first: int, last: int) -> bytes:
        """Groups ``first`` to ``last - 1`` in writing."""
        if first >= last:
            return b""
        lo = 0 if not first else self.last_a[first - 1] + self.last_b[first - 1] + 2
        hi = self.last_a[last - 1] + self.last_b[last - 1] + 2
        table = self.pair.written
        return b"".join([table[k] for k in self.written[lo:hi].tolist()])[:-1]

    def fragment(self, lo: int, hi: int) -> Fragment:
        """Tokens that end after byte ``lo`` and up to byte ``hi``."""
        a0, a1 = np.searchsorted(self.ends_a, [lo, hi], "right")
        b0, b1 = np.searchsorted(self.ends_b, [lo, hi], "right")
        first, last = np.searchsorted(self.last_a, [a0, a1])
        ids = lambda x: b",".join([b"%d" % i for i in x.tolist()])
        if first == last:
            return Fragment(int(a1 - a0), int(b1 - b0), False, ids(self.a[a0:a1]),
                            ids(self.b[b0:b1]))
        return Fragment(
            int(a1 - a0), int(b1 - b0), True,
            ids(self.a[a0:self.last_a[first] + 1]), ids(self.b[b0:self.last_b[first] + 1]),
            int(last - first - 1), self.groups(first + 1, last),
            ids(self.a[self.last_a[last - 1] + 1:a1]), ids(self.b[self.last_b[last - 1] + 1:b1]),
            self.codes[first:last].tobytes())


class GroupCoder(SpacedCoder):
    """(n_a, n_b, n_groups, groups_sha256, links) of blank + text, put together from its words.

    Both vocabularies start a token at a single blank, and A's words end where a blank or a line
    feed follows, which no piece of B reaches across; so every word ends a group, and a text's
    groups are its words' groups. A word whose tokens do not give back its bytes makes its texts
    go through both tokenizers whole.
    """

    def __init__(self, pair: Pair, keep: int = WORDS):
        self.pair, self.keep, self.known = pair, keep, {}  # A's tokenizer is loaded once
        self.tokenizer, self.special, self.opens = pair.a.tokenizer, pair.a.special, pair.a.opens
        pieces = [pair.b.id_to_piece(i) for i in range(pair.b.get_piece_size())]
        self.blank = pieces.index("▁") if "▁" in pieces else -1
        self.apart = self.blank >= 0 and not any(
            "\n" in p or "▁" in p[1:] and p.strip("▁") for p in pieces)
        self.counts: dict[int, int] = {}  # equal numbers are kept once

    def split(self, text: str) -> list[str] | None:
        return super().split(text) if self.apart else None

    def direct(self, text: str):
        return aligned_whole(self.pair, [text[1:]])[0]

    def joined(self, words: list[str], found: list[tuple]):
        if () in found:
            return self.direct("".join([w if w[:1] == "\n" else " " + w for w in words]))
        groups, links, sizes = zip(*found)
        size, held = sum(sizes), b"".join(links)
        return (size >> 32, size & 0xFFFFFFFF, len(held) >> 2,
                hashlib.sha256(b";".join(groups)).hexdigest(), held)

    def learn(self, words: list[str]) -> dict[str, tuple]:
        """Groups in writing, links, and n_a << 32 | n_b of each word; nothing of a word whose
        bytes differ."""
        pair = self.pair
        spaced = [w if w[:1] == "\n" else " " + w for w in words]
        a = np.array(self.tokenizer.encode_batch_fast(["".join(spaced)],
                                                      add_special_tokens=False)[0].ids, np.int64)
        starts_a = np.flatnonzero(self.opens[a])
        of_b = pair.b.encode(words, num_threads=1)
        for k, word in enumerate(words):
            if word[:1] == "\n":  # B puts a blank in front of it
                of_b[k] = of_b[k][1:] if of_b[k][:1] == [self.blank] else []
        want = [t.encode("utf-8", "surrogatepass") for t in spaced]
        sizes = np.array([len(x) for x in want])
        b = np.array(list(chain.from_iterable(of_b)), np.int64)
        stops_b = np.cumsum([len(x) for x in of_b])
        stops_a = np.append(starts_a[1:], len(a))
        joined = b"".join(want)
        same = (len(starts_a) == len(words) and starts_a[0] == 0
                and b"".join([pair.bytes_a[i] for i in a.tolist()]) == joined
                and b"".join([pair.bytes_b[i] for i in b.tolist()]) == joined)
        if same:
            ends = np.cumsum(sizes)
            same = (np.array_equal(np.cumsum(pair.length_a[a])[stops_a - 1], ends)
                    and np.array_equal(np.cumsum(pair.length_b[b])[stops_b - 1], ends))
        if not same:
            if len(words) == 1:
                return {words[0]: ()}
            half = len(words) // 2
            return self.learn(words[:half]) | self.learn(words[half:])
        aligned = Aligned(pair, [(a, b)])
        stops = np.searchsorted(aligned.last_a, stops_a)
        links = aligned.codes.tobytes()
        written = b"".join([pair.written[k] for k in aligned.written.tolist()])
        ends = np.cumsum(pair.length_written[aligned.written])[stops_a + stops_b - 1]
        counts = np.diff(stops_a, prepend=0) << 32 | np.diff(stops_b, prepend=0)
        found, lo, at = {}, 0, 0
        for word, stop, end, size in zip(words, (stops * 4).tolist(), ends.tolist(),
                                         counts.tolist()):
            found[word] = written[at:end - 1], links[lo:stop], self.counts.setdefault(size, size)
            lo, at = stop, end
        return found


def align_texts(pair: Pair, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
    """(n_a, n_b, n_groups, groups_sha256, links) of whole texts."""
    if pair.words is None:
        pair.words = GroupCoder(pair)
    return pair.words.encode([" " + t for t in texts])


def aligned_whole(pair: Pair, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
    """The same by both tokenizers on whole texts, aligned together."""
    coded = pair.encode(texts)
    good = [c for c in coded if c is not None]
    if not good:
        return [close(Fragment())] * len(texts)
    aligned = Aligned(pair, good)
    stops_a = np.cumsum([len(c[0]) for c in good])
    stops = np.searchsorted(aligned.last_a, stops_a).tolist()
    out, k, first = [], 0, 0
    for c in coded:
        if c is None:
            out.append(close(Fragment()))
            continue
        last = stops[k]
        out.append((len(c[0]), len(c[1]), last - first,
                    hashlib.sha256(aligned.groups(first, last)).hexdigest(),
                    aligned.codes[first:last].tobytes()))
        first, k = last, k + 1
    return out


def chunk_fragment(pair: Pair, text: str, width: int = RANGE) -> Fragment | None:
    """Fragment of blank + a chunk, composed from its ranges; None when bytes differ."""
    coded = pair.encode([text])[0]
    if coded is None:
        return None
    aligned = Aligned(pair, [coded])
    size = int(aligned.ends_a[-1])
    return compose([aligned.fragment(lo, min(lo + width, size)) for lo in range(0, size, width)])


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """The text cut at blanks before which and after which both tokenizers cut; the blank at a
    cut is left out, for it is put back before every chunk."""
    out, lo = [], 0
    while len(text) - lo > size:
        at = lo + size
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 < len(text) and text[at - 1].isalnum() and text[at + 1].isalnum():
                break
            at += 1
        if at < 0:
            break
        out.append(text[lo:at])
        lo = at + 1
    return out + [text[lo:]]


DOC = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
       "links binary")
PART = ("row bigint, doc_id bigint, no bigint, same boolean, n_a bigint, n_b bigint, cut boolean, "
        "prefix_a binary, prefix_b binary, n_closed bigint, closed binary, suffix_a binary, "
        "suffix_b binary, links binary")
FIELDS = ["n_a", "n_b", "cut", "prefix_a", "prefix_b", "n_closed", "closed", "suffix_a", "suffix_b",
          "links"]


def _row_numbers():
    """Numbers that no other task gives out; they are stored with the rows, so they stay."""
    at = TaskContext.get().partitionId() << 36
    while True:
        yield at
        at += 1


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _short(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                        ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("groups_sha256", pa.string()), ("links", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, numbers = tokenizers(*paths), _row_numbers()
        for batch in batches:
            sizes = batch.column("size").to_pylist()
            lo = 0
            while lo < batch.num_rows:
                hi, held = lo + 1, sizes[lo]
                while hi < batch.num_rows and held + sizes[hi] <= TOGETHER:
                    held, hi = held + sizes[hi], hi + 1
                part = batch.slice(lo, hi - lo)
                found = align_texts(pair, [t or "" for t in part.column("text").to_pylist()])
                yield _table([(next(numbers), d, *f) for d, f in
                              zip(part.column("doc_id").to_pylist(), found)], schema)
                lo = hi

    return docs.mapInArrow(run, DOC)


def _cut(docs: DataFrame, size: int) -> DataFrame:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("no", pa.int64()),
                        ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _row_numbers()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                row = next(numbers) | 1 << 35  # apart from the short texts' numbers
                yield _table([(row, doc_id, k, c)
                              for k, c in enumerate(chunks(text.as_py(), size))], schema)

    return docs.mapInArrow(run, "row bigint, doc_id bigint, no bigint, text string")


def _fragments(cut: DataFrame, paths: tuple[str, str]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = tokenizers(*paths)
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                f = chunk_fragment(pair, r.text)
                rows.append((r.row, r.doc_id, r.no, f is not None,
                             *[getattr(f or Fragment(), x) for x in FIELDS]))
            yield pd.DataFrame(rows, columns=["row", "doc_id", "no", "same", *FIELDS]).astype(
                {"doc_id": "Int64"})

    return cut.mapInPandas(run, PART)


def _reduced(parts: DataFrame) -> DataFrame:
    """``FAN`` neighbouring fragments become one; ``no`` counts the results."""
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("no")
        f = compose([Fragment(**{x: getattr(r, x) for x in FIELDS})
                     for r in frame.itertuples(index=False)])
        out = pd.DataFrame([(frame["row"].iloc[0], frame["doc_id"].iloc[0],
                             frame["no"].iloc[0] // FAN, bool(frame["same"].all()),
                             *[getattr(f, x) for x in FIELDS])],
                           columns=["row", "doc_id", "no", "same", *FIELDS])
        return out.astype({"doc_id": "Int64"})

    return parts.groupBy("row", F.floor(F.col("no") / FAN).alias("up")).applyInPandas(one, PART)


def _long(docs: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """Texts above a chunk: cut, read by any tasks, composed level by level."""
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment-chunks")
    _cut(docs, size).write.parquet(path)
    cut = spark.read.parquet(path)
    count, most = cut.agg(F.count(F.lit(1)), F.max("no")).first()
    parts = _fragments(cut.repartition(max(1, min(count, 4096))) if count else cut, paths)
    most = most or 0
    while True:
        parts = _reduced(parts)
        if most < FAN:
            break
        most //= FAN

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                f = Fragment(**{x: getattr(r, x) for x in FIELDS}) if r.same else Fragment()
                rows.append((r.row, r.doc_id, *close(f)))
            yield pd.DataFrame(rows, columns=["row", "doc_id", "n_a", "n_b", "n_groups",
                                              "groups_sha256", "links"]).astype({"doc_id": "Int64"})

    return parts.mapInPandas(run, DOC)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, size: int | None = None) -> DataFrame:
    """Written rows (row, doc_id, n_a, n_b, n_groups, groups_sha256, links) of all documents;
    links: for every group the last A id << 15 | the last B id, four bytes each."""
    spark, size = docs.sparkSession, size or CHUNK
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    path = scratch_path(spark, "alignment")
    _short(docs.where(F.col("size") <= size), (path_a, path_b)).write.parquet(path)
    _long(docs.where(F.col("size") > size).select("doc_id", "text"), (path_a, path_b),
          size).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Rows (code, n): how many links of the corpus hold a pair of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                raw = b"".join([x or b"" for x in batch.column(0).slice(lo, 2048).to_pylist()])
                new, n = np.unique(np.frombuffer(raw, "<u4"), return_counts=True)
                codes, at = np.unique(np.concatenate([codes, new]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n]),
                                     minlength=len(codes)).astype(np.int64)
                if len(codes) > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)],
                                                     ["code", "n"])
                    codes, counts = codes[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    return aligned.select("links").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(
        F.sum("n").alias("n"))


def link_figures(aligned: DataFrame, counts: DataFrame, hot: int | None = None) -> DataFrame:
    """``aligned`` without links, with n_links, n_best and count_sum. ``counts``: stored pair
    counts."""
    hot = hot or HOT
    best = counts.groupBy((F.col("code") % (1 << B_BITS)).alias("b")).agg(
        F.max("n").alias("n")).toPandas()
    highest = np.zeros(1 << B_BITS, dtype=np.int64)
    highest[best["b"].to_numpy(dtype=np.int64)] = best["n"].to_numpy(dtype=np.int64)
    table = counts.orderBy(F.desc("n"), "code").limit(hot).toPandas().sort_values("code")
    known = table["code"].to_numpy(dtype=np.int64), table["n"].to_numpy(dtype=np.int64)
    shared = aligned.sparkSession.sparkContext.broadcast((highest, *known))

    def found(batch: pa.RecordBatch):
        highest, codes, n = shared.value
        raw = batch.column("links").to_pylist()
        links = np.frombuffer(b"".join([x or b"" for x in raw]), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(raw)), [len(x or b"") // 4 for x in raw])
        at = np.minimum(np.searchsorted(codes, links), max(len(codes) - 1, 0))
        hit = codes[at] == links if len(codes) else np.zeros(len(links), bool)
        return highest, links, owner, np.where(hit, n[at] if len(n) else 0, 0), hit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                highest, links, owner, n, hit = found(batch)
                rows = batch.num_rows
                best = hit & (n == highest[links & (1 << B_BITS) - 1])
                sums = np.zeros(rows, np.int64)
                np.add.at(sums, owner, n)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep],
                     pa.array(np.bincount(owner, minlength=rows)),
                     pa.array(np.bincount(owner[best], minlength=rows)), pa.array(sums)],
                    [*keep, "n_links", "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                _, links, owner, _, hit = found(batch)
                row = batch.column("row").to_numpy()[owner[~hit]]
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(links[~hit])],
                                                 ["row", "code"])

    keep = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    out = aligned.select(*keep, "links").mapInArrow(
        run, "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
        "groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint")
    if len(table) < hot:
        return out.drop("row")
    top = counts.groupBy((F.col("code") % (1 << B_BITS)).alias("b")).agg(F.max("n").alias("top"))
    more = aligned.select("row", "links").mapInArrow(rare, "row bigint, code bigint").groupBy(
        "row", "code").agg(F.count(F.lit(1)).alias("k")).join(counts, "code").withColumn(
        "b", F.col("code") % (1 << B_BITS)).join(F.broadcast(top), "b").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("k")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("k")).alias("more_sum"))
    return out.join(more, "row", "left").select(
        *keep[1:], "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of all
    ``docs (doc_id, text)`` under a byte-level vocabulary A and a piece model B."""
    spark = docs.sparkSession
    aligned = aligned_documents(docs, path_a, path_b)
    path = scratch_path(spark, "alignment-counts")
    pair_counts(aligned).write.parquet(path)
    return link_figures(aligned, spark.read.parquet(path))
