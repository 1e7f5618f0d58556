"""SimHash near-duplicates, paired exactly by vantage-point trees over Hamming distance.

A text's fingerprint has 64 bits: every 3-word shingle (repeats included) is hashed, and a bit is
set when more than half the hashes set it. Distinct fingerprints form the points of a metric
space; documents of one fingerprint are one point, however many there are.

Vantage-point trees are used twice. A tree over a bounded, hash-chosen sample of the points
(``PER_SHARD`` a shard, at most ``MAX_SHARDS`` shards) deals *all* points out: a point at distance
``d`` from a node's vantage point goes inside when ``d <= radius``, else outside, down to its home
shard. It also visits every other shard that a point within ``reach`` of it could call home, which
the triangle inequality bounds: inside when ``d <= radius + reach``, outside when
``d > radius - reach``. Of two shards only the one with the smaller number is visited, so a pair
across a boundary is met once. In a shard a second tree over its members prunes in the same way,
down to leaves that are compared whole.

A shard returns a spanning forest of what it finds, not its pairs: one edge for each member or
visitor at most, so output is linear in the points however dense a group of near copies is.
Components of all edges are then found by rounds of joins. A shard's members are held in memory,
its visitors are streamed behind them.

Texts: A-Z lower-cased, words between blanks and U+0009 to U+000D; fewer than three words are one
shingle; null, empty and word-less texts have fingerprint zero, which links like any other. Equal
rows stay rows. A null doc_id is never the smallest one unless all ids of the component are null.
An empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.llm.components import components
from regiocast.session import cut_lineage

SEED = 42
REACH = 3
SHARD = 16_384  # points that a shard should hold
PER_SHARD = 64  # sampled points for each shard
MAX_SHARDS = 1 << 16  # beyond, shards grow: 8 bytes a point
LEAF = 192
PAIRS = 1 << 20  # links merged at once


def bit_counts(digests: bytes) -> np.ndarray:
    """How many of the 8-byte hashes set each bit, the highest bit first."""
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    total = np.zeros(64, dtype=np.int64)
    step = 255 * 256  # sums of 255 bits fit into a byte
    for lo in range(0, len(rows), step):
        bits = np.unpackbits(rows[lo:lo + step], axis=1)
        full = len(bits) // 255 * 255
        total += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(
            axis=0, dtype=np.int64)
        total += bits[full:].sum(axis=0, dtype=np.uint8)
    return total


def fingerprint(text: bytes | None) -> int:
    """SimHash of a text in UTF-8."""
    from xxhash import xxh64_digest

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < 3:
        digests = xxh64_digest(joined, SEED)
    else:
        after = list(accumulate([len(w) + 1 for w in words]))
        digests = b"".join([xxh64_digest(joined[a:b - 1], SEED)
                            for a, b in zip([0] + after, after[2:])])
    ones = bit_counts(digests)
    return int.from_bytes(np.packbits(2 * ones > len(digests) // 8).tobytes(), "big")


class VantageTree:
    """Points split by their distance from vantage points; leaves are numbered from 0."""

    def __init__(self, points: np.ndarray, leaf: int, splits: int | None = None):
        self.vantage, self.radius, self.inner, self.outer = [], [], [], []
        self.leaves: list[np.ndarray] = []
        work = [(np.arange(len(points)), -1, True, splits)]
        while work:
            at, parent, inside, left = work.pop()
            cut = None if left == 0 or len(at) <= leaf else self._cut(points[at])
            if cut is None:
                node = ~len(self.leaves)
                self.leaves.append(at)
            else:
                node, (vantage, radius, near) = len(self.vantage), cut
                self.vantage.append(vantage)
                self.radius.append(radius)
                self.inner.append(None)
                self.outer.append(None)
                left = None if left is None else left - 1
                work.append((at[~near], node, False, left))
                work.append((at[near], node, True, left))
            if parent >= 0:
                (self.inner if inside else self.outer)[parent] = node
            else:
                self.root = node

    @staticmethod
    def _cut(points: np.ndarray):
        """Of a few members, the vantage point whose distances spread most; None: no fair cut."""
        best = None
        some = points[::max(1, len(points) // 512)]
        for vantage in points[::max(1, len(points) // 12)][:12]:
            spread = np.bitwise_count(some ^ vantage).std()
            if best is None or spread > best[0]:
                best = spread, vantage
        vantage = best[1]
        far = np.bitwise_count(points ^ vantage).astype(np.int64)
        radius = int(np.median(far))
        if radius >= far.max():
            radius = int(far[far < far.max()].max(initial=-1))
        near = far <= radius
        few = min(near.sum(), len(near) - near.sum())
        return None if few * 32 < len(near) else (vantage, radius, near)

    def homes(self, points: np.ndarray) -> np.ndarray:
        """Leaf of every point."""
        home = np.zeros(len(points), dtype=np.int64)
        for leaf, at in self.visits(points, 0):
            home[at] = leaf
        return home

    def visits(self, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, positions of the points within ``reach`` of which it may hold a point)."""
        work = [(self.root, np.arange(len(points)))]
        while work:
            node, at = work.pop()
            if not len(at):
                continue
            if node < 0:
                yield ~node, at
                continue
            far = np.bitwise_count(points[at] ^ self.vantage[node]).astype(np.int64)
            work.append((self.inner[node], at[far <= self.radius[node] + reach]))
            work.append((self.outer[node], at[far + reach > self.radius[node]]))


class Links:
    """Forest over numbered points, merged from arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.count += len(a)
        if self.count >= PAIRS:
            self.settle()

    def settle(self) -> np.ndarray:
        """Label of every point: the smallest number of its component."""
        if self.held:
            a, b = (np.concatenate(x) for x in zip(*self.held))
            self.held, self.count = [], 0
            while True:
                x, y = self.label[a], self.label[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(up := self.label[self.label], self.label):
                    self.label = up
        return self.label


class Shard:
    """Members of a shard under a tree, and the links found among them and with visitors."""

    def __init__(self, members: np.ndarray, reach: int):
        self.members, self.reach = members, reach
        self.tree = VantageTree(members, LEAF)
        self.links = Links(len(members))
        for a, b in self._close(members):
            self.links.add(a[a < b], b[a < b])

    def _close(self, points: np.ndarray):
        """(positions in points, members) of all pairs within reach."""
        for leaf, at in self.tree.visits(points, self.reach):
            there = self.tree.leaves[leaf]
            rows = max(1, PAIRS // max(len(there), 1))
            for lo in range(0, len(at), rows):
                some = at[lo:lo + rows]
                near = np.bitwise_count(points[some][:, None] ^ self.members[there]) <= self.reach
                i, j = np.nonzero(near)
                yield some[i], there[j]

    def visit(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One edge (visitor, member) for each visitor with a link; further links join members."""
        first = np.full(len(points), -1)
        for a, b in self._close(points):
            first[a] = np.where(first[a] < 0, b, first[a])
            self.links.add(first[a], b)
        linked = np.flatnonzero(first >= 0)
        return points[linked], self.members[first[linked]]

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        label = self.links.settle()
        below = np.flatnonzero(label != np.arange(len(label)))
        return self.members[below], self.members[label[below]]


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, fp) of ``docs``; fp: the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = np.array([fingerprint(t) for t in part.column("text").to_pylist()],
                                 dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id bigint, fp bigint")


def _dealt(points: DataFrame, tree: VantageTree, reach: int) -> DataFrame:
    """Rows (shard, visitor, fp): every point at home, and where its neighbours may live."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            home = tree.homes(fps)
            shards, who, kind = [home], [fps], [np.zeros(len(fps), dtype=np.int8)]
            for leaf, at in tree.visits(fps, reach):
                at = at[home[at] > leaf]
                shards.append(np.full(len(at), leaf))
                who.append(fps[at])
                kind.append(np.ones(len(at), dtype=np.int8))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(shards).astype(np.int32)), pa.array(np.concatenate(kind)),
                 pa.array(np.concatenate(who).view(np.int64))], ["shard", "visitor", "fp"])

    return points.mapInArrow(run, "shard int, visitor byte, fp bigint")


def _linked(dealt: DataFrame, shards: int, reach: int) -> DataFrame:
    """Edges (a, b) of the shards' forests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, shard = None, [], None

        def edges(pair):
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pair], ["a", "b"])

        for batch in batches:
            home = batch.column("shard").to_numpy()
            guest = batch.column("visitor").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(home) != 0) | (np.diff(guest) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(home)]):
                if lo == hi:
                    continue
                if home[lo] != number:
                    if number is not None:
                        shard = shard or Shard(np.concatenate(parts or [fps[:0]]), reach)
                        yield edges(shard.forest())
                    number, parts, shard = home[lo], [], None
                if guest[lo]:
                    shard = shard or Shard(np.concatenate(parts or [fps[:0]]), reach)
                    yield edges(shard.visit(fps[lo:hi]))
                else:
                    parts.append(fps[lo:hi])
        if number is not None:
            shard = shard or Shard(np.concatenate(parts or [np.zeros(0, np.uint64)]), reach)
            yield edges(shard.forest())

    return dealt.repartition(shards, "shard").sortWithinPartitions("shard", "visitor").mapInArrow(
        run, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, reach: int = REACH, shard: int = SHARD) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id) of all ``docs (doc_id, text)``."""
    prints = cut_lineage(fingerprint_table(docs))
    points = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    count = points.count()
    shards = min(MAX_SHARDS, 1 << max(0, round(np.log2(max(count, 1) / shard))))
    wanted = shards * PER_SHARD
    sample = points.where(F.pmod(F.xxhash64("fp", F.lit("shards")),
                                 F.lit(max(1, count // wanted))) == 0).select("fp").limit(
        2 * wanted).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    tree = VantageTree(np.sort(sample), 1, splits=shards.bit_length() - 1)
    edges = _linked(_dealt(points.select("fp"), tree, reach), len(tree.leaves), reach)
    roots = components(edges).withColumnRenamed("node", "fp")
    linked = roots.join(points, "fp")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut_lineage(points.join(linked.join(least, "root").select("fp", "component_id"),
                                    "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
