"""Exact n-gram Jaccard join by PartEnum signatures, and its connected components.

Sets A and B of shingle hashes link when their Jaccard similarity is at least ``share``, 0.8.
Then their sizes differ by a factor of 1.25 at most, and at most ``k = (|A| + |B|) / 9`` hashes
lie in only one of them. Sizes are cut into bands of that factor; instance ``i`` compares the
sets of bands ``i`` and ``i + 1``, with the largest ``k`` that a pair there can have.

An instance partitions the hash domain into ``n1`` groups of three parts and enumerates, per
group, the three subsets of two parts; a signature is the hash of a set's members inside such a
subset. ``k`` differing hashes can spoil at most ``K`` of the ``3 * n1`` signatures, so of two
sets that link at least ``3 * n1 - K`` are equal. Of a set's signatures only the ``K + 1`` with
the most members are kept: of the equal ones, the one that comes first in this order has at most
``K`` others before it in either set, so it is kept in both. Nearly empty subsets, which many
sets would share, are thereby left out without losing a pair.

Texts with equal sets form a class, and only classes are compared. Members of a signature are
not paired with each other, but with the least of them: in a group of near copies this already
joins all. Where members of one signature are still in different components afterwards, and
only there, they are compared with ``ROUNDS`` other centres, and then the pairs between different components are examined too, so every component is
exact. Before two texts are fetched, their sizes and their sketches must allow a link; across
components both are checked while a signature is streamed, before a pair is put out. A sketch
holds the parities of a set's hashes in two to four times as many cells as there are hashes, as
far as ``MOST_CELLS`` allows; a hash in only one of two sets turns one cell, so the cells that
differ are a lower bound on the differing hashes. Halves of a sketch folded on each other are the
sketch in half the cells, so sets of different sizes compare.

Links lie inside components, so they are counted there: a component's classes are dealt into
chunks, and any two chunks whose sizes allow a link meet in one group, where all intersections
are counted. Texts are thus repeated once per chunk they meet, not once per pair.

A task emits each class's signatures once, however many copies it holds; sorting, not memory,
brings equal signatures together, so a signature shared by very many classes is streamed.

Null, empty and word-less texts have no shingles and link with nothing; a text with fewer than
five words is one shingle; very long texts are taken whole; repeated rows are copies of each
other, and rows with the same doc_id are told apart by their texts; a null doc_id links like any
other, and is the least of a component only where all its ids are null;
an empty table gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.llm.components import components
from regiocast.llm.shingles import mix, shingle_sets
from regiocast.session import cut_lineage, passing_shuffles

LEAST_CELLS, MOST_CELLS = 512, 4096  # cells of a sketch, a power of two
CHUNK, CHUNK_SHINGLES = 512, 1 << 20  # classes and shingles that a chunk holds, about
ROUNDS = 2  # further centres, before pairs are looked for across components
CELL = 1024  # classes of a signature in one part
SLAB = 2048  # shingles whose holders are counted at once
BROADCAST_PAIRS = 500_000  # up to here the ids of all pairs are small enough to broadcast
TASK_PAIRS = 20_000  # pairs that a task starts from, about
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0], dtype=np.uint64)


def band_of(n: int) -> tuple[int, int, int]:
    """Number of the band that holds size ``n``, its first and its last size."""
    i, lo = 0, 1
    while lo * 5 // 4 < n:
        i, lo = i + 1, lo * 5 // 4 + 1
    return i, lo, lo * 5 // 4


def scheme(last: int) -> tuple[int, int, int]:
    """(k, n1, K + 1) of the instance whose lower band ends with size ``last``."""
    k = (last + last * 5 // 4) // 9
    n1 = -(-3 * (k + 1) // 5) if k > 1 else k + 1
    spoilt = 2 * min(k, n1) + min(max(k - n1, 0), n1)
    return k, n1, spoilt + 1


def signatures(members: np.ndarray) -> np.ndarray:
    """All signatures of a set (distinct hashes), for both instances it takes part in."""
    if not len(members):
        return np.zeros(0, dtype=np.uint64)
    band, lo, last = band_of(len(members))
    found = []
    for instance, end in ((band, last), (band - 1, lo - 1)):
        if instance < 0:
            continue
        k, n1, keep = scheme(end)
        if not k:
            continue  # only equal sets link, and those are one class
        seed = mix(_SEEDS[:1] + np.uint64(instance))
        spread = mix(members ^ seed)
        part = ((spread >> np.uint64(32)) * np.uint64(3 * n1) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(3 * n1 + 1))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(spread[order] + _SEEDS[1]))])
        sums = (total[edges[1:]] - total[edges[:-1]]).reshape(n1, 3)
        sizes = np.diff(edges).reshape(n1, 3)
        # subset c of a group leaves part c out
        sums = (sums.sum(axis=1, dtype=np.uint64)[:, None] - sums).ravel()
        sizes = (sizes.sum(axis=1)[:, None] - sizes).ravel()
        code = mix(sums + mix(seed + np.arange(3 * n1, dtype=np.uint64)))
        best = np.lexsort((np.arange(3 * n1), -sizes))[:keep]
        found.append(code[best])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def describe(members: np.ndarray) -> tuple[int, int, bytes]:
    """Two 64-bit fingerprints of a set and its sketch."""
    if not len(members):
        return 0, 0, b""
    one = mix(np.sum(mix(members + _SEEDS[1]), dtype=np.uint64, keepdims=True)
              + np.uint64(len(members)))
    two = mix(np.sum(mix(members ^ _SEEDS[2]), dtype=np.uint64, keepdims=True))
    cells = min(max(1 << (2 * len(members) - 1).bit_length(), LEAST_CELLS), MOST_CELLS)
    held = np.bincount((mix(members + _SEEDS[0]) & np.uint64(cells - 1)).astype(np.int64),
                       minlength=cells)
    return (int(one.view(np.int64)[0]), int(two.view(np.int64)[0]),
            np.packbits((held & 1).astype(bool), bitorder="little").tobytes())


class Sketches:
    """Sketches of many sets, end to end as 64-bit words."""

    def __init__(self, column: list[bytes]):
        self.sizes = np.array([len(x) for x in column], dtype=np.int64) >> 3
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.frombuffer(b"".join(column), np.uint64)

    def folded(self, rows: np.ndarray, size: int) -> np.ndarray:
        out = np.empty((len(rows), size), np.uint64)
        for own in np.unique(self.sizes[rows]):
            at = np.flatnonzero(self.sizes[rows] == own)
            held = self.words[self.starts[rows[at]][:, None] + np.arange(own)]
            out[at] = np.bitwise_xor.reduce(held.reshape(len(at), -1, size), axis=1)
        return out

    def gap(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """What the sets in rows ``i`` and ``j`` differ in at least."""
        out = np.zeros(len(i), np.int64)
        common = np.minimum(self.sizes[i], self.sizes[j])
        for size in np.unique(common):
            at = np.flatnonzero(common == size)
            for lo in range(0, len(at), 1 << 14):
                part = at[lo:lo + (1 << 14)]
                turned = self.folded(i[part], size) ^ self.folded(j[part], size)
                out[part] = np.bitwise_count(turned).sum(axis=1)
        return out


def texts_in(batch: pa.RecordBatch, column: str, step: int = 512):
    values = batch.column(column)
    for lo in range(0, batch.num_rows, step):
        yield lo, values.slice(lo, step).to_pylist()


def set_table(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, fp, fp2, sketch) of ``docs (doc_id, text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in texts_in(batch, "text"):
                sets = shingle_sets(texts)
                seen = [describe(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, len(texts)),
                     batch.column("text_key").slice(lo, len(texts)),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([d[0] for d in seen], pa.int64()),
                     pa.array([d[1] for d in seen], pa.int64()),
                     pa.array([d[2] for d in seen], pa.binary())],
                    ["doc_id", "text_key", "n_shingles", "fp", "fp2", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, f"doc_id {kind}, text_key bigint, n_shingles bigint, fp bigint, fp2 bigint, sketch binary")


def signature_table(docs: DataFrame) -> DataFrame:
    """Rows (sig, fp); a task passes over classes that it has met before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, texts in texts_in(batch, "text"):
                codes, owners = [], []
                for members in shingle_sets(texts):
                    fp = describe(members)[0]
                    if fp not in met:
                        met.add(fp)
                        codes.append(signatures(members).view(np.int64))
                        owners.append(np.full(len(codes[-1]), fp))
                if codes:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(codes)), pa.array(np.concatenate(owners))],
                        ["sig", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "sig bigint, fp bigint")


def stars(sigs: DataFrame) -> DataFrame:
    """Rows (sig, a, b): the least class of a signature with each other class of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig = last_fp = centre = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, fp = (batch.column(c).to_numpy() for c in ("sig", "fp"))
            new = np.concatenate([[sig[0] != last_sig], sig[1:] != sig[:-1]])
            same = ~new & np.concatenate([[fp[0] == last_fp], fp[1:] == fp[:-1]])
            at = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
            centres = np.where(at >= 0, fp[at], centre if centre is not None else 0)
            keep = ~new & ~same & (fp != centres)
            last_sig, last_fp, centre = sig[-1], fp[-1], centres[-1]
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[keep]), pa.array(centres[keep]), pa.array(fp[keep])],
                    ["sig", "a", "b"])

    return sigs.repartition("sig").sortWithinPartitions("sig", "fp").mapInArrow(
        run, "sig bigint, a bigint, b bigint")


def may_link(pairs: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs whose sizes (n_a, n_b) and sketches (s_a, s_b) allow a link."""
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            held = Sketches(batch.column("s_a").to_pylist() + batch.column("s_b").to_pylist())
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            # 2 * I = |A| + |B| - differing, and den * I >= num * (|A| + |B| - I)
            room = both * (den - num)
            yield batch.filter(pa.array(
                held.gap(np.arange(n), np.arange(n, 2 * n)) * (den + num) <= room))

    near = pairs.where(den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b"))
    return near.mapInArrow(run, near.schema)


def verified(pairs: DataFrame, docs: DataFrame, share: tuple[int, int], n: int) -> DataFrame:
    """Links (a, b) among ``n`` pairs (a, b, doc_a, doc_b), decided on the whole texts' sets."""
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c) for c in ("set_a", "set_b"))
            good = []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(c[k].as_buffer(), np.uint64) for c in (a, b))
                s = len(np.intersect1d(x, y, assume_unique=True))
                good.append(den * s >= num * (len(x) + len(y) - s))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sets = class_sets(pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("fp"), F.col("doc_a").alias("doc")),
        F.struct(F.col("b").alias("fp"), F.col("doc_b").alias("doc"))))).distinct(), docs,
        small=True if 2 * n <= BROADCAST_PAIRS else None)
    left = pairs.select("a", "b").join(sets.withColumnsRenamed({"fp": "b", "members": "set_b"}), "b")
    full = left.join(sets.withColumnsRenamed({"fp": "a", "members": "set_a"}), "a")
    return full.select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint").distinct()


def class_sets(wanted: DataFrame, docs: DataFrame, small: bool | None = None) -> DataFrame:
    """One row (fp, members) for each class of ``wanted (fp, doc)``: its shingles, sorted, eight
    bytes each. ``doc`` only narrows the rows read, the set is chosen by its fingerprint, so null
    ids and ids with several texts do no harm. ``small``: known to fit a broadcast; else the rows
    are counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, texts in texts_in(batch, "text"):
                fps, held = [], []
                for members in shingle_sets(texts):
                    fp = describe(members)[0]
                    if fp not in met:
                        met.add(fp)
                        fps.append(fp)
                        held.append(members.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps, pa.int64()), pa.array(held, pa.binary())], ["fp", "members"])

    ids = wanted.select(F.col("doc").alias("wanted_doc")).distinct()
    fps = wanted.select("fp").distinct()
    if small or wanted.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        ids, fps = F.broadcast(ids), F.broadcast(fps)
    texts = docs.select("doc_id", "text").join(
        ids, F.col("doc_id").eqNullSafe(F.col("wanted_doc")), "left_semi")
    return texts.select("text").mapInArrow(run, "fp bigint, members binary").join(
        fps, "fp", "left_semi").groupBy("fp").agg(F.first("members").alias("members"))


def centred(placed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of a signature's members with another centre than before, drawn by hash, of
    ``placed (sig, fp, root)``; only those of different components. Linear in the members."""
    centre = placed.groupBy("sig").agg(F.min(F.struct(
        F.xxhash64("fp", F.lit(turn)).alias("draw"), F.col("fp").alias("c"),
        F.col("root").alias("r"))).alias("centre")).select("sig", "centre.c", "centre.r")
    return placed.join(centre, "sig").where("root <> r").select(
        F.least("fp", "c").alias("a"), F.greatest("fp", "c").alias("b")).distinct()


def across(placed: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of one signature in different components whose sizes and sketches allow a
    link, of ``placed (sig, fp, root, n_shingles, sketch)``.

    A signature's classes are dealt into parts of about ``CELL``; any two parts meet in a cell. In
    a cell classes are compared in the order of their sizes, each with those up to a quarter
    larger; only pairs that pass are put out.
    """
    num, den = share

    def near(t: dict[str, np.ndarray]) -> np.ndarray:
        new = np.concatenate([[True], (np.diff(t["sig"]) != 0) | (np.diff(t["lo"]) != 0)
                              | (np.diff(t["hi"]) != 0)])
        ends = np.concatenate([np.flatnonzero(new)[1:], [len(new)]])
        end = ends[np.cumsum(new) - 1]
        left, step, found = np.arange(len(new)), 0, []
        sketches = Sketches(t["sketch"].tolist())
        while len(left):
            step += 1
            left = left[left + step < end[left]]
            other = left + step
            # sizes grow along a cell, so a row that is too small now stays so
            fits = den * t["n"][left] >= num * t["n"][other]
            left, other = left[fits], other[fits]
            meet = (t["root"][left] != t["root"][other]) & (
                (t["side"][left] == 2) | (t["side"][left] != t["side"][other]))
            for lo in range(0, len(left), 1 << 16):
                i, j = (x[lo:lo + (1 << 16)][meet[lo:lo + (1 << 16)]] for x in (left, other))
                ok = sketches.gap(i, j) * (den + num) <= (t["n"][i] + t["n"][j]) * (den - num)
                found.append(np.stack([t["fp"][i][ok], t["fp"][j][ok]], axis=1))
        pairs = np.sort(np.concatenate(found) if found else np.zeros((0, 2), np.int64), axis=1)
        return np.unique(pairs, axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = {c: batch.column(c).to_numpy() for c in (
                "sig", "lo", "hi", "side", "fp", "root", "n")}
            t["sketch"] = batch.column("sketch").to_numpy(zero_copy_only=False)
            if held is not None:
                t = {c: np.concatenate([held[c], t[c]]) for c in t}
            last = [c for c in ("sig", "lo", "hi")]
            same = np.logical_and.reduce([t[c] == t[c][-1] for c in last])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = {c: t[c][cut:] for c in t}  # the last cell may go on
            if cut:
                pairs = near({c: t[c][:cut] for c in t})
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                                 ["a", "b"])
        if held is not None:
            pairs = near(held)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                             ["a", "b"])

    parts = placed.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("parts"))
    own = placed.join(parts, "sig").withColumn(
        "part", F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    part, other = F.col("part"), F.col("other")
    cells = own.select(
        "sig", F.least(part, other).alias("lo"), F.greatest(part, other).alias("hi"),
        F.when(part == other, 2).when(part < other, 0).otherwise(1).cast("int").alias("side"),
        "fp", "root", F.col("n_shingles").alias("n"), "sketch")
    return cells.repartition("sig", "lo", "hi").sortWithinPartitions(
        "sig", "lo", "hi", "n", "fp").mapInArrow(run, "a bigint, b bigint").distinct()


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots (node, root)`` after more ``links (a, b)``: only the roots that they join are looked
    at again. A node without a root is its own."""
    def root_of(side: str, name: str) -> DataFrame:
        return roots.select(F.col("node").alias(side), F.col("root").alias(name))

    ends = links.join(root_of("a", "ra"), "a", "left").join(root_of("b", "rb"), "b", "left")
    edges = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    merged = components(edges).select(F.col("node").alias("old"), F.col("root").alias("new"))
    fresh = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(
        roots, "node", "left_anti").select("node", F.col("node").alias("root"))
    return cut_lineage(roots.unionByName(fresh).join(
        merged, F.col("root") == F.col("old"), "left").select(
        "node", F.coalesce("new", "root").alias("root")))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of ``sets``."""
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(held > 1) - 1  # a shingle of one set is in no intersection
    owner, at = owner[held[at] > 1], column[at[held[at] > 1]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, SLAB):
        a, b = np.searchsorted(at, [lo, lo + SLAB])
        slab = np.zeros((len(sets), SLAB), dtype=np.float32)
        slab[owner[a:b], at[a:b] - lo] = 1
        out += (slab @ slab.T).astype(np.int64)
    return out


def link_counts(placed: DataFrame, docs: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Rows (fp, n_links): all classes of ``placed (root, fp, n_shingles, doc)`` that a class
    links with; classes of one root are compared with each other."""
    num, den = share

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in group["members"]]
        n = np.array([len(x) for x in sets])
        both = shared_counts(sets)
        good = den * both >= num * (n[:, None] + n[None, :] - both)
        side = group["side"].to_numpy()
        # side 2: the chunk meets itself
        good &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
        np.fill_diagonal(good, False)
        return pd.DataFrame({"fp": group["fp"], "n": good.sum(axis=1)})

    def chunks(m, n):
        return F.greatest(F.ceil(m / CHUNK), F.ceil(n / CHUNK_SHINGLES)).cast("int")

    totals = placed.groupBy("root").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("total"))
    # bands of 1.26: sizes of sets that link are in one band or in neighbouring bands
    banded = cut_lineage(placed.join(totals, "root").select(
        "root", "fp", "n_shingles", "doc", F.when(
            (F.col("m") <= CHUNK) & (F.col("total") <= CHUNK_SHINGLES), 0).otherwise(
            F.floor(F.log(F.col("n_shingles")) / float(np.log(1.26)))).cast("int").alias("band")))
    parts = cut_lineage(banded.groupBy("root", "band").agg(
        chunks(F.count(F.lit(1)), F.sum("n_shingles")).alias("parts")))

    def of(step: int, name: str) -> DataFrame:
        return parts.select("root", (F.col("band") + step).alias("band"),
                            F.col("parts").alias(name))

    own = banded.join(of(0, "same"), ["root", "band"]).join(
        of(-1, "above"), ["root", "band"], "left").join(
        of(1, "below"), ["root", "band"], "left").withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("same")).cast("int"))

    def meets(count, first, low, second, high, side):
        found = own.where(F.col(count) > 0).select(
            "*", F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias("other"))
        return found.select("fp", "root", first.alias("b1"), low.alias("p1"), second.alias("b2"),
                            high.alias("p2"), side.cast("int").alias("side"))

    band, part, other = F.col("band"), F.col("part"), F.col("other")
    keyed = meets("same", band, F.least(part, other), band, F.greatest(part, other),
                  F.when(part == other, 2).when(part < other, 0).otherwise(1)).unionByName(
        meets("above", band, part, band + 1, other, F.lit(0))).unionByName(
        meets("below", band - 1, other, band, part, F.lit(1)))
    held = cut_lineage(class_sets(placed.select("fp", "doc"), docs))
    return keyed.join(held, "fp").groupBy("root", "b1", "p1", "b2", "p2").applyInPandas(
        run, "fp bigint, n bigint").groupBy("fp").agg(F.sum("n").alias("n_links"))


def near_duplicates(docs: DataFrame, share: tuple[int, int] = (4, 5),
                    links_too: bool = True, keys_too: bool = False) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: doc_id, n_shingles, class_id (least doc_id with the
    same set), n_links (all other classes it links with), component_id.

    ``links_too``: count links, which costs the square of a component's classes; ``keys_too``: add
    ``text_key``, a hash of the text, and ``group_key``, which no two components share (doc_ids
    may be null or stand for several texts, so component_ids may be shared; null without words).

    ``share``: the least similarity, as a fraction; the signatures hold for 4/5 and more.
    """
    if 5 * share[0] < 4 * share[1]:
        raise ValueError("signatures are made for a similarity of 4/5 or more")
    with passing_shuffles(docs.sparkSession):
        out = _near_duplicates(docs, share, links_too, keys_too)
    return out.select("*")  # made outside, so its own shuffles stay


def _near_duplicates(docs: DataFrame, share: tuple[int, int], links_too: bool,
                     keys_too: bool) -> DataFrame:
    sets = cut_lineage(set_table(docs))
    classes = cut_lineage(sets.where("n_shingles > 0").groupBy("fp", "fp2", "n_shingles").agg(
        F.min("doc_id").alias("doc"), F.min("sketch").alias("sketch")))
    found = cut_lineage(stars(signature_table(docs)))

    def side(x: str) -> DataFrame:
        return classes.select(F.col("fp").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                              F.col("doc").alias(f"doc_{x}"), F.col("sketch").alias(f"s_{x}"))

    def links(pairs: DataFrame) -> DataFrame:
        known = may_link(pairs.join(side("a"), "a").join(side("b"), "b"), share)
        near = cut_lineage(known.select("a", "b", "doc_a", "doc_b"))
        n = near.count()
        if not n:
            return near.select("a", "b")
        few = near.coalesce(-(-n // TASK_PAIRS))  # else a task for each of many small pieces
        return cut_lineage(verified(few, docs, share, n))

    # all members of the signatures of three or more classes; two classes have met already
    members = found.select("sig", F.col("b").alias("fp")).unionByName(
        found.select("sig", F.col("a").alias("fp")).distinct())
    sizes = classes.select("fp", "n_shingles", "sketch")

    def open_members(roots: DataFrame) -> DataFrame:
        """Members of the signatures whose classes are not in one component yet."""
        placed = members.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn(
            "root", F.coalesce("root", "fp"))
        open_sigs = placed.groupBy("sig").agg(
            F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"),
            F.max("root").alias("hi")).where("n > 2 AND lo <> hi").select("sig")
        return cut_lineage(placed.join(open_sigs, "sig"))

    examined = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    roots = components(links(found.select("a", "b").distinct()))
    still = open_members(roots)
    for turn in range(ROUNDS):
        pairs = cut_lineage(centred(still, turn).join(examined.distinct(), ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            break
        examined = examined.unionByName(pairs)
        more = links(pairs)
        if not more.isEmpty():
            roots = joined_roots(roots, more)
            still = open_members(roots)
    sized = cut_lineage(still.join(sizes, "fp").select(
        "sig", "fp", "root", "n_shingles", "sketch"))
    second = links(across(sized, share).join(examined.distinct(), ["a", "b"], "left_anti"))
    if not second.isEmpty():
        roots = joined_roots(roots, second)
    named = roots.join(classes.select(F.col("fp").alias("node"), "doc"), "node")
    smallest = named.groupBy("root").agg(F.min("doc").alias("component"))
    placed = cut_lineage(roots.join(classes.select(
        F.col("fp").alias("node"), "n_shingles", "doc"), "node").select(
        "root", F.col("node").alias("fp"), "n_shingles", "doc"))
    if links_too:
        many = placed.join(placed.groupBy("root").count().where("count > 2").select("root"), "root")
        degree = roots.select("node").join(
            link_counts(many, docs, share).withColumnRenamed("fp", "node"), "node", "left").select(
            "node", F.coalesce("n_links", F.lit(1)).alias("n_links"))  # two classes: one link
    else:
        degree = roots.select("node", F.lit(None).cast("bigint").alias("n_links"))
    places = roots.join(smallest, "root").join(degree, "node").select(
        F.col("node").alias("fp"), F.col("root").alias("group_key"), "component", "n_links",
        F.lit(True).alias("linked"))
    linked = F.coalesce("linked", F.lit(False))
    per_class = classes.join(places, "fp", "left").select(
        "fp", "fp2", F.col("n_shingles").alias("n"), "doc",
        F.when(linked, F.col("component")).otherwise(F.col("doc")).alias("component"),
        F.when(linked, F.col("n_links")).otherwise(0).alias("n_links"),
        F.coalesce("group_key", "fp").alias("group_key"))
    out = sets.join(per_class, (sets.fp == per_class.fp) & (sets.fp2 == per_class.fp2)
                    & (sets.n_shingles == per_class.n), "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("doc", "doc_id").alias("class_id"),
        *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if links_too else []),
        F.coalesce("component", "doc_id").alias("component_id"),
        *(["text_key", "group_key"] if keys_too else []))
