import itertools
import re

import numpy as np
import pytest
import xxhash

from regiocast.llm import simhash
from regiocast.llm.simhash import VantageTree, fingerprint, simhash_groups

SCHEMA = "doc_id bigint, text string, fingerprint string, fp bigint, root int"


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 2)
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3] if len(words) > 2 else words), 42)
         for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, reach=3):
    prints = [plain_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= reach:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{p:016x}", least.get(find(i)))
                   for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def corpus(seed=1, n=250):
    rnd = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(n):
        if i and rnd.random() < .6:
            old = (rows[rnd.integers(len(rows))][1] or "a b").split(" ")
            for _ in range(rnd.integers(0, 4)):
                old[rnd.integers(len(old))] = words[rnd.integers(400)]
            text = " ".join(old)
        else:
            text = " ".join(rnd.choice(words, rnd.integers(1, 300)))
        rows.append((int(rnd.integers(0, 10_000)), text))
    rows += [(None, rows[5][1]), (None, "only null ids here so far"), (7, None), (3, ""), (9, " \t\n"),
             (11, "One"), (12, "one"), (13, "one Two"), (rows[0][0], "another text of one id"),
             rows[4], rows[4], (99, "word " * 70_000), (98, "word " * 70_001), (97, "Ünïcode ÉÉ x")]
    return rows


@pytest.mark.parametrize("shard", [16_384, 20])
def test_equals_brute_force(spark, shard):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)
    got = simhash_groups(df, shard=shard)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_fingerprints():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 254, 257, 258, 600):
        text = " ".join(f"W{x}Ü" for x in rnd.integers(0, 50, n))
        assert fingerprint(text.encode()) == plain_print(text)


def test_tree_reaches_every_pair():
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 1 << 63, 40).astype(np.uint64)
    points = [base]
    for _ in range(20):
        flips = (np.uint64(1) << rnd.integers(0, 64, (40, 3)).astype(np.uint64))
        points.append(base ^ np.bitwise_xor.reduce(flips, axis=1))
    points = np.unique(np.concatenate(points))
    tree = VantageTree(points, 8)
    assert sorted(np.concatenate(tree.leaves)) == list(range(len(points)))
    home = tree.homes(points)
    for leaf, at in enumerate(tree.leaves):
        assert (home[at] == leaf).all()
    visits = {(leaf, i) for leaf, at in tree.visits(points, 3) for i in at.tolist()}
    near = np.bitwise_count(points[:, None] ^ points) <= 3
    for i, j in zip(*np.nonzero(near)):
        assert (home[j], i) in visits
    assert len(visits) < len(points) * len(tree.leaves)


def test_dense_group_gives_a_forest(spark):
    # all fingerprints within one bit of a centre, and chains across shards
    centre = np.uint64(0x0F0F0F0F0F0F0F0F)
    ball = np.concatenate([[centre], centre ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))])
    shard = simhash.Shard(ball, 3)
    a, b = shard.forest()
    assert len(a) == 64 and len(set(b.tolist())) == 1
    visitors, members = shard.visit(np.array([centre ^ np.uint64(7), ~centre], dtype=np.uint64))
    assert visitors.tolist() == [int(centre ^ np.uint64(7))] and members[0] in ball


def test_empty(spark):
    assert simhash_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
