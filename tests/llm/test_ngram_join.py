import random
import re

import numpy as np

from conftest import SF
from regiocast.llm import ngram_join
from regiocast.llm.ngram_join import near_duplicates, scheme, signatures
from regiocast.llm.shingles import shingle_sets
from regiocast.session import REMOVE_SHUFFLES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, plain_set(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, (_, s) in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    pairs = {(a, b) for h in holders.values() for x, a in enumerate(h) for b in h[x + 1:]}
    for a, b in pairs:
        inter = len(sets[a][1] & sets[b][1])
        if 100 * inter >= 80 * (len(sets[a][1]) + len(sets[b][1]) - inter):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def run(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect())


def test_all_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def changed(words, n, rnd):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"x{rnd.randrange(10 ** 6)}"
    return words


def test_groups_chains_and_odd_texts(spark):
    rnd = random.Random(8)
    rows = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One"), (1004, "one"),
            (1005, "a b c d"), (1006, "a  b\tC d"), (1007, "a\x0bb c d e"), (1008, "\x1c"),
            (1009, "É b c d e f"), (1010, "é b c d e f"), (1011, "w " * 5000)]
    i = 0
    for size in (6, 9, 14, 30, 60, 200, 700):
        base = [f"w{rnd.randrange(400)}" for _ in range(size)]
        for _ in range(14):  # near copies at every distance around the threshold
            rows.append((i, " ".join(changed(base, rnd.randrange(0, 1 + size // 20), rnd))))
            i += 1
        step = base
        for _ in range(6):  # chains: neighbours link, ends do not
            step = step[1:] + [f"y{rnd.randrange(10 ** 6)}"]
            rows.append((i, " ".join(step)))
            i += 1
        rows.append((i, " ".join(base)))
        i += 1
    passage = " ".join(f"p{k}" for k in range(55))
    for _ in range(40):
        rows.append((i, " ".join(f"q{rnd.randrange(10 ** 6)}" for _ in range(25)) + " " + passage))
        i += 1
    rows += [(i + 5, rows[50][1]), (i + 6, rows[50][1])]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows],
                               "doc_id bigint, text string, fp int, n_shingles int")
    assert run(df) == brute(rows)
    assert near_duplicates(df.limit(0)).count() == 0


def test_linked_sets_share_a_signature():
    rnd = np.random.default_rng(2)
    for n in [*range(4, 40), 60, 97, 150, 400, 1000]:
        for _ in range(10):
            a = rnd.choice(1 << 62, size=n, replace=False).astype(np.uint64)
            lost = rnd.integers(0, n // 5 + 1)
            more = rnd.integers(0, n // 4 + 1)
            b = np.concatenate([a[lost:], rnd.choice(1 << 62, size=more).astype(np.uint64)])
            if 5 * (n - lost) >= 4 * (n + more) and lost + more:
                assert np.intersect1d(signatures(a), signatures(b)).size


def test_kept_signatures_are_fewer_than_made():
    for last in range(4, 3000):
        k, n1, keep = scheme(last)
        assert k == 0 or keep <= 3 * n1


def test_shingles_equal_plain_sets():
    texts = [None, "", "A b", "a b c d e f a b c d e", "x\ty\nz  u v w", "é É ß 1 2 3"] * 3
    assert [len(s) for s in shingle_sets(texts)] == [len(plain_set(t)) for t in texts]


def brute_links(rows):
    sets = {i: frozenset(plain_set(t)) for i, t in rows}
    classes = set(sets.values()) - {frozenset()}

    def link(a, b):
        return 5 * len(a & b) >= 4 * len(a | b)

    n = {a: sum(link(a, b) for b in classes if b != a) for a in classes}
    return {i: n.get(s, 0) for i, s in sets.items()}


def test_links_of_all_class_pairs_are_counted(spark, monkeypatch):
    rnd = random.Random(11)
    rows = []
    for size, copies in ((12, 8), (80, 30), (150, 70)):
        base = [f"w{rnd.randrange(900)}" for _ in range(size)]
        for _ in range(copies):
            cut = rnd.randrange(0, 1 + size // 6)
            rows.append((len(rows), " ".join(changed(base, rnd.randrange(3), rnd)[cut:])))
    rows += [(len(rows), rows[0][1]), (len(rows) + 1, "one pair of words here now"),
             (len(rows) + 2, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_links(rows)
    assert max(want.values()) > 20
    for chunk in (512, 9):
        monkeypatch.setattr(ngram_join, "CHUNK", chunk)
        assert {r.doc_id: r.n_links for r in near_duplicates(df).collect()} == want


def test_null_and_doubled_ids(spark):
    """Texts are told apart by what they say, whatever their ids: (None, A) links to (5, A + one
    word), and (7, Z), (8, Z + one word) link although another text has id 7."""
    rnd = random.Random(3)
    a, z, q = (" ".join(f"{c}{rnd.randrange(10 ** 6)}" for _ in range(60)) for c in "azq")
    rows = [(None, a), (5, a + " more"), (7, z), (7, q), (8, z + " more"), (None, "only here " * 3),
            (None, "only here " * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in
                  near_duplicates(df, keys_too=True).collect()), key=repr)
    assert got == sorted([(None, 56, 1, 5), (5, 57, 1, 5), (7, 56, 1, 7), (7, 56, 0, 7),
                          (8, 57, 1, 7), (None, 2, 0, None), (None, 2, 0, None)], key=repr)
    groups = near_duplicates(df, links_too=False, keys_too=True)
    assert "n_links" not in groups.columns
    assert groups.select("group_key").distinct().count() == 4


def test_large_signatures_are_dealt_into_cells(spark, monkeypatch):
    """A passage shared by many documents of several groups: pairs across groups are met in small
    cells, and the components stay those of brute force."""
    rnd = random.Random(12)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for g in range(12):
        own = [f"g{g}x{k}" for k in range(16)]
        for _ in range(15):
            words = list(own)
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(16)] = f"z{rnd.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(words + passage)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for cell in (1024, 7):
        monkeypatch.setattr(ngram_join, "CELL", cell)
        assert run(df) == brute(rows)


def test_sketches_never_overstate_a_difference():
    rnd = np.random.default_rng(5)
    sets = []
    for n in (1, 2, 250, 257, 300, 600, 1100, 2100, 2600, 6000):
        base = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        sets += [base, np.unique(np.append(base[n // 9:], rnd.integers(0, 1 << 63, n // 3).astype(
            np.uint64)))]
    held = ngram_join.Sketches([ngram_join.describe(s)[2] for s in sets])
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    gap = held.gap(i, j)
    true = [len(np.setxor1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)]
    assert (gap <= true).all()
    assert (gap[i == j] == 0).all()


def test_long_texts_that_only_share_half_are_told_apart_without_their_texts(spark):
    rnd = np.random.default_rng(6)
    both, a, b = (rnd.integers(0, 1 << 63, n).astype(np.uint64) for n in (2200, 560, 560))
    rows = []
    for k, (x, y) in enumerate([(np.append(both, a), np.append(both, b)),
                                (np.append(both, a[:200]), np.append(both, b[:200]))]):
        rows.append((k, k, len(x), bytearray(ngram_join.describe(x)[2]), len(y),
                     bytearray(ngram_join.describe(y)[2])))
    pairs = spark.createDataFrame(rows, "a long, b long, n_a long, s_a binary, n_b long, s_b binary")
    # 2,200 of 3,320 shingles are shared by the first pair, of 2,600 by the second
    assert [r.a for r in ngram_join.may_link(pairs, (4, 5)).collect()] == [1]


def test_more_links_join_roots(spark):
    first = [(1, 2), (2, 3), (5, 6), (10, 11)]
    more = [(3, 6), (11, 20), (30, 31), (5, 1), (31, 32), (40, 41)]
    roots = ngram_join.joined_roots(
        ngram_join.components(spark.createDataFrame(first, "a long, b long")),
        spark.createDataFrame(more, "a long, b long"))
    want = ngram_join.components(spark.createDataFrame(first + more, "a long, b long"))
    assert sorted(map(tuple, roots.collect())) == sorted(map(tuple, want.collect()))


def test_steps_leave_no_shuffle_files(spark, monkeypatch):
    before, seen, plain = spark.conf.get(REMOVE_SHUFFLES), [], ngram_join.cut_lineage

    def cut(df):
        seen.append(spark.conf.get(REMOVE_SHUFFLES))
        return plain(df)

    monkeypatch.setattr(ngram_join, "cut_lineage", cut)
    words = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, words), (2, words + " 1"), (3, words + " 2"), (4, "other words than these are here")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert set(seen) == {"true"} and spark.conf.get(REMOVE_SHUFFLES) == before
    ids = [sorted((r.doc_id, r.component_id) for r in got.collect()) for _ in range(2)]
    assert ids == [[(1, 1), (2, 1), (3, 1), (4, 4)]] * 2
