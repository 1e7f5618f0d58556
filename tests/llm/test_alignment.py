import functools
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regiocast.llm import alignment
from regiocast.llm.alignment import (Aligned, align_documents, chunk_fragment, chunks, close, compose,
                                     tokenizers)

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, row int, links string, code int, n int"


@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    codes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(c): c for c in codes}
    n = 256
    for c in range(256):
        if c not in codes:
            table[chr(n)] = c
            n += 1
    return a, b, table


@functools.cache
def plain(text):
    """(A ids, B ids, groups) by the libraries on the whole text, or None."""
    if not text:
        return None
    a, b, table = libraries()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = []
    for i in ids_b:
        p = b.id_to_piece(i)
        bytes_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(i)
                       else p.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    groups, i, j, ga, gb, na, nb = [], 0, 0, [], [], 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if na <= nb and i < len(ids_a):
            ga.append(ids_a[i])
            na += len(bytes_a[i])
            i += 1
        else:
            gb.append(ids_b[j])
            nb += len(bytes_b[j])
            j += 1
        if na == nb:
            groups.append((ga, gb))
            ga, gb = [], []
    return len(ids_a), len(ids_b), groups


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def brute(rows):
    found = [plain(t) for _, t in rows]
    counts = Counter((a[-1], b[-1]) for f in found if f for a, b in f[2])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for (d, _), f in zip(rows, found):
        if not f:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a[-1], b[-1]) for a, b in f[2]]
        out.append((d, f[0], f[1], len(f[2]), len(links),
                    sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(written(f[2]).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(words=30_000):
    rnd = random.Random(4)
    pool = ["the", "of", "unbelievable", "naïve", "Straße", "x1y2", "--", "don't", "東京", "🙂", "foo.bar"]
    rows = [(i, " ".join(rnd.choice(pool) + rnd.choice(["", "s", ",", ".\n", "\n\n", "  "])
                         for _ in range(rnd.randint(1, 80)))) for i in range(60)]
    rows += [(None, "a null id"), (5, "another text of five"), rows[3], rows[3], (70, None), (71, ""),
             (72, "▁mark"), (73, "<|endoftext|> <s> <0x41> is plain"), (74, " "), (75, "\n"),
             (76, "tab\tand\r\nlines   odd space"), (77, "word " * words),
             (78, ("long words here\n" * (words // 3))[:-1]), (79, "x" * (2 * words + 10_000)), (80, "a\x00b\x1cc")]
    return rows


@pytest.mark.parametrize("hot, size", [(500_000, 1 << 16), (25, 40)])
def test_equals_brute_force(spark, monkeypatch, hot, size):
    monkeypatch.setattr(alignment, "HOT", hot)
    monkeypatch.setattr(alignment, "CHUNK", size)
    rows = corpus(30_000 if size > 40 else 300)
    df = spark.createDataFrame([(d, t, 1, "x", 2, 3) for d, t in rows], SCHEMA)
    got = align_documents(df, A, B)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r) for r in got.select(names).collect()), key=repr) == brute(rows)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(
    [" ", "\n", "word", " the", "Don't", "1234", "é", "▁", "<s>", "<|endoftext|>", "  ", "日本"])),
    max_size=30), st.integers(1, 9), st.integers(1, 40))
def test_any_cutting_gives_the_same_groups(parts, width, size):
    pair = tokenizers(A, B)
    text = "".join(parts).encode("utf-8", "ignore").decode()
    want = plain(text)
    pieces = chunks(text, size)
    assert " ".join(pieces) == text
    found = [chunk_fragment(pair, p, width) for p in pieces]
    if want is None:
        assert not text or None in found
        return
    expected = (want[0], want[1], len(want[2]),
                hashlib.sha256(written(want[2]).encode()).hexdigest())
    assert close(compose(found))[:4] == expected


def test_composition_is_associative():
    pair = tokenizers(A, B)
    text = "Unbelievably naïve: straße, 東京 don't 12345 foo.bar  unusualnesses"
    aligned = Aligned(pair, [pair.encode([text])[0]])
    size = int(aligned.ends_a[-1])
    rnd = random.Random(2)
    whole = compose([aligned.fragment(0, size)])
    for _ in range(200):
        x, y, z = sorted(rnd.randint(0, size) for _ in range(3))
        f, g, h, i = (aligned.fragment(lo, hi) for lo, hi in [(0, x), (x, y), (y, z), (z, size)])
        left = compose([compose([compose([f, g]), h]), i])
        right = compose([f, compose([g, compose([h, i])])])
        assert left == right == compose([f, g, h, i]) == whole
    assert compose([]) == compose([compose([]), compose([])])


def test_empty(spark):
    assert align_documents(spark.createDataFrame([], "doc_id bigint, text string"), A, B).count() == 0


def test_words_seen_and_new_give_the_ids_of_the_whole_text():
    coder, library = alignment.SpacedCoder(A), libraries()[0]
    texts = [" " + t for t in ("one word", "a\nline of <s> and more", "one  odd space", "x", "")]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in "new", "seen":
        assert [np.frombuffer(raw, "<u4").tolist() for raw in coder.encode(texts)] == want


WORDS = ["", "a", "the", "Straße", "x\ny", "\nz", "z\n", "▁", "q▁r", "<s>", "<|endoftext|>", "it's", "1,234",
         "​q", "日本語", "🙂", "…", "\t", "é", "<0x0A>"]


@given(st.lists(st.lists(st.one_of(st.sampled_from(WORDS), st.text(max_size=6)), max_size=9)
                .map(" ".join), max_size=4))
@settings(max_examples=150, deadline=None)
def test_groups_of_words_equal_groups_of_whole_texts(texts):
    pair = tokenizers(A, B)
    assert alignment.align_texts(pair, texts) == alignment.aligned_whole(pair, texts)


def test_known_words_are_not_encoded_again():
    class Counted:
        def __init__(self, b):
            self.b, self.n = b, 0

        def __getattr__(self, name):
            return getattr(self.b, name)

        def encode(self, texts, **more):
            self.n += sum(map(len, texts))
            return self.b.encode(texts, **more)

    pair = alignment.Pair(A, B)
    text = "one line of words\nand one more, with the words of the first line"
    first = alignment.align_texts(pair, [text])
    pair.b = Counted(pair.b)
    assert alignment.align_texts(pair, [text, text]) == first * 2
    assert pair.b.n == 0
    alignment.align_texts(pair, [text + " one nothing"])
    assert pair.b.n == len("nothing")
