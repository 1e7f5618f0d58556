import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF
from regiocast.llm.packing import best_cuts, pack_documents
from regiocast.llm.tokens import coder

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def cost(at, penalty, cuts, capacity):
    fine = dict(zip(at, penalty))
    return sum(capacity - (b - a) + fine[b] for a, b in itertools.pairwise(cuts))


def test_cuts_cost_as_little_as_any():
    rnd = random.Random(3)
    for _ in range(200):
        at = [0]
        while len(at) < 11:
            at.append(at[-1] + rnd.randrange(1, 9))
        penalty = [0.0] + [rnd.choice([0.0, 1.0, 5.0]) for _ in at[1:]]
        got = best_cuts(np.array(at), np.array(penalty), 12).tolist()
        choices = [[0, *c, at[-1]] for n in range(10)
                   for c in itertools.combinations(at[1:-1], n)]
        least = min(cost(at, penalty, c, 12) for c in choices
                    if all(b - a <= 12 for a, b in itertools.pairwise(c)))
        assert all(b - a <= 12 for a, b in itertools.pairwise(got))
        assert cost(at, penalty, got, 12) == least


def check(rows, texts, capacity=1024):
    """Pieces against whole-text ids of the library itself."""
    library = Tokenizer.from_file(BYTE)
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(texts)
    for doc, pieces in docs.items():
        ids = np.array(library.encode(texts[doc] or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(1, sum(r.length for r in rows))


def test_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(pack_documents(docs, BYTE).collect(), texts) < 0.02


def test_odd_documents(spark):
    texts = {1: None, 2: "", 3: "x " * 5000, 4: "no end", 5: "\n\n", 6: "<|endoftext|> a\tb",
             7: "a" * 30000, 8: "One. Two! Three?\nFour. " * 700, -9: "same", 10: "same"}
    docs = spark.createDataFrame([(k, v, 1, "s") for k, v in texts.items()],
                                 "doc_id bigint, text string, length int, offset string")
    check(pack_documents(docs.repartition(2), BYTE).collect(), texts)
    assert pack_documents(docs.limit(0), BYTE).count() == 0
    rows = pack_documents(docs, BYTE, with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


@pytest.mark.parametrize("kind, file", [("byte", "byte_bpe_50k.json"),
                                        ("word", "word_bpe_49k.json")])
def test_coder_equals_library(kind, file):
    code = coder(kind, public_tokenizers.path(file))
    rnd = random.Random(1)
    for letters in (list(" \n  .,'s!?abÀéß9Σ́İ\U0001f600") + ["'re", "The ", " and"],
                    list(" \n \t\r,'ab9\xa0\x1c​́") + ["<|endoftext|>", "\n\n", " a"]):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(30)))
                 for _ in range(4000)]
        assert [code.direct(t) for t in texts] == code.encode(texts)
