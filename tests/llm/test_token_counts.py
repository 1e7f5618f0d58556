import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF
from regiocast.llm.token_counts import allocate, lines, token_counts
from regiocast.llm.tokens import SpanCoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def brute(text, rule):
    """Characters are marked with their section; each token looks at its characters."""
    found = Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False)
    mark, k = [], 0
    for c in text:
        mark.append(k)
        k += c == "\n"
    counts = {s: 0.0 for s in range(max(mark, default=0) + 1)}
    for a, b in found.offsets:
        chars = mark[a:b]
        if rule == "start":
            counts[chars[0]] += 1
        elif rule == "most":
            counts[max(sorted(set(chars)), key=chars.count)] += 1
        else:
            for s in chars:
                counts[s] += 1 / len(chars)
    return counts, len(found.ids)


@pytest.mark.parametrize("rule", ["most", "start", "share"])
def test_equals_marking_characters(spark, rule):
    texts = ["", "a\nb", "a\n\n\n\nb", "\n\n\n", "x  \n  y", "é\nÉß\U0001f600\n!", "w " * 3000 + "\n"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(99, None, 1)],
                                 "doc_id bigint, text string, section int")
    got = {}
    for r in token_counts(docs, BYTE, rule=rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = r
    for i, t in [*enumerate(texts), (99, "")]:
        want, n = brute(t, rule)
        assert {s: pytest.approx(c) for s, c in want.items()} == {
            s: r.n_tokens for s, r in got[i].items()}
        assert all(r.doc_tokens == n for r in got[i].values())
    assert token_counts(docs.limit(0), BYTE).count() == 0


def test_sections_with_gaps():
    tokens = np.array([[0, 3], [3, 6], [6, 9], [9, 12]])
    sections = np.array([[1, 4], [7, 8]])
    assert allocate(tokens, sections, "most")[0].tolist() == [1, 0, 3]
    assert allocate(tokens, sections, "start")[0].tolist() == [1, 0, 3]
    assert allocate(tokens, sections, "share")[0] == pytest.approx([1, 1 / 3, 4 - 4 / 3])
    assert lines("a\nb").tolist() == [[0, 2], [2, 3]]


def test_all_documents_add_up(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = token_counts(docs, BYTE).groupBy("doc_id", "doc_tokens").sum("n_tokens").collect()
    library = Tokenizer.from_file(BYTE)
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids)
            for r in docs.collect()}
    assert {r.doc_id: r.doc_tokens for r in rows} == want
    assert all(r["sum(n_tokens)"] == r.doc_tokens for r in rows)


def test_spans_from_the_word_table_equal_the_library():
    library, rnd = Tokenizer.from_file(BYTE), random.Random(5)
    parts = ["a", "\u00e9", "\u6f22", "\U0001f600", "\n", " ", " ", "  ", "'s", "23", ".", "\t",
             "<|endoftext|>", "\u00a0", "\u200d", "\x1f", "word", "Word"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(3000)]
    code = SpanCoder(BYTE, keep=50)  # the table starts anew many times
    for text, got in zip(texts, code.encode(texts)):
        want = library.encode(text, add_special_tokens=False).offsets
        assert list(map(tuple, got.tolist())) == want, text
