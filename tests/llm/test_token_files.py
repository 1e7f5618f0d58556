import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF
from regiocast.llm import range_coder
from regiocast.llm.range_coder import CorruptBlock, decode_blocks, encode_blocks
from regiocast.llm.token_files import read_ids, write_ids

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_blocks_come_back():
    rng = np.random.default_rng(5)
    zipf = np.minimum(rng.zipf(1.3, size=20000), 65535)
    blocks = [np.zeros(0, int), np.array([65535]), np.full(8192, 7), rng.integers(0, 65536, 8192),
              *np.split(zipf, [100, 227, 355, 484, 3000, 9000, 9257, 17000]),
              np.tile([5, 9, 2, 2, 11], 700)]
    coded = encode_blocks(blocks)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(decode_blocks(coded), blocks))
    for i in (3, 7, 11):  # a block does not depend on the others
        assert (decode_blocks([coded[i]])[0] == blocks[i]).all()
        assert encode_blocks([blocks[i]])[0] == coded[i]
    assert len(coded[2]) < 300 and len(coded[-1]) < 400
    assert len(coded[3]) < 2.3 * 8192


def test_damage_is_noticed():
    block = encode_blocks([np.arange(500) % 37])[0]
    for at in (0, 5, 9, len(block) // 2, len(block) - 5):
        bad = bytearray(block)
        bad[at] ^= 0x41
        with pytest.raises(CorruptBlock):
            decode_blocks([bytes(bad)])
    with pytest.raises(CorruptBlock):
        decode_blocks([block[:10]])
    with pytest.raises(ValueError):
        encode_blocks([np.array([65536])])


def expected(rows):
    library, at, out = Tokenizer.from_file(WORD), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_all_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    write_ids(docs, str(tmp_path / "f"), WORD)
    got = sorted(tuple(r) for r in read_ids(spark, str(tmp_path / "f")).collect())
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(range_coder, "BLOCK", 64)
    monkeypatch.setattr(range_coder, "LANES", 3)
    rows = [(3, None), (-5, ""), (9, "w " * 3000), (4, "# #"), (10, "same"), (10, "same"),
            (7, "<|endoftext|> x"), (None, "no id"), *[(100 + i, f"text {i}") for i in range(90)]]
    docs = spark.createDataFrame([(a, b, 1, 2) for a, b in rows],
                                 "doc_id bigint, text string, start int, part int")
    write_ids(docs, str(tmp_path / "f"), WORD, parts=5)
    got = read_ids(spark, str(tmp_path / "f"), with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got)
    assert sorted((r[1:4] for r in map(tuple, got))) == sorted(r[1:] for r in expected(rows))
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    write_ids(docs.limit(0), str(tmp_path / "e"), WORD)
    assert read_ids(spark, str(tmp_path / "e")).count() == 0
