from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlane.llm import token_files
from ledgerlane.llm.token_files import TokenFile, TokenWriter, WordEncoder, bits_for, pack, unpack

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(PATH)


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@drawn(st.integers(1, 32), st.data())
@settings(max_examples=60, deadline=None)
def test_pack_and_unpack(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=300)), np.uint32)
    packed = pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert unpack(packed, bits, len(ids)).tolist() == ids.tolist()


def test_fewest_bits():
    assert [bits_for(n) for n in (1, 2, 3, 4, 5, 256, 257, 49408, 65537)] == [1, 1, 2, 2, 3, 8, 9, 16, 17]


@pytest.mark.parametrize("vocabulary", [3, 1000, 49408, 70_000])
def test_random_access(tmp_path, vocabulary, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 512)
    draw = np.random.default_rng(3)
    ids = draw.integers(0, vocabulary, 5000).astype(np.uint32)
    counts = np.array([0, 1, 700, 0, 4299])
    writer = TokenWriter(str(tmp_path / "a" / "x.ids"), vocabulary)
    for first, last in ((0, 2), (2, 5)):
        here = slice(counts[:first].sum(), counts[:last].sum())
        writer.write(np.arange(first, last), np.ones(last - first, bool), counts[first:last], ids[here])
    assert writer.close() == (5, 5000)
    file = TokenFile(str(tmp_path / "a" / "x.ids"))
    for start, count in ((0, 5000), (0, 0), (511, 2), (4999, 1), (1000, 2600)):
        assert file.read(start, count).tolist() == ids[start:start + count].tolist()
    assert file.document(2).tolist() == ids[1:701].tolist() and not len(file.document(3))
    size = os.path.getsize(tmp_path / "a" / "x.ids")
    assert size < 5000 * bits_for(vocabulary) / 8 + 5 * 17 + 10 * 9 + 60


def test_same_ids_as_the_library(encoder, given, odd_rows):
    texts = [row["text"] for row in given("documents").select("text").collect()] + [row[1] for row in odd_rows]
    texts += ["İstanbul ſoft", "<|endoftext|> a", "<|ENDOFTEXT|> a", 'said."yes",(no)', "é ;̸ ÉCOLE Été", "a\u0085b\x1cc"]
    for _ in range(2):  # the second time from memory
        assert split(*encoder.encode(pa.array(texts))) == library_ids(texts)


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    encoder = WordEncoder(PATH)
    for texts in (["a b c"], ["c d e f", "a"], ["f g", None]):
        assert split(*encoder.encode(pa.array(texts, pa.string()))) == library_ids(texts)
        assert len(encoder._seen) <= 4


def expected(rows):
    ordered = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    start, out = 0, []
    for (doc_id, *_), ids in zip(ordered, library_ids([row[1] for row in ordered])):
        raw = np.array([*ids, 1], "<u4").tobytes()
        out.append((doc_id, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    return out


def test_digests_of_odd_rows(docs, odd_rows):
    found = token_files.token_digests(docs(*odd_rows), PATH).collect()
    assert sorted(map(tuple, found), key=lambda row: row[1]) == expected(odd_rows)


def test_digests_of_the_sample(spark, given):
    rows = [(row["doc_id"], row["text"]) for row in given("documents").collect()]
    found = token_files.token_digests(given("documents").repartition(5), PATH)
    assert sorted(map(tuple, found.collect()), key=lambda row: row[1]) == expected(rows)


def test_empty_table(docs):
    assert token_files.token_digests(docs((1, "a")).limit(0), PATH).collect() == []
