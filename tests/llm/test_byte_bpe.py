from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from ledgerlane.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


LIBRARY = library()


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(PATH, PATTERN)


def check(codec, texts):
    ids, counts = codec.encode(pa.array(texts, pa.string()))
    found = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == [LIBRARY.encode_ordinary(text or "") for text in texts]
    assert codec.decode(ids, counts) == [(text or "").encode() for text in texts]


def test_sample_and_odd_texts(codec, given, odd_rows):
    texts = [row["text"] for row in given("documents").select("text").collect()] + [row[1] for row in odd_rows]
    check(codec, texts)


def test_single_characters(codec):
    points = [c for c in range(1, 0x20000, 3) if not 0xD800 <= c < 0xE000]
    check(codec, [f"{chr(c)}a {chr(c)}{chr(c)} b{chr(c)}" for c in points])


@drawn(st.lists(st.text(st.sampled_from("ab 'stré,.\n\t1٣ 東🙂|<>"), max_size=60), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_any_text(codec, texts):
    check(codec, texts)


@pytest.mark.parametrize("size", [255, 256, 257, 3000])
def test_long_pieces(codec, size):
    check(codec, ["ab" * size, "thon" * size, "é" * size, " " * size + "x", "7" * size])


def test_digests(docs, odd_rows):
    found = byte_bpe.digests(docs(*odd_rows), PATH, PATTERN).collect()
    want = []
    for doc_id, text, *_ in odd_rows:
        ids = LIBRARY.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda row: (row[0] or 0, row[2])
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_ids_and_texts(docs):
    found = byte_bpe.encoded(docs((1, "the heed"), (2, None)), PATH, PATTERN, ("doc_id", "lang")).collect()
    assert sorted((r["doc_id"], r["lang"], r["ids"], r["decoded"]) for r in found) == [
        (1, "en", LIBRARY.encode_ordinary("the heed"), "the heed"), (2, "en", [], "")
    ]


def test_empty_table(docs):
    assert byte_bpe.digests(docs((1, "a")).limit(0), PATH, PATTERN).collect() == []
