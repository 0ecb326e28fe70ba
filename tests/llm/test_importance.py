from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlane.llm import importance, queries
from tests.conftest import SAMPLE

_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SMALL = {c: c + 32 for c in range(0x41, 0x5B)}


def features(text):
    words = _WORDS.findall((text or "").translate(_SMALL))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]


def expected(documents, target):
    found = [(doc_id, *features(text)) for doc_id, text, *_ in documents]
    source, wanted = [0] * 10_000, [0] * 10_000
    for _, _, buckets in found:
        for b in buckets:
            source[b] += 1
    for text in target:
        for b in features(text)[1]:
            wanted[b] += 1
    s, t = sum(source), sum(wanted)
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000)))) for b in range(10_000)
    ]
    rows = []
    for doc_id, n, buckets in found:
        key = f"42:{'null' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append([doc_id, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    order = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(order[:5 * len(order) // 100]):
        row[4] = rank + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(rows):
    return sorted((tuple(r) for r in rows.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_against_brute_force(spark, given):
    documents = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    target = [r["text"] for r in given("benchmark").collect()]
    assert got(queries.op13_resampling(spark, SAMPLE)) == expected(documents, target)


@pytest.mark.parametrize("ranked_rows", [1_000_000, 7])
def test_odd_rows(spark, docs, odd_rows, ranked_rows):
    """Nulls, blanks, long texts, a third of all rows alike, several ranges of ranks."""
    draw = random.Random(1)
    more = [(100 + k, " ".join(draw.choice("alpha beta gamma Été 12".split()) for _ in range(30))) for k in range(60)]
    rows = [*odd_rows, *more, *[(7777, more[0][1])] * 40]
    target = spark.createDataFrame([("alpha beta 12",), (None,)], "text string")
    found = importance.resampled(docs(*rows), target, ranked_rows=ranked_rows)
    assert got(found) == expected(rows, ["alpha beta 12", None])
    chosen = importance.drawn(docs(*rows), found)
    ids = {r["doc_id"] for r in found.where("rank is not null").collect()}
    assert {r["doc_id"] for r in chosen.collect()} == ids and chosen.columns == docs(*rows).columns


def test_empty_tables(spark, docs):
    none = docs((1, "a")).limit(0)
    assert got(importance.resampled(none, none)) == []
    assert got(importance.resampled(docs((1, "a b"), (2, None)), none)) == expected([(1, "a b"), (2, None)], [])


def scanned(texts, most):
    out = [[] for _ in texts]
    words = np.zeros(len(texts), np.int64)
    for rows, buckets, count in importance.scanned(pa.array(texts, pa.string()), most):
        words += count
        for row, bucket in zip(rows.tolist(), buckets.tolist(), strict=True):
            out[row].append(bucket)
    return [(n, sorted(x)) for n, x in zip(words.tolist(), out, strict=True)]


def test_texts_in_parts():
    draw = random.Random(2)
    for _ in range(60):
        text = "".join(draw.choice("ab1 .\nÉ東 Z-") for _ in range(draw.randrange(300)))
        n, buckets = features(text)
        assert scanned([text], draw.choice([1, 5, 40])) == [(n, sorted(buckets))]
    texts = ["a b", None, "", "b", " x" * 3, "Q" * 700, "y " + "é" * 9000]
    assert scanned(texts, 10) == [(n, sorted(b)) for n, b in map(features, texts)]


def test_registers_over_blocks(monkeypatch):
    monkeypatch.setattr(importance, "_BLOCK", 1024)
    data = np.random.default_rng(3).integers(0, 256, 5000).astype(np.uint8)
    at = np.array([0, 1, 255, 256, 1023, 1024, 2500, 4999])
    found = importance.registers(data, at)
    ones = importance.shifted(np.full(len(at), 0xFFFFFFFF, np.uint32), at + 1)
    assert (~(found ^ ones)).tolist() == [zlib.crc32(data[:k + 1].tobytes()) for k in at.tolist()]


def test_shift_cancels_a_prefix():
    a, b = b"some prefix ", b"and the rest" * 700
    joined, first = np.array([zlib.crc32(a + b)], np.uint32), np.array([zlib.crc32(a)], np.uint32)
    assert joined ^ importance.shifted(first, np.array([len(b)])) == zlib.crc32(b)
