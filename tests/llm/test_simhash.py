from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ledgerlane.llm import simhash
from ledgerlane.llm.components import components


def brute_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [words[k:k + 4] for k in range(len(words) - 3)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(x).encode(), 42) for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(pairs, distance=4):
    """(doc_id, fingerprint) -> smallest doc_id reachable, by all pairs."""
    parent = list(range(len(pairs)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(pairs)), 2):
        if (pairs[a][1] ^ pairs[b][1]).bit_count() <= distance:
            parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(pairs):
        least[root(k)] = min(least.get(root(k), 2**63), doc_id if doc_id is not None else 2**63)
    return [least[root(k)] if least[root(k)] < 2**63 else None for k in range(len(pairs))]


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def test_fingerprints(given, odd_rows):
    texts = [row["text"] for row in given("documents").select("text").collect()] + [row[1] for row in odd_rows]
    texts += ["a b c", "A  b\x0bc d\x0ce", " x y z w v"]
    assert simhash.text_fingerprints(pa.array(texts)).tolist() == [brute_fingerprint(text) for text in texts]


def check(frame):
    rows = [(row["doc_id"], row["text"]) for row in frame.collect()]
    prints = [brute_fingerprint(text) for _, text in rows]
    want = [
        (doc_id, f"{fp:016x}", group)
        for (doc_id, _), fp, group in zip(rows, prints, brute_groups([(r[0], fp) for r, fp in zip(rows, prints)]))
    ]
    key = lambda row: (row[0] is not None, row[0] or 0, row[1])
    assert sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=key) == sorted(want, key=key)


def test_sample(given):
    check(given("documents"))


def test_odd_rows(docs, odd_rows):
    check(docs(*odd_rows))


def test_empty_table(docs):
    assert simhash.near_duplicates(docs((1, "a")).limit(0)).collect() == []
    assert simhash.representatives(docs((1, "a")).limit(0)).collect() == []


@pytest.mark.parametrize("tile", [2048, 70, 5])
def test_links_of_crowded_keys(spark, monkeypatch, tile):
    """Clusters of fingerprints a few bits apart, split into tiles of different size."""
    monkeypatch.setattr(simhash, "TILE", tile)
    draw = random.Random(tile)
    prints = set()
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(60):
            prints.add(centre ^ sum(1 << draw.randrange(64) for _ in range(draw.choice((1, 2, 5)))) % 2**64)
    prints |= {draw.getrandbits(64) for _ in range(300)}
    pairs = [(k, fp) for k, fp in enumerate(sorted(prints))]
    frame = spark.createDataFrame([(signed(fp),) for _, fp in pairs], "fp long")
    roots = {row["node"]: row["root"] for row in components(simhash.links(frame)).collect()}
    found = {}
    for k, fp in pairs:
        found.setdefault(roots.get(signed(fp), signed(fp)), set()).add(k)
    want = {}
    for (k, _), group in zip(pairs, brute_groups(pairs)):
        want.setdefault(group, set()).add(k)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_no_link_is_lost_at_the_limit(spark):
    """Exactly four differing bits, one in each of four parts."""
    prints = [0]
    for parts in itertools.combinations(range(6), 4):
        prints.append(sum(1 << (round(64 * p / 6) + 3) for p in parts))
    frame = spark.createDataFrame([(signed(fp),) for fp in prints], "fp long")
    assert {row["root"] for row in components(simhash.links(frame)).collect()} == {0}


def test_pivots_discard_only_what_is_too_far():
    draw = np.random.default_rng(1)
    fps = draw.integers(0, 2**64, 400, dtype=np.uint64)
    fps[200:] = fps[:200] ^ (np.uint64(1) << draw.integers(0, 64, 200, dtype=np.uint64))
    tables = np.bitwise_count(fps[:, None] ^ simhash._references(simhash.PIVOTS)).astype(np.int16)
    left, right = np.triu_indices(400, 1)
    a, b = simhash._linked(fps, tables, left, right, 4)
    near = np.bitwise_count(fps[left] ^ fps[right]) <= 4
    assert set(zip(a.tolist(), b.tolist())) == set(zip(left[near].tolist(), right[near].tolist()))


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, 2000 + k) for k in range(50)]
    edges += [(5000 + k, 5000 + (k + 1) % 7) for k in range(7)] + [(9, 9), (1, 0), (1, 0)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {found[k] for k in range(61)} == {0} and found[1000] == 1000
    assert {found[2000 + k] for k in range(50)} == {1000} and {found[5000 + k] for k in range(7)} == {5000}


def test_representatives(docs):
    frame = docs((5, "one two three four five"), (3, "One two three four five"), (3, "one two three four five"), (3, "One two three four five"),
                 (8, "something else in these words here"), (8, "and a third text that is far from both"))
    kept = sorted((row["doc_id"], row["text"].lower()) for row in simhash.representatives(frame).collect())
    assert kept == [(3, "one two three four five"), (8, "and a third text that is far from both"), (8, "something else in these words here")]
