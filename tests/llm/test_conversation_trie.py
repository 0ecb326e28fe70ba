from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from ledgerlane.llm import conversation_trie, queries
from tests.conftest import SAMPLE

SCHEMA = "conv_id long, turn long, role string, text string, c1 string, block long, n int"


def expected(rows):
    """The trie by listing every prefix of every conversation."""
    conversations = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            conversations[c].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [turn for *_, turn in sorted(turns)] for c, turns in conversations.items()}
    sequences = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        sequences[c] = own.get(base, [])[:h] + own[c][h:]
    members, children = defaultdict(list), defaultdict(int)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        words = (len(held) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += words
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(held) if len(sequences[c]) == len(node)).encode()).hexdigest(),
        )
        for node, held in members.items()
    )


@pytest.fixture
def found(spark):
    def build(rows):
        frame = spark.createDataFrame([(*row, "x", 3, 1) for row in rows], SCHEMA)
        return sorted((tuple(row) for row in conversation_trie.rebuilt_trie(frame).collect()), key=lambda r: (r[0], r[1]))

    return build


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


def made(seed, conversations, most, texts, odd=False):
    draw, rows = random.Random(seed), []
    for c in range(conversations):
        for turn in range(draw.randint(0, most)):
            rows.append((c, turn * draw.choice([1, 700]) if odd else turn, draw.choice(["u", "a", None]), draw.choice(texts)))
            if odd and draw.random() < 0.2:
                rows.append(rows[-1])
            if odd and draw.random() < 0.05:
                rows.append((c, None, "x", "y z"))
    return rows


def test_given_table(spark, given):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in given("conversations").collect()]
    result = queries.op11_prefix_trie(spark, SAMPLE)
    assert result.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    assert ordered(tuple(r) for r in result.collect()) == ordered(expected(rows))


def test_many_shared_turns(found):
    rows = made(1, 150, 14, ["a", "a", "a b c"])
    assert found(rows) == ordered(expected(rows))


def test_odd_rows(found):
    """Null turns, roles, texts and ids; repeated rows and ties; negative and far ids; turns far apart."""
    rows = made(2, 80, 21, ["a", "b \n c", None, "é " * 40_000], odd=True)
    rows += [(None, 1, "a", "b"), (-5, 1, "u", "a"), (-40, 1, "u", "a"), (-47, 0, "u", "a"), (10**12, 0, "u", "a")]
    assert found(rows) == ordered(expected(rows))


def test_one_conversation_holds_a_third(found, monkeypatch):
    """Its positions and digests are found over many sections; all conversations end at few nodes."""
    monkeypatch.setattr(conversation_trie, "SECTION", 4)
    monkeypatch.setattr(conversation_trie, "TURN_BITS", 3)
    monkeypatch.setattr(conversation_trie, "ID_BITS", 2)
    monkeypatch.setattr(conversation_trie, "HOT_SHARE", 10)
    rows = [(c, turn, "u", "a b") for c, most in ((40, 230), (41, 228), (47, 190)) for turn in range(most)]
    rows += [(c, 0, "u", "hello") for c in range(60, 190)] + [(200, 0, "u", "x"), *((201 + k, 0, "u", f"{k}") for k in range(40))]
    assert found(rows) == ordered(expected(rows))


def test_small_tables(found):
    for rows in ([(1, 0, "u", "x")], [(20, 0, "u", "x")] * 2):
        assert found(rows) == ordered(expected(rows))


def test_an_empty_table(spark):
    assert conversation_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).collect() == []
