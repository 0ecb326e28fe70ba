from __future__ import annotations

import random

import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from ledgerlane.llm import decontamination
from ledgerlane.llm.decontamination import Items, clean, contaminated, myers, squashed


def distances(pattern, text, anchored=False):
    """Least edit distance of the pattern to a part of the text that ends at each place."""
    row = list(range(len(pattern) + 1))
    out = [row[-1]]
    for k, char in enumerate(text, 1):
        new = [k if anchored else 0]
        for j, other in enumerate(pattern, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (char != other)))
        row = new
        out.append(row[-1])
    return out


@drawn(st.text("ab", min_size=1, max_size=12), st.text("abc", max_size=30), st.booleans())
@settings(max_examples=300, deadline=None)
def test_myers(pattern, text, anchored):
    want = distances(pattern, text, anchored)
    assert myers(pattern, text, anchored) == (min(want), want.index(min(want)))


def changed(text, edits, draw):
    text = list(text)
    for _ in range(edits):
        at = draw.randrange(len(text))
        text[at:at + 1] = draw.choice(([], [draw.choice("xyzq")], [text[at], draw.choice("xyzq")]))
    return "".join(text)


def test_all_edited_passages_are_found(given):
    draw = random.Random(8)
    items = [(row["item_id"], row["text"]) for row in given("benchmark").collect()]
    search = Items(items)
    filler = " ".join(row["text"] for row in given("documents").limit(4).collect() if row["text"])[:3000]
    for item_id, text in items:
        plain = squashed(text)[0]
        budget = len(plain) // decontamination.PER_EDIT
        for edits in (0, 1, budget):
            passage = changed(plain, edits, draw)
            found = search.matches(f"{filler}. {passage} {filler}")
            want = min(distances(plain, squashed(passage)[0]))
            assert [x[1] <= want for x in found if x[0] == item_id] == [True]


def test_same_as_all_distances():
    """Every match of brute force, and no other, on small texts."""
    draw = random.Random(2)
    items = [(k, "".join(draw.choice("abcd") for _ in range(40))) for k in range(4)] + [(9, "ab"), (10, ""), (11, None)]  # a short item needs word boundaries, of which these texts have none
    search = Items(items)
    for _ in range(60):
        base = "".join(draw.choice("abcd") for _ in range(50))
        text = base + changed(draw.choice(items[:4])[1], draw.randrange(6), draw) + base[::-1]
        want = {i for i, t in items if t and len(t) > 2 and min(distances(t, text)) <= len(t) // decontamination.PER_EDIT}
        found = search.matches(text)
        assert {x[0] for x in found} == want
        for item, edits, start, end in found:
            assert distances(dict(items)[item], text[start:end], anchored=True)[-1] == edits


def test_places_in_the_text(spark, docs):
    items = spark.createDataFrame([(7, "Which river is the longest, in all?", 1)], "item_id long, text string, lang int")
    text = "é!  Q: which RIVER is – the longest in all? Yes"
    rows = contaminated(docs((1, text), (1, text), (2, "a river"), (3, None), (4, "")), items).collect()
    assert [tuple(row) for row in rows] == [(1, 7, 0, 7, 42)] * 2
    assert text[7:42] == "which RIVER is – the longest in all"


def test_clean(spark, docs, odd_rows):
    items = spark.createDataFrame([(1, "the heed thon of and one more"), (2, None), (3, "")], "item_id long, text string")
    frame = docs(*odd_rows, (20, "THE heed, thon of and one more!"), (None, "the heed thon of and one more"))
    kept = clean(frame, items)
    assert kept.columns == frame.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs(*odd_rows).collect()))
    assert clean(frame, items.limit(0)).count() == frame.count()
    assert clean(frame.limit(0), items).count() == 0


@pytest.mark.parametrize("size", [50, 4 << 20])
def test_blocks_of_items(given, monkeypatch, size):
    monkeypatch.setattr(decontamination, "ITEM_CHARS", 2000 if size == 50 else size)
    rows = contaminated(given("documents"), given("benchmark")).collect()
    texts = {r["item_id"]: squashed(r["text"])[0] for r in given("benchmark").collect()}
    want = set()
    for doc in given("documents").collect():
        plain = squashed(doc["text"] or "")[0]
        want |= {(doc["doc_id"], item) for item, text in texts.items() if text in plain}
    assert want <= {(r["doc_id"], r["item_id"]) for r in rows}
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["edits"] == 0} == want


def test_every_occurrence_is_found():
    item = "ab" * 60
    search = Items([(1, item)])
    found = search.matches(f"{item} qq {item}")
    assert [x[1:] for x in found] == [(0, 0, 120), (0, 124, 244)]
    assert len(search.matches("ab" * 600)) == 10


def test_no_occurrence_beside_the_matches_is_left_out():
    """Matches do not overlap, are within the budget, and no further occurrence fits between them."""
    draw = random.Random(11)
    several = 0
    for _ in range(150):
        item = "".join(draw.choice("ab" if draw.random() < 0.5 else "abcd") for _ in range(draw.randrange(16, 50)))
        budget = len(item) // decontamination.PER_EDIT
        text = "".join(
            changed(item, draw.randrange(budget + 2), draw) if draw.random() < 0.6 else "".join(draw.choice("abcd") for _ in range(20))
            for _ in range(draw.randrange(1, 6))
        )
        found = sorted(Items([(1, item)]).matches(text), key=lambda x: x[2])
        several += len(found) > 1
        ends = [0, *(x[3] for x in found)]
        begins = [*(x[2] for x in found), len(text)]
        for _, edits, start, end in found:
            assert edits <= budget and distances(item, text[start:end], anchored=True)[-1] == edits
        for low, high in zip(ends, begins, strict=True):
            assert low <= high and min(distances(item, text[low:high])) > budget
    assert several > 30


def test_short_items_are_whole_words():
    search = Items([(1, "Yes."), (2, "a b"), (3, "東京")])
    assert search.matches("my eyes, yesterday, oyes") == []
    assert [x[0] for x in search.matches("Oh yes! (a) b; 私は東京にいる")] == [1, 2, 3]
    assert [x[2:] for x in search.matches("yes yes")] == [(0, 3), (4, 7)]


def test_short_items_remove_no_document(spark, docs):
    items = spark.createDataFrame([(1, "Yes."), (2, "a")], "item_id long, text string")
    frame = docs((1, "yes, a text"), (2, "no"))
    assert clean(frame, items).count() == 2
    assert {row["item_id"] for row in contaminated(frame, items).collect()} == {1, 2}


def test_repeated_items_count_once(spark, docs):
    items = spark.createDataFrame([(1, "one and the same item")] * 50 + [(2, "one and the same item")], "item_id long, text string")
    rows = contaminated(docs((1, "here one and the same item is")), items).collect()
    assert sorted(tuple(row)[:3] for row in rows) == [(1, 1, 0), (1, 2, 0)]
