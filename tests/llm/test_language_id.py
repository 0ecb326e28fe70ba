from __future__ import annotations

import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlane.llm import language_id
from ledgerlane.llm.common import held_out

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_held_out_rows_of_the_sample(given):
    rows = language_id.identified(given("documents"), held_out("doc_id", 4, 2))
    rows = rows.where(held_out("doc_id", 4, 2) & F.col("lang").isNotNull()).collect()
    assert rows and sum(row["lang"] == row["lang_pred"] for row in rows) >= 0.95 * len(rows)
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_odd_rows(docs, odd_rows):
    frame = docs(*odd_rows, (30, "der die und", "de"), (31, "123 ,.", "fr"))
    found = language_id.identified(frame, F.lit(False))
    assert found.columns == [c for c in frame.columns if c != "score"] + ["lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == frame.count()
    for row in rows:
        if not any(c.isalpha() for c in row["text"] or ""):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
        else:
            assert row["lang_pred"] in ("en", "de")
    assert next(r for r in rows if r["doc_id"] == 30)["lang_pred"] == "de"


def test_nothing_learned(docs):
    rows = language_id.identified(docs((1, "abc"), (2, None)), F.lit(True)).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)] * 2
    assert language_id.identified(docs((1, "abc")).limit(0), F.lit(False)).collect() == []


def test_trigrams():
    codes, rows, numbers = language_id.trigrams(pa.array(["Ab  c!", None, "é", "1 2"]))
    said = ["".join(map(chr, codes[k])) for k in numbers]
    assert list(zip(rows.tolist(), said)) == [(0, " ab"), (0, "ab "), (0, " c "), (2, " é ")]


def test_bundles_are_sums_of_bound_vectors():
    vectors = language_id._Vectors()
    found = vectors.documents(pa.array(["abab", "zz", ""]))
    letter = language_id._letter_vector
    bind = lambda s: np.roll(letter(ord(s[0])), 2) * np.roll(letter(ord(s[1])), 1) * letter(ord(s[2]))
    want = sum(bind(s).astype(float) for s in (" ab", "aba", "bab", "ab "))
    assert np.allclose(found[0], want / np.linalg.norm(want), atol=1e-5)
    assert abs(np.linalg.norm(found[1]) - 1) < 1e-5 and not found[2].any()
    assert abs(float(found[0] @ found[1])) < 0.2


def test_prototypes_do_not_depend_on_the_partitions(given):
    one = language_id.prototypes(given("documents").repartition(1))
    many = language_id.prototypes(given("documents").repartition(7))
    assert list(one) == list(many) and all(np.allclose(one[k], many[k], atol=1e-4) for k in one)


def test_groups_of_trigrams_give_the_same_vectors(monkeypatch):
    draw = random.Random(4)
    texts = pa.array(["".join(draw.choice("abcdé 東京都 ") for _ in range(draw.randrange(80))) for _ in range(700)] + [None, ""])
    whole = language_id._Vectors().documents(texts)
    monkeypatch.setattr(language_id, "_CODES", 37)
    monkeypatch.setattr(language_id._Vectors, "MOST", 50)
    assert np.array_equal(language_id._Vectors().documents(texts), whole)


MANY = """
import random, resource
import pyarrow as pa
from ledgerlane.llm import language_id
draw = random.Random(1)
weights = [1 / (k + 1) for k in range(4000)]
text = "".join(chr(0x4E00 + k) for k in draw.choices(range(4000), weights, k=1_400_000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert language_id._Vectors().documents(pa.array([text])).any()
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_memory_with_very_many_different_trigrams():
    """A text of 4 MB with some million different trigrams stays under 1.5 GB."""
    found = subprocess.run([sys.executable, "-c", MANY], capture_output=True, text=True, check=True, cwd=ROOT)
    assert int(found.stdout) < 1500
