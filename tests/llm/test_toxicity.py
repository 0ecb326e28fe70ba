from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlane.llm import toxicity
from ledgerlane.llm.common import held_out

FOLDER = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    documents, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    held = held_out("doc_id", 4, 2)
    rows = toxicity.toxicity(documents, labels, held).join(labels, "doc_id").where(held).collect()
    toxic = [row for row in rows if row["toxic"] == 1]
    clean = [row for row in rows if row["toxic"] == 0]
    assert sum(row["predicted"] for row in toxic) >= 0.85 * len(toxic)
    assert sum(row["predicted"] for row in clean) <= 0.02 * len(clean)


def test_odd_rows(docs, odd_rows, spark):
    frame = docs(*odd_rows, *((100 + k, "you are an idiot and a clown" if k % 2 else "a fine day") for k in range(80)))
    labels = spark.createDataFrame([(100 + k, k % 2, None) for k in range(80)] + [(1, None, 1), (None, 1, 1), (4, 0, 0), (4, 0, 0)],
                                   "doc_id long, toxic int, quality int")
    rows = toxicity.toxicity(frame, labels, F.lit(False)).collect()
    assert len(rows) == frame.count()
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3) for row in rows)
    assert all(row["predicted"] == row["doc_id"] % 2 for row in rows if (row["doc_id"] or 0) >= 100)


def test_without_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs((1, "you idiot"), (2, None)), labels, F.lit(False)).collect()
    assert [(row["score"], row["predicted"]) for row in rows] == [(0.0, 0)] * 2
    assert toxicity.toxicity(docs((1, "a")).limit(0), labels, F.lit(False)).collect() == []


def test_plain_spelling():
    for word in ("IDIOT!", "1d10t", "i.d.i.o.t", "idiooooot", "(id-iot)"):
        assert toxicity.plain_word(word)[0] == "idiot"
    assert toxicity.plain_word("1d10t")[1] and not toxicity.plain_word("Idiot,")[1]
    assert toxicity.plain_word("2024") == ("2024", False)


def test_features():
    found = toxicity.features(pa.array(["YOU are an idiot!! ok?", None, "", "   "]), toxicity._Words({"ok": 2.0}))
    row = dict(zip(toxicity.FEATURES, found[0].tolist(), strict=True))
    assert abs(row["insults"] - 20) < 1e-4 and abs(row["second_person"] - 20) < 1e-4 and row["near_second_person"] > 0
    assert row["learned_most"] == 2.0 and row["exclamations"] > 0 and row["questions"] > 0
    assert not found[1:].any()


def test_isotonic():
    at, steps = toxicity.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(steps) > 0).all() and (np.diff(at) > 0).all() and steps.tolist() == [0.0, 0.5, 1.0]


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    forest = toxicity.fit(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_the_fit_is_bounded(spark, docs):
    frame = docs(*((k, "you idiot" if k % 2 else "fine day") for k in range(60)))
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    forest, _ = toxicity.train(frame, labels, fit_rows=20)
    assert 0 <= forest.score(np.zeros((1, len(toxicity.FEATURES))))[0] <= 1


def test_words_are_learned_from_all_labelled_rows(spark, docs):
    """Not from the fitted sample alone, and more than 300 of them."""
    words = [f"bad{chr(97 + k // 26)}{chr(97 + k % 26)}x" for k in range(400)]
    frame = docs(*((k, " ".join(words) if k % 10 == 0 else "fine day") for k in range(400)))
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(400)], "doc_id long, toxic int")
    assert set(toxicity.train(frame, labels, fit_rows=20)[1]) == set(words)


def test_an_id_with_a_third_of_the_rows(spark, docs):
    """Its repeated rows count once in the trees, and no more rows are collected than the bound says."""
    frame = docs(*([(1, "you idiot")] * 60), *((k, "you idiot" if k % 2 else f"fine day {'so ' * k}") for k in range(2, 60)))
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(900 + k, 1) for k in range(40)], "doc_id long, toxic int")
    forest, learned = toxicity.train(frame, labels, fit_rows=50)
    assert learned and 0 <= forest.score(np.zeros((1, len(toxicity.FEATURES))))[0] <= 1
    rows = toxicity.toxicity(frame, labels, F.lit(False)).collect()
    assert len(rows) == 118 and all(row["predicted"] == row["doc_id"] % 2 for row in rows)


def test_lists_without_a_fold_have_not_seen_its_labels(spark):
    """As if each list were learned alone, by brute force over the other folds' rows."""
    rows = [(f"bad{'abc'[k % 3]} thing", int(k % 4 == 0), k % 3) for k in range(240)]
    rows += [("only here", 1, 1)] * 30 + [("good thing", 0, k % 3) for k in range(90)]
    frame = spark.createDataFrame(rows, "text string, toxic int, fold int")
    lists = toxicity.learned_words(frame)
    assert len(lists) == toxicity.FOLDS + 1
    assert "only" in lists[0] and "only" in lists[1] and "only" in lists[3] and "only" not in lists[2]
    for k in range(toxicity.FOLDS):
        alone = toxicity.learned_words(frame.where(F.col("fold") != k))
        assert lists[k + 1] == alone[0]


def test_fits_with_one_fold_only():
    x, y = np.random.default_rng(1).random((40, 3)), np.arange(40) % 2.0
    assert 0 <= toxicity.fit(x, y, np.zeros(40, np.int64)).score(x).min() <= 1
