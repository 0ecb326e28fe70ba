from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlane.llm import quality_kernel as quality
from ledgerlane.llm.common import held_out

FOLDER = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    documents, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    held = held_out("doc_id", 5, 0)
    rows = quality.quality(documents, labels, held).join(labels, "doc_id").where(held).collect()
    good = [row["predicted"] for row in rows if row["quality"] == 1]
    poor = [row["predicted"] for row in rows if row["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(poor) <= 0.08 * len(poor)


def test_odd_rows(docs, odd_rows, spark):
    poor = "word word word word $$$ ||| !!"
    frame = docs(*odd_rows, *((100 + k, poor if k % 2 else f"A fine day, number {k}.") for k in range(120)))
    labels = spark.createDataFrame(
        [(100 + k, 1 - k % 2, None) for k in range(100)] + [(1, None, 1), (None, 1, 1), (4, 1, 0), (4, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.quality(frame, labels, F.lit(False)).collect()
    assert len(rows) == frame.count()
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3) for row in rows)
    assert all(row["predicted"] == 1 - row["doc_id"] % 2 for row in rows if (row["doc_id"] or 0) >= 100)


def test_a_third_of_the_rows_with_one_id(docs, spark):
    """They are learned as often as they come, and dealt to several tasks where texts differ."""
    rows = [(1, " ".join(f"good text {j}." for j in range(k % 7 + 1))) for k in range(60)] + [(2 + k, "bad bad bad $$$ " * (k % 7 + 1)) for k in range(60)]
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(62)], "doc_id long, quality int")
    measured = quality.measured(docs(*rows))
    known = quality.labelled_rows(measured, labels, "quality", 3)
    assert {(r["y"], r["s"]) for r in known.groupBy("y").agg(F.sum("n").alias("s")).collect()} == {(1, 60), (0, 60)}
    assert all(row["predicted"] == int(row["doc_id"] == 1) for row in quality.quality(docs(*rows), labels, F.lit(False)).collect())


def test_without_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.quality(docs((1, "some text"), (2, None)), labels, F.lit(False)).collect()
    assert [(row["score"], row["predicted"]) for row in rows] == [(0.0, 0)] * 2
    assert quality.quality(docs((1, "a")).limit(0), labels, F.lit(False)).collect() == []
    ones = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [row["score"] for row in quality.quality(docs((1, "a")), ones, F.lit(False)).collect()] == [1.0]


def test_sums_by_partition_equal_sums_at_once(spark):
    draw = np.random.default_rng(0)
    k = len(quality.STATISTICS)
    x, y = draw.random((300, k)), draw.integers(0, 2, 300)
    n, fold = draw.integers(1, 4, 300), draw.integers(0, 3, 300)
    rows = spark.createDataFrame(
        [(x[i].tolist(), int(y[i]), int(n[i]), int(fold[i])) for i in range(300)], "x array<float>, y int, n long, fold int"
    )
    x = x.astype(np.float32).astype(float)
    kernel = quality.Kernel.of(x.mean(0), x.std(0), 16, 1)
    z = kernel.features(x)
    for least in (5_000, 7):  # one part; a tree of two levels
        quality.LEAST_PART_ROWS, quality.FAN_IN = least, 3
        found = quality._equations(rows, 300, kernel, 3)
        for f in range(3):
            w = (z * (n * (fold == f))[:, None]).T @ np.concatenate([z, y[:, None]], axis=1)
            assert np.allclose(found[f], w)
    quality.LEAST_PART_ROWS, quality.FAN_IN = 5_000, 16


def test_kernel_is_approximated():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((40, 5)) * 0.5
    kernel = quality.Kernel.of(np.zeros(5), np.ones(5), 20_000, 1)
    z = kernel.features(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * quality.WIDTH**2 * 5))).max() < 0.05


def test_isotonic():
    n, ones = np.zeros(quality.BINS), np.zeros(quality.BINS)
    for at, value in ((1000, 0), (2000, 1), (2500, 0), (3000, 1)):
        n[at], ones[at] = 2, 2 * value
    at, steps = quality.isotonic(n, ones)
    assert steps.tolist() == [0.0, 0.5, 1.0] and (np.diff(at) > 0).all()


def test_statistics():
    texts = ["One two two TWO!\nOne two two TWO!\n\nlast | $$ é", None, "", " \n\t ", "a" * 5000]
    found = quality.statistics(pa.array(texts))
    row = dict(zip(quality.STATISTICS, found[0].tolist(), strict=True))
    words = texts[0].split()
    near = {
        "words": np.log1p(len(words)), "distinct_words": len(set(words)) / len(words), "commonest_word": 4 / len(words),
        "repeated_next": 2 / len(words), "lines": np.log1p(3), "repeated_lines": 1 / 3, "bars": 1 / len(words),
        "word_length": sum(map(len, words)) / len(words), "capital_words": 2 / len(words), "bangs": 2 / len(words),
    }
    assert all(abs(row[name] - value) < 1e-5 for name, value in near.items())
    assert not found[1:4].any() and found[4].any()
    alone = np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(alone, found)
