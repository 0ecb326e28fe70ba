from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from ledgerlane.llm import topk
from ledgerlane.llm.queries import ORACLE_SQL, QUERIES
from ledgerlane.llm.topk import ImpactIndex
from tests.conftest import SAMPLE


def brute(rows, every=100, k=10):
    kept = [
        (vec_id, [math.floor(1024 * float(x)) for x in vector]) for vec_id, vector in rows
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for query_id, query in {(a, tuple(b)) for a, b in kept if a % every == 0}:
        scores = [(-sum(x * y for x, y in zip(query, v)), i) for i, v in kept if i != query_id and len(v) == len(query)]
        out += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(frame, **more):
    return sorted(map(tuple, topk.scaled_search(frame, **more).collect()))


def test_sample(given):
    frame = given("embeddings")
    assert found(frame, every=10) == brute([(r["vec_id"], r["embedding"]) for r in frame.collect()], 10)


def test_small_shards_and_blocks(given, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    frame = given("embeddings").limit(300)
    assert found(frame, every=10) == brute([(r["vec_id"], r["embedding"]) for r in frame.collect()], 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (2, [0.5, -0.25]), (3, None), (4, [nan, 1.0]),
            (5, [None, 1.0]), (6, [inf, 0.0]), (None, [1.0, 1.0]), (200, [0.0, 0.0]), (7, [1.0, 2.0, 3.0]), (300, [1.0, 0.5, 0.0]),
            (400, [nan, 0.0]), (100, [0.5, -0.25]), (8, [-1e-9, 0.0]), (500, []), (9, []), (600, []), (10, [])]
    frame = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "vec_id long, embedding array<float>, score int, shard string")
    assert found(frame) == brute(rows)


def test_large_components_do_not_wrap(spark):
    """Products beyond 64 bits that cancel, and rows whose doubles are alike."""
    rows = [(100, [2.0**30, 2.0**30, 1.0]), (1, [2.0**30, -(2.0**30), 1.0]), (2, [2.0**30, -(2.0**30), 2.0]),
            (3, [-(2.0**40), 2.0**40, 2.0]), (4, [-(2.0**40), 2.0**30, 3.0]), (5, [-(2.0**30), -(2.0**30), 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(frame, k=3) == brute(rows, k=3)
    with pytest.raises(Exception, match="too large"):
        found(spark.createDataFrame([(100, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>"))


def test_expected_sql(spark, given):
    """The registered query against its SQL on the sample, and the SQL against brute force."""
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SAMPLE}/embeddings.parquet')")
    expected = connection.execute(ORACLE_SQL["op7_top_k"])
    names = [column[0] for column in expected.description]
    result = QUERIES["op7_top_k"](spark, SAMPLE)
    assert dict(result.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    rows = sorted(tuple(row[name] for name in names) for row in result.collect())
    assert rows == sorted(expected.fetchall())
    assert rows == brute([(r["vec_id"], r["embedding"]) for r in given("embeddings").collect()])


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "vec_id long, embedding array<float>")) == []


@pytest.mark.parametrize("kind", ["usual", "equal", "sparse", "huge", "one"])
def test_search_is_exact(kind):
    draw = np.random.default_rng(4)
    vectors = (draw.standard_normal((3000, 16)) * 100).astype(np.int64)
    if kind == "equal":
        vectors[:] = vectors[0]
    if kind == "sparse":
        vectors[draw.random(vectors.shape) < 0.9] = 0
    if kind == "huge":
        vectors[::7] *= 10_000
    if kind == "one":
        vectors = vectors[:1]
    index, allowed = ImpactIndex(vectors), np.ones(len(vectors), bool)
    for query in vectors[:5]:
        rows, scores = index.search(query, 10, allowed)
        best = np.sort(vectors @ query)[::-1][:10]
        assert np.sort(scores)[::-1][:10].tolist() == best.tolist()
        # every row that ties with the last one is there
        assert set(np.flatnonzero(vectors @ query >= best[-1])) <= set(rows.tolist())


def test_stops_before_all_rows_are_rescored():
    draw = np.random.default_rng(5)
    vectors = (draw.standard_normal((8000, 32)) * 128).astype(np.int64)
    rows, _ = ImpactIndex(vectors).search(vectors[0], 10, np.ones(8000, bool))
    assert len(rows) <= topk.RESCORED


def test_postings_of_a_batch_are_added_up_at_once():
    draw = np.random.default_rng(6)
    index = ImpactIndex((draw.standard_normal((500, 8)) * 128).astype(np.int64))
    segments = draw.permutation(len(index.dim))[:50]
    impact = draw.standard_normal(len(index.dim))
    rows, added = index._postings(segments, impact)
    expected = np.zeros(500)
    for segment in segments:
        expected[index.rows[index.starts[segment]:index.starts[segment + 1]]] += impact[segment]
    assert np.allclose(np.bincount(rows, added, minlength=500), expected)
    assert [len(part) for part in index._postings(segments[:0], impact)] == [0, 0]
