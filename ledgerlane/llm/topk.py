"""Exact top-k inner products from an impact-ordered index, processed score at a time.

Vectors are dealt over shards. A shard's index holds one posting segment per dimension and quantised
component value: the rows whose component lies in that step. For a query the segments are processed
in the order of their impact, the size of query component times quantised value, and each adds its
impact to the accumulators of its rows. At any time a row's true score differs from its accumulator
by at most ``slack``: what the unprocessed segments and the quantisation could still contribute. Once
so few rows lie within twice the slack of the k-th accumulator that rescoring them is cheap,
processing stops: every other row is proven to score less than k rows do. Rows within the bound are
rescored with whole numbers.

Scores are exact at every size of the components: sums that may not fit 64 bits are taken with whole
numbers of any width. Empty vectors meet each other with score 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 4096
LEVELS = 96
RESCORED = 128
_TEST_EVERY = 192


class ImpactIndex:
    """Posting segments of one shard, for whole-number vectors."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors = vectors
        n, dims = vectors.shape
        largest = int(np.abs(vectors).max(initial=0))
        self.step = max(1, -(-2 * (largest + 1) // levels))
        self.half = (self.step - 1) / 2
        quantised = vectors // self.step
        dim_of, value_of, starts, rows = [], [], [0], []
        for dim in range(dims):
            order = np.argsort(quantised[:, dim], kind="stable")
            values, first = np.unique(quantised[order, dim], return_index=True)
            rows.append(order)
            dim_of.append(np.full(len(values), dim))
            value_of.append(values)
            starts.extend((dim * n + np.append(first[1:], n)).tolist())
        self.rows = np.concatenate([*rows, np.empty(0, np.int64)])
        self.starts = np.array(starts)
        self.dim = np.concatenate([*dim_of, np.empty(0, np.int64)]).astype(np.int64)
        self.centre = np.concatenate([*value_of, np.empty(0)]) * self.step + self.half

    def search(self, query: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of all allowed rows that may be among the k best."""
        kept = np.flatnonzero(allowed)
        if len(kept) > k:
            impact = query[self.dim] * self.centre
            reach = np.abs(query[self.dim]) * (np.abs(self.centre) + self.half)
            order = np.argsort(-np.abs(impact), kind="stable")
            # the largest reach of a dimension's segments that are still to come
            least = np.abs(query) * self.half
            total = np.zeros(self.vectors.shape[0])
            waiting = _Waiting(self.dim[order], reach[order], len(query))
            # what adding up a row's impacts in doubles may be off by
            inexact = 2.0**-50 * len(query) * float(waiting.after(0).sum())
            for low in range(0, len(order), _TEST_EVERY):
                at = min(low + _TEST_EVERY, len(order))
                rows, added = self._postings(order[low:at], impact)
                total += np.bincount(rows, added, minlength=len(total))
                slack = float(np.maximum(waiting.after(at), least).sum()) * (1 + 1e-9) + 1e-6 + inexact
                some = total[kept]
                bound = np.partition(some, len(some) - k)[len(some) - k] - 2 * slack
                near = kept[some >= bound]
                if len(near) <= RESCORED or at == len(order):
                    kept = near
                    break
        return kept, products(self.vectors[kept], query)

    def _postings(self, segments: np.ndarray, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of some segments one after another, each with its segment's impact."""
        begins = self.starts[segments]
        sizes = self.starts[segments + 1] - begins
        ends = np.cumsum(sizes)
        places = np.arange(sizes.sum()) + np.repeat(begins - ends + sizes, sizes)
        return self.rows[places], np.repeat(impact[segments], sizes)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products; an array of Python's whole numbers where 64 bits may be too few."""
    largest = [int(np.abs(side).max(initial=0)) for side in (vectors, query)]
    if len(query) * largest[0] * largest[1] < 2**63:
        return vectors @ query
    return vectors.astype(object) @ query.astype(object)


class _Waiting:
    """Per dimension, the largest reach among the segments not yet processed."""

    def __init__(self, dim: np.ndarray, reach: np.ndarray, dims: int):
        self._dim, self._reach, self._dims = dim, reach, dims

    def after(self, at: int) -> np.ndarray:
        out = np.zeros(self._dims)
        np.maximum.at(out, self._dim[at:], self._reach[at:])
        return out


def _best(index: ImpactIndex, ids: np.ndarray, query_id: int, query: np.ndarray, k: int):
    rows, scores = index.search(query, k, ids != query_id)
    if scores.dtype == object:
        order = np.array(sorted(range(len(rows)), key=lambda i: (-scores[i], ids[rows[i]]))[:k], np.int64)
    else:
        order = np.lexsort((ids[rows], -scores))[:k]
    return ids[rows[order]], scores[order]


def scaled(vector: Column) -> Column:
    """floor(1024 * x) of every component, x taken as double; fails where that does not fit a long."""
    def whole(x: Column) -> Column:
        wide = x.cast("double") * 1024
        fits = F.abs(wide) < F.lit(2.0**63)
        return F.when(fits, F.floor(wide).cast("long")).otherwise(
            F.raise_error(F.concat(F.lit("component too large: "), x.cast("string"))).cast("long")
        )

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold finite numbers alone."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Per query: query_id, rank, vec_id, score of its k best rows, ties to the smaller vec_id.

    Both tables hold vec_id and ``vector`` (whole numbers). A row of the query's own id is no
    candidate. Rows without a vec_id and vectors that are not usable take no part; vectors of
    different length are not compared. A query row that is repeated counts once; a repeated
    candidate row is a candidate each time. An empty table gives no row; further columns are not read.
    One of the k best scores that does not fit a long fails the search.
    """
    count, wanted = vectors.count(), queries.count()
    shards, blocks = -(-count // SHARD_ROWS) or 1, -(-wanted // QUERY_ROWS) or 1
    given = (
        vectors.where("vec_id is not null").select("vec_id", "vector", F.size("vector").alias("dims"))
        .withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    asked = (
        queries.where("vec_id is not null").select("vec_id", "vector", F.size("vector").alias("dims")).distinct()
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )

    def compare(key: tuple, candidates: pa.Table, wanted: pa.Table) -> pa.Table:
        found = {"query_id": [], "form": [], "vec_id": [], "score": []}
        if candidates.num_rows and wanted.num_rows:
            dims = key[0].as_py()
            ids = candidates.column("vec_id").to_numpy()
            index = ImpactIndex(_matrix(candidates, dims))
            for number, query in zip(wanted.column("vec_id").to_pylist(), _matrix(wanted, dims), strict=True):
                best, scores = _best(index, ids, number, query, k)
                found["query_id"] += [number] * len(best)
                found["form"] += [zlib.crc32(query.tobytes())] * len(best)
                found["vec_id"] += best.tolist()
                found["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in found.items()})

    keys = ["dims", "shard", "block"]
    partial = given.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        compare, "query_id long, form long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "form").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


def _matrix(rows: pa.Table, dims: int) -> np.ndarray:
    values = rows.column("vector").combine_chunks()
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows.num_rows, dims)


def scaled_search(embeddings: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Search with the scaled rows whose vec_id ``every`` divides, against all rows."""
    vectors = embeddings.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("vector")
    )
    return search(vectors, vectors.where(F.col("vec_id") % every == 0), k)
