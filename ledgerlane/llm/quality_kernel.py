"""Document quality: ridge scores on random Fourier features of document statistics, calibrated.

Every text is measured once and its statistics stored. Random cosines of the standardised statistics
approximate a Gaussian kernel; each partition sums its part of the normal equations, apart for each
fold, so that the weights without a fold come from subtracting its sums. Predictions of rows a fold
did not see calibrate the score by isotonic regression over a histogram. Labelled rows are neither
capped nor sampled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import pieces, stored, text_slices, utf8

THRESHOLD = 0.3
COSINES = 256
FOLDS = 3
RIDGE = 1.0
#: Width of the kernel over the square root of the number of statistics.
WIDTH = 0.7
BINS = 4096

#: Labelled rows whose normal equations one task sums, and sums that one task adds up.
PART_ROWS = 1_000_000
LEAST_PART_ROWS = 5_000
FAN_IN = 16

#: Copies of the labels of an id, so that a repeated id is dealt to as many tasks.
SALTS = 8

STATISTICS = (
    "words", "bytes", "word_length", "word_length_spread", "long_words", "short_words", "capital_words", "capitals",
    "first_capitals", "digits", "stops", "bangs", "bars", "signs", "sign_ends", "beyond_ascii", "controls", "lines",
    "words_a_line", "repeated_lines", "repeated_next", "distinct_words", "commonest_word", "byte_entropy",
    "plain_ends",
)

_BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_KIND = np.zeros(256, np.uint8)
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A] = 1, 2, 3
_KIND[list(b".,;:?'\"()-")] = 4
_KIND[list(b"!")], _KIND[list(b"|")] = 5, 6
_KIND[list(b"#$%&*+/<=>@[\\]^_`{}~")] = 7
_KIND[list(_BLANKS)] = 8
_KIND[[b for b in range(32) if b not in _BLANKS] + [127]] = 9
_KIND[0x80:] = 10


def _hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit number of each stretch of bytes, equal for equal ones: wrapping sums of mixed
    positions and bytes, which differences of running sums give."""
    size = stop - start
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    taken = data[np.repeat(start, size) + at]
    mixed = (taken.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= (at.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    end = np.cumsum(size)
    return sums[end] - sums[end - size]


def _per_row(rows: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many keys are distinct, and how often the commonest one comes."""
    distinct, most = np.zeros(n), np.zeros(n)
    if len(keys):
        order = np.lexsort((keys, rows))
        r, k = rows[order], keys[order]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(r)))
        distinct = np.bincount(r[first], minlength=n).astype(float)
        np.maximum.at(most, r[first], times)
    return distinct, most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text, as float32; zeros for a null, empty or blank one."""
    data, rows = utf8(texts)
    n = len(texts)
    out = np.zeros((n, len(STATISTICS)), np.float32)
    kind = _KIND[data]
    letter = kind != 8
    if not letter.any():
        return out
    row_of = np.repeat(np.arange(n), np.diff(rows))
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    before = np.concatenate([[False], letter[:-1]]) & ~edge[:-1]
    after = np.concatenate([letter[1:], [False]]) & ~edge[1:]
    start, stop = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
    row = row_of[start]
    words = np.bincount(row, minlength=n)
    per, size = np.maximum(words, 1), np.maximum(np.bincount(row_of, letter, n), 1)
    lead = data[start]

    def of_bytes(*kinds: int) -> np.ndarray:
        return np.bincount(row_of, np.isin(kind, kinds), n)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row, mask, n)

    def inside(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[stop] - sums[start]

    # characters: bytes that do not continue one
    length = inside((data & 0xC0) != 0x80)
    mean = of_words(length) / per
    spread = np.sqrt(np.maximum(of_words(length.astype(float) ** 2) / per - mean**2, 0))
    small, big = inside(kind == 2), inside(kind == 1)
    same = _hashes(data, start, stop)
    distinct, commonest = _per_row(row, same, n)
    follows = np.concatenate([[False], (same[1:] == same[:-1]) & (row[1:] == row[:-1])])
    # lines: stretches between line ends that hold a word; their words' numbers make them alike
    line = np.cumsum(data == 0x0A)[start]
    opens = np.concatenate([[True], (line[1:] != line[:-1]) | (row[1:] != row[:-1])])
    at = np.flatnonzero(opens)
    line_row = row[at]
    lines = np.bincount(line_row, minlength=n)
    kinds_of_line, _ = _per_row(line_row, _hashes(data, start[at], stop[np.append(at[1:], len(row)) - 1]), n)
    counts = np.bincount(row_of * 256 + data, minlength=n * 256).reshape(n, 256)
    share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    entropy = -(share * np.log(np.where(share > 0, share, 1))).sum(1)
    ends = kind[stop - 1]
    columns = (
        np.log1p(words), np.log1p(size), mean, spread, of_words(length > 12) / per, of_words(length < 3) / per,
        of_words((big > 1) & (small == 0)) / per, of_bytes(1) / size, of_words((lead >= 0x41) & (lead <= 0x5A)) / per,
        of_bytes(3) / size, of_bytes(4) / size, of_bytes(5) / per, of_bytes(6) / per, of_bytes(7) / size,
        of_words(ends == 7) / per, of_bytes(10) / size, of_bytes(9) / size, np.log1p(lines), words / np.maximum(lines, 1),
        1 - kinds_of_line / np.maximum(lines, 1), of_words(follows) / per, distinct / per, commonest / per, entropy,
        of_words(np.isin(ends, (1, 2, 10))) / per,
    )
    for k, values in enumerate(columns):
        out[:, k] = values
    out[words == 0] = 0
    return out


def measured(documents: DataFrame) -> DataFrame:
    """Per row: doc_id and its statistics x; the one pass over the texts."""
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").cast(pa.int64()), _lists(statistics(piece.column("text")))], names=["doc_id", "x"]
            )

    return documents.select("doc_id", "text").mapInArrow(measure, "doc_id long, x array<float>")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.from_numpy_dtype(x.dtype)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


@dataclass(frozen=True)
class Kernel:
    """Standardising and the random cosines, of fixed size."""

    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phases: np.ndarray

    @classmethod
    def of(cls, mean: np.ndarray, spread: np.ndarray, cosines: int, seed: int) -> Kernel:
        draw = np.random.default_rng(seed)
        waves = draw.standard_normal((len(mean), cosines)) / (WIDTH * np.sqrt(len(mean)))
        return cls(mean, np.where(spread > 1e-9, spread, 1.0), waves, draw.uniform(0, 2 * np.pi, cosines))

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosines, and a constant; far values are drawn in to six deviations."""
        scaled = np.clip((x - self.mean) / self.spread, -6, 6)
        waves = np.cos(scaled @ self.waves + self.phases) * np.sqrt(2 / self.waves.shape[1])
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)


@dataclass(frozen=True)
class Quality:
    """A fitted model; a constant one has no kernel."""

    kernel: Kernel | None
    weights: np.ndarray
    at: np.ndarray
    steps: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(x), self.steps[0])
        return np.clip(np.interp(self.kernel.features(x) @ self.weights, self.at, self.steps), 0, 1)


def labelled_rows(rows: DataFrame, labels: DataFrame, label: str, folds: int) -> DataFrame:
    """Distinct (doc_id, x) of labelled documents with y, the times they come (n), and their fold.

    Rows of one id with equal statistics share a fold. Repeated rows are counted before they are
    shuffled. A label that comes several times counts by its
    greatest value. Labels are dealt out ``SALTS`` times, so the rows of one id meet in as many tasks.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("y")
    )
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    folded = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "x").agg(F.count("*").alias("n"))
    dealt = folded.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int"))
    # one kind of join at every size
    joined = dealt.join(salted.hint("shuffle_hash"), ["doc_id", "salt"])
    return joined.select("x", "y", "n", F.pmod(F.xxhash64("doc_id", "x"), F.lit(folds)).cast("int").alias("fold"))


def _spread_of(rows: DataFrame) -> tuple[int, float, np.ndarray, np.ndarray]:
    """Rows, sum of labels, and mean and deviation of each statistic."""
    k = len(STATISTICS)
    n = F.col("n").cast("double")
    sums = [F.sum("n").alias("rows"), F.sum(n * F.col("y")).alias("ones")]
    for i in range(k):
        value = F.col("x")[i].cast("double")
        sums += [F.sum(n * value).alias(f"s{i}"), F.sum(n * value * value).alias(f"q{i}")]
    row = rows.agg(*sums).first()
    count = row["rows"] or 0
    if not count:
        return 0, 0.0, np.zeros(k), np.ones(k)
    mean = np.array([row[f"s{i}"] for i in range(k)]) / count
    square = np.array([row[f"q{i}"] for i in range(k)]) / count
    return count, row["ones"], mean, np.sqrt(np.maximum(square - mean**2, 0))


def _summed(kernel: Kernel, folds: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's part of the normal equations, apart for each fold: the matrix, then the right side."""
    size = kernel.waves.shape[1] + 1
    total = np.zeros((folds, size, size + 1))
    for batch in batches:
        z = kernel.features(_matrix(batch.column("x")))
        n = batch.column("n").to_numpy().astype(np.float64)
        y, fold = batch.column("y").to_numpy().astype(np.float64), batch.column("fold").to_numpy()
        for k in range(folds):
            inside = fold == k
            weighted = z[inside] * n[inside, None]
            total[k] += weighted.T @ np.concatenate([z[inside], y[inside, None]], axis=1)
    yield _part(TaskContext.get().partitionId(), total)


def _part(number: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"]
    )


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the parts of each group, which come one after another, in the order of their numbers."""
    group, total = None, None
    for batch in batches:
        for part, value in zip(batch.column("part").to_pylist(), batch.column("sums"), strict=True):
            sums = np.frombuffer(value.as_buffer(), np.float64)
            if part // FAN_IN == group:
                total += sums
                continue
            if group is not None:
                yield _part(group, total)
            group, total = part // FAN_IN, sums.copy()
    if group is not None:
        yield _part(group, total)


def _equations(rows: DataFrame, count: int, kernel: Kernel, folds: int) -> np.ndarray:
    """The normal equations of each fold, summed by partition and then as a tree, in a fixed order."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(pieces(count, PART_ROWS), min(cores, pieces(count, LEAST_PART_ROWS)))
    kind = "part long, sums binary"
    sums = rows.repartition(parts).mapInArrow(partial(_summed, kernel, folds), kind)
    while parts > 1:
        parts = pieces(parts, FAN_IN)
        group = F.expr(f"part div {FAN_IN}")
        sums = sums.repartition(parts, group).sortWithinPartitions("part").mapInArrow(_added, kind)
    size = kernel.waves.shape[1] + 1
    return np.frombuffer(sums.first()["sums"], np.float64).reshape(folds, size, size + 1)


def _solved(sums: np.ndarray, ridge: float) -> np.ndarray:
    size = len(sums)
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-9  # the constant is free
    return np.linalg.solve(sums[:, :size] + np.diag(penalty), sums[:, size])


def _histogram(rows: DataFrame, kernel: Kernel, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and labels 1 by bin of the prediction of rows left out."""
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS))
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            z = kernel.features(_matrix(batch.column("x")))
            raw = np.einsum("ij,ij->i", z, weights[fold])
            at = _bin(raw)
            n = batch.column("n").to_numpy().astype(np.float64)
            total[0] += np.bincount(at, n, BINS)
            total[1] += np.bincount(at, n * batch.column("y").to_numpy(), BINS)
        hit = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(hit), *(pa.array(t[hit]) for t in total)], names=["bin", "n", "ones"])

    summed = rows.mapInArrow(place, "bin long, n double, ones double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    out = np.zeros((2, BINS))
    for row in summed.collect():  # at most one row per bin
        out[:, row["bin"]] = row["n"], row["ones"]
    return out[0], out[1]


def _bin(raw: np.ndarray) -> np.ndarray:
    """Predictions mostly lie between 0 and 1; bins reach from -1 to 2."""
    return np.clip(((raw + 1) / 3 * BINS).astype(np.int64), 0, BINS - 1)


def isotonic(n: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins: centres and means of the blocks, both ascending."""
    blocks: list[list[float]] = []  # rows, ones, rows times place
    for k in np.flatnonzero(n).tolist():
        blocks.append([n[k], ones[k], n[k] * ((k + 0.5) / BINS * 3 - 1)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    table = np.array(blocks)
    return table[:, 2] / table[:, 0], table[:, 1] / table[:, 0]


def fitted(rows: DataFrame, *, cosines: int = COSINES, folds: int = FOLDS, ridge: float = RIDGE, seed: int = 1) -> Quality:
    """Fit on all rows of (x, y, n, fold). With no rows every score is 0; with labels of one kind it is
    that label."""
    count, ones, mean, spread = _spread_of(rows)
    if not count or ones in (0, count):
        return Quality(None, np.zeros(0), np.zeros(1), np.array([ones / count if count else 0.0]))
    kernel = Kernel.of(mean, spread, cosines, seed)
    sums = _equations(rows, count, kernel, folds)
    total = sums.sum(0)
    apart = np.stack([_solved(total - sums[k], ridge) for k in range(folds)])
    at, steps = isotonic(*_histogram(rows, kernel, apart))
    return Quality(kernel, _solved(total, ridge), at, steps)


def scored(rows: DataFrame, model: Quality, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of (doc_id, x): doc_id, score, predicted (1 if score >= threshold)."""
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found), pc.cast(pa.array(found >= threshold), pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    return rows.mapInArrow(score, "doc_id long, score double, predicted int")


def quality(
    documents: DataFrame, labels: DataFrame, held: Column, *, label: str = "quality", threshold: float = THRESHOLD
) -> DataFrame:
    """Learn from labelled rows that are not held out; score every row: doc_id, score, predicted.

    ``held`` is an expression over doc_id. Null, empty and blank texts have statistics of zero and are
    scored like any other; texts of any length are measured whole. Repeated rows are learned as often
    as they come and scored one by one; rows without doc_id are scored, not learned. An empty table
    gives no rows. Columns other than doc_id, text and the label are not read.
    """
    rows = stored(measured(documents), "quality-statistics")
    known = stored(labelled_rows(rows.where(~held), labels.where(~held), label, FOLDS), "quality-labelled")
    return scored(rows, fitted(known), threshold)
