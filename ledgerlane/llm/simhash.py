"""Near-duplicate groups from SimHash fingerprints, compared through pivot distance tables.

Equal fingerprints are one class from the start. Different ones can link only if they differ in at
most ``distance`` bits; cut into ``parts`` parts, they then agree in at least ``parts - distance`` of
them, so rows are dealt by the values of every such choice of parts and no link is lost. Rows that
meet are compared by a table of their Hamming distances to fixed reference fingerprints: where two
rows' distances to any reference differ by more than ``distance``, the triangle inequality rules the
pair out. The survivors' own distance decides. Of the links found together only those of a spanning
forest leave the task, and their components are the groups.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import BLANK_BYTES, stored, text_slices, utf8
from ledgerlane.llm.components import components

SHINGLE = 4
DISTANCE = 4
PARTS = 6
PIVOTS = 16
TILE = 2048
_PAIRS = 1 << 20


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    table[list(BLANK_BYTES)] = 0x20
    return table


_FOLD = _fold()


def text_fingerprints(texts: pa.Array, width: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint per row; zero for a text without words."""
    data, rows = utf8(texts)
    data = _FOLD[data]
    out = np.zeros(len(texts), np.uint64)
    blank = data == 0x20
    for row in range(len(texts)):
        first, last = rows[row], rows[row + 1]
        gaps = blank[first:last]
        word = ~gaps
        before, after = np.empty(len(gaps) + 1, bool), np.empty(len(gaps) + 1, bool)
        before[0], before[1:], after[-1], after[:-1] = False, word, False, word
        starts = np.flatnonzero(after[:-1] & ~before[:-1]) if len(gaps) else np.empty(0, int)
        if not len(starts):
            continue
        ends = np.flatnonzero(before[1:] & ~after[1:]) + 1
        raw = data[first:last]
        lengths = ends - starts
        if len(raw) != int(lengths.sum()) + len(starts) - 1:  # runs of blanks, or blanks outside
            keep = word.copy()
            keep[ends[:-1]] = True
            raw = raw[keep]
            ends = np.cumsum(lengths) + np.arange(len(lengths))
            starts = ends - lengths
        joined = raw.tobytes()
        if len(starts) < width:
            spans = [(0, len(joined))]
        else:
            spans = zip(starts[:len(starts) - width + 1].tolist(), ends[width - 1:].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 65_536):
            some = hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[row] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprints(documents: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, mark (a hash of the text), fp (the fingerprint's bits as a signed long).

    A null text has no words.
    """
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            found = text_fingerprints(piece.column("text"), width)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").cast(pa.int64()), piece.column("mark"), pa.array(found.view(np.int64))],
                names=["doc_id", "mark", "fp"],
            )

    return documents.select("doc_id", "text", _mark().alias("mark")).mapInArrow(hashed, "doc_id long, mark long, fp long")


def _mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _references(count: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(2024)).integers(0, 2**64, count, dtype=np.uint64)


def _linked(
    fps: np.ndarray, tables: np.ndarray, left: np.ndarray, right: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs given by row numbers, those that link."""
    for pivot in range(tables.shape[1]):
        near = np.abs(tables[left, pivot] - tables[right, pivot]) <= distance
        left, right = left[near], right[near]
    near = np.bitwise_count(fps[left] ^ fps[right]) <= distance
    return left[near], right[near]


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row number reachable from each row through the pairs.

    Rows are in the order of their fingerprints, so links lead from the smallest one of a group: no
    node has many smaller neighbours, whose minimum ``components`` would gather at it.
    """
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
        open_ = label[left] != label[right]
        if not open_.any():
            break
    return label


def _tile_links(fps: np.ndarray, tables: np.ndarray, group: np.ndarray, other: np.ndarray, distance: int):
    """Links within a group (``other`` empty) or between two, sorted by the first pivot's distance."""
    lefts, rights = [], []
    if len(other):
        order = other[np.argsort(tables[other, 0], kind="stable")]
        keys = tables[order, 0]
        low = np.searchsorted(keys, tables[group, 0] - distance)
        high = np.searchsorted(keys, tables[group, 0] + distance, "right")
    else:
        group = order = group[np.argsort(tables[group, 0], kind="stable")]
        low = np.arange(1, len(group) + 1)
        high = np.maximum(low, np.searchsorted(tables[order, 0], tables[group, 0] + distance, "right"))
    counts = high - low
    at = 0
    while at < len(group):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), _PAIRS, "right")) + at)
        some = counts[at:upto]
        left = np.repeat(group[at:upto], some)
        inner = np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
        right = order[np.repeat(low[at:upto], some) + inner]
        for k, found in enumerate(_linked(fps, tables, left, right, distance)):
            (lefts, rights)[k].append(found)
        at = upto
    return np.concatenate([*lefts, np.empty(0, int)]), np.concatenate([*rights, np.empty(0, int)])


def _keyed(distinct: DataFrame, parts: int, distance: int) -> DataFrame:
    """Each fingerprint once per choice of agreeing parts: (choice, key, fp)."""
    cuts = [round(64 * k / parts) for k in range(parts + 1)]
    masks = []
    for chosen in itertools.combinations(range(parts), parts - distance):
        mask = 0
        for k in chosen:
            mask |= ((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k]
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[
        F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
        for k, mask in enumerate(masks)
    ])
    return distinct.select("fp", F.explode(keys).alias("at")).select("at.choice", "at.key", "fp")


def links(distinct: DataFrame, distance: int = DISTANCE, parts: int = PARTS, pivots: int = PIVOTS) -> DataFrame:
    """A spanning forest of the links between different fingerprints: (src, dst).

    A key that more than ``TILE`` fingerprints share is split into tiles; each pair of tiles is a
    unit of its own, so no task holds more than two tiles of one key.
    """
    if parts <= distance:
        raise ValueError("parts must exceed distance")
    keyed = _keyed(distinct, parts, distance)
    crowded = keyed.groupBy("choice", "key").count().where(F.col("count") > TILE)
    tiles = F.ceil(F.coalesce("count", F.lit(1)) / TILE).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    units = (
        keyed.join(crowded, ["choice", "key"], "left")
        .withColumn("tiles", tiles).withColumn("own", own)
        .select("choice", "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select("choice", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "fp")
    )
    references = _references(pivots)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                held, last = rest, True
            else:
                now = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("choice", "key", "a", "b", "own", "fp")]
                held, last = (now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]), False
            if held is None or not len(held[0]):
                continue
            same = np.ones(len(held[0]), bool)
            same[0] = False
            for column in held[:4]:
                same[1:] &= column[1:] == column[:-1]
            starts = np.flatnonzero(~same)
            whole = len(held[0]) if last else int(starts[-1])
            rest = [column[whole:] for column in held]
            bounds = np.append(starts[starts < whole], whole)
            many = np.flatnonzero(np.diff(bounds) > 1)
            found = _unit_links(held, bounds, many, references, distance)
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["src", "dst"])

    return (
        units.repartition("choice", "key", "a", "b")
        .sortWithinPartitions("choice", "key", "a", "b", "fp")
        .mapInArrow(compare, "src long, dst long")
        .distinct()
    )


def _unit_links(held, bounds, many, references, distance):
    """Links of all units of a batch; small units are compared together."""
    fps = held[5].view(np.uint64)
    out = []
    sizes = np.diff(bounds)[many]
    small = many[sizes <= 64]
    if len(small):
        starts, counts = bounds[small], np.diff(bounds)[small]
        rows = np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        tables = np.bitwise_count(fps[rows][:, None] ^ references).astype(np.int16)
        left_of = np.repeat(np.cumsum(counts), counts) - np.arange(len(rows)) - 1  # rows of the unit behind each
        at = 0
        lefts, rights = [], []
        ends = np.cumsum(left_of)
        while at < len(rows):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
            some = left_of[at:upto]
            left = np.repeat(np.arange(at, upto), some)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
            a, b = _linked(fps[rows], tables, left, right, distance)
            lefts.append(a)
            rights.append(b)
            at = upto
        left, right = np.concatenate(lefts), np.concatenate(rights)
        label = _forest(len(rows), left, right)
        tied = np.flatnonzero(label != np.arange(len(rows)))
        out.append((fps[rows[label[tied]]], fps[rows[tied]]))
    for k in many[sizes > 64].tolist():
        rows = np.arange(bounds[k], bounds[k + 1])
        a, b, own = held[2][rows[0]], held[3][rows[0]], held[4][rows]
        here = fps[rows]
        tables = np.bitwise_count(here[:, None] ^ references).astype(np.int16)
        if a == b:
            left, right = _tile_links(here, tables, np.arange(len(rows)), np.empty(0, int), distance)
        else:
            left, right = _tile_links(here, tables, np.flatnonzero(own == a), np.flatnonzero(own == b), distance)
        label = _forest(len(rows), left, right)
        tied = np.flatnonzero(label != np.arange(len(rows)))
        out.append((here[label[tied]], here[tied]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate([x[k] for x in out]).view(np.int64) for k in (0, 1))


def classes(documents: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint (doc_id, mark, fp), and each fingerprint's group (fp, root)."""
    hashed = stored(fingerprints(documents, width), "fingerprints")
    distinct = hashed.select("fp").distinct()
    linked = components(links(distinct, distance, parts)).withColumnRenamed("node", "fp")
    return hashed, distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null and empty texts have fingerprint zero and link like any other. Rows that share a doc_id
    stay apart rows; a null doc_id never names a component unless no other id is in it.
    """
    hashed, rooted = classes(documents, width, distance, parts)
    least = hashed.groupBy("fp").agg(F.min("doc_id").alias("least")).join(rooted, "fp")
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    group = least.join(named, "root").select("fp", "component_id")
    return hashed.join(group, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(documents: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """One row of each group: that of the smallest doc_id, then of the smallest hash of its text.

    A null doc_id comes first. Of rows equal in both one stays.
    """
    hashed, rooted = classes(documents, width, distance, parts)
    first = F.min(F.struct("doc_id", "mark")).alias("first")
    chosen = (
        hashed.groupBy("fp").agg(first).join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_chosen")).distinct()
    )
    rows = documents.withColumn("__mark__", _mark())
    same = rows["doc_id"].eqNullSafe(chosen["_id"]) & (rows["__mark__"] == chosen["_chosen"])
    return rows.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "__mark__"]).drop("__mark__")
