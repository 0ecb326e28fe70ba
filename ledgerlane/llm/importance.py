"""Importance resampling: draw documents by how much their word runs look like a target's.

A text becomes its words joined by one blank and is scanned once. The scan stores the running CRC-32
before and after every word, and the CRC of any run of words follows from two of them: that of the
text up to the run's end, and that of the text before it, which is shifted over the run's length and
cancelled. Buckets are counted over all documents, a bucket's gain compares them with the target's,
and keyed noise turns the highest scores into a draw without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import pieces, stored, text_slices, utf8

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
SEED = 42

#: A text is scanned in parts of about so many bytes; the words a run may begin with go on to the next.
PART_BYTES = 4 << 20

#: Rows of the ranking that one task sorts, about.
RANKED_ROWS = 1_000_000

_BLANK = 0x20
# capitals become small; signs and controls blanks; digits, letters and bytes beyond ASCII stay
_NORMAL = np.array([
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else _BLANK
    for b in range(256)
], np.uint8)


def _byte_table() -> np.ndarray:
    """The CRC register after each single byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_ONE = _byte_table()


def _through(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map, given by its values on each of the four bytes, of 32-bit values."""
    return (
        table[0][values & 255] ^ table[1][(values >> 8) & 255] ^ table[2][(values >> 16) & 255] ^ table[3][values >> 24]
    )


def _zero_byte(values: np.ndarray) -> np.ndarray:
    return _ONE[values & 255] ^ (values >> 8)


_SHORT = 64


def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps for 0 to 63 zero bytes, and for 64, 128, 256, ... of them."""
    none = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    few = [none]
    for _ in range(_SHORT - 1):
        few.append(_zero_byte(few[-1]))
    doubled = [_zero_byte(few[-1])]
    while len(doubled) < 26:
        doubled.append(_through(doubled[-1], doubled[-1]))
    return np.stack(few), doubled


_FEW, _DOUBLED = _shift_tables()


def shifted(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Carry each CRC over so many bytes of zero, which is a linear map over GF(2)."""
    at = (lengths & (_SHORT - 1)).astype(np.intp) << 10
    table = _FEW.reshape(-1)
    out = table.take(at + (values & 255))
    for k in (1, 2, 3):
        out ^= table.take(at + ((values >> (8 * k)) & 255) + (k << 8))
    rest, k = lengths // _SHORT, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _through(_DOUBLED[k], out[odd])
        rest, k = rest >> 1, k + 1
    return out


_LANE = 256  # bytes that one lane of a block goes through, a power of two times _SHORT
_LANE_MAP = 2  # its map among the doubled ones
_BLOCK = 1 << 22


def registers(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The running CRC register, begun at zero, after each byte of ``data`` that ``at`` names, ascending.

    The bytes of a block are dealt to lanes which are scanned side by side; what the lanes before a
    lane leave in the register is shifted over its bytes and added.
    """
    out, carried, done = np.empty(len(at), np.uint32), np.uint32(0), 0
    for low in range(0, len(data), _BLOCK):
        block = data[low:low + _BLOCK]
        lanes = -(-len(block) // _LANE)
        columns = np.zeros(lanes * _LANE, np.uint8)
        columns[:len(block)] = block
        columns = np.ascontiguousarray(columns.reshape(lanes, _LANE).T)
        inner, register = np.empty((_LANE, lanes), np.uint32), np.zeros(lanes, np.uint32)
        for k in range(_LANE):
            register = _ONE.take((register ^ columns[k]) & 255) ^ (register >> 8)
            inner[k] = register
        after = register.copy()
        after[:1] ^= _through(_DOUBLED[_LANE_MAP], np.array([carried]))
        step, k = 1, _LANE_MAP
        while step < lanes:
            after[step:] ^= _through(_DOUBLED[k], after[:-step])
            step, k = step * 2, k + 1
        before = np.concatenate([[carried], after[:-1]]).astype(np.uint32)
        carried = after[-1]
        stop = int(np.searchsorted(at, low + len(block)))
        lane, byte = np.divmod(at[done:stop] - low, _LANE)
        out[done:stop] = inner[byte, lane] ^ shifted(before[lane], byte + 1)
        done = stop
    return out


class Scan:
    """The words of several texts, one after another, each after one blank, with registers before and
    after every word. ``data`` is normalised; ``rows`` says where each text begins, and the end."""

    def __init__(self, data: np.ndarray, rows: np.ndarray):
        letter = data != _BLANK
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        edges = rows[:-1][rows[:-1] < len(data)]
        begins[edges] = letter[edges]
        self.place = np.flatnonzero(begins)  # of each word in data
        self.row = np.searchsorted(rows, self.place, "right") - 1
        kept = np.flatnonzero(letter)
        word = np.cumsum(begins)[kept]
        stream = np.full(len(kept) + len(self.place), _BLANK, np.uint8)
        stream[np.arange(len(kept)) + word] = data[kept]
        sizes = np.bincount(word, minlength=len(self.place) + 1)[1:]
        self.stop = np.cumsum(sizes + 1)
        self.start = self.stop - sizes
        both = registers(stream, np.stack([self.start, self.stop], axis=1).ravel() - 1)
        self.before, self.after = both[::2], both[1::2]

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of all runs of ``length`` words inside one text: the number of the last word, and the CRC.

        The register before the run, with the ones that every CRC begins with, is shifted over the
        run's bytes and cancels what came before it in the register after the run.
        """
        last = np.arange(length - 1, len(self.row))
        last = last[self.row[last] == self.row[last - length + 1]]
        first = last - length + 1
        return last, ~(self.after[last] ^ shifted(~self.before[first], self.stop[last] - self.start[first]))


def _parts(normal: bytes, most: int) -> Iterator[tuple[int, int, int]]:
    """Cut a long text at blanks: begin, end, and where the words begin that no part before counted."""
    begin, fresh = 0, 0
    while True:
        end = normal.find(b" ", fresh + most) if len(normal) - fresh > most else -1
        if end < 0:
            yield begin, len(normal), fresh
            return
        yield begin, end, fresh
        back = end
        for _ in range(LONGEST_RUN - 1):
            while back > begin and normal[back - 1] == _BLANK:
                back -= 1
            back = max(normal.rfind(b" ", begin, back) + 1, begin)
        begin, fresh = back, end


def _found(data: np.ndarray, rows: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    scan = Scan(data, rows)
    counted = scan.place >= fresh
    of, buckets = [], []
    for length in range(1, LONGEST_RUN + 1):
        last, crc = scan.runs(length)
        kept = counted[last]
        of.append(scan.row[last[kept]])
        buckets.append((crc[kept] % BUCKETS).astype(np.int64))
    return np.concatenate(of), np.concatenate(buckets), np.bincount(scan.row[counted], minlength=len(rows) - 1)


def scanned(texts: pa.Array, most: int = PART_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The row of each run, the run's bucket, and how many words each row has; a single text of over
    ``most`` bytes comes in parts, any other texts at once."""
    data, rows = utf8(texts)
    data = _NORMAL.take(data)
    if len(texts) != 1:
        yield _found(data, rows, 0)
        return
    for begin, end, fresh in _parts(data.tobytes(), most):
        yield _found(data[begin:end], np.array([0, end - begin]), fresh - begin)


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many runs of all texts fall in each bucket; one row per bucket and task is shuffled."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for piece in text_slices(batches, most=PART_BYTES):
            for _, buckets, _ in scanned(piece.column("text")):
                total += np.bincount(buckets, minlength=BUCKETS)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    counted = rows.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():  # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: thousandths of the log ratio of the smoothed shares, rounded down."""
    all_source, all_target = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([
        math.floor(1000 * math.log((t + 1) * all_source / ((s + 1) * all_target)))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], np.int64)


def weighed(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight."""
    def weigh(gain: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, most=PART_BYTES):
            n = piece.num_rows
            totals = np.zeros((3, n), np.int64)
            for rows, buckets, words in scanned(piece.column("text")):
                totals[0] += words
                totals[1] += np.bincount(rows, minlength=n)
                order = np.argsort(rows, kind="stable")
                summed = np.concatenate([[0], np.cumsum(gain[buckets[order]])])
                totals[2] += np.diff(summed[np.searchsorted(rows[order], np.arange(n + 1))])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").cast(pa.int64()), *map(pa.array, totals)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    step = partial(weigh, gain)
    return documents.select("doc_id", "text").mapInArrow(step, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: int) -> Column:
    """Thousandths of a Gumbel variable from a hash of seed and id (a null id counts as 'null')."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _ranked(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """Number the rows by falling score, then id; those beyond the drawn share get no number.

    Rows are sorted by ranges and stored with their place inside their range; a range starts where the
    ones before it end. Repeated rows are set apart by their own number, so one id cannot fill a range.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    # numbers count up along the sorted rows of a partition, from its own number times 2^33
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    sorted_rows = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "resample-ranges")
    place = sorted_rows.withColumns({"range": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)})
    # one row per range
    sizes = sorted((row["range"], row["n"]) for row in place.groupBy("range").agg(F.count("*").alias("n")).collect())
    before = list(accumulate((n for _, n in sizes), initial=0))
    starts = rows.sparkSession.createDataFrame(
        [(k, start) for (k, _), start in zip(sizes, before, strict=False)], "range long, start long"
    )
    total = before[-1]
    ranked = place.join(F.broadcast(starts), "range").withColumn("rank", F.col("start") + F.col("at") + 1)
    return ranked.withColumn("rank", F.when(F.col("rank") <= percent * total // 100, F.col("rank")))


def resampled(
    documents: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = LEAST_WORDS, seed: int = SEED,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank.

    Of the N documents with ``least_words`` words or more, those with the floor(percent * N / 100)
    highest scores are drawn and ranked from 1; all others have no rank. Ties go to the smaller id;
    rows that share id and score follow one another in no set order. A null text is empty: no
    features, weight 0. A null doc_id draws its noise from 'null' and comes last among ties. Texts of
    any length are scanned whole, in parts. An empty table gives no rows, an empty target smoothed
    counts of zero. Columns other than doc_id and text are not read.
    """
    gain = gains(bucket_counts(documents), bucket_counts(target))
    scored = weighed(documents, gain).withColumns({
        "score": F.col("weight") + noise("doc_id", seed), "row": F.monotonically_increasing_id(),
    })
    rows = stored(scored, "resample-scores")
    enough = F.col("n_words") >= least_words
    eligible = rows.where(enough)
    ranked = _ranked(eligible, percent, pieces(eligible.count(), ranked_rows))
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    rest = rows.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionByName(rest)


def drawn(documents: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of the drawn documents with all their columns; every row of a drawn id comes along."""
    ids = ranked.where("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn_id__")).distinct()
    return documents.join(ids, documents["doc_id"].eqNullSafe(ids["__drawn_id__"]), "left_semi")
