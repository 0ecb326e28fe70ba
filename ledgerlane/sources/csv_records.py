"""Records of large CSV files with line breaks inside fields, read by many tasks a file.

A line break ends a record if the quotes before it in the file are even in number. A first pass counts
the quotes of each split, one bit a split; the exclusive sum of these bits tells every split whether it
starts inside a field, so in a second pass all splits find their records at once. Only the pieces of
records that cross a split, at most two a split, are moved and put together; splits that a record crosses
are read once more for them. Lines are never shuffled, and are put together a batch at a time.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ["file", "start"]
_PIECES = "record string, split long, at int, ends boolean, opens boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Each split that holds a line: its number, whether it starts inside a field, whether a record crosses
    one of its ends, and what it tells its task, in one number."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy(*_SPLIT).agg(F.bit_xor(quotes.cast("long") % 2).alias("odd"))
    in_file = Window.partitionBy("file").orderBy("start")
    before = F.coalesce(F.bit_xor("odd").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a split, and a split is no smaller than the session makes it
    number = F.row_number().over(Window.orderBy(*_SPLIT)).cast("long")
    known = counted.withColumns({"before": before, "split": number})
    mark = F.col("split") * 4 + F.col("before") * 2 + (F.col("start") == 0).cast("long")
    crossed = (F.col("before") == 1) | (F.col("before") != F.col("odd"))
    return known.select(*_SPLIT, "split", crossed.alias("crossed"), mark.alias("mark"))


def _runs(column: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(column[1:] != column[:-1]) + 1
    yield from zip(np.concatenate([[0], edges]).tolist(), np.append(edges, len(column)).tolist(), strict=True)


def _check_header(record: str, names: Sequence[str]) -> None:
    found = next(csv.reader([record.removeprefix("\ufeff")]), [])
    if [name.strip() for name in found] != list(names):
        raise ValueError(f"the header {found} is not {list(names)}")


class _Split:
    """Puts the lines of one split together to records, batch by batch."""

    def __init__(self, mark: int, names: Sequence[str]):
        self.mark, self.names = mark, names
        self.inside = bool(mark & 2)
        self.first = self.inside  # the piece that a record of an earlier split goes on with
        self.header = bool(mark & 1)
        self.open: list[pa.Array] = []

    def records(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + self.inside) % 2
        self.inside = bool(after[-1])
        ends = np.flatnonzero(after == 0) + 1
        if not len(ends):
            self.open.append(values)
            return
        ends += sum(map(len, self.open))
        lines, last = pa.concat_arrays([*self.open, values]) if self.open else values, int(ends[-1])
        self.open = [lines.slice(last)] if last < len(lines) else []
        texts = lines.slice(0, last)
        if len(ends) < last:
            texts = pc.binary_join(pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), texts), "\n")
        if self.first:
            self.first = False
            yield self._piece(texts[0].as_py(), 0, True, False)
            texts = texts.slice(1)
        texts = self._made(texts)
        if len(texts):
            n = len(texts)
            yield _batch(texts, pa.nulls(n, pa.int64()), np.full(n, -1), np.full(n, True), np.full(n, True))

    def _made(self, texts: pa.Array) -> pa.Array:
        """Records without the header and without blank ones, line ends inside them as line feeds."""
        if pc.any(pc.match_substring(texts, "\r")).as_py():
            texts = pc.replace_substring(texts, "\r\n", "\n")
            texts = pc.replace_substring_regex(texts, "\r\\z", "", max_replacements=1)
        if self.header and len(texts):
            self.header = False
            _check_header(texts[0].as_py(), self.names)
            texts = texts.slice(1)
        # only these can be blank
        unsure = pc.match_substring_regex(texts, "\\A(\\z|[^!-~])").to_numpy(zero_copy_only=False)
        if unsure.any():
            blank = [k for k in np.flatnonzero(unsure).tolist() if not texts[k].as_py().strip()]
            texts = texts.take(pa.array(np.delete(np.arange(len(texts)), blank)))
        return texts

    def _piece(self, text: str, at: int, ends: bool, opens: bool) -> pa.RecordBatch:
        return _batch([text], [self.mark // 4], [at], [ends], [opens])

    def rest(self) -> Iterator[pa.RecordBatch]:
        """What is left open: the begin of a record, or, if no record ended here, the middle of one."""
        if self.open:
            text = "\n".join(line for lines in self.open for line in lines.to_pylist())
            yield self._piece(text, 0 if self.first else 1, False, not self.first)


def _batch(records, split, at, ends, opens) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_())
    columns = [pa.array(c, kind) for c, kind in zip((records, split, at, ends, opens), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["record", "split", "at", "ends", "opens"])


def _found(names: Sequence[str], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        if batch.column("mark").null_count:
            raise RuntimeError("the splits changed between the two passes over a file")
        marks = batch.column("mark").to_numpy()
        for low, high in _runs(marks) if len(marks) else ():
            if split is None or split.mark != marks[low]:
                if split is not None:
                    yield from split.rest()
                split = _Split(int(marks[low]), names)
            yield from split.records(batch.column("value").slice(low, high - low))
    if split is not None:
        yield from split.rest()


def read_records(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """(record, whole): the text of each record after the header, blank ones left out.

    ``whole`` is false for what a file leaves open at its end, when its quotes do not pair up. A header
    other than ``names`` fails the read. Line ends inside fields come out as line feeds.
    """
    lines = _lines(spark, path)
    splits = _splits(lines)

    def pieces(of: DataFrame, how: str) -> DataFrame:
        marked = lines.join(F.broadcast(of.select(*_SPLIT, "mark")), _SPLIT, how)
        return marked.select("value", "mark").mapInArrow(partial(_found, tuple(names)), _PIECES)

    whole = pieces(splits, "left").where("at = -1").select("record", F.lit(True).alias("whole"))
    # a record over several splits: its begin, splits that are all middle, and its end
    in_file = Window.partitionBy("file").orderBy("start", "at")
    number = F.sum(F.col("opens").cast("int")).over(in_file)
    crossing = pieces(splits.where("crossed"), "inner").where("at >= 0")
    parts = crossing.join(F.broadcast(splits.select(*_SPLIT, "split")), "split").withColumn("number", number)
    joined = parts.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "at", "record"))).alias("parts"), F.bool_or("ends").alias("whole")
    )
    text = F.rtrim(F.replace(F.array_join("parts.record", "\n"), F.lit("\r\n"), F.lit("\n")), F.lit("\r"))
    return whole.unionByName(joined.select(text.alias("record"), "whole"))
