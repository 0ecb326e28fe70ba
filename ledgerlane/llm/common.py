"""Shared helpers: the shared folder, bounded slices of Arrow batches, chunk dictionaries."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters between words, where a contract names them: a blank and 0x09 to 0x0D.
BLANK_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or one in the warehouse in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; what is put there goes when the application ends."""
    folder = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to a new shared folder and read them back, which cuts their lineage."""
    folder = work_folder(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def held_out(doc_id: Column | str, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves the given remainder; a null id counts as 'null'."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("null")).cast("binary")) % folds == fold


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each slice hold ``most`` bytes, or one row, at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column, most)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and the offset of each row, as int64."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.offset or len(column) == 0:
        column = pa.concat_arrays([column, pa.array([], pa.large_string())])
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return everything[starts[0]:starts[-1]], starts - starts[0]


def chunked(
    data: np.ndarray, rows: np.ndarray, starts_chunk: np.ndarray
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Cut ``data`` where ``starts_chunk`` says and at row starts.

    Returns the distinct chunks, the number of each chunk in order, and each row's first chunk.
    """
    if not len(data):
        return pa.array([], pa.large_binary()), np.empty(0, np.int64), np.zeros(len(rows), np.int64)
    starts_chunk[rows[:-1][rows[:-1] < len(data)]] = True
    cuts = np.flatnonzero(starts_chunk)
    offsets = np.append(cuts, len(data)).astype(np.int64)
    chunks = pa.Array.from_buffers(
        pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).dictionary_encode()
    numbers = chunks.indices.to_numpy(zero_copy_only=False)
    return chunks.dictionary, numbers, np.searchsorted(cuts, rows)


class Lists:
    """Lists of unequal length in one array of values."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray):
        self.starts, self.lengths, self.values = starts, lengths, values

    @classmethod
    def gathered(cls, count: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Lists:
        """From parts of (list numbers, lengths, values in that order); lists in no part are empty."""
        lengths, starts = np.zeros(count, np.int64), np.zeros(count, np.int64)
        at = 0
        for numbers, sizes, values in parts:
            lengths[numbers] = sizes
            starts[numbers] = at + np.cumsum(sizes) - sizes
            at += len(values)
        return cls(starts, lengths, np.concatenate([np.empty(0, np.uint32), *(x[2] for x in parts)]))

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of list ``numbers[i]`` for every i, one after another, and where each ends."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        if not total:
            return self.values[:0], ends
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        shift += np.arange(total)
        return self.values[shift], ends


def pieces(total: float, each: float) -> int:
    return max(1, math.ceil(total / each))


def spare(columns: Iterable[str], *names: str) -> list[str]:
    """The names, lengthened until none is a column's."""
    taken, out = {column.lower() for column in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
