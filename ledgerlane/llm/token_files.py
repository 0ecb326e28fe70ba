"""Token ids in fixed-width bit-packed files.

A file holds ids of ``bits`` bits each (the fewest that hold the vocabulary's largest id), in blocks
of ``BLOCK`` ids that start on a byte, so that an id's place is computed and any range is unpacked by
numpy without touching the rest:

    header   magic, bits, ids per block
    payload  blocks, little-endian bit order, the last one short
    tables   doc_id (int64), known (uint8, 0 where doc_id is null), ids per document (int64),
             byte offset of each block (int64)
    footer   number of ids, number of documents, place of the tables, magic

A set of files has a manifest: one row per file, in order, with its number of documents and ids.
Only files that the manifest names belong to the set, so a task that ran twice does no harm.
"""

from __future__ import annotations

import functools
import itertools
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import Lists, chunked, text_slices, utf8, work_folder

MAGIC = b"LLPACK01"
BLOCK = 1 << 16
_HEADER = struct.Struct("<8sII")
_FOOTER = struct.Struct("<QQQ8s")
_READ_IDS = 1 << 20
REMEMBERED = 1_000_000  # words whose ids a process keeps, some fifty bytes each
_PLAIN = "^[a-z]+$"
_ACCENTED = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
_ANY_CASE = "^[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    wide = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    flags = np.unpackbits(wide, axis=1, bitorder="little")[:, :bits]
    return np.packbits(flags.ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, count: int) -> np.ndarray:
    flags = np.unpackbits(np.frombuffer(packed, np.uint8), count=count * bits, bitorder="little")
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flags.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path.replace("file:/", "file:///") if "://" not in path else path)
    return pafs.LocalFileSystem(), path


class TokenWriter:
    """Writes one file; holds one unfinished block and sixteen bytes a document."""

    def __init__(self, path: str, vocabulary: int):
        files, where = _place(path)
        files.create_dir(posixpath.dirname(where), recursive=True)
        self.bits, self.n_ids = bits_for(vocabulary), 0
        self._out = files.open_output_stream(where)
        self._out.write(_HEADER.pack(MAGIC, self.bits, BLOCK))
        self._at, self._rest, self._offsets = _HEADER.size, np.empty(0, np.uint32), []
        self._docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _block(self, ids: np.ndarray) -> None:
        packed = pack(ids, self.bits)
        self._offsets.append(self._at)
        self._out.write(packed)
        self._at += len(packed)

    def write(self, doc_ids: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self._docs.append((doc_ids.astype("<i8"), known.astype("u1"), counts.astype("<i8")))
        self.n_ids += len(ids)
        ids = np.concatenate([self._rest, ids])
        whole = len(ids) - len(ids) % BLOCK
        for start in range(0, whole, BLOCK):
            self._block(ids[start:start + BLOCK])
        self._rest = ids[whole:]

    def close(self) -> tuple[int, int]:
        if len(self._rest):
            self._block(self._rest)
        tables, n_docs = self._at, sum(len(x[0]) for x in self._docs)
        for k, kind in enumerate(("<i8", "u1", "<i8")):
            column = [x[k] for x in self._docs] or [np.empty(0, kind)]
            self._out.write(np.concatenate(column).tobytes())
        self._out.write(np.array(self._offsets, "<i8").tobytes())
        self._out.write(_FOOTER.pack(self.n_ids, n_docs, tables, MAGIC))
        self._out.close()
        return n_docs, self.n_ids


class TokenFile:
    """Random access to the ids of one file."""

    def __init__(self, path: str):
        files, where = _place(path)
        self._in = files.open_input_file(where)
        size = self._in.size()
        magic, self.bits, self.block = _HEADER.unpack(self._in.read_at(_HEADER.size, 0))
        self.n_ids, self.n_docs, tables, end = _FOOTER.unpack(
            self._in.read_at(_FOOTER.size, size - _FOOTER.size)
        )
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{path} is no token file")
        raw = self._in.read_at(size - _FOOTER.size - tables, tables)
        n = self.n_docs
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.known = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        counts = np.frombuffer(raw, "<i8", n, 9 * n)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self._offsets = np.frombuffer(raw, "<i8", -(-self.n_ids // self.block), 17 * n)

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the file; reads the bytes of those blocks' part alone."""
        parts = []
        while count > 0:
            block, skip = divmod(start, self.block)
            here = min(count, self.block - skip)
            first, last = skip * self.bits // 8, -(-(skip + here) * self.bits // 8)
            raw = self._in.read_at(last - first, int(self._offsets[block]) + first)
            lead = skip * self.bits - 8 * first
            flags = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
            wide = np.zeros((here, 32), np.uint8)
            wide[:, :self.bits] = flags[lead:lead + here * self.bits].reshape(here, self.bits)
            parts.append(np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel())
            start, count = start + here, count - here
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def document(self, number: int) -> np.ndarray:
        first = int(self.starts[number])
        return self.read(first, int(self.starts[number + 1]) - first)

    def close(self) -> None:
        self._in.close()


def _class_of_byte() -> np.ndarray:
    """0 other, 1 blank, 2 lower-case letter or digit, 3 a symbol that never joins with those."""
    table = np.zeros(256, np.uint8)
    table[list(b" \t\n\r")] = 1
    table[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = 2
    table[list(b".,!?;:$%&*#")] = 3
    return table


class WordEncoder:
    """Whole texts to ids with a word-level tokenizer, each distinct word encoded once a slice.

    The tokenizer drops blanks and never joins a letter or digit with one of the symbols above, so
    a text cut there has the ids of its parts. Texts that spell a special token are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # Lower-case Latin words stay as they are under the normalizer: split at blanks and merge.
        self._plain, self._accented = Tokenizer(self._tokenizer.model), Tokenizer(self._tokenizer.model)
        blanks, as_bytes = pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(False, True, False)
        self._plain.pre_tokenizer = blanks
        self._accented.pre_tokenizer = pre_tokenizers.Sequence([blanks, as_bytes])
        self._seen, self._lists = pa.array([], pa.large_string()), Lists.gathered(0, [])
        self.vocabulary = self._tokenizer.get_vocab_size()
        words = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(words.values()) + 1, bool)
        self._ends[[number for word, number in words.items() if word.endswith("</w>")]] = True
        self._class = _class_of_byte()
        self._marks = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.array([len(ids) for ids in found], np.int64)
        return lengths, np.array(list(itertools.chain.from_iterable(found)), np.uint32)

    def _joined(self, words: pa.Array, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, encoded as one text: each word ends in an end-of-word id."""
        text = " ".join(words.to_pylist())
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self._ends[ids]) + 1
        return np.diff(ends, prepend=0), ids

    def _new_words(self, words: pa.Array) -> Lists:
        """Ids of distinct words, joined where each is sure to be one word to the tokenizer."""
        parts, left = [], np.ones(len(words), bool)
        for shape, tokenizer in ((_PLAIN, self._plain), (_ACCENTED, self._accented)):
            fits = left & pc.match_substring_regex(words, shape).to_numpy(zero_copy_only=False)
            left &= ~fits
            numbers = np.flatnonzero(fits)
            for start in range(0, len(numbers), 8192):
                group = numbers[start:start + 8192]
                parts.append((group, *self._joined(words.take(pa.array(group)), tokenizer)))
        numbers = np.flatnonzero(left)
        parts.append((numbers, *self._each(words.take(pa.array(numbers)).to_pylist())))
        return Lists.gathered(len(words), parts)

    def _words(self, chunks: pa.Array) -> Lists:
        """Ids of every distinct chunk; words met before, in this process, are not encoded again."""
        texts = pc.ascii_trim(chunks.cast(pa.large_string()), " \t\n\r")
        accented = pc.match_substring_regex(texts, _ANY_CASE)
        texts = pc.if_else(accented, pc.utf8_lower(texts), texts).dictionary_encode()
        words, number = texts.dictionary, texts.indices.to_numpy(zero_copy_only=False)
        place = pc.fill_null(pc.index_in(words, self._seen), -1).to_numpy(zero_copy_only=False).copy()
        new = np.flatnonzero(place < 0)
        fresh = words.take(pa.array(new))
        lists, held = self._new_words(fresh), self._lists
        place[new] = len(self._seen) + np.arange(len(new))
        joined = Lists(
            np.concatenate([held.starts, len(held.values) + lists.starts]),
            np.concatenate([held.lengths, lists.lengths]),
            np.concatenate([held.values, lists.values]),
        )
        if len(self._seen) + len(new) <= REMEMBERED:
            self._seen, self._lists = pa.concat_arrays([self._seen, fresh]), joined
        else:
            self._seen, self._lists = fresh, lists
        return Lists(joined.starts[place[number]], joined.lengths[place[number]], joined.values)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, one after another, and the number of ids of each row."""
        column = pc.fill_null(column, "")
        special = np.zeros(len(column), bool)
        for mark in self._marks:
            found = pc.match_substring(column, mark, ignore_case=True)  # lowered below
            special |= found.to_numpy(zero_copy_only=False)
        usual = pc.if_else(pa.array(~special), column, "")
        data, rows = utf8(pc.ascii_lower(usual))
        kind = self._class[data]
        before = np.concatenate([[1], kind[:-1]]).astype(np.uint8) if len(kind) else kind
        cut = ((kind == 1) & (before != 1)) | ((kind == 2) & (before == 3)) | ((kind == 3) & (before == 2))
        chunks, numbers, first = chunked(data, rows, cut)
        ids, ends = self._words(chunks).take(numbers)
        ends = np.concatenate([[0], ends])[first]
        if not special.any():
            return ids, np.diff(ends)
        lengths, marked = self._each(column.filter(pa.array(special)).to_pylist())
        whole = dict(zip(np.flatnonzero(special).tolist(), np.split(marked, np.cumsum(lengths)[:-1])))
        parts = [
            whole[row] if row in whole else ids[ends[row]:ends[row + 1]]
            for row in range(len(column))
        ]
        return np.concatenate(parts), np.array([len(part) for part in parts])


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary, built once in each worker process."""
    return WordEncoder(path)


def write_token_files(
    documents: DataFrame, folder: str, tokenizer: str, end_id: int = 1, slice_bytes: int = 8 << 20
) -> list[tuple[str, int, int]]:
    """Encode whole texts and write them in ascending doc_id order; returns the manifest.

    Null texts are empty, a null doc_id comes first, rows that share a doc_id lie side by side in
    the order of their texts. An empty table gives an empty manifest. Other columns are not read.
    """
    ordered = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        encoder = writer = None
        for piece in text_slices(batches, most=slice_bytes):
            if writer is None:
                encoder = word_encoder(tokenizer)
                writer = TokenWriter(f"{folder}/{name}", max(encoder.vocabulary, end_id + 1))
            ids, counts = encoder.encode(piece.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            keys = piece.column("doc_id").cast(pa.int64())
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            writer.write(keys.fill_null(0).to_numpy(zero_copy_only=False), known, counts + 1, ids)
        if writer is not None:
            n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "name": [name], "n_docs": [n_docs], "n_ids": [n_ids]}
            )

    rows = ordered.mapInArrow(write, "part long, name string, n_docs long, n_ids long").collect()
    manifest = [(row["name"], row["n_docs"], row["n_ids"]) for row in sorted(rows, key=lambda row: row["part"])]
    files, where = _place(folder)
    files.create_dir(where, recursive=True)
    with files.open_output_stream(f"{where}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> list[tuple[str, int, int]]:
    files, where = _place(folder)
    with files.open_input_stream(f"{where}/manifest.json") as given:
        return [tuple(row) for row in json.loads(given.read())]


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    manifest, start, parts = read_manifest(folder), 0, []
    for name, _, n_ids in manifest:
        parts.append((f"{folder}/{name}", start))
        start += n_ids

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(k).to_pylist() for k in ("path", "start")), strict=True):
                yield from _digests(path, base)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    given = spark.createDataFrame(parts, "path string, start long")
    return given.repartition(max(1, len(parts)), "path").mapInArrow(read, schema)


def _digests(path: str, base: int) -> Iterator[pa.RecordBatch]:
    tokens = TokenFile(path)
    first = 0
    while first < tokens.n_docs:
        last = int(np.searchsorted(tokens.starts, tokens.starts[first] + _READ_IDS, "right")) - 1
        last = min(max(last, first + 1), tokens.n_docs)
        starts = tokens.starts[first:last + 1]
        checks = []
        if last == first + 1:  # may be very long
            check = 0
            for at in range(int(starts[0]), int(starts[1]), _READ_IDS):
                check = zlib.crc32(tokens.read(at, min(_READ_IDS, int(starts[1]) - at)).tobytes(), check)
            checks.append(check)
        else:
            raw = memoryview(tokens.read(int(starts[0]), int(starts[-1] - starts[0])).tobytes())
            places = 4 * (starts - starts[0])
            checks = [zlib.crc32(raw[a:b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist())]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(tokens.doc_ids[first:last], mask=~tokens.known[first:last]),
            "start": pa.array(base + starts[:-1]),
            "n_tokens": pa.array(np.diff(starts)),
            "ids_crc32": pa.array(checks, pa.int64()),
        })
        first = last
    tokens.close()


def token_digests(documents: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write token files into a new shared folder and read them back."""
    folder = work_folder(documents.sparkSession, "token-files")
    write_token_files(documents, folder, tokenizer, end_id)
    return read_token_files(documents.sparkSession, folder)
