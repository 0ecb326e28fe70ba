"""Byte-level BPE in padded numpy matrices.

Distinct pieces of a slice are put into buckets of like length, one row of token numbers each. In
each round every row merges its leftmost pair of least rank: ranks of pairs come from a hash table
with open addressing, the columns behind the merge move up, and rows without a further merge leave
the matrix. A pair's rank is that of its joined bytes, so all ways to split a token in two known
tokens are in the table. Pieces of over ``LONGEST`` bytes, for which a round a merge would take
quadratic time, are merged with a heap by the same rule.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame

from ledgerlane.llm.common import Lists, chunked, text_slices, utf8

LONGEST = 256
_NONE = np.iinfo(np.int32).max
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = "^ ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"


class PairTable:
    """Rank of (left, right) by open addressing; ``_NONE`` where the pair never merges."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        size = 1 << max(4, (2 * len(pairs)).bit_length())
        self._shift, self._mask = np.uint64(64 - size.bit_length() + 1), size - 1
        self._keys, self._ranks = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        keys = np.array([left << 32 | right for left, right in pairs], np.int64)
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slot(keys)
        while len(keys):  # each free slot takes the last key that asks for it, the others go on
            free = self._keys[slots] == -1
            self._keys[slots[free]], self._ranks[slots[free]] = keys[free], ranks[free]
            left = self._keys[slots] != keys
            keys, ranks, slots = keys[left], ranks[left], (slots[left] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> self._shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        out = np.full(len(keys), _NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slots = self._slot(keys[open_])
        while len(open_):
            found = self._keys[slots]
            hit = found == keys[open_]
            out[open_[hit]] = self._ranks[slots[hit]]
            on = ~hit & (found != -1)
            open_, slots = open_[on], (slots[on] + 1) & self._mask
        return out


def _newer_members(kind: str) -> str:
    """Characters that the regex module's Unicode table has in a class and tiktoken's has not yet.

    A throw-away tiktoken encoding whose pattern is the class alone keeps just the characters that
    tiktoken counts in it.
    """
    singles = {bytes([b]): b for b in range(256)}
    members = regex.findall(kind, "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
    doubtful = "".join(c for c in members if unicodedata.category(c) == "Cn")
    keeps = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=singles, special_tokens={})
    return "".join(sorted(set(doubtful) - set(bytes(keeps.encode_ordinary(doubtful)).decode())))


class ByteBpe:
    """Encoder and decoder of one vocabulary file of base64 tokens with ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self._ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        pairs = {}
        for token, rank in self._ranks.items():
            for cut in range(1, len(token)):
                left, right = self._ranks.get(token[:cut]), self._ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self._pairs, self._table = pairs, PairTable(pairs)
        self._byte = np.array([self._ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        tokens: list[bytes | None] = [None] * (max(self._ranks.values()) + 1)
        for token, rank in self._ranks.items():
            tokens[rank] = token
        self._tokens = pa.array(tokens, pa.large_binary())
        self._known = pa.array(self._ranks, pa.large_binary())
        self._known_ids = np.fromiter(self._ranks.values(), np.uint32, len(self._ranks))
        newer = {kind: _newer_members(kind) for kind in (r"\p{L}", r"\p{N}")}
        exact = pattern
        for kind, listed in newer.items():
            exact = exact.replace(kind, f"[{kind}--[{listed}]]" if listed else kind)
        self._newer = f"[{''.join(newer.values())}]" if any(newer.values()) else "$^"
        self._pattern, self._exact = regex.compile(pattern), regex.compile(exact, regex.V1)
        self._kind = np.zeros(256, np.uint8)  # 1 letter, 2 other visible, 3 a symbol that is no apostrophe
        self._kind[0x21:0x7F] = 2
        self._kind[0xC3:0xCA] = 2  # lead bytes of Latin letters
        self._kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
        self._kind[list(b".,!?;:$%&*#|()")] = 3

    def _long(self, piece: bytes) -> np.ndarray:
        """Merge one piece with a heap of (rank, place)."""
        ids = self._byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        gone = bytearray(len(ids))
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(ids):
                rank = self._pairs.get((ids[at], ids[after[at]]))
                if rank is not None:
                    heap.append((rank, at, ids[at], ids[after[at]]))

        for at in range(len(ids)):
            offer(at)
        heapq.heapify(heap)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            other = after[at]
            if gone[at] or other >= len(ids) or ids[at] != left or ids[other] != right:
                continue
            ids[at], gone[other], after[at] = rank, 1, after[other]
            if after[at] < len(ids):
                before[after[at]] = at
            for place in (before[at], at):
                size = len(heap)
                offer(place)
                if len(heap) > size:
                    heapq.heappush(heap, heap.pop())
        return np.array([x for x, dead in zip(ids, gone, strict=True) if not dead], np.uint32)

    def _matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, numbers: np.ndarray):
        """Merge pieces of at most ``width`` bytes, a row each; parts of (numbers, lengths, ids)."""
        n, parts = len(numbers), []
        places = np.arange(width + 1)
        inside = places < lengths[:, None]
        rows = np.full((n, width + 1), -1, np.int32)
        rows[inside] = self._byte[data[(starts[:, None] + places)[inside]]]
        ranks = self._table.rank(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(n, width)
        while len(numbers):
            best = ranks.argmin(axis=1)
            least = ranks[np.arange(len(best)), best]
            done = least == _NONE
            if done.any():
                ready, sizes = rows[done], lengths[done]
                parts.append((numbers[done], sizes, ready[np.arange(ready.shape[1]) < sizes[:, None]].astype(np.uint32)))
                keep = ~done
                width = max(2, int(lengths[keep].max(initial=0)))
                rows, ranks = rows[keep, :width + 1], ranks[keep, :width]
                numbers, lengths, best, least = numbers[keep], lengths[keep], best[keep], least[keep]
                if not len(numbers):
                    break
            each = np.arange(len(best))
            rows[each, best] = least
            behind = np.arange(rows.shape[1]) > best[:, None]
            rows[:, :-1] = np.where(behind[:, :-1], rows[:, 1:], rows[:, :-1])
            ranks[:, :-1] = np.where(behind[:, :ranks.shape[1] - 1], ranks[:, 1:], ranks[:, :-1])
            lengths = lengths - 1
            rows[each, lengths] = -1
            ranks[:, -1] = _NONE
            ranks[each, best] = self._table.rank(rows[each, best], rows[each, best + 1])
            inner = np.flatnonzero(best > 0)
            ranks[inner, best[inner] - 1] = self._table.rank(rows[inner, best[inner] - 1], rows[inner, best[inner]])
        return parts

    def pieces(self, given: pa.Array) -> Lists:
        """Token ids of each piece of a large binary array."""
        given = pa.concat_arrays([given, pa.array([], pa.large_binary())])
        offsets = np.frombuffer(given.buffers()[1], np.int64)[given.offset:given.offset + len(given) + 1]
        data = np.frombuffer(given.buffers()[2], np.uint8) if offsets[-1] else np.empty(0, np.uint8)
        sizes = np.diff(offsets)
        known = pc.fill_null(pc.index_in(given, self._known), -1).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(known >= 0)
        parts = [(whole, np.ones(len(whole), np.int64), self._known_ids[known[whole]])]
        for k in np.flatnonzero((known < 0) & (sizes > LONGEST)).tolist():
            ids = self._long(given[k].as_py())
            parts.append((np.array([k]), np.array([len(ids)]), ids))
        width, least = 4, 0
        while least < LONGEST:
            members = np.flatnonzero((known < 0) & (sizes > least) & (sizes <= width))
            most = max(64, (1 << 18) // width)
            for start in range(0, len(members), most):
                group = members[start:start + most]
                parts += self._matrix(data, offsets[group], sizes[group], width, group)
            least, width = width, width + 2 if width < 16 else 2 * width
        return Lists.gathered(len(given), parts)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, one after another, and the number of ids of each row.

        A blank before a visible character always starts a piece, and ASCII letters never share
        one with the symbols below, so texts are cut there first. Distinct cuts that are letters
        behind at most one blank are pieces; the others are matched against the pattern.
        """
        data, rows = utf8(column)
        before, after = self._kind[data[:-1]], self._kind[data[1:]]
        cut = np.zeros(len(data), bool)
        cut[1:-1] = ((data[1:-1] == 0x20) & (self._kind[data[2:]] > 0))
        cut[1:] |= ((before == 1) & (after == 3)) | ((before == 3) & (after == 1))
        chunks, numbers, first = chunked(data, rows, cut)
        plain = pc.match_substring_regex(chunks.cast(pa.large_string()), _LETTERS).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~plain)
        texts = chunks.take(pa.array(rest)).cast(pa.large_string())
        newer = pc.match_substring_regex(texts, self._newer).to_pylist()
        found = [
            (self._exact if new else self._pattern).findall(text)
            for text, new in zip(texts.to_pylist(), newer, strict=True)
        ]
        counts = np.array([len(x) for x in found], np.int64)
        split = pa.array(list(itertools.chain.from_iterable(found)), pa.large_string()).cast(pa.large_binary())
        plain_at = np.flatnonzero(plain)
        distinct = pa.concat_arrays([chunks.take(pa.array(plain_at)), split]).dictionary_encode()
        lists = self.pieces(distinct.dictionary)
        piece_ids, piece_ends = lists.take(distinct.indices.to_numpy(zero_copy_only=False))
        piece_ends = np.concatenate([[0], piece_ends])
        n = len(plain_at)
        bounds = piece_ends[n + np.concatenate([[0], np.cumsum(counts)])]
        starts, lengths = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        starts[plain_at], lengths[plain_at] = piece_ends[:n], np.diff(piece_ends[:n + 1])
        starts[rest], lengths[rest] = bounds[:-1], np.diff(bounds)
        ids, ends = Lists(starts, lengths, piece_ids).take(numbers)
        return ids, np.diff(np.concatenate([[0], ends])[first])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each row's ids."""
        tokens = self._tokens.take(pa.array(ids, pa.int64()))
        offsets = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
        raw = memoryview(tokens.buffers()[2]) if len(ids) else memoryview(b"")
        places = offsets[np.concatenate([[0], np.cumsum(counts)])] if len(ids) else np.zeros(len(counts) + 1, int)
        return [bytes(raw[a:b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    """The codec of a vocabulary, built once in each worker process."""
    return ByteBpe(path, pattern)


def encoded(documents: DataFrame, path: str, pattern: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the named columns, the ids of its whole text, and the text decoded from those ids.

    A null or empty text has no ids and decodes to an empty text. Rows are kept as they come,
    repeated ones too; other columns are left out.
    """
    kept = [field for field in documents.schema.fields if field.name in columns]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            ids, counts = codec(path, pattern).encode(piece.column("text"))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            texts = codec(path, pattern).decode(ids, counts)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(f.name) for f in kept),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                 pa.array([text.decode() for text in texts], pa.string())],
                names=[*(f.name for f in kept), "ids", "decoded"],
            )

    from pyspark.sql import types as T

    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return documents.select(*dict.fromkeys([*(f.name for f in kept), "text"])).mapInArrow(encode, schema)


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; null and empty texts have no ids."""
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            ids, counts = codec(path, pattern).encode(piece.column("text"))
            texts = codec(path, pattern).decode(ids, counts)
            raw = memoryview(ids.astype("<u4").tobytes())
            places = (4 * np.concatenate([[0], np.cumsum(counts)])).tolist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column("doc_id").cast(pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(places[:-1], places[1:])],
                "decoded_sha256": [hashlib.sha256(text).hexdigest() for text in texts],
            })

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents.select("doc_id", "text").mapInArrow(encode, schema)
