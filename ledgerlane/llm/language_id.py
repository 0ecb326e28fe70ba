"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a generator seeded with its code point. A
trigram is bound by multiplying the vectors of its letters, each rotated by its place; words are
framed by blanks, so that starts and ends count. Bundling a text means adding the vectors of its
trigrams. A language's prototype is the sum of its training documents' vectors, each scaled to
length one; a document belongs to the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import unicodedata
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import text_slices

UNDETERMINED = "und"
DIMENSIONS = 1024
_CODES = 8_192  # distinct trigrams made vectors at once
_GROUP = 256  # documents whose trigram counts are multiplied at once
_BLANK = 0x20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter; a blank for everything else."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        if (char := chr(code)).isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


@functools.lru_cache(maxsize=20_000)
def _letter_vector(code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return 2 * bits - 1


def _bound(codes: np.ndarray) -> np.ndarray:
    """Vectors of trigrams, given as rows of three code points."""
    letters, place = np.unique(codes, return_inverse=True)
    place = place.reshape(codes.shape)
    vectors = np.stack([_letter_vector(int(code)) for code in letters])
    bound = vectors[place[:, 2]].copy()
    for k in (0, 1):
        bound *= np.roll(vectors, 2 - k, axis=1)[place[:, k]]
    return bound


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams as code points, and the row and trigram number of each occurrence."""
    points, rows, row = [], [], 0
    table = _letters()
    for text in texts.to_pylist():
        codes = np.frombuffer(f" {text or ''} ".encode("utf-32-le"), np.uint32)
        points.append(table[codes])
        rows.append(np.full(len(codes), row, np.int32))
        row += 1
    if not points:
        return np.empty((0, 3), np.int64), np.empty(0, np.int32), np.empty(0, np.int64)
    points, rows = np.concatenate(points).astype(np.int64), np.concatenate(rows)
    kept = np.ones(len(points), bool)  # runs of blanks become one
    kept[1:] = (points[1:] != _BLANK) | (points[:-1] != _BLANK) | (rows[1:] != rows[:-1])
    points, rows = points[kept], rows[kept]
    inside = (rows[2:] == rows[:-2]) & (points[1:-1] != _BLANK)
    keys = (points[:-2] << 42 | points[1:-1] << 21 | points[2:])[inside]
    found = pa.array(keys).dictionary_encode()
    distinct = found.dictionary.to_numpy(zero_copy_only=False)
    codes = np.stack([distinct >> 42, distinct >> 21 & 0x1FFFFF, distinct & 0x1FFFFF], axis=1)
    return codes, rows[:-2][inside], found.indices.to_numpy(zero_copy_only=False)


class _Vectors:
    """Document vectors; keeps the vectors of trigrams met so far, up to a bound."""

    MOST = 40_000

    def __init__(self):
        self._rows: dict[int, int] = {}
        self._bound = np.empty((0, DIMENSIONS), np.int8)

    def _of(self, codes: np.ndarray) -> np.ndarray:
        keys = (codes[:, 0] << 42 | codes[:, 1] << 21 | codes[:, 2]).tolist()
        if len(self._rows) + len(keys) > self.MOST:
            self.__init__()
        new = [k for k, key in enumerate(keys) if key not in self._rows]
        if new:
            self._rows |= {keys[k]: len(self._rows) + n for n, k in enumerate(new)}
            self._bound = np.concatenate([self._bound, _bound(codes[new])])
        return self._bound[[self._rows[key] for key in keys]]

    def documents(self, texts: pa.Array) -> np.ndarray:
        """One vector of length one per row; zero for a text without letters.

        Distinct trigrams are gone through in groups of ``_CODES``, so memory does not follow how many
        of them the texts hold. Sums are whole numbers, the same in any order.
        """
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        codes, rows, numbers = trigrams(texts)
        if len(codes) > _CODES:
            order = np.argsort(numbers // _CODES, kind="stable")  # rows stay ascending inside a group
            rows, numbers = rows[order], numbers[order]
        cuts = np.searchsorted(numbers // _CODES, np.arange(len(codes) // _CODES + 2))
        for group, low in enumerate(range(0, len(codes), _CODES)):
            inside = slice(cuts[group], cuts[group + 1])
            self._add(out, codes[low:low + _CODES], rows[inside], numbers[inside] - low)
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, length, out=out, where=length > 0)

    def _add(self, out: np.ndarray, codes: np.ndarray, rows: np.ndarray, numbers: np.ndarray) -> None:
        bound = self._of(codes).astype(np.float32)
        starts = np.searchsorted(rows, np.arange(0, len(out) + _GROUP, _GROUP))
        for k, first in enumerate(range(0, len(out), _GROUP)):
            here = slice(starts[k], starts[k + 1])
            if here.start == here.stop:
                continue
            last = min(first + _GROUP, len(out))
            flat = (rows[here].astype(np.int64) - first) * len(codes) + numbers[here]
            counts = np.bincount(flat, minlength=(last - first) * len(codes))
            used = counts.reshape(last - first, len(codes)).astype(np.float32)
            out[first:last] += used @ bound


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in text_slices(batches, most=2 << 20):
        for start in range(0, piece.num_rows, 2048):
            yield piece.slice(start, 2048)


def prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Sum of document vectors per language, over all rows that have a language and a letter.

    Each task adds up its own rows, so a language costs one vector per task whatever its share.
    """
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        vectors = _Vectors()
        for piece in _slices(batches):
            found = vectors.documents(piece.column("text"))
            langs = pc.dictionary_encode(piece.column("lang"))
            numbers = langs.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                part = found[numbers == k].sum(axis=0, dtype=np.float64)
                sums[lang] = sums[lang] + part if lang in sums else part
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * DIMENSIONS),
                "place": pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                # whole numbers add up the same in any order
                "value": pa.array(np.round(vector * 2**20).astype(np.int64)),
            })

    given = labelled.where("lang is not null and text is not null").select("lang", "text")
    rows = (
        given.mapInArrow(add, "lang string, place int, value long")
        .groupBy("lang", "place").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector"))
        .collect()
    )
    found = {}
    for row in sorted(rows, key=lambda row: row["lang"]):
        vector = np.array([entry["value"] for entry in row["vector"]], np.float64)
        if length := np.linalg.norm(vector):
            found[row["lang"]] = (vector / length).astype(np.float32)
    return found


def with_language(
    documents: DataFrame, known: dict[str, np.ndarray], predicted: str = "lang_pred", cosine: str = "score"
) -> DataFrame:
    """Add the language predicted and its score (the largest cosine, between 0 and 1) to every row.

    ``und`` with score 0 where the text is null or has no letter, or where no language is known.
    Equal cosines go to the language that sorts first. All other columns stay; columns of the two
    new names are replaced.
    """
    from pyspark.sql import types as T

    names = list(known)
    matrix = np.stack(list(known.values())) if known else np.zeros((0, DIMENSIONS), np.float32)
    kept = [f for f in documents.schema.fields if f.name not in (predicted, cosine)]

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _Vectors()
        for piece in _slices(batches):
            found = vectors.documents(piece.column("text"))
            some = (np.abs(found).sum(axis=1) > 0) & bool(names)
            cosines = found @ matrix.T if names else np.zeros((len(found), 1), np.float32)
            best = cosines.argmax(axis=1)
            score = np.where(some, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(f.name) for f in kept),
                 pa.array([names[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), some.tolist())]),
                 pa.array(score)],
                names=[*(f.name for f in kept), predicted, cosine],
            )

    schema = T.StructType([*kept, T.StructField(predicted, T.StringType()), T.StructField(cosine, T.DoubleType())])
    return documents.select(*[f"`{f.name}`" for f in kept]).mapInArrow(predict, schema)


def identified(documents: DataFrame, held: Column) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    return with_language(documents, prototypes(documents.where(~held)))
