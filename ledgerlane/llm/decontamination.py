"""Benchmark passages in documents, found by pigeonhole pieces and Myers' bit-parallel distance.

Texts are compared by their letters and digits alone, lower-cased. An item of m such characters may
differ in k = m // ``PER_EDIT`` of them. Cut into k + 1 pieces, at least one piece is then in the
document unchanged; an automaton over all pieces finds those, and the distance of the whole item to
the text around each hit decides.

Matches of an item do not overlap. They are taken from the left: from the first place where an item
ends within its budget, the end of the least distance no more than 2k characters on counts, and the
search goes on behind it. An occurrence that overlaps none of the matches is therefore never left out.
An item of fewer than ``PER_EDIT`` characters has no budget and must stand between word boundaries.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import pieces, stored, text_slices

PER_EDIT = 16
ITEM_CHARS = 4 << 20  # characters of items that are searched for at once
# Fixed ranges of scripts that write words without blanks: Thai to Lao, Burmese, Khmer, kana, Han.
UNSPACED = (("\u0e00", "\u0eff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"), ("\u3040", "\u30ff"),
            ("\u3400", "\u9fff"), ("\uf900", "\ufaff"), ("\U00020000", "\U0003ffff"))


@functools.lru_cache(maxsize=1)
def _kept() -> np.ndarray:
    """Lower-case code point of letters and digits, zero for all else."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (char := chr(code)).isalnum():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def squashed(text: str) -> tuple[str, np.ndarray]:
    """Letters and digits of a text, lower-cased, and the place of each in it."""
    codes = _kept()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    places = np.flatnonzero(codes)
    return codes[places].astype("<u4").tobytes().decode("utf-32-le"), places


def _one_word(before: str, after: str) -> bool:
    """Whether no word boundary lies between two characters; scripts without blanks have one everywhere."""
    return all(char.isalnum() and not any(low <= char <= high for low, high in UNSPACED) for char in (before, after))


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for k, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << k
    return masks


def distances(pattern: str, text: Iterable[str], anchored: bool = False, masks: dict[str, int] | None = None) -> Iterator[int]:
    """After each character of the text, the least edit distance of the pattern to a part that ends there.

    ``anchored``: the part starts with the text.
    """
    masks = _masks(pattern) if masks is None else masks
    every, high = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    up, down, score = every, 0, len(pattern)
    for char in text:
        equal = masks.get(char, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        rises, falls = down | (every & ~(across | up)), up & across
        if rises & high:
            score += 1
        elif falls & high:
            score -= 1
        rises, falls = (rises << 1 | anchored) & every, falls << 1 & every
        up, down = falls | (every & ~(vertical | rises)), rises & vertical
        yield score


def myers(pattern: str, text: str, anchored: bool = False, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of the pattern to a part of the text, and the first place it ends at."""
    if not pattern:
        return 0, 0
    best = (len(pattern), 0)
    for k, score in enumerate(distances(pattern, text, anchored, masks), 1):
        if score < best[0]:
            best = (score, k)
    return best


def occurrences(pattern: str, turned: str, text: str, edits: int, masks: dict[str, int]) -> Iterator[tuple[int, int, int]]:
    """(distance, start, end) of the matches in a text, from the left; ``turned`` is the pattern reversed."""
    begin = 0
    while begin < len(text):
        best, last = None, math.inf
        for end, score in enumerate(distances(pattern, map(text.__getitem__, range(begin, len(text))), masks=masks), begin + 1):
            if end > last:
                break
            if score <= edits and (best is None or score < best[0]):
                last = min(last, end + 2 * edits)
                best = (score, end)
        if best is None:
            return
        distance, end = best
        # The part that ends here is at most this long.
        low = max(begin, end - len(pattern) - edits)
        yield distance, end - myers(turned, text[low:end][::-1], anchored=True)[1], end
        begin = end


class Items:
    """The pieces of some items in one automaton; items of fewer than ``least`` characters are left out."""

    def __init__(self, items: list[tuple[int, str]], least: int = 1):
        self._items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            pattern = squashed(text or "")[0]
            if not pattern:
                continue
            edits = len(pattern) // PER_EDIT
            if len(pattern) < least:
                continue
            cuts = [len(pattern) * k // (edits + 1) for k in range(edits + 2)]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                where.setdefault(pattern[first:last], []).append((len(self._items), first))
            self._items.append((item_id, pattern, edits, _masks(pattern), pattern[::-1]))
        self._automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self._automaton.add_word(piece, (len(piece), places))
        if where:
            self._automaton.make_automaton()
        self._any = bool(where)

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, start, end) of every match, in code points of the text."""
        if not self._any or not text:
            return []
        plain, places = squashed(text)
        starts: dict[int, set[int]] = {}
        for end, (size, owners) in self._automaton.iter(plain):
            for item, first in owners:
                starts.setdefault(item, set()).add(end + 1 - size - first)
        found = []
        for item, begins in starts.items():
            item_id, pattern, edits, masks, turned = self._items[item]
            if not edits:
                found += [(item_id, 0, *span) for span in _whole_words(text, places, sorted(begins), len(pattern))]
                continue
            for low, high in _windows(sorted(begins), edits, len(pattern)):
                for distance, first, end in occurrences(pattern, turned, plain[low:high], edits, masks):
                    found.append((item_id, distance, int(places[low + first]), int(places[low + end - 1]) + 1))
        return sorted(found)


def _whole_words(text: str, places: np.ndarray, begins: list[int], size: int) -> Iterator[tuple[int, int]]:
    """Places in the text of exact hits that cut no word in two and do not overlap, from the left."""
    free = 0
    for begin in begins:
        first, last = int(places[begin]), int(places[begin + size - 1]) + 1
        cut = (first and _one_word(text[first - 1], text[first])) or (
            last < len(text) and _one_word(text[last - 1], text[last])
        )
        if begin >= free and not cut:
            free = begin + size
            yield first, last


def _windows(begins: list[int], edits: int, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of text that hold every match of an item that would begin about these places, merged."""
    low, high = max(0, begins[0] - edits), begins[0] + size + edits
    for begin in begins[1:]:
        if begin - edits >= high:
            yield low, high
            low = begin - edits
        high = begin + size + edits
    yield low, high


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per match: doc_id, item_id, edits, start, end (code points, end exclusive).

    Null and empty texts, on either side, match nothing; neither do empty tables. An item of fewer than
    ``PER_EDIT`` letters and digits must occur unchanged, as whole words. Repeated documents give
    repeated matches; a repeated item counts once. Texts are searched whole, however long. Further
    columns are not read. Items are sent to the tasks in blocks of ``ITEM_CHARS`` characters (or one
    item); every document meets every block, and one block is held at a time.
    """
    schema = "doc_id long, item_id long, edits int, start int, end int"
    found = None
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks, items = _blocks(benchmark)
    for block in range(blocks):
        held = _held(items, block)
        part = texts.mapInArrow(functools.partial(_search, held), schema)
        if blocks > 1:
            part = stored(part, "benchmark-matches")
            held.destroy()
        found = part if found is None else found.unionAll(part)
    return found


def _blocks(benchmark: DataFrame) -> tuple[int, DataFrame]:
    """How many blocks there are, and the distinct items with the block each is dealt to by its hash."""
    items = benchmark.where("text is not null and text != ''").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = pieces(total, ITEM_CHARS)
    return blocks, items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))


def _held(items: DataFrame, block: int):
    rows = items.where(F.col("block") == block).collect()
    return items.sparkSession.sparkContext.broadcast([(row["item_id"], row["text"]) for row in rows])


def _search(held, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = Items(held.value)
    for piece in text_slices(batches):
        rows = [
            (doc_id, *match)
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True)
            for match in items.matches(text or "")
        ]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 *(pa.array(c, pa.int32()) for c in columns[2:])],
                names=["doc_id", "item_id", "edits", "start", "end"],
            )


def clean(documents: DataFrame, benchmark: DataFrame, least: int = PER_EDIT) -> DataFrame:
    """The documents without a benchmark passage, with all their columns.

    Items of fewer than ``least`` letters and digits (answers such as "Yes.") are found by
    ``contaminated`` but are no passage: any clean text may hold them, so they remove no document.
    With several blocks of items what is left is stored after each.
    """
    blocks, items = _blocks(benchmark)
    for block in range(blocks):
        held = _held(items, block)
        documents = documents.mapInArrow(functools.partial(_without, held, least), documents.schema)
        if blocks > 1:
            documents = stored(documents, "without-benchmark")
            held.destroy()
    return documents


def _without(held, least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = Items(held.value, least)
    for piece in text_slices(batches):
        found = [not items.matches(text or "") for text in piece.column("text").to_pylist()]
        yield piece.filter(pa.array(found, pa.bool_()))
