"""Toxicity from gradient-boosted trees over dense features, with isotonic calibration.

Per text: densities of three fixed word lists and of a list learned from the training labels, how
often a listed word stands near the second person, and the rates of capitals, punctuation, digits
and disguised spellings. Trees are grown on histograms of at most ``FIT_ROWS`` labelled training
rows, the only bound here, while the learned list is counted over all of them.

Labelled texts are dealt to ``FOLDS`` folds by a hash of the id (copies with other ids may be in others,
which lets a few texts be learned at all). The features a tree
or the calibration sees of a labelled text use the list learned without that text's fold, and
predictions of rows a fold did not see calibrate the score. Other texts use the list of all folds.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import chunked, text_slices, utf8

FIT_ROWS = 20_000
#: Copies of the labels of an id, so that rows of a repeated id are dealt to as many tasks.
SALTS = 8
FOLDS = 3
NEAR = 5
THRESHOLD = 0.3

# Fixed word lists (English, German, French, Spanish).
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb fool loser losers clown pathetic worthless scum trash garbage imbecile cretin
dimwit jerk creep pig coward ugly disgusting vermin parasite degenerate freak lunatic
dumm dummkopf trottel depp vollidiot abschaum versager widerlich
imbécile crétin abruti connard minable ordure débile
idiota imbécil estúpido estúpida basura escoria inútil payaso asqueroso
""".split())
PROFANITY = frozenset("""
fuck fucking fucker shit bullshit bitch bastard asshole ass damn crap dick whore slut
scheisse scheiße arschloch fick hure merde putain salope mierda puta cabrón joder
""".split())
THREATS = frozenset("""
kill die hurt destroy murder beat hang shoot burn hate exterminate töten sterben hasse tuer mourir matar morir odio
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself u ur du dich dir dein deine ihr euch tu toi ton ta tes vous votre vos tú ti tus usted ustedes
""".split())

_LEET = str.maketrans("013457@$!|", "oieastasil")
_INNER = re.compile(r"(?<=\w)[.*_\-~'`+^]+(?=\w)")
_EDGE = re.compile(r"^\W+|\W+$")
_REPEAT = re.compile(r"(.)\1{2,}")
_LISTS = (INSULTS, PROFANITY, THREATS)

FEATURES = (
    "words", "insults", "insult_hits", "profanity", "threats", "learned_mean", "learned_most", "learned_hits",
    "second_person", "near_second_person", "capital_words", "capitals", "punctuation", "exclamations", "questions",
    "symbols", "digits", "disguised", "word_length",
)


def plain_word(word: str) -> tuple[str, bool]:
    """A word's plain spelling and whether it was disguised (digits, inner signs, long repeats)."""
    lower = _EDGE.sub("", word.lower())
    bare = _REPEAT.sub(r"\1", _INNER.sub("", lower))
    if any(c.isalpha() for c in bare) and not bare.isalpha():
        bare = bare.translate(_LEET)
    if bare == lower:
        return lower, False
    hit = any(bare in words for words in _LISTS) and not any(lower in words for words in _LISTS)
    return (bare if hit else lower), hit


class _Words:
    """What is known of distinct words, kept over the slices of a task up to a bound."""

    MOST = 300_000

    def __init__(self, learned: dict[str, float]):
        self._learned, self._known = learned, {}

    def flags(self, words: list[bytes]) -> np.ndarray:
        """Per word: insult, profanity, threat, second person, capitals, disguised, learned weight."""
        if len(self._known) > self.MOST:
            self._known = {}
        out = np.zeros((len(words), 7), np.float32)
        known, learned = self._known, self._learned
        for k, raw in enumerate(words):
            row = known.get(raw)
            if row is None:
                word = raw.decode().strip()
                bare, disguised = plain_word(word)
                row = known[raw] = (
                    bare in INSULTS, bare in PROFANITY, bare in THREATS, bare in SECOND_PERSON,
                    len(bare) > 1 and word.isupper(), disguised, learned.get(bare, 0.0),
                ) if bare else (0, 0, 0, 0, 0, 0, 0)
            if any(row):
                out[k] = row
        return out


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, rows = utf8(column)
    blank = np.isin(data, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
    cut = np.zeros(len(data), bool)
    cut[1:] = blank[:-1] & ~blank[1:]
    distinct, numbers, first = chunked(data, rows, cut)
    if len(numbers):  # blanks before a row's first word are no word
        kept = ~np.array([raw.isspace() for raw in distinct.to_pylist()])[numbers]
        first, numbers = np.concatenate([[0], np.cumsum(kept)])[first], numbers[kept]
    return distinct, numbers, first, data, rows


_KIND = np.zeros(256, np.uint8)  # 1 capital, 2 punctuation, 3 digit, 4 other sign, 5 small letter
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A] = 1, 5, 3
_KIND[list(b".,;:'\"()-!?")] = 2
_KIND[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = 4


def features(column: pa.Array, words: _Words) -> np.ndarray:
    """One row of ``FEATURES`` per text; zeros for a null or empty one."""
    distinct, numbers, first, data, rows = _words(column)
    n = len(column)
    out = np.zeros((n, len(FEATURES)), np.float32)
    if not len(numbers):
        return out
    flags = words.flags(distinct.to_pylist())[numbers]
    totals = np.concatenate([np.zeros((1, flags.shape[1])), np.cumsum(flags, axis=0, dtype=np.float64)])
    begin, end = first[:-1], first[1:]
    count = end - begin
    per = np.maximum(count, 1)
    sums = totals[end] - totals[begin]
    listed = flags[:, :3].any(axis=1) | (flags[:, 6] > 1)
    row_of = np.repeat(np.arange(n), count)
    hits = np.flatnonzero(listed)
    low = np.maximum(hits - NEAR, begin[row_of[hits]])
    high = np.minimum(hits + NEAR + 1, end[row_of[hits]])
    near = np.bincount(row_of[hits][totals[high, 3] > totals[low, 3]], minlength=n)
    strong = np.zeros(n)
    np.maximum.at(strong, row_of, flags[:, 6])
    learned_hits = np.bincount(row_of[flags[:, 6] > 1], minlength=n)
    kinds = _KIND[data]
    size = np.maximum(np.diff(rows), 1)

    def rate(mask: np.ndarray) -> np.ndarray:
        cumulated = np.concatenate([[0], np.cumsum(mask)])
        return (cumulated[rows[1:]] - cumulated[rows[:-1]]) / size

    columns = (
        np.log1p(count), 100 * sums[:, 0] / per, np.log1p(sums[:, 0]), 100 * sums[:, 1] / per, 100 * sums[:, 2] / per,
        100 * sums[:, 6] / per, strong, np.log1p(learned_hits), 100 * sums[:, 3] / per, np.log1p(near),
        100 * sums[:, 4] / per, rate(kinds == 1), rate(kinds == 2), 100 * rate(data == 0x21), 100 * rate(data == 0x3F),
        100 * rate(kinds == 4), 100 * rate(kinds == 3), 100 * sums[:, 5] / per, size / per,
    )
    for k, values in enumerate(columns):
        out[:, k] = values
    out[count == 0] = 0
    return out


@dataclass
class Forest:
    """Trees of depth three as arrays: feature and cut of seven inner nodes, value of eight leaves."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float
    steps_at: np.ndarray
    steps: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        each = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(3):
                node = 2 * node + 1 + (x[each, feature[node]] > cut[node])
            out += leaf[node - 7]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability: linear between the steps of the isotonic fit."""
        return np.clip(np.interp(self.raw(x), self.steps_at, self.steps), 0, 1)


def _grow(x: np.ndarray, y: np.ndarray, trees: int, rate: float, bins: int = 48, least: int = 15):
    """Newton boosting of the logistic loss on binned features."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    raw = np.full(len(y), start)
    width = bins + 1
    flat = binned + np.arange(x.shape[1]) * width
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(7, np.int64), np.full(7, np.inf)
        for level in range(3):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == k)
                best = (1e-6, 0, np.inf, None)
                if len(rows) >= 2 * least:
                    places = flat[rows].ravel()
                    each = x.shape[1]
                    sums = [
                        np.bincount(places, np.repeat(v, each), minlength=each * width).reshape(each, width).cumsum(1)
                        for v in (g[rows], h[rows], np.ones(len(rows)))
                    ]
                    gs, hs, ns = sums
                    gain = gs**2 / (hs + 1) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + 1) - gs[:, -1:] ** 2 / (hs[:, -1:] + 1)
                    gain[(ns < least) | (ns[:, -1:] - ns < least)] = -1
                    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, b] > best[0] and b < len(cuts[f]):
                        best = (gain[f, b], int(f), cuts[f][b], int(b))
                if best[3] is not None:
                    feature[k], cut[k] = best[1], best[2]
                right = x[rows, feature[k]] > cut[k]
                node[rows] = 2 * k + 1 + right
        leaf = np.bincount(node - 7, g, minlength=8) / (np.bincount(node - 7, h, minlength=8) + 1) * rate
        raw += leaf[node - 7]
        all_features.append(feature)
        all_cuts.append(cut)
        all_leaves.append(leaf)
    return np.array(all_features), np.array(all_cuts), np.array(all_leaves), start


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and their means, both ascending."""
    order = np.argsort(x, kind="stable")
    means, sizes, centres = [], [], []
    for at, value in zip(x[order].tolist(), y[order].tolist(), strict=True):
        means.append(value)
        sizes.append(1)
        centres.append(at)
        while len(means) > 1 and means[-2] >= means[-1]:
            n = sizes[-2] + sizes[-1]
            means[-2] = (means[-2] * sizes[-2] + means[-1] * sizes[-1]) / n
            centres[-2] = (centres[-2] * sizes[-2] + centres[-1] * sizes[-1]) / n
            sizes[-2] = n
            means.pop(), sizes.pop(), centres.pop()
    return np.array(centres), np.array(means)


def fit(x: np.ndarray, y: np.ndarray, fold: np.ndarray | None = None, trees: int = 80, rate: float = 0.1) -> Forest:
    """Trees on all given rows, calibrated on predictions of rows left out fold by fold."""
    if not len(y) or y.min() == y.max():
        constant = float(y.mean()) if len(y) else 0.0
        return Forest(*(np.zeros((0, 7)), np.zeros((0, 7)), np.zeros((0, 8))), 0.0, np.array([0.0]), np.array([constant]))
    fold = np.arange(len(y)) % FOLDS if fold is None else fold
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        inside, outside = fold != k, fold == k
        if outside.any() and inside.any():
            raw[outside] = Forest(*_grow(x[inside], y[inside], trees, rate), np.zeros(1), np.zeros(1)).raw(x[outside])
    at, steps = isotonic(raw, y)
    return Forest(*_grow(x, y, trees, rate), at, steps)


def learned_words(rows: DataFrame) -> list[dict[str, float]]:
    """Log-odds of all words that surely speak for label 1, from (text, toxic, fold) rows.

    The first list is learned from all rows, the others from all but those of fold 0, 1 and so on. Fewer
    than five documents of that label are too few for the test of their share.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            distinct, numbers, first, _, _ = _words(piece.column("text"))
            plain: dict[str, int] = {}
            number = np.array(
                [plain.setdefault(plain_word(raw.decode().strip())[0], len(plain)) for raw in distinct.to_pylist()], np.int64
            )
            row_of = np.repeat(np.arange(piece.num_rows), np.diff(first))
            pairs = np.unique(row_of * (len(plain) + 1) + number[numbers]) if len(numbers) else np.empty(0, np.int64)
            row, word = pairs // (len(plain) + 1), pairs % (len(plain) + 1)
            key = word * FOLDS + piece.column("fold").to_numpy(zero_copy_only=False)[row]
            toxic = piece.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[row]
            n = np.bincount(key, minlength=len(plain) * FOLDS)
            ones = np.bincount(key, toxic, minlength=len(plain) * FOLDS).astype(np.int64)
            held = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(plain), pa.string()).take(pa.array(held // FOLDS)), pa.array((held % FOLDS).astype(np.int32)),
                 pa.array(n[held], pa.int64()), pa.array(ones[held])],
                names=["word", "fold", "n", "ones"],
            )

    base = {row["fold"]: (row["n"], row["ones"]) for row in rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("toxic").alias("ones")).collect()}
    counted = rows.mapInArrow(count, "word string, fold int, n long, ones long").where("word != ''")
    of_fold = lambda column, k: F.sum(F.when(F.col("fold") == k, F.col(column)).otherwise(0)).alias(f"{column}{k}")
    counted = counted.groupBy("word").agg(*[of_fold(column, k) for column in ("n", "ones") for k in range(FOLDS)])

    def rise(left_out: int) -> Column:
        """The log-odds of a word if they are sure without one fold (-1: with all), else null."""
        used = [k for k in range(FOLDS) if k != left_out]
        rows_, toxic = (sum(base.get(k, (0, 0))[i] for k in used) for i in (0, 1))
        share = toxic / rows_ if rows_ else 0.0
        if not 0 < share < 1:
            return F.lit(None).cast("double")
        n, ones = (sum(F.col(f"{column}{k}") for k in used) for column in ("n", "ones"))
        odds = F.log((ones + 0.5 * share) / (n - ones + 0.5 * (1 - share))) - F.lit(float(np.log(share / (1 - share))))
        sure = (ones - n * share) / F.sqrt(n * max(share * (1 - share), 1e-9))
        return F.when((ones >= 5) & (sure > 5) & (odds > 1), odds)

    rises = {f"rise{k}": rise(k) for k in range(-1, FOLDS)}
    best = counted.select("word", *[column.alias(name) for name, column in rises.items()])
    best = best.where(F.coalesce(*[F.col(name) for name in rises]).isNotNull()).collect()
    return [{row["word"]: float(row[name]) for row in best if row[name] is not None} for name in rises]


def train(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[Forest, dict[str, float]]:
    """Count words over all labelled rows given; fit trees on at most ``fit_rows`` of them.

    Labelled documents are taken in the order of a hash of the id, then of the features. Rows with one
    id and equal features count once in the trees, however often they come. Labels without a document
    take no place. Texts meet the labels by one kind of join at every size. Without labels of both kinds
    every score is the share of label 1, or zero. Texts are measured whole.
    """
    labelled = (
        labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    met = labelled.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = met.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(FOLDS)), F.lit(FOLDS)).cast("int").alias("fold")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", fold)
    salted = labelled.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("shuffle_hash")
    dealt = texts.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    learned = learned_words(dealt.join(salted, ["doc_id", "salt"]).select("text", "toxic", fold))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [_Words(without) for without in learned[1:]]
        for whole in text_slices(batches):
            of = whole.column("fold").to_numpy(zero_copy_only=False)
            for k in np.unique(of).tolist():
                piece = whole.filter(pa.array(of == k))
                x = features(piece.column("text"), words[k])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), piece.column("toxic"), piece.column("fold"),
                     pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))],
                    names=["doc_id", "toxic", "fold", "x"],
                )

    measured = rows.mapInArrow(measure, "doc_id long, toxic int, fold int, x array<float>").distinct()
    bounded = measured.orderBy(F.xxhash64("doc_id"), "doc_id", "x", "fold").limit(fit_rows)
    table = bounded.toArrow()
    x = table.column("x").combine_chunks()
    x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(np.float64)
    y, fold_of = table.column("toxic").to_numpy().astype(np.float64), table.column("fold").to_numpy()
    return fit(x, y, fold_of), learned[0]


def scored(documents: DataFrame, forest: Forest, learned: dict[str, float], threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, score, predicted (1 if score >= threshold). Null texts score as empty ones.

    Repeated rows are scored as often as they come, an empty table gives no rows, equal scores are equal
    predictions. Texts are measured whole, however long; further columns are not read.
    """
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(learned)
        for piece in text_slices(batches):
            found = forest.score(features(piece.column("text"), words).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").cast(pa.int64()), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return documents.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, predicted int")


def toxicity(documents: DataFrame, labels: DataFrame, held: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Learn from the labelled rows that are not held out; score every row."""
    forest, learned = train(documents.where(~held), labels.where(~held))
    return scored(documents, forest, learned, threshold)
