"""Log-likelihood of whole documents under a gated recurrent network over words.

The output softmax is factored into classes. The most frequent training words, ``HEAD`` of them with
the end of a document, are spread over classes by frequency, and a softmax of the state picks the
word in its class. All other words fall into ``TAIL`` classes by a hash of their last two characters,
inside which a word has its add-one share of the training count; a class keeps one share for any
unseen word. The state picks the class, so each text has one probability.

Training is truncated backpropagation through time in numpy, ``EPOCHS`` times over all training
documents. They are dealt into parts of about ``PART_TOKENS``; in each round every part trains on its
share of the round from common weights, and the parts' weights and moments, whose size is fixed, are
averaged by tokens. Word counts, classes and shares are those of all training documents. In scoring,
many documents are dealt over lanes; a lane runs through its documents in windows, carries its state
from window to window and clears it between documents.

Texts are cut into words once: each block lists its distinct words and keeps its documents as numbers
in that list. The lists are cut into buckets by a hash of the word and travel as packed rows, one for a
block and bucket; each bucket is counted over all blocks, and counts and codes come back to the block's
documents. So no table of all words is ever sent to a task. Training and scoring read the stored codes.
"""

from __future__ import annotations

import heapq
import pickle
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import chunked, pieces, slices, stored, utf8, work_folder

HEAD = 1024
CLASS_WORDS = 32
TAIL = 64
STATE = 24
EPOCHS = 2
ROUNDS = 8
PART_TOKENS = 4_000_000
MERGED = 32
BLOCK_TOKENS = 1_500_000
BLOCKS_A_BUCKET = 2
HASHED = 64
SCORED_TOKENS = 4_000_000
BLOCK_BYTES = 32_000_000
OFTEN = 1000
LANES = 512
WINDOW = 48
ROWS = 640
SCORED_ROWS = 1024
UPDATED = 16_384
MARKED = 16
END = " "  # no word holds a blank
_LN10 = np.log(10)
_BLANKS = " \t\n\x0b\x0c\r"


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in order, and each row's first word."""
    data, rows = utf8(pc.ascii_lower(column))
    blank = np.zeros(256, bool)
    blank[list(_BLANKS.encode())] = True
    blanks = blank[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = blanks[:-1] & ~blanks[1:]
    chunks, numbers, first = chunked(data, rows, cut)
    words = pc.ascii_trim(chunks.cast(pa.large_string()), _BLANKS).dictionary_encode()
    numbers = words.indices.to_numpy(zero_copy_only=False)[numbers] if len(numbers) else numbers
    empty = pc.index(words.dictionary, "").as_py() if len(words.dictionary) else -1
    if empty >= 0:  # blanks before a row's first word
        kept = numbers != empty
        first = np.concatenate([[0], np.cumsum(kept)])[first]
        numbers = numbers[kept]
    return words.dictionary, numbers, first


_PARAMETERS = ("table", "recur", "bias", "classes", "class_bias", "words", "word_bias")


@dataclass
class Network:
    """Weights; codes are head words by rank, then tail classes."""

    head: list[str]
    table: np.ndarray  # code -> inputs of the three gates
    recur: np.ndarray
    bias: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray  # head class -> weights of its words
    word_bias: np.ndarray

    @classmethod
    def fresh(cls, head: list[str], seed: int = 11) -> Network:
        draw = np.random.Generator(np.random.PCG64(seed))
        groups = max(1, -(-len(head) // CLASS_WORDS))
        small = lambda *shape: (draw.standard_normal(shape) * 0.1).astype(np.float32)
        word_bias = np.zeros((groups, CLASS_WORDS), np.float32)
        word_bias.ravel()[len(head):] = -1e9  # places without a word
        return cls(
            head, small(len(head) + TAIL, 3 * STATE), small(STATE, 3 * STATE) * 3, np.zeros(STATE, np.float32),
            small(STATE, groups + TAIL), np.zeros(groups + TAIL, np.float32),
            small(groups, STATE, CLASS_WORDS), word_bias,
        )

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in _PARAMETERS]

    def class_of(self, codes: np.ndarray) -> np.ndarray:
        n = len(self.head)
        return np.where(codes < n, codes // CLASS_WORDS, len(self.words) + codes - n)

    def step(self, inputs: np.ndarray, state: np.ndarray):
        """One step; also what backpropagation needs."""
        across = state @ self.recur
        gates = 1 / (1 + np.exp(-(inputs[:, :2 * STATE] + across[:, :2 * STATE])))
        keep, reset = gates[:, :STATE], gates[:, STATE:]
        inner = across[:, 2 * STATE:] + self.bias
        new = np.tanh(inputs[:, 2 * STATE:] + reset * inner)
        return new + keep * (state - new), keep, reset, inner, new

    def log_probability(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Natural log of class times word, the word's part for head words alone."""
        order, codes, bounds = self._by_class(codes)
        states, group = _with_ones(states).take(order, axis=0), self.class_of(codes)
        weights, small = self._class_weights(), self._small(states)
        found = np.empty(len(codes), states.dtype)
        for at in range(0, len(codes), SCORED_ROWS):  # what a processor's cache holds
            logits = _logits(states[at:at + SCORED_ROWS], weights, small)
            found[at:at + SCORED_ROWS] = _picked(logits, group[at:at + SCORED_ROWS]) - np.log(_exp_sums(logits))
        logits = self._word_logits(states, bounds, small)
        found[:len(logits)] += _picked(logits, codes[:len(logits)] % CLASS_WORDS) - np.log(_exp_sums(logits))
        out = np.empty_like(found)
        out[order] = found
        return out

    def _by_class(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order that puts the codes of a class together, the codes in it, and where head classes begin."""
        order = np.argsort(codes.astype(np.int16), kind="stable")
        codes = codes[order]
        firsts = np.minimum(np.arange(len(self.words) + 1) * CLASS_WORDS, len(self.head))
        return order, codes, np.searchsorted(codes, firsts)

    def _class_weights(self) -> np.ndarray:
        return np.vstack([self.classes, self.class_bias])

    def _small(self, states: np.ndarray) -> bool:
        """Whether the weights are so small that no such state's exponentials overflow or all vanish."""
        most = max(float(states.max()), -float(states.min())) if len(states) else 0
        for weights, bias in ((self.classes, self.class_bias), (self.words, self.word_bias)):
            reach = np.abs(weights).sum(axis=-2) * most
            if not ((bias + reach).max() < 60 and (bias - reach).max(axis=-1).min() > -60):
                return False
        return True

    def _word_logits(self, states: np.ndarray, bounds: np.ndarray, small: bool) -> np.ndarray:
        """For the states of head words, ordered by class: the logits of the words of their class."""
        weights = np.concatenate([self.words, self.word_bias[:, None]], axis=1)
        logits = np.empty((bounds[-1], CLASS_WORDS), np.result_type(states, weights))
        for k, low, high in _filled(bounds):
            np.matmul(states[low:high], weights[k], out=logits[low:high])
        return _shifted(logits, small)


def _with_ones(states: np.ndarray) -> np.ndarray:
    """States, by row, with a one behind each, which stands for the bias."""
    out = np.ones((*states.shape[:-1], STATE + 1), states.dtype)
    out[..., :STATE] = states
    return out.reshape(-1, STATE + 1)


def _logits(states: np.ndarray, weights: np.ndarray, small: bool) -> np.ndarray:
    return _shifted(states @ weights, small)


def _filled(bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """The number and the bounds of each part that is not empty."""
    ends = bounds.tolist()
    return [(k, low, high) for k, (low, high) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if low < high]


def _shifted(logits: np.ndarray, small: bool) -> np.ndarray:
    """Logits whose exponentials neither overflow nor all vanish: less their maximum, unless they are small."""
    if len(logits) and not small:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _picked(rows: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return rows.ravel()[np.arange(len(rows)) * rows.shape[1] + chosen]


def _exp_sums(logits: np.ndarray) -> np.ndarray:
    """Sums of the exponentials of each row; these take the place of the logits."""
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], logits.dtype)


def _output_gradient(logits: np.ndarray, chosen: np.ndarray, share: float) -> np.ndarray:
    """The scale of each row of the gradient; the rows without it take the place of the logits."""
    sums = _exp_sums(logits)
    logits.ravel()[np.arange(len(logits)) * logits.shape[1] + chosen] -= sums
    return (share / sums)[:, None]


@dataclass
class Moments:
    """Running first and second moments of the gradients, one array a parameter."""

    first: list[np.ndarray]
    second: list[np.ndarray]
    updates: int = 0

    @classmethod
    def fresh(cls, network: Network) -> Moments:
        return cls(*([np.zeros_like(p) for p in network.parameters()] for _ in range(2)))


def learn(
    network: Network, moments: Moments, codes: np.ndarray, end: int, begin: float = 0.0, finish: float = 1.0,
    lanes: int = 128, window: int = 20, rate: float = 6e-3,
) -> None:
    """One pass over the codes, from the share ``begin`` of the whole training to ``finish``.

    Lanes of equal length cover every code; where the length does not divide, neighbours share some.
    """
    before = np.concatenate([[end], codes[:-1]])  # a document's first input is the end of another
    lanes = max(1, min(lanes, len(codes) // (2 * window)))
    length = -(-len(codes) // lanes)
    starts = np.arange(lanes) * (len(codes) - length) // max(1, lanes - 1)
    places = starts + np.arange(length)[:, None]
    state = np.zeros((lanes, STATE), np.float32)
    # all parameters in one array, and so their moments: an update is a few passes over them
    p, first, second = (_flat(arrays) for arrays in (network.parameters(), moments.first, moments.second))
    trained = replace(network, **dict(zip(_PARAMETERS, _parts(p, network.parameters()), strict=True)))
    slope, part = np.empty_like(p), np.empty_like(p)
    for at in range(0, length, window):
        some = places[at:at + window]
        gradients, state = _window_gradients(trained, before[some], codes[some], state, end)
        np.concatenate([g.ravel() for g in gradients], out=slope)
        size = float(np.sqrt(slope @ slope))
        scale = min(1.0, 1.0 / size) if size else 1.0
        moments.updates += 1
        pace = rate * (1 - 0.9 * (begin + (finish - begin) * at / length))
        first_part, second_part = 1 - 0.9**moments.updates, 1 - 0.995**moments.updates
        for low in range(0, len(p), UPDATED):  # what a processor's cache holds
            some = slice(low, low + UPDATED)
            _updated(p[some], first[some], second[some], slope[some], part[some], scale, pace / first_part, second_part)
    for old, new in ((network.parameters(), p), (moments.first, first), (moments.second, second)):
        for array, values in zip(old, _parts(new, old), strict=True):
            array[...] = values


def _updated(p, first, second, slope, part, scale: float, pace: float, second_part: float) -> None:
    """Move parameters by their moments, in place; ``slope`` and ``part`` are used up."""
    np.multiply(slope, 0.1 * scale, out=part)
    first *= 0.9
    first += part
    slope *= slope
    slope *= 0.005 * scale**2
    second *= 0.995
    second += slope
    np.sqrt(second, out=part)
    part += 1e-8 * second_part**0.5
    np.divide(first, part, out=part)
    part *= pace * second_part**0.5
    p -= part


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([array.ravel() for array in arrays])


def _parts(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    """Views of one array in the shapes of others."""
    ends = np.cumsum([array.size for array in like])
    return [flat[end - array.size:end].reshape(array.shape) for end, array in zip(ends, like, strict=True)]


def fit(network: Network, texts: list[np.ndarray], end: int, epochs: int = EPOCHS, lanes: int = 128, window: int = 20, rate: float = 6e-3) -> Network:
    """Truncated backpropagation over code sequences, each of which ends in the code ``end``."""
    codes = np.concatenate([np.empty(0, np.int64), *texts])
    moments = Moments.fresh(network)
    for k in range(epochs if len(codes) else 0):
        learn(network, moments, codes, end, k / epochs, (k + 1) / epochs, lanes, window, rate)
    return network


def _window_gradients(network: Network, x: np.ndarray, y: np.ndarray, state: np.ndarray, end: int):
    """Gradients over a window (steps, lanes) and the state behind it.

    Inside, a state has a column a lane, so each gate is a block of rows, and a last row of ones that
    stands for the bias. Only what needs the next state is worked out step by step.
    """
    steps, lanes = x.shape
    kind = network.table.dtype
    both = 2 * STATE
    opened = (x != end).astype(kind)[:, None]
    entered, gates, inner, new, left = _run(network, x, state, opened)

    order, codes, bounds = network._by_class(y.ravel())
    states, share = _with_ones(left.transpose(0, 2, 1)).take(order, axis=0), kind.type(1 / lanes)
    weights, small = network._class_weights(), network._small(states)
    group, back = network.class_of(codes), np.ascontiguousarray(network.classes.T)
    d_classes, d_ordered = np.zeros((STATE + 1, back.shape[0]), kind), np.empty((len(codes), STATE), kind)
    for at in range(0, len(codes), ROWS):  # what a processor's cache holds
        some = states[at:at + ROWS]
        by_class = _logits(some, weights, small)
        scale = _output_gradient(by_class, group[at:at + ROWS], share)
        d_classes += (some * scale).T @ by_class
        np.multiply(by_class @ back, scale, out=d_ordered[at:at + ROWS])
    by_word = network._word_logits(states, bounds, small)
    scale = _output_gradient(by_word, codes[:len(by_word)] % CLASS_WORDS, share)
    scaled, d_inside = states[:len(by_word)] * scale, np.empty((len(by_word), STATE), kind)
    d_words = np.zeros((len(network.words), STATE + 1, CLASS_WORDS), kind)
    for k, low, high in _filled(bounds):
        np.matmul(scaled[low:high].T, by_word[low:high], out=d_words[k])
        np.matmul(by_word[low:high], network.words[k].T, out=d_inside[low:high])
    d_inside *= scale
    d_ordered[:len(by_word)] += d_inside
    back_to = np.empty_like(order)
    back_to[order] = np.arange(len(order))
    d_states = d_ordered.take(back_to, axis=0).reshape(steps, lanes, STATE)
    d_states = np.ascontiguousarray(d_states.transpose(0, 2, 1))

    keep, reset = gates[:, :STATE], gates[:, STATE:]
    shut = 1 - gates
    to_new = new * new
    np.subtract(1, to_new, out=to_new)
    to_new *= shut[:, :STATE]
    d_gates = np.empty((steps, 3, STATE, lanes), kind)  # first of a state's gates and inner part by the state
    np.subtract(entered[:, :STATE], new, out=d_gates[:, 0])
    d_gates[:, 0] *= keep
    d_gates[:, 0] *= shut[:, :STATE]
    np.multiply(to_new, reset, out=d_gates[:, 2])
    np.multiply(d_gates[:, 2], inner, out=d_gates[:, 1])
    d_gates[:, 1] *= shut[:, STATE:]
    keep *= opened
    ahead, through = np.zeros((STATE, lanes), kind), np.empty((STATE, lanes), kind)
    for t in reversed(range(steps)):
        d, by_gate = d_states[t], d_gates[t]
        d += ahead
        by_gate *= d
        np.matmul(network.recur, by_gate.reshape(3 * STATE, lanes), out=through)
        through *= opened[t]
        np.multiply(d, keep[t], out=ahead)
        ahead += through
    rows = np.ascontiguousarray(d_gates.reshape(steps, 3 * STATE, lanes).transpose(0, 2, 1))
    flat = rows.reshape(steps * lanes, 3 * STATE)
    d_recur = entered.transpose(1, 0, 2).reshape(STATE + 1, steps * lanes) @ flat
    d_states *= to_new
    rows[:, :, both:] = d_states.transpose(0, 2, 1)
    d_table = _summed(x.ravel(), flat, len(network.table))
    return [
        d_table, d_recur[:STATE], d_recur[STATE, both:], d_classes[:STATE], d_classes[STATE], d_words[:, :STATE], d_words[:, STATE],
    ], left[-1].T


def _run(
    network: Network, x: np.ndarray, state: np.ndarray, opened: np.ndarray, learning: bool = True
) -> tuple[np.ndarray, ...]:
    """``Network.step`` over a window (steps, lanes): what each step enters with, its gates, its inner
    part, the new state it offers and the one it leaves. Only the last are kept if not ``learning``."""
    steps, lanes = x.shape
    kind = network.table.dtype
    both = 2 * STATE
    sign = np.repeat(np.array([-1, 1], kind), [both, STATE])  # both gates go into an exponential
    table = network.table * sign
    recur = np.zeros((3 * STATE, STATE + 1), kind)
    recur[:, :STATE] = (network.recur * sign).T
    recur[both:, STATE] = network.bias
    kept = steps if learning else 1
    entered, across = np.ones((kept, STATE + 1, lanes), kind), np.empty((kept, 3 * STATE, lanes), kind)
    new, left = (np.empty((size, STATE, lanes), kind) for size in (kept, steps))
    state = state.T
    for t in range(steps):
        at = t % kept
        before = np.multiply(state, opened[t], out=entered[at, :STATE])
        np.matmul(recur, entered[at], out=across[at])
        gate, inner, offered = across[at, :both], across[at, both:], table.take(x[t], axis=0).T
        gate += offered[:both]
        np.exp(gate, out=gate)
        gate += 1
        np.reciprocal(gate, out=gate)
        fresh = np.multiply(gate[STATE:], inner, out=new[at])
        fresh += offered[both:]
        np.tanh(fresh, out=fresh)
        state = np.subtract(before, fresh, out=left[t])
        state *= gate[:STATE]
        state += fresh
    return entered, across[:, :both], across[:, both:], new, left


def _summed(codes: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sums of rows by code: products with marks of the code's place among ``MARKED`` neighbours."""
    parts = -(-count // MARKED)
    out = np.zeros((parts * MARKED, rows.shape[1]), rows.dtype)
    order = np.argsort(codes.astype(np.int16), kind="stable")
    codes, rows = codes[order], rows.take(order, axis=0)
    marks = (codes % MARKED == np.arange(MARKED)[:, None]).astype(rows.dtype)
    for k, low, high in _filled(np.searchsorted(codes, np.arange(parts + 1) * MARKED)):
        np.matmul(marks[:, low:high], rows[low:high], out=out[k * MARKED:(k + 1) * MARKED])
    return out[:count]


def document_logs(network: Network, codes: np.ndarray, starts: np.ndarray, end: int, lanes: int = LANES) -> np.ndarray:
    """Natural log of the codes' probability per document; ``starts`` are the documents' bounds."""
    lengths = np.diff(starts)
    loads = [(0, lane) for lane in range(min(lanes, len(lengths)))]
    owned: list[list[int]] = [[] for _ in loads]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        load, lane = heapq.heappop(loads)
        owned[lane].append(doc)
        heapq.heappush(loads, (load + int(lengths[doc]), lane))
    rows = [np.concatenate([np.arange(starts[doc], starts[doc + 1]) for doc in docs]) for docs in owned]
    rows.sort(key=len, reverse=True)
    sizes = np.array([len(row) for row in rows])
    out = np.zeros(len(codes))
    state = np.zeros((len(rows), STATE), np.float32)
    before = np.empty(len(codes), np.int64)
    before[1:] = codes[:-1]
    before[starts[:-1]] = end
    for at in range(0, int(sizes[0]), WINDOW):
        active = int((sizes > at).sum())
        places = np.full((WINDOW, active), -1)
        for lane in range(active):
            part = rows[lane][at:at + WINDOW]
            places[:len(part), lane] = part
        places = places[:min(WINDOW, int(sizes[0]) - at)]
        x = before[places]
        left = _run(network, x, state[:active], (x != end).astype(np.float32)[:, None], learning=False)[-1]
        state[:active] = left[-1].T
        inside = np.flatnonzero(places.ravel() >= 0)  # a lane that ends here does not go on
        wanted, states = places.ravel(), left.transpose(0, 2, 1).reshape(-1, STATE)
        if len(inside) < len(wanted):
            wanted, states = wanted[inside], states[inside]
        out[wanted] = network.log_probability(states, codes[wanted])
    return np.add.reduceat(out, starts[:-1]) if len(lengths) else np.empty(0)


_PACKED = (
    "block long, bucket int, first long, words binary, counts binary, "
    "doc_id long, training boolean, key long, n long, numbers binary"
)
_NUMBERED = "block long, number long, word string, n long, doc_id long, training boolean, key long, numbers binary"
_COUNTED = (
    "block long, bucket int, first long, counts binary, marks binary, word string, place int, k int, c long, v long"
)


def _packed(rows: DataFrame, buckets: int) -> DataFrame:
    """Per block: its distinct words by bucket, one row a bucket, with their training counts, the end of
    a document among them, and its rows as the numbers of their words. A bucket's words are numbered from
    ``first``; a word's bucket is a hash of its bytes, so blocks agree on it."""
    def pack(key: tuple, given: pa.Table) -> pa.Table:
        words, numbers, first = words_of(given.column("text").combine_chunks())
        times, training = given.column("n").to_numpy(), given.column("training").to_numpy()
        weights = np.where(training, times, 0)
        counted = np.bincount(numbers, np.repeat(weights, np.diff(first)), minlength=len(words))
        counted = np.append(counted, weights.sum()).astype(np.int64)
        numbers, bounds = _with_ends(numbers, first, len(words))
        words = pa.concat_arrays([words.cast(pa.large_string()), pa.array([END], pa.large_string())])
        bucket = _bucket_of(words, buckets)
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        data, ends = utf8(pc.binary_join_element_wise(words.take(pa.array(order)), *(pa.scalar(x, words.type) for x in ("", "\n"))))
        filled, cuts = np.unique(bucket[order], return_index=True)
        cuts = np.append(cuts, len(order))
        listed, texts = len(filled), given.num_rows
        block = key[0].as_py()
        return pa.concat_tables([
            _rows(_PACKED, listed, block=np.full(listed, block), bucket=filled.astype(np.int32), first=cuts[:-1],
                  words=_binary(data, ends[cuts]), counts=_binary(counted[order], cuts)),
            _rows(_PACKED, texts, block=np.full(texts, block), doc_id=given.column("doc_id"), training=given.column("training"),
                  key=given.column("key"), n=times, numbers=_binary(number[numbers], bounds)),
        ])

    return rows.groupBy("block").applyInArrow(pack, _PACKED)


def _numbered(rows: DataFrame) -> DataFrame:
    """The packed rows with a row a word: a row of the result is a word of a block or one of its texts."""
    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["words"] is None:
                    out = {name: [row[name]] for name in ("block", "n", "doc_id", "training", "key", "numbers")}
                else:
                    words = row["words"].decode().split("\n")[:-1]
                    numbers = range(row["first"], row["first"] + len(words))
                    out = {"block": [row["block"]] * len(words), "number": numbers, "word": words, "n": np.frombuffer(row["counts"], np.int64)}
                yield from _rows(_NUMBERED, len(out["block"]), **out).to_batches()

    return _packed(rows, 2).mapInArrow(unpack, _NUMBERED)


_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
}


def _rows(schema: str, count: int, **columns) -> pa.Table:
    """A table of the schema; columns that are not given are null."""
    kinds = {name: _KINDS[kind] for name, kind in (part.split() for part in schema.split(","))}
    given = {
        name: columns[name] if isinstance(columns.get(name), pa.Array | pa.ChunkedArray)
        else pa.array(columns[name], kind) if name in columns else pa.nulls(count, kind)
        for name, kind in kinds.items()
    }
    return pa.table({name: column.cast(kinds[name]) for name, column in given.items()})


def _bucket_of(words: pa.Array, buckets: int) -> np.ndarray:
    """A number below ``buckets`` for each word, by a sum of its first bytes, weighted by their places."""
    out, factors = [], np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, HASHED, np.uint64)
    for at in range(0, len(words), 1 << 16):
        data, starts = utf8(pc.binary_slice(words.slice(at, 1 << 16).cast(pa.large_binary()), 0, HASHED).cast(pa.large_string(), safe=False))
        places = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
        sums = np.add.reduceat((data + np.uint64(1)) * factors[places], starts[:-1])  # no word is empty
        sums ^= sums >> np.uint64(32)
        out.append((sums * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets))
    return np.concatenate(out).astype(np.int64)


def _tail_of(words: pa.Array) -> np.ndarray:
    """The tail class of each word, from its last two characters; words end in a line feed here."""
    ends = pc.utf8_slice_codeunits(words, -3, -1).dictionary_encode()
    found = np.array([zlib.crc32(end.encode()) % TAIL for end in ends.dictionary.to_pylist()], np.int32)
    return found[ends.indices.to_numpy()]


def _counted_bucket(given: pa.Table) -> pa.Table:
    """The words of a bucket, counted over all blocks.

    For each block the counts of its words and their marks: the tail class, and for the ``HEAD`` most
    frequent words of the bucket, which follow as rows, ``TAIL`` times their place and one. The end of a
    document is always among these. The last rows are the sums of each tail class.
    """
    data, _ = _values(given.column("words"), np.uint8)
    ends = np.append(0, np.flatnonzero(data == ord("\n")) + 1)
    words = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    numbers, words = words.indices.to_numpy(), words.dictionary
    counts, bounds = _values(given.column("counts"), np.int64)
    c = np.bincount(numbers, counts, minlength=len(words)).astype(np.int64)
    k = _tail_of(words)
    is_end = pc.equal(words, END + "\n").to_numpy(zero_copy_only=False)
    first = np.where(is_end, np.iinfo(np.int64).max, c)
    least = max(1, np.partition(first, -HEAD)[-HEAD] if len(first) > HEAD else 1)
    some = np.flatnonzero(first >= least)
    said = pc.ascii_rtrim(words.take(pa.array(some)), "\n")
    order = pc.sort_indices(pa.table({"c": first[some], "word": said}), [("c", "descending"), ("word", "ascending")])[:HEAD]
    best = some[order.to_numpy()]
    marks = k.copy()
    marks[best] += TAIL * np.arange(1, len(best) + 1, dtype=np.int32)
    bucket = given.column("bucket")[0].as_py()
    live = k[c > 0]
    return pa.concat_tables([
        _rows(_COUNTED, given.num_rows, block=given.column("block"), bucket=given.column("bucket"), first=given.column("first"),
              counts=_binary(c[numbers], bounds), marks=_binary(marks[numbers], bounds)),
        _rows(_COUNTED, len(best), bucket=np.full(len(best), bucket), word=said.take(order), place=np.arange(len(best)), k=k[best], c=c[best]),
        _rows(_COUNTED, TAIL, k=np.arange(TAIL), c=np.bincount(k, c, minlength=TAIL).astype(np.int64), v=np.bincount(live, minlength=TAIL)),
    ])


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Lists of numbers as bytes."""
    offsets = (values.itemsize * bounds).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array | pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers from bytes: all numbers and the bounds of each list."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
    whole = b"".join(value.as_buffer() for value in column)
    return np.frombuffer(whole, kind), np.concatenate([[0], np.cumsum(lengths)])


def _block_count(documents: DataFrame) -> int:
    """Blocks by tokens, an end for each row among them, or by bytes: whichever takes more."""
    words = F.col("text")
    for blank in _BLANKS:
        words = F.replace(words, F.lit(blank), F.lit(""))
    blanks = F.octet_length("text") - F.octet_length(words)
    size = documents.agg(F.sum(blanks + 1).alias("tokens"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    return max(pieces(size["tokens"] or 0, BLOCK_TOKENS), pieces(size["bytes"] or 0, BLOCK_BYTES))


def _dealt(documents: DataFrame, blocks: int | None = None) -> DataFrame:
    """Rows with a block by id and text and the number of rows they stand for.

    A row that comes more than ``OFTEN`` times, and in more than one of 100,000 rows, becomes one;
    so at most 100,000 keys are broadcast.
    """
    blocks = F.lit(blocks or _block_count(documents))
    keyed = documents.withColumn("key", F.xxhash64("doc_id", "text"))
    counted = stored(keyed.groupBy("key").count().where(F.col("count") > OFTEN), "lm-often")
    least = keyed.count() // 100_000 if counted.head(1) else 0
    often = counted.where(F.col("count") > least).select("key")
    rows = keyed.withColumn("n", F.lit(1).cast("long"))
    if often.head(1):
        one = keyed.join(F.broadcast(often), "key", "left_semi").groupBy(*keyed.columns).agg(F.count("*").alias("n"))
        rows = rows.join(F.broadcast(often), "key", "left_anti").unionByName(one)
    return rows.withColumn("block", F.pmod("key", blocks))


def scored(documents: DataFrame, held: Column) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Learns from the rows that are not held out. A null or empty text is one end token. Without any
    training row all counts are zero and the base score is zero. Repeated rows count each time.
    """
    documents = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        (~held).alias("training"),
    )
    spark, blocks = documents.sparkSession, _block_count(documents)
    folder = work_folder(spark, "lm-numbers")
    _packed(_dealt(documents, blocks), pieces(blocks, BLOCKS_A_BUCKET)).write.option("compression", "zstd").parquet(folder)
    packed = spark.read.schema(_PACKED).parquet(folder)
    counting = work_folder(spark, "lm-counts")
    lexicon = packed.where("words IS NOT NULL").select("block", "bucket", "first", "words", "counts")
    lexicon.groupBy("bucket").applyInArrow(_counted_bucket, _COUNTED).write.option("compression", "zstd").parquet(counting)
    counted = spark.read.schema(_COUNTED).parquet(counting)
    tails = {
        row["k"]: (row["n"], row["v"])
        for row in counted.where("v IS NOT NULL").groupBy("k").agg(F.sum("c").alias("n"), F.sum("v").alias("v")).collect()
    }
    tokens, distinct = (sum(values) for values in zip((0, 0), *tails.values(), strict=True))
    frequent = counted.where("word IS NOT NULL").select("word", "bucket", "place", "k", "c")
    best = frequent.where((F.col("word") != END) & (F.col("c") > 0)).orderBy(F.desc("c"), "word").limit(HEAD - 1).collect()
    best = [*frequent.where(F.col("word") == END).collect(), *best]
    head = [END, *(row["word"] for row in best[1:])]
    for row in best:
        n, v = tails[row["k"]]
        tails[row["k"]] = n - row["c"], v - (row["c"] > 0)
    ranks = {row["bucket"] * HEAD + row["place"]: rank for rank, row in enumerate(best)}
    known = counted.where("block IS NOT NULL").select(F.col("block").alias("of"), "bucket", "first", "counts", "marks")
    texts = packed.where("words IS NULL").select("block", "doc_id", "training", "key", "n", "numbers")

    def encode(key: tuple, texts: pa.Table, words: pa.Table) -> pa.Table:
        return _coded_block(len(head), ranks, tails, tokens, distinct, texts, words)

    coded = stored(
        texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
            encode,
            "doc_id long, training boolean, n long, place long, n_tokens long, n_known long, base double, rest double, codes binary",
        ),
        "lm-codes",
    )
    _deleted(documents, folder)
    _deleted(documents, counting)
    network = _fitted(coded.where("training"), head, tokens)
    held_model = documents.sparkSession.sparkContext.broadcast(pickle.dumps(network))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(held_model.value)
        for some in _gathered(batches):
            yield from _scored_rows(model, tokens, some).to_batches()

    return coded.mapInArrow(
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of several batches together, of ``SCORED_TOKENS`` or one row: with many documents at a time
    a long one holds up the others little."""
    held, size = [], 0
    for batch in batches:
        for piece in slices(batch, "codes", 2 * SCORED_TOKENS):
            more = pc.sum(piece.column("n_tokens")).as_py() or 0
            if held and size + more > SCORED_TOKENS:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(piece)
            size += more
    if held:
        yield pa.Table.from_batches(held)


def _with_ends(numbers: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Put an end behind each row's words; also the new bounds."""
    return np.insert(numbers, first[1:], end), first + np.arange(len(first))


def _fitted(training: DataFrame, head: list[str], tokens: int) -> Network:
    """Train on all rows given: rounds of training in every part, weights averaged after each.

    The encoded rows are stored by round, dealt by a hash of id and text into parts and rounds; repeated
    rows go to different parts. A round passes over its share of each part.
    """
    network = Network.fresh(head)
    if not tokens:
        return network
    moments = Moments.fresh(network)
    parts = pieces(tokens, PART_TOKENS)
    rounds = min(ROUNDS, parts)
    spark = training.sparkSession
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")
    dealt = F.coalesce(F.try_add("place", "copy"), F.col("copy"))
    part = F.pmod(dealt, F.lit(parts))
    turn = F.pmod(F.call_function("div", dealt - F.pmod(dealt, F.lit(parts)), F.lit(parts)), F.lit(rounds))
    coded = training.select("place", "codes", copy).select(
        part.alias("part"), turn.cast("int").alias("round"), "place", "codes"
    ).repartition(parts, "part")
    folder = work_folder(spark, "lm-rounds")
    coded.sortWithinPartitions("round", "part", "place").write.partitionBy("round").parquet(folder)
    coded = spark.read.schema(coded.schema).parquet(folder)
    for k in range(EPOCHS * rounds):
        network, moments = _round(
            coded.where(F.col("round") == k % rounds).select("part", "codes"), parts, network, moments,
            k / (EPOCHS * rounds), (k + 1) / (EPOCHS * rounds),
        )
    _deleted(training, folder)
    return network


def _deleted(rows: DataFrame, folder: str) -> None:
    """Take a work folder away that no plan reads any more."""
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _repeats(values: np.ndarray) -> np.ndarray:
    """How often each value has come before in the array."""
    order = np.argsort(values, kind="stable")
    new = np.ones(len(values), bool)
    new[1:] = np.diff(values[order]) != 0
    out = np.empty(len(values), np.int64)
    every = np.arange(len(values))
    out[order] = every - np.maximum.accumulate(np.where(new, every, 0))
    return out


_WEIGHTS = "part long, tokens long, updates long, weights binary"


def _weights(part: int, tokens: int, updates: int, arrays: list[np.ndarray]) -> dict:
    return {"part": [part], "tokens": [tokens], "updates": [updates], "weights": [pickle.dumps(arrays)]}


def _merged(tokens: list[int], updates: list[int], weights: Iterable[bytes]) -> tuple[int, int, list[np.ndarray]]:
    """The mean of weights, by tokens."""
    total, mean = sum(tokens), None
    for n, held in zip(tokens, weights, strict=True):
        arrays = [x * (n / total) for x in pickle.loads(held)]
        mean = arrays if mean is None else [a + b for a, b in zip(mean, arrays, strict=True)]
    return total, max(updates), mean


def _round(
    coded: DataFrame, parts: int, network: Network, moments: Moments, begin: float, finish: float
) -> tuple[Network, Moments]:
    """Each part trains from the given weights on its rows; then the parts are averaged as a tree."""
    head, count = network.head, len(network.parameters())
    now = coded.sparkSession.sparkContext.broadcast(pickle.dumps((network, moments)))

    def train(part: int, texts: list[np.ndarray]) -> pa.RecordBatch:
        own, its = pickle.loads(now.value)
        codes = np.concatenate(texts).astype(np.int64)
        learn(own, its, codes, 0, begin, finish)
        return pa.RecordBatch.from_pydict(_weights(part, len(codes), its.updates, [*own.parameters(), *its.first, *its.second]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, texts = -1, []
        for batch in batches:
            for number, codes in zip(batch.column("part").to_pylist(), batch.column("codes"), strict=True):
                if number != part and texts:
                    yield train(part, texts)
                    texts = []
                part = number
                texts.append(np.frombuffer(codes.as_buffer(), np.int16))
        if texts:
            yield train(part, texts)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("part", "ascending"), ("tokens", "ascending")])
        columns = (rows.column(name).to_pylist() for name in ("tokens", "updates", "weights"))
        return pa.table(_weights(key[0].as_py(), *_merged(*columns)))

    trained = coded.mapInArrow(run, _WEIGHTS)
    while parts > MERGED:
        parts = pieces(parts, MERGED)
        above = trained.withColumn("above", F.floor(F.col("part") / MERGED))
        trained = above.groupBy("above").applyInArrow(merge, _WEIGHTS)
    rows = trained.collect()
    now.destroy()
    if not rows:
        return network, moments
    rows.sort(key=lambda row: (row["part"], row["tokens"]))
    _, updates, mean = _merged(*([row[name] for row in rows] for name in ("tokens", "updates", "weights")))
    mean = [x.astype(np.float32) for x in mean]
    return Network(head, *mean[:count]), Moments(mean[count:2 * count], mean[2 * count:], updates)


def _coded_block(
    head: int, ranks: dict, shares: dict, tokens: int, distinct: int, texts: pa.Table, known: pa.Table
) -> pa.Table:
    """A block's rows as codes, with what their scores owe to the counts alone.

    ``ranks``: of the head words, by their bucket and their place among its most frequent words.
    """
    known = known.sort_by("first")
    counts, bounds = _values(known.column("counts"), np.int64)
    marks, _ = _values(known.column("marks"), np.int32)
    codes = (head + marks % TAIL).astype(np.int16)
    some = np.flatnonzero(marks >= TAIL)
    bucket = np.repeat(known.column("bucket").to_numpy().astype(np.int64), np.diff(bounds))[some]
    places, order = np.unique(np.fromiter(ranks, np.int64, len(ranks)), return_index=True)
    wanted = bucket * HEAD + marks[some] // TAIL - 1
    found = np.searchsorted(places, wanted).clip(max=max(0, len(places) - 1))
    hit = places[found] == wanted if len(places) else np.zeros(len(some), bool)
    codes[some[hit]] = np.fromiter(ranks.values(), np.int16, len(ranks))[order[found[hit]]]
    tail = np.zeros(len(codes))
    rare = np.flatnonzero(codes >= head)
    sums = np.array([sum(shares.get(k, (0, 0))) + 1 for k in range(TAIL)], np.float64)
    tail[rare] = np.log((counts[rare] + 1) / sums[codes[rare] - head])
    base = np.log10((counts + 1) / (tokens + distinct + 1))
    numbers, bounds = _values(texts.column("numbers"), np.int32)
    per_row = lambda values: np.add.reduceat(values[numbers], bounds[:-1])
    place = texts.column("key").to_numpy()
    return pa.table({
        "doc_id": texts.column("doc_id"),
        "training": texts.column("training"),
        "n": texts.column("n"),
        "place": pa.array(place + _repeats(place)),
        "n_tokens": pa.array(np.diff(bounds)),
        "n_known": pa.array(per_row((counts > 0).astype(np.int64))),
        "base": pa.array(per_row(base)),
        "rest": pa.array(per_row(tail)),
        "codes": _binary(codes[numbers], bounds),
    })


def _scored_rows(network: Network, tokens: int, rows: pa.Table) -> pa.Table:
    codes, bounds = _values(rows.column("codes"), np.int16)
    logs = document_logs(network, codes.astype(np.int64), bounds, 0)
    return pa.table({
        "doc_id": rows.column("doc_id"),
        "held_out": pc.invert(rows.column("training")),
        "n_tokens": rows.column("n_tokens"),
        "n_known": rows.column("n_known"),
        "train_tokens": pa.array(np.full(rows.num_rows, tokens, np.int64)),
        "base_score": rows.column("base"),
        "score": pa.array((logs + rows.column("rest").to_numpy()) / _LN10),
    }).take(pa.array(np.repeat(np.arange(rows.num_rows), rows.column("n").to_numpy())))
