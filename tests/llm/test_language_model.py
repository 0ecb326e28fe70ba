from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlane.llm import language_model as lm
from ledgerlane.llm.common import held_out


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def base(rows, training):
    counts = collections.Counter(t for (doc_id, text), on in zip(rows, training) if on for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        ts = tokens(text)
        out.append((doc_id, len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)))
    return out


def check(frame, held, training, least_gain=None):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    want = base(rows, training(rows))
    found = [tuple(r) for r in lm.scored(frame, held).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[-1])
    got = sorted(((r[0], r[2], r[3], r[4], r[5]) for r in found), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) <= 1e-6 * max(1, abs(b[4]))
    assert all(math.isfinite(r[6]) and r[6] <= 1e-9 for r in found)
    return found


def test_sample(given):
    fold = lambda rows: [zlib.crc32(str(r[0]).encode()) % 7 != 2 for r in rows]
    found = check(given("documents"), held_out("doc_id", 7, 2), fold)
    assert {r[0] for r in found if r[1]} == {r[0] for r in found if zlib.crc32(str(r[0]).encode()) % 7 == 2}
    unseen = [r for r in found if r[1]]
    assert sum(r[6] for r in unseen) > sum(r[5] for r in unseen)


def test_odd_rows_and_many_blocks(docs, odd_rows, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 5000)
    check(docs(*odd_rows), F.lit(False), lambda rows: [True] * len(rows))


def test_nothing_to_learn_from(docs):
    found = lm.scored(docs((1, "a b"), (2, None)), F.lit(True)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert lm.scored(docs((1, "a")).limit(0), F.lit(False)).collect() == []


def test_words_of():
    words, numbers, first = lm.words_of(pa.array(["  A b\tA", None, "\n ", "É c\x0bÉ"]))
    said = words.take(pa.array(numbers)).to_pylist()
    assert [said[a:b] for a, b in zip(first[:-1], first[1:])] == [["a", "b", "a"], [], [], ["É", "c", "É"]]


@pytest.fixture
def network():
    found = lm.Network.fresh([f"w{k}" for k in range(70)])
    found.class_bias[:] = np.random.default_rng(0).standard_normal(len(found.class_bias))
    return found


def test_probabilities_add_up_to_one(network):
    """Over all head words and all tail classes, whose words share the class by counts."""
    states = np.random.default_rng(1).standard_normal((3, lm.STATE)).astype(np.float32)
    codes = np.arange(len(network.head) + lm.TAIL)
    for state in states:
        logs = network.log_probability(np.repeat(state[None], len(codes), 0), codes)
        assert abs(np.exp(logs).sum() - 1) < 1e-4


def slow_logs(network, codes):
    state, before, total = np.zeros((1, lm.STATE), np.float32), 0, 0.0
    for code in codes:
        state = network.step(network.table[[before]], state if before != 0 else state * 0)[0]
        total += float(network.log_probability(state.copy(), np.array([code]))[0])
        before = code
    return total


@pytest.mark.parametrize("lanes", [1, 2, 5, 64])
def test_lanes_and_windows_do_not_change_a_document(network, lanes):
    draw = np.random.default_rng(2)
    docs = [np.append(draw.integers(1, 100, n), 0) for n in (0, 3, 200, 47, 48, 1, 95)]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    found = lm.document_logs(network, np.concatenate(docs), starts, 0, lanes)
    assert np.allclose(found, [slow_logs(network, d) for d in docs], rtol=1e-4, atol=1e-3)


def test_gradients(network):
    """Against differences of the loss, in double precision."""
    for name in ("table", "recur", "bias", "classes", "class_bias", "words", "word_bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    draw = np.random.default_rng(3)
    x = draw.integers(0, 100, (6, 4))
    x[2, 1] = 0
    y = draw.integers(0, 100, (6, 4))
    start = draw.standard_normal((4, lm.STATE)) * 0.3

    def loss():
        state, total = start, 0.0
        for t in range(6):
            state = network.step(network.table[x[t]], state * (x[t] != 0)[:, None])[0]
            total -= network.log_probability(state.copy(), y[t]).sum() / 4
        return total

    gradients, _ = lm._window_gradients(network, x, y, start, 0)
    for p, g in zip(network.parameters(), gradients, strict=True):
        flat, slope = p.reshape(-1), g.reshape(-1)
        places = [k for k in np.argsort(-np.abs(slope))[:3]] + [int(draw.integers(len(flat)))]
        for k in places:
            if flat[k] < -1e8:
                continue
            old = flat[k]
            flat[k] = old + 1e-5
            up = loss()
            flat[k] = old - 1e-5
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-5 - slope[k]) < 1e-4 * max(1, abs(slope[k]))


@pytest.mark.parametrize("most", [1, 50, 10_000])
def test_large_logits_and_pieces_of_states(network, monkeypatch, most):
    """Exponentials of these logits overflow in single precision unless they are shifted."""
    network.class_bias[:] *= 200
    network.words *= 300
    states = np.random.default_rng(4).uniform(-1, 1, (120, lm.STATE)).astype(np.float32)
    codes = np.random.default_rng(5).integers(0, len(network.head) + lm.TAIL, 120)
    monkeypatch.setattr(lm, "SCORED_ROWS", most)
    found = network.log_probability(states, codes)
    group = network.class_of(codes)
    wide = states.astype(np.float64)

    def logs(logits, chosen):
        logits = logits - logits.max(1, keepdims=True)
        return logits[np.arange(len(logits)), chosen] - np.log(np.exp(logits).sum(1))

    want = logs(wide @ network.classes + network.class_bias, group)
    for i in np.flatnonzero(codes < len(network.head)):
        want[i] += logs(wide[i:i + 1] @ network.words[group[i]] + network.word_bias[group[i]], codes[i:i + 1] % lm.CLASS_WORDS)[0]
    assert np.isfinite(found).all() and np.allclose(found, want, rtol=1e-4, atol=1e-2)


def test_texts_are_cut_into_words_once(docs, monkeypatch):
    """Words are counted by block and the block's rows kept as their numbers, the end of a row behind each."""
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 10)
    rows = [(k, f"a b{k % 3} a") for k in range(12)] + [(99, "")]
    frame = docs(*rows).select("doc_id", "text", (F.col("doc_id") < 6).alias("training"))
    found = lm._numbered(lm._dealt(frame)).collect()
    words = {(r["block"], r["number"]): (r["word"], r["n"]) for r in found if r["word"] is not None}
    said = {
        r["doc_id"]: [words[r["block"], int(k)][0] for k in np.frombuffer(r["numbers"], np.int32)]
        for r in found if r["word"] is None
    }
    assert said == {k: [*text.split(), lm.END] for k, text in rows}
    total = collections.Counter()
    for word, n in words.values():
        total[word] += n
    assert total == {"a": 12, "b0": 2, "b1": 2, "b2": 2, lm.END: 6} and len({b for b, _ in words}) > 1


def test_words_travel_packed(docs, monkeypatch):
    """One row for a block and bucket, however many words; blocks agree on a word's bucket."""
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 50)
    frame = docs(*((k, " ".join(f"w{j}" for j in range(k, k + 40))) for k in range(12)))
    found = lm._packed(lm._dealt(frame.select("doc_id", "text", F.lit(True).alias("training"))), 3).where("words IS NOT NULL").collect()
    buckets = collections.defaultdict(set)
    for row in found:
        words = row["words"].decode().split("\n")[:-1]
        assert len(words) == len(np.frombuffer(row["counts"], np.int64))
        for word in words:
            buckets[word].add(row["bucket"])
    assert set(buckets) == {*(f"w{j}" for j in range(51)), lm.END} and all(len(b) == 1 for b in buckets.values())
    assert len(found) == len({(r["block"], r["bucket"]) for r in found}) and len({r["block"] for r in found}) > 3


def test_bucket_counts_and_codes(monkeypatch):
    """Over both blocks; the end first, ties by the bytes of the word, which may be smaller than a line feed."""
    monkeypatch.setattr(lm, "HEAD", 3)
    longs = lambda *values: np.array(values, np.int64).tobytes()
    given = pa.table({
        "block": [0, 1], "bucket": pa.array([4, 4], pa.int32()), "first": [0, 0],
        "words": [b"a\nb\na\x01\n \n", b"b\nc\n"], "counts": [longs(2, 1, 2, 1), longs(1, 0)],
    })
    found = lm._counted_bucket(given).to_pylist()
    assert [np.frombuffer(r["counts"], np.int64).tolist() for r in found[:2]] == [[2, 2, 2, 1], [2, 0]]
    assert [(r["word"], r["c"]) for r in found[2:5]] == [(" ", 1), ("a", 2), ("a\x01", 2)]
    assert sum(r["c"] for r in found[5:]) == 7 and sum(r["v"] for r in found[5:]) == 4
    ranks = {4 * lm.HEAD + r["place"]: k for k, r in enumerate(found[2:5])}
    texts = pa.table({
        "doc_id": [1], "training": [True], "n": [1], "key": [5], "numbers": [np.array([0, 1, 2, 3], np.int32).tobytes()],
    })
    known = pa.Table.from_pylist(found[:1]).set_column(1, "bucket", pa.array([4], pa.int32()))
    codes = lm._coded_block(3, ranks, {}, 7, 4, texts, known).column("codes")[0].as_py()
    assert np.frombuffer(codes, np.int16).tolist() == [1, 3 + zlib.crc32(b"b") % lm.TAIL, 2, 0]


def test_sums_by_code():
    draw = np.random.default_rng(6)
    codes, rows = draw.integers(0, 100, 300), draw.standard_normal((300, 5))
    want = np.zeros((100, 5))
    np.add.at(want, codes, rows)
    assert np.allclose(lm._summed(codes, rows, 100), want)


def test_training_learns_an_order():
    text = np.array([3, 1, 2] * 400 + [0])
    network = lm.fit(lm.Network.fresh([f"w{k}" for k in range(10)]), [text] * 4, 0, epochs=8, lanes=4)
    per_token = lm.document_logs(network, text, np.array([0, len(text)]), 0)[0] / len(text)
    assert per_token > -0.3


def test_every_training_document_is_learned(docs, monkeypatch):
    """Also those past the first 2,500 ids by their hash, in several parts and rounds."""
    monkeypatch.setattr(lm, "PART_TOKENS", 150_000)
    ids = docs(*((k, "") for k in range(3000))).orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()
    rows = [(r["doc_id"], "a b " * 20 if k < 2500 else "p q " * 400) for k, r in enumerate(ids)]
    found = lm.scored(docs(*rows, (-1, "p q " * 400)), F.col("doc_id") < 0).where("doc_id = -1").first()
    assert found["train_tokens"] == 2500 * 41 + 500 * 801 and found["score"] > found["base_score"] / 2


def test_weights_of_many_parts_are_averaged_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART_TOKENS", 100)
    draw = np.random.default_rng(3)
    rows = [(place, 1, np.append(draw.integers(1, 9, 30), 0).astype(np.int16).tobytes()) for place in range(20)]
    training = spark.createDataFrame(rows, "place long, n long, codes binary")
    head = [f"w{k}" for k in range(10)]
    flat = lm._fitted(training, head, 620)
    monkeypatch.setattr(lm, "MERGED", 2)
    for mean, other in zip(flat.parameters(), lm._fitted(training, head, 620).parameters(), strict=True):
        assert np.allclose(mean, other, atol=1e-5)


def test_lanes_cover_every_code(network, monkeypatch):
    seen = []
    whole = lm._window_gradients
    monkeypatch.setattr(lm, "_window_gradients", lambda n, x, y, *rest: (seen.extend(y.ravel()), whole(n, x, y, *rest))[1])
    lm.learn(network, lm.Moments.fresh(network), np.arange(997) % 100, 0, lanes=7)
    assert len(seen) < 997 + 7 and collections.Counter(seen) >= collections.Counter((np.arange(997) % 100).tolist())


def test_repeated_rows_are_told_apart():
    assert lm._repeats(np.array([5, 7, 5, 5, 7, -1])).tolist() == [0, 0, 1, 2, 1, 0]


def test_blocks_count_ends_and_bytes(docs, monkeypatch):
    """Texts without blanks, empty ones too, are more than one block."""
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 10)
    assert lm._block_count(docs(*((k, "") for k in range(40)))) == 4
    monkeypatch.setattr(lm, "BLOCK_BYTES", 60)
    assert lm._block_count(docs((1, "東京" * 40))) == 4


def test_rows_that_come_often(docs, odd_rows, monkeypatch):
    monkeypatch.setattr(lm, "OFTEN", 3)
    frame = docs(*odd_rows, *[(4, "The heed")] * 9, *[(20, "の" * 50)] * 30, *[(None, None)] * 5)
    key = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)) == 0
    assert lm._dealt(frame.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("training"))).count() == 13
    check(frame, F.lit(False), lambda rows: [True] * len(rows))
