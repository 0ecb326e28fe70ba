from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlane.llm.decontamination import Items
from tests.conftest import SAMPLE
from tests.llm.test_byte_bpe import LIBRARY
from tests.llm.test_secrets import base_spans
from tests.llm.test_simhash import brute_fingerprint, brute_groups


@pytest.fixture(scope="module")
def stages(spark, given, tmp_path_factory):
    out, docs = [], given("documents")
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp(name) / "out")
        result = stage(spark, docs, SAMPLE)
        result.write.parquet(folder)
        docs = spark.read.parquet(folder)
        out.append(docs)
    return out


def by_id(frame, column="text"):
    return {row["doc_id"]: row[column] for row in frame.collect()}


def test_order_and_columns(stages, given):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "secrets", "encode"]
    for frame in stages[:-1]:
        assert frame.dtypes == given("documents").dtypes


def test_language_keeps_clean_documents(stages, given):
    before, after = by_id(given("documents")), by_id(stages[0])
    gone = {k: before[k] for k in before.keys() - after.keys()}
    assert all(sum(c.isalpha() for c in text or "") < 0.5 * len(text or "x") or len(text or "") < 40 for text in gone.values())
    assert len(after) >= 0.95 * len(before)


def test_one_of_each_group_stays(stages):
    rows = [(row["doc_id"], brute_fingerprint(row["text"])) for row in stages[0].collect()]
    assert set(by_id(stages[1])) == set(brute_groups(rows))


def test_no_benchmark_passage_stays(stages, given):
    items = Items([(r["item_id"], r["text"]) for r in given("benchmark").collect()])
    before = by_id(stages[1])
    assert set(by_id(stages[2])) == {k for k, text in before.items() if not items.matches(text)}


def test_secrets_are_replaced(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    assert before.keys() == after.keys()
    for k, text in before.items():
        assert (after[k] == text) or ("[secret]" in after[k] and base_spans(text))


def test_encoded_texts(stages):
    texts, ids, decoded = by_id(stages[3]), by_id(stages[4], "ids"), by_id(stages[4], "decoded")
    assert decoded == texts and ids == {k: LIBRARY.encode_ordinary(text) for k, text in texts.items()}


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SAMPLE).exceptAll(stages[-1]).count() == 0


def test_odd_rows(spark, docs, odd_rows):
    """Every stage takes odd rows and further columns, whose values stay."""
    frame = docs(*odd_rows, (40, "the thon of a longer text " * 9)).withColumns({
        name: F.lit(f"own {name}") for name in ("lang_pred", "score", "mark", "row", "_mark", "owner", "fp")
    })
    for given_ in (frame, frame.limit(0)):
        rows = given_
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SAMPLE)
            assert rows.columns == frame.columns
        for row in rows.collect():
            assert all(row[name] == f"own {name}" for name in ("lang_pred", "score", "mark", "row", "_mark", "owner", "fp"))
        corpus_pipeline.STAGES[-1][1](spark, rows, SAMPLE).collect()
