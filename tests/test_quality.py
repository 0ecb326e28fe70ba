from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators import quality
from ledgerlane.plans import checks
from ledgerlane.plans.warehouse import sample_warehouse
from tests.conftest import SAMPLE


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "x"), (3, None), (None, "a"), (None, None)], "id long, kind string"
    )


def test_unique_ignores_missing_values(rows):
    found = quality.unique(rows, "t", "id").first()
    assert (found.failing_rows, found.passed) == (1, False)


def test_unique_checks_of_all_tables_share_one_shuffle(spark, rows):
    """Values of every type, against counting them by hand; a third of one column is a single value."""
    numbers = spark.range(300)
    wide = numbers.select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 1000).cast("int").alias("hot"),
        (F.col("id") % 250).cast("string").alias("code"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 299).cast("int")).alias("day"),
        F.timestamp_micros("id").alias("at"),
        F.when(F.col("id") < 2, F.lit(0.0) * (F.col("id") * 2 - 1)).otherwise(F.col("id")).alias("zero"),
        F.when(F.col("id") > 5, F.col("id").cast("decimal(20,2)")).alias("money"),
        F.encode((F.col("id") % 298).cast("string"), "utf-8").alias("bytes"),
    )
    found = quality.unique_values({"wide": (wide, wide.columns), "t": (rows, ("id", "kind")), "none": (rows, ())})
    got = {(r.table, r.column): r.failing_rows for r in found.collect()}
    assert got == {
        ("wide", "hot"): 1, ("wide", "code"): 50, ("wide", "day"): 1, ("wide", "at"): 0, ("wide", "zero"): 1,
        ("wide", "money"): 0, ("wide", "bytes"): 2, ("t", "id"): 1, ("t", "kind"): 1,
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
    assert quality.unique(rows.limit(0), "t", "kind").first().passed


def test_unique_texts_of_digits_and_others(spark):
    """Digits packed two in a byte are not taken for other digits or for the text of their bytes."""
    texts = ["616263", "abc", "ABCD", "abcd", "00", "0", "000", "", "\x00", "\x01", "0x", "6A", "6a", None, None]
    found = quality.unique(spark.createDataFrame([(x,) for x in texts], "v string"), "t", "v").first()
    assert (found.failing_rows, found.passed) == (0, True)
    twice = spark.createDataFrame([(x,) for x in texts + ["616263", "ABCD", ""]], "v string")
    assert quality.unique(twice, "t", "v").first().failing_rows == 3


def test_surrogate_keys_move_half_their_digits(spark):
    keys = spark.range(10).select(F.md5(F.col("id").cast("string")).alias("v"))
    number, text = quality._comparable(keys, "v")
    assert {tuple(r) for r in keys.select(number.isNull(), F.length(text)).collect()} == {(True, 17)}


def test_checked_columns_of_the_fact_leave_out_its_key(spark):
    """The key of the fact is not stored a second time, and is the same."""
    w = sample_warehouse(spark, SAMPLE)
    checked = w.marts(checks.FACT_CHECKED).fact
    assert tuple(checked.columns) == checks.FACT_CHECKED
    names = ("po_line_id", "fct_po_line_sk")
    assert checked.select(*names).exceptAll(w.fact().select(*names)).count() == 0
    stored = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in checked.inputFiles()})
    assert "po_line_id" in stored.columns and "fct_po_line_sk" not in stored.columns


def test_column_checks_share_one_scan(rows):
    found = quality.column_checks(rows, "t", ["id", "kind"], {"kind": ["a", "b"]}, {"kind": "warn"})
    results = {(r.check, r.column): (r.failing_rows, r.severity) for r in found.collect()}
    assert results == {
        ("not_null", "id"): (2, "error"), ("not_null", "kind"): (2, "error"),
        ("accepted_values", "kind"): (1, "warn"),
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_relationship_counts_child_rows(spark, rows):
    parent = spark.createDataFrame([(2,), (2,)], "key long")
    found = quality.relationship(rows, "t", "id", parent, "key").first()
    assert (found.failing_rows, found.passed) == (3, False)
    assert quality.relationship(rows.filter("id = 2"), "t", "id", parent, "key").first().passed


def test_gate_lets_warnings_pass(rows):
    found = quality.column_checks(rows, "t", [], {"kind": ["a", "b"]}, {"kind": "warn"})
    assert quality.gate(found).count() == 0
    assert quality.gate(quality.unique(rows, "t", "id")).count() == 1


@pytest.mark.parametrize("hours,status", [(24, "pass"), (25, "pass"), (26, "warn"), (49, "warn"), (50, "error")])
def test_freshness(raw, hours, status):
    day, hour = divmod(hours, 24)
    found = quality.freshness(raw("items"), "items", datetime(2025, 1, 1 + day, hour)).first()
    assert (found.age_hours, found.status) == (hours, status)


def test_an_empty_source_is_stale(raw):
    assert quality.freshness(raw("items").limit(0), "items", datetime(2025, 1, 1)).first().status == "error"


def test_bounds(spark):
    measures = spark.createDataFrame([(5, 7)], "a long, b long")
    found = quality.within_bounds(measures, {"a": (5, 5), "b": (None, 6)}).collect()
    assert [(r.name, r.value, r.ok) for r in found] == [("a", 5, True), ("b", 7, False)]


def test_declared_checks_are_complete():
    count = {
        "unique": sum(len(v) for v in checks.UNIQUE.values()),
        "not_null": sum(len(v) for v in checks.NOT_NULL.values()),
        "accepted": sum(len(v) for v in checks.ACCEPTED.values()),
        "relationships": len(checks.RELATIONSHIPS),
    }
    assert count == {"unique": 24, "not_null": 136, "accepted": 22, "relationships": 6}


def test_marts_built_here_pass_their_key_checks(spark):
    m = sample_warehouse(spark, SAMPLE).marts()
    assert checks.unique_checks(checks.mart_tables(m)).filter("NOT passed").count() == 0
    assert checks.relationship_checks(m).filter("NOT passed").count() == 0
