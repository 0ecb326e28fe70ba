"""Every registered query against its expected SQL, on the sample data and on a skewed copy."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from ledgerlane.plans.warehouse import FACT, Warehouse, sample_warehouse
from ledgerlane.sources.layers import MARTS, LayerStore
from ledgerlane.sources.sample import SampleTables
from tests.conftest import SAMPLE

GIVEN = "region nation customer supplier part orders lineitem".split()
QUERIES, EXPECTED = registered.queries(), registered.oracle_sql()
TRAINING_DATA = {key for key in QUERIES if key.startswith("op") or key == "pipeline"}  # has tests of its own


def plain(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return str(int(value)) if value == int(value) else f"{value:.12g}"
    return str(value)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def compare(spark, connection, key: str, folder: str) -> None:
    found = QUERIES[key](spark, folder)
    expected = connection.execute(EXPECTED[key])
    names = [column[0] for column in expected.description]
    assert sorted(names) == sorted(found.columns)
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {name: kinds[kind] for name, kind in found.dtypes} == types
    want = sorted(tuple(map(plain, row)) for row in expected.fetchall())
    got = sorted(tuple(plain(row[name]) for name in names) for row in found.collect())
    assert got == want


@pytest.fixture(scope="module")
def sample():
    return connect(SAMPLE)


def test_every_query_of_the_library_has_an_expected_result():
    assert set(QUERIES) - TRAINING_DATA == set(EXPECTED) - TRAINING_DATA
    assert set(EXPECTED) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(set(EXPECTED) - TRAINING_DATA))
def test_query(spark, sample, key):
    compare(spark, sample, key, SAMPLE)


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A copy in which one order, one customer and one part hold a third of all rows each."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in GIVEN:
        rows = spark.read.parquet(f"{SAMPLE}/{name}.parquet")
        if name == "lineitem":
            rows = rows.withColumns({
                "l_orderkey": F.when(F.col("l_suppkey") % 3 == 0, 4).otherwise(F.col("l_orderkey")),
                "l_partkey": F.when(F.col("l_quantity") % 3 == 1, 9).otherwise(F.col("l_partkey")),
            })
        if name == "orders":
            rows = rows.withColumn(
                "o_custkey", F.when(F.col("o_orderkey") % 3 == 1, 8).otherwise(F.col("o_custkey"))
            )
        rows.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.mark.parametrize("key", ["T6", "T7", "L1", "L2", "X1", "X6", "D1", "D5", "D6", "G5", "V1", "V4", "G1", "Q1", "Q2",
                                 "Q3", "Q5", "PM1", "PM2", "FIN4", "OPS1", "OPS2", "OPS3", "OPS4", "WH1"])
def test_skewed_query_without_broadcasts(spark, skewed, key):
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{skewed}/{name}.parquet/*.parquet')"
        )
    for name, value in SKEW_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        compare(spark, connection, key, skewed)
    finally:
        for name in SKEW_SETTINGS:
            spark.conf.unset(name)


def test_without_a_store_the_plan_runs_from_the_given_tables(spark):
    lazy = Warehouse(spark, SampleTables(spark, SAMPLE).table)
    stored = sample_warehouse(spark, SAMPLE)
    assert lazy.fact().exceptAll(stored.fact()).count() == 0
    assert lazy.fact().count() == stored.fact().count()


def test_lines_are_moved_to_their_order_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lazy = Warehouse(spark, SampleTables(spark, SAMPLE).table)
        plan = lazy.raw("purchase_order_lines")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the lines and the orders
    assert "l_linenumber" not in plan.split("Exchange hashpartitioning(")[1].split(")")[0]


def test_reports_store_no_fact_and_checks_the_columns_they_scan(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "s"))
    warehouse = Warehouse(spark, SampleTables(spark, SAMPLE).table, store)
    assert registered.monthly_order_value(warehouse.marts()).count() == 80
    assert not store.exists(MARTS, FACT)
    kept = warehouse.marts(registered.checks.KEY_COLUMNS).fact
    assert kept.columns == list(registered.checks.KEY_COLUMNS)
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()
