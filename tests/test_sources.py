from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlane.plans.ingest import REJECTED, TooManyBadRows, export_csv, ingest, load_table
from ledgerlane.schemas import INGESTED_AT, LOAD_ORDER, RAW_SCHEMAS
from ledgerlane.sources import layers
from ledgerlane.sources.csv_files import CORRUPT, infer_types, nan_to_null, read_csv
from ledgerlane.sources.layers import RAW, Conflict, LayerStore
from ledgerlane.sources.sample import SampleTables
from tests.conftest import SAMPLE

LOADED = datetime(2025, 1, 1, 12, 30)
SCHEMA = RAW_SCHEMAS["departments"]
HEADER = ",".join(SCHEMA.fieldNames())


@pytest.fixture()
def file(tmp_path):
    def write(text: str, name: str = "departments.csv", bom: bool = True) -> str:
        (tmp_path / name).write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
        return str(tmp_path / name)

    return write


def test_byte_order_mark_quotes_and_empty_fields(spark, file):
    path = file(f'{HEADER}\n1,D1,"Riset, ""R&D""",,Jakarta,Sri,5000,2024-01-02\n')
    row = read_csv(spark, path, SCHEMA).first()
    assert (row.department_id, row.department_name, row.cost_center) == (1, 'Riset, "R&D"', None)
    assert str(row.created_at) == "2024-01-02"


def test_swapped_columns_fail(spark, file):
    path = file(f"{HEADER.replace('location,manager_name', 'manager_name,location')}\n1,D,N,C,L,M,5,2024-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, SCHEMA).collect()


def test_bad_rows_fail_or_are_kept(spark, file):
    path = file(f"{HEADER}\nabc,D1,N,C,L,M,5,2024-01-02\n2,D2,N,C,L,M,5,2024-01-02\n3,D3,N,C,L,M,5.5,kemarin\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, SCHEMA).collect()
    rows = read_csv(spark, path, SCHEMA, keep_bad_rows=True).cache()
    bad = [row[CORRUPT] for row in rows.filter(F.col(CORRUPT).isNotNull()).orderBy("department_code").collect()]
    assert bad == ["abc,D1,N,C,L,M,5,2024-01-02", "3,D3,N,C,L,M,5.5,kemarin"]
    assert rows.count() == 3


def test_missing_words_and_whole_numbers_with_a_point(spark, file):
    path = file(f'{HEADER}\n1.0,NA,"N/A",null,None,n/a,NaN,\n2,D2,NAN,na,-,#N/A,-5.00,2024-01-02\n')
    a, b = read_csv(spark, path, SCHEMA).orderBy("department_id").collect()
    assert tuple(a) == (1, None, None, None, None, None, None, None)
    assert tuple(b)[:7] == (2, "D2", "NAN", "na", "-", None, -5)


def test_a_load_sets_bad_rows_aside(spark, file, tmp_path):
    file(f'{HEADER}\n1,D1,"dua\nbaris",C,L,M,5,2024-01-02\nx,D2,N,C,L,M,5,2024-01-02\n')
    store = LayerStore(spark, str(tmp_path / "store"))
    done = load_table(spark, store, str(tmp_path), "departments", LOADED, keep_bad_rows=True, multi_line=True)
    assert done[:4] == ("departments", 1, 1, "OK")
    assert store.read(RAW, "departments").first().department_name == "dua\nbaris"
    assert store.read(REJECTED, "departments").first()[CORRUPT].startswith("x,D2")


def test_a_record_is_parsed_once(spark, file, tmp_path, monkeypatch):
    path = file(f'{HEADER}\n1,D1,"dua\nbaris",C,L,M,5,2024-01-02\nx,D2,N,C,L,M,5,2024-01-02\n')
    rows = read_csv(spark, path, SCHEMA, keep_bad_rows=True, multi_line=True)
    for kept in (rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)):
        assert kept.count() == 1
        assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    stored, write = [], LayerStore.write
    monkeypatch.setattr(LayerStore, "write", lambda self, layer, table, given, *a, **k: (
        stored.append("from_csv" in given._jdf.queryExecution().optimizedPlan().toString()),
        write(self, layer, table, given, *a, **k))[1])
    store = LayerStore(spark, str(tmp_path / "store"))
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    done = load_table(spark, store, str(tmp_path), "departments", LOADED, keep_bad_rows=True, multi_line=True)
    assert done[:4] == ("departments", 1, 1, "OK") and sorted(stored) == [False, False, True]
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
    assert not list((tmp_path / "store" / "scratch").iterdir())


def test_line_breaks_inside_fields(spark, file):
    path = file(f'{HEADER}\n1,D1,"dua\nbaris",C,L,M,5,2024-01-02\n')
    assert read_csv(spark, path, SCHEMA, multi_line=True).first().department_name == "dua\nbaris"


def test_not_a_number_becomes_null(spark):
    rows = spark.createDataFrame([(1, float("nan")), (2, 2.5), (3, None)], "id long, x double")
    assert [row.x for row in nan_to_null(rows).orderBy("id").collect()] == [None, 2.5, None]


def test_inference_sees_every_value(spark):
    rows = spark.createDataFrame(
        [
            ("1", "1", "1.5", "2024-01-02", "True", "2024-01-02", None),
            ("-2", None, "3", "2024-02-03", "False", "2024-01-02", None),
            ("3", "4", "1e3", "2024-02-04", "True", "lusa", None),
        ],
        "whole string, gappy string, number string, day string, flag string, text string, none string",
    )
    assert dict(infer_types(rows).collect()) == {
        "whole": "BIGINT", "gappy": "DOUBLE PRECISION", "number": "DOUBLE PRECISION",
        "day": "DATE", "flag": "BOOLEAN", "text": "TEXT", "none": "DOUBLE PRECISION",
    }


def test_round_trip_and_missing_files(spark, raw, tmp_path):
    tables = {name: raw(name) for name in LOAD_ORDER[:-1]}
    tables["vendors"] = raw("vendors", dict(vendor_name=' PT "Satu", Tbk ', city="  ", rating=4.5))
    export_csv(tables, str(tmp_path / "csv"))
    store = LayerStore(spark, str(tmp_path / "store"))
    loads = {row.table: row for row in ingest(spark, store, str(tmp_path / "csv"), LOADED).collect()}
    assert loads["goods_receipts"].status == "SKIPPED" and loads["goods_receipts"].rows == 0
    assert loads["GRAND TOTAL"].rows == 6
    for name, rows in tables.items():
        loaded = store.read(RAW, name)
        assert loaded.first()[INGESTED_AT] == "2025-01-01 12:30:00"
        columns = RAW_SCHEMAS[name].fieldNames()
        assert loaded.select(*columns).exceptAll(rows.select(*columns)).count() == 0


def test_a_failed_load_leaves_the_old_table(spark, file, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    file(f"{HEADER}\n1,D1,N,C,L,M,5,2024-01-02\n")
    assert load_table(spark, store, str(tmp_path), "departments", LOADED)[:4] == ("departments", 1, 0, "OK")
    file(f"{HEADER}\n1,D1,N,C,L,M,5,2024-01-02\nx,D2,N,C,L,M,5,2024-01-02\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        load_table(spark, store, str(tmp_path), "departments", LOADED)
    assert store.read(RAW, "departments").count() == 1
    file(f"{HEADER}\n1,D1,N,C,L,M,5,2024-01-02\n2,D2,N,C,L,M,5,2024-01-02\n")
    load_table(spark, store, str(tmp_path), "departments", LOADED)
    assert store.read(RAW, "departments").count() == 2


def test_a_discarded_store_is_empty(spark, raw, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    store.write(RAW, "vendors", raw("vendors"))
    assert store.written(RAW, "vendors")
    store.discard()
    assert not store.written(RAW, "vendors") and not (tmp_path / "store").exists()
    assert store.write(RAW, "vendors", raw("vendors")) == 1


def test_former_loads_are_deleted_but_for_one(spark, raw, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    for _ in range(4):
        store.write(RAW, "vendors", raw("vendors"))
    assert len(list((tmp_path / "store" / "raw" / "vendors").glob("load=*"))) == 2
    alone = LayerStore(spark, str(tmp_path / "alone"), keep=0)
    for _ in range(2):
        alone.write(RAW, "vendors", raw("vendors"))
    assert len(list((tmp_path / "alone" / "raw" / "vendors").glob("load=*"))) == 1


def test_a_new_session_finds_stored_tables(spark, raw, tmp_path):
    LayerStore(spark, str(tmp_path)).write(RAW, "vendors", raw("vendors"))
    later = LayerStore(spark, str(tmp_path))
    assert later.exists(RAW, "vendors") and not later.written(RAW, "vendors")
    assert later.read(RAW, "vendors").schema == raw("vendors").schema
    with pytest.raises(FileNotFoundError):
        later.read(RAW, "items")


def test_replacing_partitions(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path), publish=False)
    rows = spark.createDataFrame([(k, k % 4 if k % 4 else None) for k in range(40)], "id long, part int")
    store.write(RAW, "t", rows, ("part",))
    new = spark.createDataFrame([(100, 1), (101, None)], "id long, part int")
    assert store.replace(RAW, "t", new, "part", [1, 2, None]) == 2
    found = sorted((row.id, row.part or 0) for row in store.read(RAW, "t").collect())
    assert found == sorted([(k, 3) for k in range(3, 40, 4)] + [(100, 1), (101, 0)])


def test_a_partitioned_write_leaves_few_files(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rows = spark.range(2000).select("id", (F.col("id") % 3).alias("part")).repartition(16)
    store.write(RAW, "t", rows, ("part",))
    assert len(list(tmp_path.glob("raw/t/load=*/part=*/*.parquet"))) <= 6


def years(spark, value):
    return spark.createDataFrame([(y, value) for y in (2020, 2021, 2022)], "po_year long, v string")


def test_two_writers_of_different_partitions_both_survive(spark, tmp_path):
    """Both read the same state and commit side by side; neither commit is lost."""
    first, second = (LayerStore(spark, str(tmp_path / "s"), keep=5) for _ in range(2))
    first.write("marts", "t", years(spark, "a"), ("po_year",))
    ready = threading.Barrier(2)

    def replace(store, year):
        since = store.version("marts", "t")
        ready.wait()
        rows = years(spark, f"new {year}").where(F.col("po_year") == year)
        store.replace("marts", "t", rows, "po_year", [year], since=since)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(replace, (first, second), (2020, 2022)))
    found = {tuple(row) for row in first.read("marts", "t").select("po_year", "v").collect()}
    assert found == {(2020, "new 2020"), (2021, "a"), (2022, "new 2022")}
    assert first.version("marts", "t") == 3
    assert {row.v for row in first.read("marts", "t", 1).collect()} == {"a"}


def test_two_writers_of_one_partition_conflict(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "s"))
    store.write("marts", "t", years(spark, "a"), ("po_year",))
    since = store.version("marts", "t")
    store.replace("marts", "t", years(spark, "b").where("po_year = 2020"), "po_year", [2020])
    with pytest.raises(Conflict, match="po_year=2020"):
        store.replace("marts", "t", years(spark, "c").where("po_year = 2020"), "po_year", [2020], since=since)
    assert {row.v for row in store.read("marts", "t").where("po_year = 2020").collect()} == {"b"}


def test_a_load_in_buckets_is_found_by_a_later_session(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "s"))
    store.write("raw", "t", spark.range(100).withColumn("v", F.col("id") % 7), bucket_key="id")
    (load,) = store._state("raw", "t")["parts"]
    spark.sql(f"DROP TABLE {store._entry(load)}")  # another session's catalog does not know it
    rows = LayerStore(spark, store.root).read("raw", "t")
    assert rows.count() == 100
    plan = rows.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_held_commits_show_together_or_not_at_all(spark, tmp_path):
    store, other = (LayerStore(spark, str(tmp_path / "s")) for _ in range(2))
    store.write("marts", "t", years(spark, "a"), ("po_year",))
    with store.held("marts", "raw"):
        store.write("marts", "t", years(spark, "b"), ("po_year",))
        store.replace("marts", "t", years(spark, "c").where("po_year = 2020"), "po_year", [2020])
        store.write("raw", "n", spark.range(3), bucket_key="id")
        assert {row.v for row in store.read("marts", "t").collect()} == {"b", "c"}
        assert {row.v for row in other.read("marts", "t").collect()} == {"a"}
        assert store.read("raw", "n").count() == 3 and not other.exists("raw", "n")
    assert {row.v for row in other.read("marts", "t").collect()} == {"b", "c"}
    assert other.version("marts", "t") == 2 and other.read("raw", "n").count() == 3
    folders = {path.name for path in (tmp_path / "s").glob("*/*/load=*")}
    with pytest.raises(ZeroDivisionError), store.held("marts", "raw"):
        store.write("marts", "t", years(spark, "d"), ("po_year",))
        store.write("raw", "new", spark.range(3), bucket_key="id")
        assert store.written("raw", "new")
        raise ZeroDivisionError
    assert {row.v for row in store.read("marts", "t").collect()} == {"b", "c"}
    assert not store.exists("raw", "new") and not store.written("raw", "new")
    assert {path.name for path in (tmp_path / "s").glob("*/*/load=*")} == folders


def test_a_conflict_shows_no_table_of_the_block(spark, tmp_path):
    store, other = (LayerStore(spark, str(tmp_path / "s")) for _ in range(2))
    store.write("marts", "t", years(spark, "a"), ("po_year",))
    with pytest.raises(Conflict, match="po_year=2020"), store.held("marts"):
        store.write("marts", "first", spark.range(3))
        store.replace("marts", "t", years(spark, "c").where("po_year = 2020"), "po_year", [2020])
        other.replace("marts", "t", years(spark, "b").where("po_year = 2020"), "po_year", [2020])
    assert not other.exists("marts", "first")
    assert {row.v for row in other.read("marts", "t").where("po_year = 2020").collect()} == {"b"}
    with store.held("marts"):  # another year has changed since: both stay
        store.replace("marts", "t", years(spark, "c").where("po_year = 2020"), "po_year", [2020])
        other.replace("marts", "t", years(spark, "d").where("po_year = 2021"), "po_year", [2021])
    found = {row.po_year: row.v for row in other.read("marts", "t").collect()}
    assert (found[2020], found[2021]) == ("c", "d")


@pytest.mark.parametrize("bad,shown", [(1, True), (60, False)])
def test_a_load_that_is_mostly_bad_is_not_shown(spark, file, tmp_path, bad, shown):
    store = LayerStore(spark, str(tmp_path / "store"))
    file(f"{HEADER}\n7,D7,N,C,L,M,5,2024-01-02\n")
    load_table(spark, store, str(tmp_path), "departments", LOADED, keep_bad_rows=True)
    lines = [f"{'x' if k < bad else k},D{k},N,C,L,M,5,2024-01-02" for k in range(100)]
    file("\n".join([HEADER, *lines, ""]))

    def load():
        return load_table(spark, store, str(tmp_path), "departments", LOADED, keep_bad_rows=True, most_bad=0.05)

    if shown:
        assert load()[1:4] == (99, 1, "OK")
    else:
        with pytest.raises(TooManyBadRows, match="departments: 60 of 100 rows"):
            load()
    assert store.read(RAW, "departments").count() == (99 if shown else 1)
    assert store.read(REJECTED, "departments").count() == bad


def test_shuffles_and_buckets_grow_with_the_largest_table(spark, tmp_path):
    try:
        layers.deal_for(spark, 100)
        assert layers.shuffle_partitions(spark) == 4
        layers.deal_for(spark, 20 * layers.TASK_ROWS + 1)
        assert layers.shuffle_partitions(spark) == 21
        layers.deal_for(spark, 100)
        store = LayerStore(spark, str(tmp_path / "s"))
        store.write("raw", "t", spark.range(100), bucket_key="id")
        assert store._state("raw", "t")["buckets"] == [21, "id"]
        assert store.read("raw", "t").count() == 100
        assert list((tmp_path / "s").rglob("*.zstd.parquet"))
    finally:
        spark.conf.unset(layers._FIRST_PARTITIONS)


def test_scans_of_large_tables_have_small_tasks(spark):
    """So that values a task keeps to combine equal ones stay in memory; a smaller setting stays."""
    spark.conf.unset(layers._READ_BYTES)
    try:
        layers.deal_for(spark, 100)
        assert spark.conf.get(layers._READ_BYTES) != str(layers.TASK_BYTES)
        layers.deal_for(spark, 20 * layers.TASK_ROWS + 1)
        assert spark.conf.get(layers._READ_BYTES) == str(layers.TASK_BYTES)
        spark.conf.unset(layers._FIRST_PARTITIONS)
        spark.conf.set(layers._READ_BYTES, "1m")
        layers.deal_for(spark, 20 * layers.TASK_ROWS + 1)
        assert spark.conf.get(layers._READ_BYTES) == "1m"
    finally:
        spark.conf.unset(layers._FIRST_PARTITIONS)
        spark.conf.unset(layers._READ_BYTES)


def test_lines_go_to_their_bucket_before_they_are_written_out(spark):
    given = SampleTables(spark, SAMPLE, to_buckets=True)
    rows = given.table("purchase_order_lines", None)
    plan = rows.repartition(layers.shuffle_partitions(spark), "line_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(line_id") == 1
    assert plan.index("Exchange hashpartitioning(line_id") > plan.index("line_status")
    plain = SampleTables(spark, SAMPLE).table("purchase_order_lines", None)
    assert rows.exceptAll(plain).count() == plain.exceptAll(rows).count() == 0
