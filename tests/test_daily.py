from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlane.__main__ import main
from ledgerlane.operators import snapshot
from ledgerlane.plans.checks import SMOKE_BOUNDS
from ledgerlane.plans.daily import ChecksFailed, run
from ledgerlane.plans.ingest import export_csv
from ledgerlane.plans.reports import REPORTS
from ledgerlane.plans.stakeholders import STAKEHOLDER_REPORTS
from ledgerlane.plans.warehouse import Warehouse, sample_warehouse
from ledgerlane.schemas import LOAD_ORDER
from ledgerlane.sources.layers import MARTS, RAW, LayerStore
from tests.conftest import SAMPLE

LOADED = datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv"))
    export_csv(sample_warehouse(spark, SAMPLE).raw_tables(), path)
    return path


def test_a_run_gives_the_same_fact_as_the_raw_tables(spark, folder, tmp_path):
    done = run(spark, folder, str(tmp_path), LOADED, gate=False, bounds=None)
    assert {row.table: row.status for row in done.loads.collect()} == dict.fromkeys(
        [*LOAD_ORDER, "GRAND TOTAL"], "OK"
    )
    expected = sample_warehouse(spark, SAMPLE).fact()
    assert done.marts.fact.exceptAll(expected).count() == expected.exceptAll(done.marts.fact).count() == 0
    assert set(done.reports(date(2024, 12, 31))) == {*REPORTS, *STAKEHOLDER_REPORTS}
    assert done.checks.count() == 24 + 136 + 22 + 6
    lines = expected.count()
    assert spark.sql("SELECT count(*) FROM marts.fct_purchase_order_lines").first()[0] == lines
    assert spark.sql("SELECT count(*) FROM raw.vendors").first()[0] == 10
    assert LayerStore(spark, str(tmp_path)).read(MARTS, "fct_purchase_order_lines").count() == lines


def test_a_second_run_updates_what_the_first_left(spark, folder, tmp_path):
    """A vendor moves and an order is cancelled between two runs; a new session carries on."""
    tables = sample_warehouse(spark, SAMPLE).raw_tables()
    first = run(spark, folder, str(tmp_path / "root"), LOADED, gate=False)
    chosen = first.marts.fact.where("NOT is_cancelled").first().po_id
    vendor = tables["vendors"].where("trim(vendor_name) <> ''").first().vendor_id
    tables["purchase_orders"] = tables["purchase_orders"].withColumn(
        "status", F.when(F.col("po_id") == chosen, "Dibatalkan").otherwise(F.col("status"))
    )
    tables["vendors"] = tables["vendors"].withColumn(
        "city", F.when(F.col("vendor_id") == vendor, "Bogor").otherwise(F.col("city"))
    )
    export_csv(tables, str(tmp_path / "csv"))
    second = run(spark, str(tmp_path / "csv"), str(tmp_path / "root"), datetime(2025, 2, 1), gate=False)
    versions = second.marts.vendors.where(F.col("vendor_id") == vendor).orderBy("record_version").collect()
    assert versions[-1].city == "Bogor" and versions[-1].dbt_valid_from == date(2025, 2, 1)
    assert versions[-2].dbt_valid_to == date(2025, 1, 31)
    store = LayerStore(spark, str(tmp_path / "root"))
    later = Warehouse(spark, lambda table, _: store.read(RAW, table), store, keep_raw=False)
    full = snapshot.order_lines_fact(
        *(later.staged(t) for t in ("purchase_order_lines", "purchase_orders", "goods_receipts")),
        *(store.read(MARTS, f"dim_{t}") for t in ("date", "vendors", "departments", "items")),
    )
    fact = second.marts.fact
    assert fact.exceptAll(full).count() == full.exceptAll(fact).count() == 0
    assert fact.where(F.col("po_id") == chosen).first().is_cancelled
    assert spark.sql("SELECT count(*) FROM marts.fct_purchase_order_lines WHERE is_cancelled").first()[0] == \
        fact.where("is_cancelled").count()


def test_the_command_line_writes_reports_in_full(spark, folder, tmp_path, capsys):
    expected = tmp_path / "expected.json"
    expected.write_text(json.dumps({
        "bounds": {name: [None, None] for name in SMOKE_BOUNDS},
        "accepted": {"dim_items": {"item_category": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}},
    }))
    assert main([folder, str(tmp_path / "root"), "--no-gate", "--expected", str(expected)]) == 0
    said = capsys.readouterr().out
    assert "Q1: " in said and "vendors: 10 rows, 0 set aside, OK" in said
    q1 = spark.read.parquet(f"{tmp_path}/root/reports/Q1")
    assert q1.count() == REPORTS["Q1"](sample_warehouse(spark, SAMPLE).marts()).count() == 80
    assert {p.name for p in (tmp_path / "root" / "reports").iterdir()} == {*REPORTS, *STAKEHOLDER_REPORTS}


def test_failed_checks_stop_a_run(spark, folder, tmp_path):
    with pytest.raises(ChecksFailed, match="accepted_values"):
        run(spark, folder, str(tmp_path), LOADED)


def test_readers_keep_the_former_tables_when_a_check_fails(spark, folder, tmp_path):
    """The second load has a repeated department; the third is right again and ends where a run that
    never saw the second one ends."""
    root = str(tmp_path / "root")
    accepted = {"dim_items": {"item_category": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}}
    run(spark, folder, root, LOADED, gate=False)
    reader = LayerStore(spark, root)
    names = [(RAW, "departments"), (RAW, "vendors"), (MARTS, "dim_vendors"), (MARTS, "fct_purchase_order_lines")]
    before = {name: (reader.version(*name), sorted(map(str, reader.read(*name).collect()))) for name in names}
    files = sorted(str(path) for path in (tmp_path / "root").glob("*/*/load=*") if "checks" not in str(path))
    tables = sample_warehouse(spark, SAMPLE).raw_tables()
    tables["departments"] = tables["departments"].unionAll(tables["departments"].limit(1))
    tables["vendors"] = tables["vendors"].withColumn("city", F.lit("Bogor"))
    tables["purchase_orders"] = tables["purchase_orders"].withColumn("status", F.lit("Dibatalkan"))
    export_csv(tables, str(tmp_path / "csv"))
    with pytest.raises(ChecksFailed, match="departments.department_id"):
        run(spark, str(tmp_path / "csv"), root, datetime(2025, 2, 1), accepted=accepted)
    for name in names:
        assert (reader.version(*name), sorted(map(str, reader.read(*name).collect()))) == before[name]
    assert spark.sql("SELECT count(*) FROM marts.dim_vendors WHERE city = 'Bogor' AND record_version > 1").first()[0] == 0
    left = sorted(str(path) for path in (tmp_path / "root").glob("*/*/load=*") if "checks" not in str(path))
    assert [path for path in left if "scratch" not in path] == [path for path in files if "scratch" not in path]
    assert reader.read("checks", "declared").where("NOT passed").count() > 0
    third = run(spark, folder, root, datetime(2025, 3, 1), gate=False)
    assert third.marts.vendors.count() == len(before[MARTS, "dim_vendors"][1])
    assert sorted(map(str, reader.read(MARTS, "fct_purchase_order_lines").collect())) == \
        before[MARTS, "fct_purchase_order_lines"][1]


def test_model_names_in_sql(spark):
    sample_warehouse(spark, SAMPLE).register_views()
    joined = spark.sql("""
        SELECT count(*) FROM fct_purchase_order_lines f JOIN dim_date d ON f.date_key_po_date = d.date_key
    """).first()[0]
    assert joined == spark.sql("SELECT count(*) FROM int_po_lifecycle").first()[0]
    assert spark.sql("SELECT count(*) FROM stg_items").first()[0] == 199
