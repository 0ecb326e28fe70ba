from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlane.functions import text
from ledgerlane.operators import dimensions, lifecycle, snapshot, staging, tracking
from ledgerlane.plans.warehouse import FACT, Warehouse, sample_warehouse
from ledgerlane.schemas import BUCKET_KEYS, RECEIPT_STATUSES
from ledgerlane.sources.layers import MARTS, RAW, LayerStore
from tests.conftest import SAMPLE


@pytest.fixture(scope="module")
def warehouse(spark):
    return sample_warehouse(spark, SAMPLE)


@pytest.fixture()
def fact_of(spark, raw):
    def build(order=()):
        return snapshot.order_lines_fact(
            staging.purchase_order_lines(raw("purchase_order_lines")),
            staging.purchase_orders(raw("purchase_orders", dict(order))),
            staging.goods_receipts(raw("goods_receipts")),
            dimensions.calendar(spark),
            dimensions.vendors(staging.vendors(raw("vendors", dict(vendor_id=3)))),
            dimensions.departments(staging.departments(raw("departments"))),
            dimensions.items(staging.items(raw("items"))),
        )

    return build


def test_order_outside_the_calendar_keeps_its_row(fact_of):
    row = fact_of(dict(po_date=date(2017, 12, 31))).first()
    assert (row.date_key_po_date, row.po_year) == (None, 2017)
    assert (row.date_key_delivery_expected, row.date_key_gr_date) == (20240111, 20240109)


def test_the_current_vendor_version_is_used_even_for_old_orders(fact_of):
    rows = fact_of(dict(vendor_id=3, po_date=date(2020, 5, 1))).collect()
    assert len(rows) == 1
    current = dimensions.surrogate_key(F.lit(3), F.lit("2022-01-01"))
    spark = fact_of().sparkSession
    assert rows[0].vendor_sk == spark.range(1).select(current).first()[0]


def test_unknown_vendor_keeps_its_row(fact_of):
    assert fact_of(dict(vendor_id=77)).first().vendor_sk is None


def test_columns(fact_of):
    assert tuple(fact_of().columns) == snapshot.FACT_COLUMNS
    assert len(snapshot.FACT_COLUMNS) == 63


def test_invariants(warehouse):
    fact = warehouse.fact()
    lines, orders = warehouse.staged("purchase_order_lines"), warehouse.staged("purchase_orders")
    kept = lines.join(orders, "po_id", "left_semi").count()
    checks = fact.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("po_line_id").alias("lines"),
        F.count_if(F.expr(
            "net_total_ordered_idr - net_total_received_idr <> value_shortfall_idr"
        )).alias("unbalanced"),
        F.count_if(F.expr("has_goods_receipt <> (gr_date IS NOT NULL)")).alias("unmarked"),
        F.count_if(F.expr("unfulfilled_qty + quantity_received_calc <> quantity_ordered"))
        .alias("odd"),
    ).first()
    assert checks.rows == checks.lines == kept
    assert (checks.unbalanced, checks.unmarked, checks.odd) == (0, 0, 0)


def test_every_vendor_has_one_current_version_and_versions_do_not_overlap(warehouse):
    vendors = warehouse.vendors()
    current = vendors.groupBy("vendor_id").agg(F.count_if("is_current_record").alias("n"))
    assert current.filter("n <> 1").count() == 0
    a, b = vendors.alias("a"), vendors.alias("b")
    overlapping = a.join(b, F.expr(
        "a.vendor_id = b.vendor_id AND a.record_version < b.record_version "
        "AND coalesce(a.dbt_valid_to, DATE '9999-12-31') >= b.dbt_valid_from"
    ))
    assert overlapping.count() == 0


def earlier(warehouse):
    """Sources as they were: another status of old orders, other lines, other and missing receipts."""
    lines, orders, receipts = (
        warehouse.staged(t) for t in ("purchase_order_lines", "purchase_orders", "goods_receipts")
    )
    gone = lines.where("line_id % 3 = 0").withColumn("line_id", -F.col("line_id"))
    return (
        lines.where("line_id % 5 <> 0").unionByName(gone),
        orders.withColumn("po_status", F.when(F.col("po_date") < "2019-06-01", "Terbuka").otherwise(F.col("po_status"))),
        receipts.where("gr_id % 7 <> 0").withColumn("inspection_status", F.lit("Lulus")),
    )


def dimensions_of(warehouse):
    return warehouse.dates(), warehouse.vendors(), warehouse.departments(), warehouse.items()


def test_merging_changes_gives_the_full_rebuild(warehouse):
    stored = snapshot.sources(*earlier(warehouse), *dimensions_of(warehouse)).fact()
    merged, full = warehouse.refreshed_fact(stored), warehouse.fact()
    assert merged.exceptAll(full).count() == full.exceptAll(merged).count() == 0


def test_only_changed_lines_are_found(warehouse):
    given = warehouse.fact_sources()
    assert snapshot.changes(given.fact(), given).count() == 0
    orders = given.orders.withColumn("po_status", F.lit("Dibatalkan")).where("po_id > 0")
    one = given.orders.select(F.max("po_id")).first()[0]
    changed = given.fact().where(F.col("po_id") != one)
    found = snapshot.changes(changed, given)
    assert {row.po_id for row in found.collect()} == {one} and orders.count() > 1


def test_an_update_writes_only_touched_years(spark, warehouse, tmp_path):
    """One order of one year is cancelled; other years keep their files, and so does nobody's reader."""
    store = LayerStore(spark, str(tmp_path / "store"))
    for name, rows in warehouse.raw_tables().items():
        store.write(RAW, name, rows)

    def open_warehouse():
        opened = LayerStore(spark, str(tmp_path / "store"))
        return Warehouse(spark, lambda table, _: opened.read(RAW, table), opened, keep_raw=False), opened

    first, _ = open_warehouse()
    assert first.update_fact() == []
    before = first.fact()
    rows = before.count()
    orders = store.read(RAW, "purchase_orders")
    chosen = before.where("po_year = 2020 AND NOT is_cancelled").first().po_id
    status = F.when(F.col("po_id") == chosen, "Dibatalkan").otherwise(F.col("status"))
    store.write(RAW, "purchase_orders", orders.withColumn("status", status))
    second, opened = open_warehouse()
    old_parts = opened._state(MARTS, FACT)["parts"]
    assert second.update_fact() == [2020]
    parts = opened._state(MARTS, FACT)["parts"]
    written = {part.split("/")[1] for part in parts if not part.startswith(old_parts[0])}
    assert written == {"po_year=2020"} and len(parts) > 2
    assert before.count() == rows  # files of the former state are still there
    after, full = second.fact(), second.build_fact()
    assert after.exceptAll(full).count() == full.exceptAll(after).count() == 0
    assert after.where("is_cancelled").count() > before.where("is_cancelled").count()
    third, _ = open_warehouse()
    assert third.update_fact() == []


def shuffled(spark) -> int:
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


@pytest.fixture()
def kept(spark, warehouse, tmp_path):
    """Opens a warehouse over one stored root, each time as a later session would."""
    store = LayerStore(spark, str(tmp_path / "store"))
    for name, rows in warehouse.raw_tables().items():
        store.write(RAW, name, rows, bucket_key=BUCKET_KEYS.get(name))

    def load(table, change):
        store.write(RAW, table, change(store.read(RAW, table)), bucket_key=BUCKET_KEYS.get(table))

    def opened():
        found = LayerStore(spark, store.root)
        return Warehouse(spark, lambda table, _: found.read(RAW, table), found, keep_raw=False)

    return load, opened


def test_fingerprints_find_every_kind_of_change(spark, kept):
    """Lines, orders, receipts and keys of dimensions; new, changed and gone; moved to another order."""
    load, opened = kept
    opened().update_fact()
    two = opened().staged("purchase_orders").orderBy("po_id").limit(2).collect()

    def lines(rows):
        moved = F.when(F.col("po_id") == two[0].po_id, two[1].po_id).otherwise(F.col("po_id"))
        more = rows.where("line_id % 50 = 1").withColumn("line_id", -F.col("line_id"))
        return rows.where("line_id % 50 <> 2").withColumn("po_id", moved).unionByName(more)

    def newer(rows):
        again = rows.where("gr_id % 40 = 3").withColumns({"gr_id": -F.col("gr_id"), "gr_date": F.date_add("gr_date", 1)})
        return rows.where("gr_id % 40 <> 5").unionByName(again)

    other = F.when(F.col("po_id") % 30 == 0, F.lit("Dibatalkan")).otherwise(F.col("status"))
    steps = (
        ("purchase_order_lines", lines), ("goods_receipts", newer),
        ("purchase_orders", lambda rows: rows.where("po_id % 60 <> 7").withColumn("status", other)),
        ("vendors", lambda rows: rows.where("vendor_id <> 3")), ("items", lambda rows: rows.where("item_id % 20 <> 3")),
    )
    for table, change in steps:
        load(table, change)
    later = opened()
    later.update_fact()
    found, full = later.fact(), later.build_fact()
    assert found.exceptAll(full).count() == full.exceptAll(found).count() == 0
    assert opened().update_fact() == []


def test_what_an_update_shuffles_follows_the_change(spark, kept):
    load, opened = kept
    start = shuffled(spark)
    opened().update_fact()
    built = shuffled(spark) - start
    one = opened().staged("purchase_orders").select(F.min("po_id")).first()[0]
    status = F.when(F.col("po_id") == one, "Dibatalkan").otherwise(F.col("status"))
    load("purchase_orders", lambda rows: rows.withColumn("status", status))
    later = opened()
    for dimension in (later.dates, later.vendors, later.departments, later.items):
        dimension()
    start = shuffled(spark)
    assert len(later.update_fact()) == 1
    assert shuffled(spark) - start < built / 10
    assert later.fact().where(F.col("po_id") == one).first().is_cancelled


def test_many_changed_keys_meet_their_tables_in_buckets(spark, warehouse, kept, monkeypatch):
    monkeypatch.setattr(tracking, "FEW_KEYS", 0)
    load, opened = kept
    opened().update_fact()
    load("purchase_order_lines", lambda rows: rows.withColumn("quantity_ordered", F.col("quantity_ordered") + 1))
    later = opened()
    later.update_fact()
    found, full = later.fact(), later.build_fact()
    assert found.exceptAll(full).count() == full.exceptAll(found).count() == 0


def test_a_source_meets_its_former_state_without_a_shuffle(spark, kept):
    _, opened = kept
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = opened()
        old = first.track(first._fingerprints(), "former")
        for name in ("lines", "orders", "receipts"):
            found = tracking.differing(old[name], first._fingerprints()[name], tracking.KEYS[name])
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, name
            assert found.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_order_with_a_third_of_the_lines(spark, warehouse):
    lines, orders, receipts = (
        warehouse.staged(t) for t in ("purchase_order_lines", "purchase_orders", "goods_receipts")
    )
    hot = orders.select(F.min("po_id")).first()[0]
    lines = lines.withColumn("po_id", F.when(F.col("line_id") % 3 == 0, hot).otherwise(F.col("po_id")))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        given = snapshot.sources(lines, orders, receipts, *dimensions_of(warehouse))
        was = snapshot.sources(
            lines, orders.withColumn("po_status", F.lit("Terbuka")), receipts, *dimensions_of(warehouse)
        ).fact()
        changed = snapshot.changes(was, given)
        merged, full = snapshot.merged(was, changed, given), given.fact()
        assert merged.exceptAll(full).count() == full.exceptAll(merged).count() == 0
        assert changed.where(F.col("po_id") == hot).count() > full.count() / 4
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_only_bounded_tables_are_broadcast_by_request(spark, warehouse):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warehouse.build_fact()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hinted = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert len(hinted) == 3 and all("_day" in line for line in hinted)
    # stored receipts lie in buckets of their line: they are cut to one per line where they lie
    cut = plan.split("WindowGroupLimit")
    assert len(cut) == 2 and "Exchange" not in cut[1].split("FileScan")[0]


def test_receipts_that_lie_elsewhere_are_cut_before_their_shuffle(warehouse):
    loose = staging.goods_receipts(warehouse.raw("goods_receipts").repartition("gr_id"))
    plan = lifecycle.latest_receipts(loose)._jdf.queryExecution().executedPlan().toString()
    last, first = (part.split("FileScan")[0] for part in plan.split("WindowGroupLimit")[1:])
    assert "hashpartitioning(po_line_id" in last and "hashpartitioning(po_line_id" not in first


def test_a_former_fact_in_parts_is_brought_up_to_date(spark, warehouse):
    """Given by its sources, the changed lines are left out before they are joined."""
    lines, orders, receipts = (warehouse.raw(t) for t in ("purchase_order_lines", "purchase_orders", "goods_receipts"))
    more = lines.withColumn("quantity_ordered", F.col("quantity_ordered") + (F.col("line_id") % 3 == 0).cast("int"))
    halves = [more.where("line_id % 2 = 0"), more.where("line_id % 2 <> 0")]
    dims = dimensions_of(warehouse)
    known = tracking.fingerprints(more, orders, receipts, *dims)
    parts = [
        snapshot.sources(staging.purchase_order_lines(half), staging.purchase_orders(orders), staging.goods_receipts(receipts), *dims)
        for half in halves
    ]
    full = warehouse.fact()
    for found in (warehouse.refreshed_fact(parts, known), warehouse.refreshed_fact(parts).select(*full.columns)):
        assert found.exceptAll(full).count() == 0 and found.count() == full.count()


def test_labels_and_keys_come_back_as_they_were(spark):
    texts = [None, "", " ", "Kurang", "kurang", "Lebih", "0a", "0A", "abc", "\u00e9", "d41d8cd98f00b204e9800998ecf8427e"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    place, other = text.label_code(F.col("t"), RECEIPT_STATUSES)
    coded = rows.select("t", place.alias("p"), other.alias("o"), text.packed_key(F.col("t")).alias("k"))
    back = coded.select("t", text.coded_label(F.col("p"), F.col("o"), RECEIPT_STATUSES).alias("l"), text.unpacked_key(F.col("k")).alias("u"))
    assert all(row.t == row.l == row.u for row in back.collect())
    assert coded.where("t = 'Kurang'").first().o is None and len(coded.where("length(t) = 32").first().k) == 17
