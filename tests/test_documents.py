from __future__ import annotations

import hashlib
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlane.functions.text import document_number, zero_filled
from ledgerlane.operators import documents


def test_totals_are_zero_without_children(raw):
    orders = raw("purchase_orders", dict(po_id=1, pr_id=5), dict(po_id=2, pr_id=5), dict(po_id=3, pr_id=6))
    lines = raw("purchase_order_lines", dict(line_id=1, po_id=1, total_price=7),
                dict(line_id=2, po_id=1, total_price=8), dict(line_id=3, po_id=2, total_price=9))
    filled = documents.with_order_totals(orders, lines)
    assert dict(filled.select("po_id", "total_amount").collect()) == {1: 15, 2: 9, 3: 0}
    requests = raw("purchase_requests", dict(pr_id=5), dict(pr_id=6), dict(pr_id=7))
    found = documents.with_request_totals(requests, filled)
    assert dict(found.select("pr_id", "total_amount").collect()) == {5: 24, 6: 0, 7: 0}


def test_unused_totals_cost_no_join(spark, raw):
    orders, lines = raw("purchase_orders"), raw("purchase_order_lines")
    plan = documents.with_order_totals(orders, lines).select("po_id")._jdf.queryExecution()
    assert "Join" not in plan.optimizedPlan().toString()


def test_eligible_rows(raw):
    orders = raw("purchase_orders", *[dict(po_id=i, status=s) for i, s in enumerate(
        ["Selesai", "Sebagian Diterima", "Terbuka", None])])
    lines = raw("purchase_order_lines", *[dict(line_id=i, po_id=i) for i in range(5)])
    kept = documents.receivable_lines(lines, orders).collect()
    assert sorted(row.line_id for row in kept) == [0, 1]
    items = raw("items", dict(item_id=1, is_active=True), dict(item_id=2, is_active=False), dict(item_id=3))
    assert [row.item_id for row in documents.active(items).collect()] == [1]
    requests = raw("purchase_requests", dict(pr_id=1, status="Disetujui"), dict(pr_id=2, status="Ditolak"))
    assert [row.pr_id for row in documents.approved_requests(requests).collect()] == [1]


@pytest.mark.parametrize("ordered,received,percent,status", [
    (10, 10, 0.0, "Lengkap"),
    (10, 11, 10.0, "Lebih"),
    (10, 9, -10.0, "Kurang"),
    (100, 75, -25.0, "Kurang Signifikan"),
    (100, 74, -26.0, "Barang Sangat Kurang"),
    (3, 2, -33.33, "Barang Sangat Kurang"),
    (0, 1, None, "Lebih"),
])
def test_receipt_measures(spark, ordered, received, percent, status):
    day, due = date(2024, 1, 1), date(2024, 1, 10)
    rows = spark.createDataFrame(
        [(day, due, date(2024, 1, 11), ordered, received)],
        "po_date date, expected_delivery_date date, gr_date date, quantity_ordered long, quantity_received long",
    )
    row = documents.with_receipt_measures(rows).first()
    assert (row.quantity_variance, row.variance_pct) == (received - ordered, percent)
    assert (row.receipt_status, row.lead_time_days, row.is_on_time) == (status, 10, False)


def test_numbers_are_padded_but_never_cut(spark):
    rows = spark.createDataFrame([(7, date(2024, 3, 1)), (1234567, None)], "n long, d date")
    found = rows.select(zero_filled(F.col("n"), 5), document_number("PO", F.col("d"), F.col("n"), 5)).collect()
    assert [tuple(row) for row in found] == [("00007", "PO-202403-00007"), ("1234567", None)]


@pytest.mark.parametrize("wanted", [0, 1, 17, 2_000, 9_999, 10_000, 50_000])
def test_sample_has_its_size_and_is_the_same_however_rows_are_dealt(spark, wanted):
    rows = spark.range(10_000)
    drawn = documents.sample_rows(rows, wanted, "id", seed=1)
    found = sorted(row.id for row in drawn.collect())
    by_hash = sorted(range(10_000), key=lambda k: (hashlib.md5(f"1|{k}".encode()).hexdigest(), k))
    assert found == sorted(by_hash[:wanted])
    again = documents.sample_rows(rows.repartition(7), wanted, "id", seed=1)
    assert sorted(row.id for row in again.collect()) == found


def test_samples_of_other_seeds_differ(spark):
    one, two = (
        {row.id for row in documents.sample_rows(spark.range(1000), 500, "id", seed).collect()} for seed in (1, 2)
    )
    assert 150 < len(one & two) < 350


@pytest.mark.parametrize("held,wanted", [(10_000, 0), (10_000, 1), (10_000, 10_000), (3, 5_000), (1, 40), (0, 10)])
def test_drawing_with_replacement_has_its_size(spark, held, wanted):
    rows = spark.range(held).withColumn("other", F.col("id") * 2)
    drawn = documents.sample_with_replacement(rows, wanted, "id", seed=1)
    assert drawn.columns == rows.columns
    counts = dict(drawn.groupBy("id").count().collect())
    by_hash = sorted(range(held), key=lambda k: (hashlib.md5(f"1|{k}".encode()).hexdigest(), k))
    expected = Counter(
        by_hash[int(hashlib.md5(f"1|draw|{j}".encode()).hexdigest()[:15], 16) % held] for j in range(wanted if held else 0)
    )
    assert counts == expected and sum(counts.values()) == (wanted if held else 0)
    again = documents.sample_with_replacement(rows.repartition(5), wanted, "id", seed=1)
    assert dict(again.groupBy("id").count().collect()) == counts


def test_draws_with_replacement_are_even(spark):
    """The share never drawn is 1/e, and the spread over tenths of the ids is that of chance."""
    drawn = documents.sample_with_replacement(spark.range(10_000), 10_000, "id", seed=3)
    tenths = [row["count"] for row in drawn.groupBy((F.col("id") / 1000).cast("int")).count().collect()]
    assert abs(drawn.distinct().count() - 6_321) < 150
    assert sum((n - 1000) ** 2 / 1000 for n in tenths) < 28  # chi-square of nine degrees, one in a thousand


def test_a_row_without_key_can_be_drawn(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,)], "id long")
    assert documents.sample_rows(rows, 5, "id", seed=1).count() == 3
    drawn = documents.sample_with_replacement(rows, 200, "id", seed=1)
    assert drawn.count() == 200 and drawn.where("id is null").count() > 20


def test_profile_and_shapes(raw):
    receipts = raw("goods_receipts", *[
        dict(gr_id=i, lead_time_days=d, variance_pct=v, is_on_time=t)
        for i, (d, v, t) in enumerate([(1, -10.0, True), (2, 0.0, False), (10, 5.5, None)])
    ])
    row = documents.receipt_profile(receipts).first()
    assert (row.lead_min, row.lead_median, row.lead_mean, row.lead_max) == (1, 2.0, Decimal("4.3"), 10)
    assert (row.on_time_pct, row.variance_mean) == (Decimal("50.0"), Decimal("-1.50"))
    shapes = documents.shape_report({"a": receipts, "b": receipts.limit(1)}).collect()
    assert {row.table: (row.rows, row.columns) for row in shapes} == {
        "a": (3, 21), "b": (1, 21), documents.GRAND_TOTAL: (4, 42)
    }
    counts = documents.value_counts(receipts, "is_on_time").collect()
    assert {row.value: row.rows for row in counts} == {True: 1, False: 1}
