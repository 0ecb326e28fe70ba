from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from ledgerlane.operators import staging
from tests.conftest import values


def test_blank_and_missing_names_are_dropped(raw):
    rows = raw("departments", dict(department_name="   "), dict(department_name=None),
               dict(department_id=None), dict(department_name=" IT ", budget_annual=5))
    kept = staging.departments(rows).collect()
    assert values(kept, "department_name") == ["IT"]
    assert kept[0].budget_annual_idr == Decimal(5)
    assert kept[0].loaded_at == datetime(2025, 1, 1)


def test_vendor_columns(raw):
    rows = raw("vendors",
               dict(vendor_type="Barang & Jasa", postal_code=6132, email=" A@B.Co ", rating=4.25),
               dict(vendor_type=" Jasa ", postal_code=123456, rating=3.349),
               dict(vendor_type=None, rating=None))
    a, b, c = staging.vendors(rows).collect()
    assert (a.postal_code, b.postal_code, c.postal_code) == ("06132", "12345", None)
    assert (a.email, a.vendor_rating, b.vendor_rating) == ("a@b.co", Decimal("4.3"), Decimal("3.3"))
    assert (a.is_goods_vendor, a.is_service_vendor) == (True, True)
    assert (b.is_goods_vendor, b.is_service_vendor) == (False, True)
    assert (c.is_goods_vendor, c.is_service_vendor) == (False, False)


def test_price_tiers_and_fast_moving(raw):
    prices = [99_999, 100_000, 1_000_000, 1_000_001, None]
    rows = raw("items", *[dict(item_id=i, unit_price=p) for i, p in enumerate(prices)])
    kept = staging.items(rows).orderBy("item_id").collect()
    assert values(kept, "price_tier") == ["Murah", "Menengah", "Menengah", "Mahal", "Mahal"]
    days = raw("items", *[dict(item_id=i, lead_time_days=d) for i, d in enumerate([3, 4, None])])
    assert values(staging.items(days).orderBy("item_id").collect(), "is_fast_moving") == [
        True, False, False
    ]


def test_request_flags_and_notes(raw):
    rows = raw("purchase_requests",
               dict(pr_id=1, status=" Disetujui ", approval_date=date(2024, 1, 4), notes="  "),
               dict(pr_id=2, status=None, total_amount=7, notes=" x "),
               dict(pr_id=3, pr_date=None))
    a, b = staging.purchase_requests(rows).orderBy("pr_id").collect()
    assert (a.is_approved, a.approval_lead_days, a.notes, a.total_amount_idr) == (True, 3, None, 0)
    assert (a.pr_year, a.pr_month, a.pr_year_month) == (2024, 1, "2024-01")
    assert (b.is_approved, b.is_rejected, b.is_pending) == (False, False, False)
    assert (b.approval_lead_days, b.notes, b.total_amount_idr) == (None, "x", 7)


@pytest.mark.parametrize("status,flags", [
    ("Terbuka", (True, False, False, False, True)),
    ("Sebagian Diterima", (False, True, False, False, True)),
    ("Selesai", (False, False, True, False, False)),
    (" Dibatalkan ", (False, False, False, True, False)),
    ("lain", (False, False, False, False, True)),
    (None, (False, False, False, False, False)),
])
def test_order_flags(raw, status, flags):
    row = staging.purchase_orders(raw("purchase_orders", dict(status=status))).first()
    assert (row.is_open, row.is_partial, row.is_completed, row.is_cancelled,
            row.is_active_po) == flags
    assert row.expected_lead_time_days == 10


def test_half_rupiah_rounds_up(raw):
    line = dict(unit_price=10, quantity_ordered=1, discount_pct=5)
    row = staging.purchase_order_lines(raw("purchase_order_lines", line)).first()
    assert (row.net_unit_price_idr, row.net_total_price_idr, row.discount_amount_idr) == (10, 10, 1)


def test_discount_tiers_and_missing_discount(raw):
    rates = [None, 0, 1, 5, 6, 10, 11]
    rows = raw("purchase_order_lines", *[dict(line_id=i, discount_pct=d) for i, d in enumerate(rates)])
    kept = staging.purchase_order_lines(rows).orderBy("line_id").collect()
    assert values(kept, "discount_tier") == [
        "Tanpa Diskon", "Tanpa Diskon", "Diskon Kecil", "Diskon Kecil", "Diskon Sedang",
        "Diskon Sedang", "Diskon Besar",
    ]
    assert values(kept, "has_discount") == [False, False, True, True, True, True, True]
    assert kept[0].discount_pct == Decimal("0.00")


def test_lines_without_quantity_or_key_are_dropped(raw):
    rows = raw("purchase_order_lines", dict(quantity_ordered=0), dict(quantity_ordered=-1),
               dict(quantity_ordered=None), dict(item_id=None), dict(po_id=None))
    assert staging.purchase_order_lines(rows).count() == 0


@pytest.mark.parametrize("on_time,days,label", [
    (True, 99, "Tepat Waktu"),
    (False, 7, "Terlambat ≤1 Minggu"),
    (False, 14, "Terlambat ≤2 Minggu"),
    (None, 30, "Terlambat ≤1 Bulan"),
    (False, 31, "Terlambat >1 Bulan"),
    (False, None, "Terlambat >1 Bulan"),
])
def test_timeliness_goes_by_lead_time(raw, on_time, days, label):
    receipt = dict(is_on_time=on_time, lead_time_days=days)
    row = staging.goods_receipts(raw("goods_receipts", receipt)).first()
    assert row.delivery_timeliness == label


@pytest.mark.parametrize("ordered,variance,label", [
    (10, 0, "Tidak Ada Kekurangan"),
    (10, 3, "Tidak Ada Kekurangan"),
    (10, -1, "Kurang Ringan (<10%)"),
    (100, -11, "Kurang Sedang (10–25%)"),
    (4, -1, "Kurang Sedang (10–25%)"),
    (100, -26, "Kurang Parah (>25%)"),
    (10, None, "Kurang Parah (>25%)"),
    (0, -1, "Kurang Parah (>25%)"),
])
def test_shortage_severity(raw, ordered, variance, label):
    receipt = dict(quantity_ordered=ordered, quantity_variance=variance)
    row = staging.goods_receipts(raw("goods_receipts", receipt)).first()
    assert row.shortage_severity == label
    assert row.is_short_delivery == bool(variance is not None and variance < 0)
    assert row.is_over_delivery == bool(variance is not None and variance > 0)
    assert row.is_full_delivery == (variance == 0)
    assert row.quantity_fulfillment_pct == (None if ordered == 0 else Decimal(1000) / ordered)


def test_receipt_values_and_filters(raw):
    rows = raw("goods_receipts", dict(gr_id=1, quantity_variance=-3, unit_price=10.5),
               dict(gr_id=2, unit_price=None), dict(gr_id=3, quantity_received=-1),
               dict(gr_id=4, gr_date=None), dict(gr_id=5, inspection_status=" Ditolak "))
    a, b, c = staging.goods_receipts(rows).orderBy("gr_id").collect()
    assert (a.shortage_value_idr, b.shortage_value_idr, b.unit_price_idr) == (32, 0, 0)
    assert (c.is_rejected_by_inspection, a.needs_reinspection) == (True, False)


def test_values_near_a_half_are_rounded_once(raw):
    rows = raw("goods_receipts", dict(gr_id=1, variance_pct=0.0049999996), dict(gr_id=2, variance_pct=-0.005),
               dict(gr_id=3, variance_pct=1.005), dict(gr_id=4, variance_pct=1.0e-7))
    found = {row.gr_id: row.variance_pct for row in staging.goods_receipts(rows).collect()}
    assert found == {1: Decimal("0.00"), 2: Decimal("-0.01"), 3: Decimal("1.01"), 4: Decimal("0.00")}
    rated = staging.vendors(raw("vendors", dict(rating=3.04999999999))).first()
    assert rated.vendor_rating == Decimal("3.0")


def test_prices_keep_their_decimals(raw):
    row = staging.goods_receipts(raw("goods_receipts", dict(unit_price=1.00004, quantity_variance=-99_995))).first()
    assert (row.unit_price_idr, row.shortage_value_idr) == (Decimal("1.00004"), 99_999)
