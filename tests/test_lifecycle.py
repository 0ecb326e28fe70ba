from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ledgerlane.operators import staging
from ledgerlane.operators.lifecycle import latest_receipts, order_lifecycle


@pytest.fixture()
def run(raw):
    def build(line=(), order=(), receipts=()):
        lines = staging.purchase_order_lines(raw("purchase_order_lines", dict(line)))
        orders = staging.purchase_orders(raw("purchase_orders", dict(order)))
        found = raw("goods_receipts", *receipts) if receipts else raw("goods_receipts").limit(0)
        return order_lifecycle(lines, orders, latest_receipts(staging.goods_receipts(found)))

    return build


def test_line_without_receipt(run):
    row = run().first()
    assert row.lifecycle_stage == "Ditutup Tanpa Penerimaan"
    assert (row.quantity_received, row.quantity_received_coalesced) == (None, 0)
    assert (row.fulfillment_pct, row.delivery_timeliness, row.is_on_time) == (0, None, None)
    assert (row.has_goods_receipt, row.is_fully_fulfilled) == (False, False)
    assert (row.is_rejected_by_inspection, row.lead_time_variance_days) == (False, None)
    assert (row.net_total_received_idr, row.value_shortfall_idr) == (0, 1000)


@pytest.mark.parametrize("status,received,stage", [
    ("Dibatalkan", 10, "Dibatalkan"),
    ("Dibatalkan", None, "Dibatalkan"),
    ("Terbuka", None, "Menunggu Penerimaan"),
    ("Selesai", None, "Ditutup Tanpa Penerimaan"),
    ("Selesai", 10, "Selesai – Terpenuhi Penuh"),
    ("Terbuka", 12, "Selesai – Terpenuhi Penuh"),
    ("Selesai", 3, "Selesai – Terpenuhi Sebagian"),
    ("Selesai", 0, "Tidak Ada Penerimaan"),
])
def test_stages(run, status, received, stage):
    receipts = [] if received is None else [dict(quantity_received=received)]
    assert run(order=dict(status=status), receipts=receipts).first().lifecycle_stage == stage


def test_latest_receipt_wins_and_ties_go_to_the_higher_number(run):
    older = dict(gr_id=9, gr_date=date(2024, 1, 5), quantity_received=1)
    newer = dict(gr_id=2, gr_date=date(2024, 1, 6), quantity_received=4)
    tied = dict(gr_id=3, gr_date=date(2024, 1, 6), quantity_received=5)
    assert run(receipts=[older, newer]).first().gr_id == 2
    rows = run(receipts=[older, tied, newer]).collect()
    assert [row.gr_id for row in rows] == [3]
    assert (rows[0].unfulfilled_qty, rows[0].fulfillment_pct) == (5, Decimal("50.00"))


def test_line_without_order_is_dropped(run):
    assert run(line=dict(po_id=99)).count() == 0


def test_values_and_lead_times(run):
    row = run(
        line=dict(unit_price=33, quantity_ordered=10, discount_pct=5, total_price=330),
        receipts=[dict(quantity_received=12, quantity_variance=2, lead_time_days=8,
                       inspection_status="Ditolak")],
    ).first()
    assert row.net_total_ordered_idr == 314  # 313.5 rounded once
    assert row.net_total_received_idr == 12 * 31  # from the rounded unit price
    assert row.value_shortfall_idr == 314 - 372
    assert row.rejected_goods_value_idr == 372
    assert (row.unfulfilled_qty, row.lead_time_variance_days) == (-2, -2)
