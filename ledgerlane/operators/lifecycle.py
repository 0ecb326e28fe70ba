"""One row per order line, from order to receipt.

Join order: lines first meet their latest receipt on the line key, then the order on the order
key. The result leaves the last join clustered by order, so the stored fact keeps the lines of an
order next to each other and counting distinct orders later combines them before its shuffle. What is
moved for it is made small first: labels go as their places in the declared lists, keys as bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.numeric import fulfilment, value_of
from ledgerlane.functions.text import coded_label, label_code, packed_key, unpacked_key
from ledgerlane.schemas import (
    DISCOUNT_TIERS,
    INSPECTION_STATUSES,
    LIFECYCLE_STAGES,
    MONEY,
    ORDER_STATUSES,
    PERCENT,
    RECEIPT_STATUSES,
    SHORTAGES,
    TIMELINESS,
)

# Columns of lines and receipts that mostly hold one of a few labels; any other text stays as it is.
_LINE_LABELS = {"discount_tier": DISCOUNT_TIERS, "line_status": ORDER_STATUSES}
_RECEIPT_LABELS = {
    "receipt_status": RECEIPT_STATUSES, "delivery_timeliness": TIMELINESS, "shortage_severity": SHORTAGES,
    "inspection_status": INSPECTION_STATUSES,
}


def latest_receipts(receipts: DataFrame) -> DataFrame:
    """The last receipt of each line; equal dates are settled by the higher receipt number.

    Ranking with a limit of one lets Spark keep a single row per line and task before the shuffle,
    so a line with very many receipts never reaches one task whole.
    """
    newest = Window.partitionBy("po_line_id").orderBy(F.desc("gr_date"), F.desc("gr_id"))
    ranked = receipts.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter("_rank = 1").drop("_rank")


def stage(cancelled: Column, opened: Column, receipt: Column, received: Column,
          ordered: Column) -> Column:
    """Position of a line between order and receipt; the first matching rule decides."""
    dropped, waiting, closed, full, part, nothing = LIFECYCLE_STAGES
    return (
        F.when(cancelled, dropped)
        .when(receipt.isNull() & opened, waiting)
        .when(receipt.isNull() & ~opened, closed)
        .when(received >= ordered, full)
        .when(received > 0, part)
        .otherwise(nothing)
    )


def _packed(rows: DataFrame, alias: str, labels: Mapping[str, Sequence[str]]
            ) -> tuple[DataFrame, Callable[[str], Column]]:
    """Rows with their labels and surrogate keys made small, under an alias, and what gives a column of
    them as it was, under its name."""
    packed, given = {}, {}
    for name in rows.columns:
        if name in labels:
            place, other = f"_place_{name}", f"_other_{name}"
            packed[place], packed[other] = label_code(F.col(name), labels[name])
            given[name] = coded_label(F.col(f"{alias}.{place}"), F.col(f"{alias}.{other}"), labels[name])
        elif name.endswith("_sk"):
            packed[f"_bytes_{name}"] = packed_key(F.col(name))
            given[name] = unpacked_key(F.col(f"{alias}._bytes_{name}"))
    small = rows.withColumns(packed).drop(*given) if given else rows
    return small.alias(alias), lambda name: given.get(name, F.col(f"{alias}.{name}")).alias(name)


def order_lifecycle(
    lines: DataFrame,
    orders: DataFrame,
    receipts: DataFrame,
    *,
    line_extras: Sequence[str] = (),
    order_extras: Sequence[str] = (),
    receipt_extras: Sequence[str] = (),
) -> DataFrame:
    """Join staged lines, orders and latest receipts and derive the lifecycle measures.

    ``receipts`` holds at most one row per line (see :func:`latest_receipts`). The extras name
    columns the caller attached to a side beforehand and wants carried through.
    """
    line, of_line = _packed(lines, "line", _LINE_LABELS)
    gr, of_receipt = _packed(receipts, "gr", _RECEIPT_LABELS)
    order = orders.alias("ord")
    joined = line.join(gr, F.col("line.line_id") == F.col("gr.po_line_id"), "left").join(
        order, F.col("line.po_id") == F.col("ord.po_id")
    )

    ordered = F.col("line.quantity_ordered")
    received = F.col("gr.quantity_received")
    counted = F.coalesce(received, F.lit(0))
    has_receipt = F.col("gr.gr_id").isNotNull()
    # a whole count times a whole price: nothing is left to round
    value = value_of(F.col("line.net_unit_price_idr"), counted)
    rejected = F.coalesce(F.col("gr.is_rejected_by_inspection"), F.lit(False))

    return joined.select(
        F.col("line.line_id").alias("po_line_id"),
        "line.po_id",
        "ord.pr_id",
        "ord.vendor_id",
        "ord.department_id",
        "line.item_id",
        "gr.gr_id",
        "ord.po_number",
        "gr.gr_number",
        "line.line_number",
        "ord.po_date",
        "line.delivery_date_expected",
        "gr.gr_date",
        "ord.po_year",
        "ord.po_month",
        "ord.po_year_month",
        "line.quantity_ordered",
        received.alias("quantity_received"),
        counted.alias("quantity_received_coalesced"),
        F.coalesce(F.col("gr.quantity_variance"), F.lit(0)).alias("quantity_variance_gr"),
        (ordered - counted).alias("unfulfilled_qty"),
        F.when(ordered > 0, fulfilment(counted, ordered)).otherwise(F.lit(0).cast(PERCENT))
        .alias("fulfillment_pct"),
        "line.unit_price_idr",
        "line.net_unit_price_idr",
        "line.discount_pct",
        "line.discount_amount_idr",
        "line.has_discount",
        of_line("discount_tier"),
        F.col("line.gross_total_price_idr").alias("gross_total_ordered_idr"),
        F.col("line.net_total_price_idr").alias("net_total_ordered_idr"),
        value.alias("net_total_received_idr"),
        (F.col("line.net_total_price_idr") - value).cast(MONEY).alias("value_shortfall_idr"),
        F.when(rejected, value).otherwise(F.lit(0).cast(MONEY)).alias("rejected_goods_value_idr"),
        "ord.expected_lead_time_days",
        F.col("gr.lead_time_days").alias("actual_lead_time_days"),
        (F.col("gr.lead_time_days") - F.col("ord.expected_lead_time_days"))
        .alias("lead_time_variance_days"),
        "ord.po_status",
        of_line("line_status"),
        stage(F.col("ord.is_cancelled"), F.col("ord.is_open"), F.col("gr.gr_id"), received, ordered)
        .alias("lifecycle_stage"),
        of_receipt("receipt_status"),
        of_receipt("delivery_timeliness"),
        of_receipt("shortage_severity"),
        "gr.is_on_time",
        "gr.is_short_delivery",
        "gr.is_over_delivery",
        "gr.is_full_delivery",
        has_receipt.alias("has_goods_receipt"),
        F.coalesce(received >= ordered, F.lit(False)).alias("is_fully_fulfilled"),
        rejected.alias("is_rejected_by_inspection"),
        F.coalesce(F.col("gr.needs_reinspection"), F.lit(False)).alias("needs_reinspection"),
        "line.unit_of_measure",
        "gr.warehouse_location",
        of_receipt("inspection_status"),
        "ord.payment_terms",
        "ord.is_cancelled",
        "ord.is_completed",
        *[of_line(name) for name in line_extras],
        *[f"ord.{name}" for name in order_extras],
        *[of_receipt(name) for name in receipt_extras],
    )
