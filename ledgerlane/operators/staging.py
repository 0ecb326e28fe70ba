"""Cleaning of the raw tables: one filter and one projection each, one row out per kept row.

No staging step shuffles. Key filters reach the Parquet scan; the blank-name filters stay above it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.dates import date_parts, days_between
from ledgerlane.functions.numeric import exact, fulfilment, rate_of, ratio
from ledgerlane.functions.text import blank_to_null, is_filled, is_status, trimmed
from ledgerlane.schemas import (
    DISCOUNT_TIERS,
    INGESTED_AT,
    MONEY,
    PERCENT,
    PRICE,
    PRICE_TIERS,
    SHORTAGES,
    TIMELINESS,
)


def _loaded_at() -> Column:
    return F.col(INGESTED_AT).cast("timestamp_ntz").alias("loaded_at")


def _present(*columns: str) -> Column:
    condition = F.lit(True)
    for column in columns:
        condition = condition & F.col(column).isNotNull()
    return condition


def _status(column: str = "status") -> Column:
    return F.trim(F.col(column))


def departments(raw: DataFrame) -> DataFrame:
    kept = raw.filter(_present("department_id") & is_filled("department_name"))
    return kept.select(
        "department_id",
        *trimmed("department_code", "department_name", "cost_center", "location", "manager_name"),
        F.col("budget_annual").cast(MONEY).alias("budget_annual_idr"),
        "created_at",
        _loaded_at(),
    )


def vendors(raw: DataFrame) -> DataFrame:
    kind = F.trim(F.col("vendor_type"))
    kept = raw.filter(_present("vendor_id") & is_filled("vendor_name"))
    return kept.select(
        "vendor_id",
        *trimmed("vendor_code", "vendor_name", "vendor_category", "vendor_type", "address", "city",
                 "province"),
        F.lpad(F.col("postal_code").cast("string"), 5, "0").alias("postal_code"),
        *trimmed("phone"),
        F.lower(F.trim(F.col("email"))).alias("email"),
        *trimmed("npwp", "payment_terms"),
        F.round(exact(F.col("rating")), 1).cast("decimal(3,1)")
        .alias("vendor_rating"),
        "is_active",
        is_status(kind, "Barang", "Barang & Jasa").alias("is_goods_vendor"),
        is_status(kind, "Jasa", "Barang & Jasa").alias("is_service_vendor"),
        "registered_date",
        "created_at",
        _loaded_at(),
    )


def items(raw: DataFrame) -> DataFrame:
    price = F.col("unit_price")
    cheap, medium, dear = PRICE_TIERS
    kept = raw.filter(_present("item_id") & is_filled("item_name"))
    return kept.select(
        "item_id",
        *trimmed("item_code", "item_name", "item_category", "unit_of_measure"),
        price.cast(MONEY).alias("unit_price_idr"),
        "min_order_qty",
        "lead_time_days",
        "is_active",
        F.when(price < 100_000, cheap).when(price <= 1_000_000, medium).otherwise(dear)
        .alias("price_tier"),
        F.coalesce(F.col("lead_time_days") <= 3, F.lit(False)).alias("is_fast_moving"),
        "created_at",
        _loaded_at(),
    )


def purchase_requests(raw: DataFrame) -> DataFrame:
    status = _status()
    return raw.filter(_present("pr_id", "pr_date")).select(
        "pr_id",
        *trimmed("pr_number"),
        "pr_date",
        *date_parts("pr_date", "pr"),
        "department_id",
        *trimmed("requester_name"),
        F.lower(F.trim(F.col("requester_email"))).alias("requester_email"),
        *trimmed("purpose", "priority"),
        status.alias("pr_status"),
        *trimmed("approved_by"),
        "approval_date",
        is_status(status, "Disetujui").alias("is_approved"),
        is_status(status, "Ditolak").alias("is_rejected"),
        is_status(status, "Pending Approval").alias("is_pending"),
        days_between(F.col("approval_date"), F.col("pr_date")).alias("approval_lead_days"),
        F.coalesce(F.col("total_amount"), F.lit(0)).cast(MONEY).alias("total_amount_idr"),
        blank_to_null("notes"),
        "created_at",
        _loaded_at(),
    )


def purchase_orders(raw: DataFrame) -> DataFrame:
    status = _status()
    return raw.filter(_present("po_id", "po_date")).select(
        "po_id",
        *trimmed("po_number"),
        "po_date",
        *date_parts("po_date", "po"),
        "pr_id",
        "vendor_id",
        "department_id",
        "expected_delivery_date",
        days_between(F.col("expected_delivery_date"), F.col("po_date"))
        .alias("expected_lead_time_days"),
        *trimmed("payment_terms"),
        status.alias("po_status"),
        *trimmed("shipping_address", "approved_by"),
        "approval_date",
        days_between(F.col("approval_date"), F.col("po_date")).alias("approval_lag_days"),
        is_status(status, "Terbuka").alias("is_open"),
        is_status(status, "Sebagian Diterima").alias("is_partial"),
        is_status(status, "Selesai").alias("is_completed"),
        is_status(status, "Dibatalkan").alias("is_cancelled"),
        # a missing status is not active either
        F.coalesce(~status.isin("Selesai", "Dibatalkan"), F.lit(False)).alias("is_active_po"),
        F.coalesce(F.col("total_amount"), F.lit(0)).cast(MONEY).alias("total_amount_idr"),
        blank_to_null("notes"),
        "created_at",
        _loaded_at(),
    )


def purchase_order_lines(raw: DataFrame) -> DataFrame:
    """Discounted prices are rounded from the undiscounted product, each on its own."""
    discount = F.coalesce(F.col("discount_pct"), F.lit(0))
    rate = discount.cast("decimal(5,2)")
    price, quantity = F.col("unit_price"), F.col("quantity_ordered")
    off = (discount * 100).cast("long")
    none, small, medium, large = DISCOUNT_TIERS
    kept = raw.filter(_present("line_id", "po_id", "item_id") & (F.col("quantity_ordered") > 0))
    return kept.select(
        "line_id",
        "po_id",
        "item_id",
        "line_number",
        "quantity_ordered",
        *trimmed("unit_of_measure"),
        price.cast(MONEY).alias("unit_price_idr"),
        rate.alias("discount_pct"),
        rate_of(price, F.lit(1), 10_000 - off).alias("net_unit_price_idr"),
        F.col("total_price").cast(MONEY).alias("gross_total_price_idr"),
        rate_of(price, quantity, 10_000 - off).alias("net_total_price_idr"),
        rate_of(price, quantity, off).alias("discount_amount_idr"),
        (discount > 0).alias("has_discount"),
        F.when(discount == 0, none)
        .when(discount.between(1, 5), small)
        .when(discount.between(6, 10), medium)
        .otherwise(large)
        .alias("discount_tier"),
        "delivery_date_expected",
        *trimmed("line_status"),
        blank_to_null("notes"),
        "created_at",
        _loaded_at(),
    )


def delivery_timeliness(on_time: Column, lead_days: Column) -> Column:
    """Late deliveries are graded by their whole lead time, not by the days they were late."""
    in_time, week, fortnight, month, later = TIMELINESS
    return (
        F.when(on_time, in_time)
        .when(lead_days <= 7, week)
        .when(lead_days <= 14, fortnight)
        .when(lead_days <= 30, month)
        .otherwise(later)
    )


def shortage_severity(variance: Column, ordered: Column) -> Column:
    """Share of the ordered quantity that is missing, compared without dividing."""
    none, light, medium, heavy = SHORTAGES
    missing, base = F.abs(variance), F.nullif(ordered, F.lit(0))
    return (
        F.when(variance >= 0, none)
        .when(missing * 10 <= base, light)
        .when(missing * 4 <= base, medium)
        .otherwise(heavy)
    )


def goods_receipts(raw: DataFrame) -> DataFrame:
    ordered, received = F.col("quantity_ordered"), F.col("quantity_received")
    variance = F.col("quantity_variance")
    price = F.coalesce(exact(F.col("unit_price")), F.lit(0)).cast(PRICE)
    inspection = _status("inspection_status")
    kept = raw.filter(
        _present("gr_id", "po_id", "po_line_id", "item_id", "gr_date") & (received >= 0)
    )
    return kept.select(
        "gr_id",
        *trimmed("gr_number"),
        "gr_date",
        *date_parts("gr_date", "gr"),
        "po_id",
        "po_line_id",
        "item_id",
        "quantity_ordered",
        "quantity_received",
        "quantity_variance",
        F.round(exact(F.col("variance_pct")), 2).cast(PERCENT)
        .alias("variance_pct"),
        F.when(ordered > 0, fulfilment(received, ordered)).alias("quantity_fulfillment_pct"),
        *trimmed("receipt_status"),
        "lead_time_days",
        "is_on_time",
        delivery_timeliness(F.col("is_on_time"), F.col("lead_time_days"))
        .alias("delivery_timeliness"),
        F.coalesce(variance < 0, F.lit(False)).alias("is_short_delivery"),
        F.coalesce(variance > 0, F.lit(False)).alias("is_over_delivery"),
        F.coalesce(variance == 0, F.lit(False)).alias("is_full_delivery"),
        shortage_severity(variance, ordered).alias("shortage_severity"),
        price.alias("unit_price_idr"),
        F.coalesce(F.col("total_received_value"), F.lit(0)).cast(MONEY)
        .alias("total_received_value_idr"),
        F.when(variance < 0, ratio(
            F.abs(variance).cast("decimal(10,0)") * (price * F.lit(10**PRICE.scale)).cast("decimal(30,0)"),
            F.lit(Decimal(10**PRICE.scale)), 0,
        ).cast(MONEY))
        .otherwise(F.lit(0).cast(MONEY))
        .alias("shortage_value_idr"),
        *trimmed("warehouse_location", "received_by", "inspection_status"),
        is_status(inspection, "Ditolak").alias("is_rejected_by_inspection"),
        is_status(inspection, "Perlu Pemeriksaan Ulang").alias("needs_reinspection"),
        blank_to_null("notes"),
        "created_at",
        _loaded_at(),
    )
