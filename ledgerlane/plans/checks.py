"""The declared checks of raw tables and marts, and running them all."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.numeric import count_where
from ledgerlane.operators import quality
from ledgerlane.plans.warehouse import Marts
from ledgerlane.schemas import (
    BUDGET_TIERS,
    DAYS_ID,
    INSPECTION_STATUSES,
    ITEM_CATEGORIES,
    LIFECYCLE_STAGES,
    MONTHS_ID,
    ORDER_STATUSES,
    PAYMENT_TERMS,
    PRICE_TIERS,
    PRIORITIES,
    RECEIPT_STATUSES,
    REQUEST_STATUSES,
    SHORTAGES,
    TIMELINESS,
    VENDOR_TYPES,
)

# Columns whose values must not repeat.
UNIQUE = {
    "departments": ("department_id", "department_code"),
    "vendors": ("vendor_id", "vendor_code"),
    "items": ("item_id", "item_code"),
    "purchase_requests": ("pr_id", "pr_number"),
    "purchase_orders": ("po_id", "po_number"),
    "purchase_order_lines": ("line_id",),
    "goods_receipts": ("gr_id", "gr_number"),
    "dim_date": ("date_key", "full_date"),
    "dim_departments": ("department_sk", "department_id", "department_code"),
    "dim_items": ("item_sk", "item_id", "item_code"),
    "dim_vendors": ("vendor_sk",),
    "fct_purchase_order_lines": ("fct_po_line_sk", "po_line_id"),
}

# Columns that must be filled.
NOT_NULL = {
    "departments": ("department_id", "department_code", "department_name"),
    "vendors": ("vendor_id", "vendor_code", "vendor_name", "vendor_type", "is_active"),
    "items": ("item_id", "item_code", "item_name", "unit_of_measure", "is_active"),
    "purchase_requests": (
        "pr_id", "pr_number", "pr_date", "department_id", "requester_name", "status",
    ),
    "purchase_orders": (
        "po_id", "po_number", "po_date", "pr_id", "vendor_id", "department_id",
        "expected_delivery_date", "status",
    ),
    "purchase_order_lines": (
        "line_id", "po_id", "item_id", "line_number", "quantity_ordered", "unit_price",
    ),
    "goods_receipts": (
        "gr_id", "gr_number", "gr_date", "po_id", "po_line_id", "item_id", "quantity_received",
        "receipt_status", "lead_time_days",
    ),
    "dim_date": (
        "date_key", "full_date", "date_label", "year", "iso_year", "quarter_number",
        "quarter_label", "year_quarter", "month_number", "month_name_id", "year_month",
        "week_of_year", "day_of_month", "day_of_week_iso", "day_name_id", "is_weekend",
        "is_weekday", "is_first_day_of_month", "is_last_day_of_month", "is_last_day_of_quarter",
        "fiscal_year", "fiscal_quarter",
    ),
    "dim_departments": (
        "department_sk", "department_id", "department_code", "department_name", "cost_center",
        "location", "budget_annual_idr", "budget_tier", "loaded_at",
    ),
    "dim_items": (
        "item_sk", "item_id", "item_code", "item_name", "item_category", "unit_of_measure",
        "current_unit_price_idr", "price_tier", "min_order_qty", "standard_lead_time_days",
        "is_active", "is_fast_moving", "last_updated_at",
    ),
    "dim_vendors": (
        "vendor_sk", "vendor_id", "dbt_valid_from", "is_current_record", "record_version",
        "vendor_name", "city", "province", "payment_terms", "vendor_code", "vendor_category",
        "vendor_type", "is_active", "is_goods_vendor", "is_service_vendor",
    ),
    "fct_purchase_order_lines": (
        "fct_po_line_sk", "date_key_po_date", "date_key_delivery_expected", "vendor_sk",
        "department_sk", "item_sk", "po_line_id", "po_id", "vendor_id", "department_id",
        "item_id", "po_date", "po_year", "po_month", "po_year_month", "delivery_date_expected",
        "quantity_ordered", "quantity_received_calc", "quantity_variance_gr", "unfulfilled_qty",
        "fulfillment_pct", "unit_price_idr", "net_unit_price_idr", "discount_pct",
        "gross_total_ordered_idr", "net_total_ordered_idr", "net_total_received_idr",
        "value_shortfall_idr", "discount_amount_idr", "expected_lead_time_days", "po_status",
        "lifecycle_stage", "has_goods_receipt", "is_fully_fulfilled", "has_discount",
    ),
}

# The only values a column may hold, besides none.
ACCEPTED = {
    "vendors": {"vendor_type": VENDOR_TYPES},
    "purchase_requests": {"priority": PRIORITIES, "status": REQUEST_STATUSES},
    "purchase_orders": {"status": ORDER_STATUSES},
    "goods_receipts": {
        "receipt_status": RECEIPT_STATUSES, "inspection_status": INSPECTION_STATUSES,
    },
    "dim_date": {
        "quarter_number": range(1, 5),
        "quarter_label": [f"Q{quarter}" for quarter in range(1, 5)],
        "month_number": range(1, 13),
        "month_name_id": MONTHS_ID,
        "day_of_week_iso": range(1, 8),
        "day_name_id": DAYS_ID,
    },
    "dim_departments": {"budget_tier": BUDGET_TIERS},
    "dim_items": {"item_category": ITEM_CATEGORIES, "price_tier": PRICE_TIERS},
    "dim_vendors": {"payment_terms": PAYMENT_TERMS, "vendor_type": VENDOR_TYPES},
    "fct_purchase_order_lines": {
        "po_status": ORDER_STATUSES,
        "lifecycle_stage": LIFECYCLE_STAGES,
        "receipt_status": RECEIPT_STATUSES,
        "delivery_timeliness": TIMELINESS,
        "shortage_severity": SHORTAGES,
    },
}

#: Checks that only warn; all others are errors.
WARNINGS = {"delivery_timeliness": quality.WARN, "shortage_severity": quality.WARN}

# Fact column, dimension and its key column.
RELATIONSHIPS = (
    ("date_key_po_date", "dim_date", "date_key"),
    ("date_key_delivery_expected", "dim_date", "date_key"),
    ("date_key_gr_date", "dim_date", "date_key"),
    ("vendor_sk", "dim_vendors", "vendor_sk"),
    ("department_sk", "dim_departments", "department_sk"),
    ("item_sk", "dim_items", "item_sk"),
)

#: Fact columns that the relationship checks read, and those that any check reads.
KEY_COLUMNS = tuple(column for column, _, _ in RELATIONSHIPS)
_FACT = "fct_purchase_order_lines"
FACT_CHECKED = tuple(dict.fromkeys((*UNIQUE[_FACT], *NOT_NULL[_FACT], *ACCEPTED[_FACT], *KEY_COLUMNS)))

# Allowed sizes of the marts on the reference data set.
SMOKE_BOUNDS = {
    "dim_date rows": (3652, 3652),
    "dim_departments rows": (30, 30),
    "dim_items rows": (300, 300),
    "dim_vendors current rows": (150, 150),
    "dim_vendors rows": (155, 185),
    "fact rows": (10_000, 12_000),
    "fact rows with receipt": (7_500, 9_000),
    "fact vendor_sk missing": (0, 0),
    "fact date_key_po_date missing": (0, 0),
    "fact item_sk missing": (0, 0),
    "fact department_sk missing": (0, 0),
}


def mart_tables(m: Marts) -> dict[str, DataFrame]:
    return {
        "dim_date": m.dates,
        "dim_departments": m.departments,
        "dim_items": m.items,
        "dim_vendors": m.vendors,
        "fct_purchase_order_lines": m.fact,
    }


def unique_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """All unique checks: one scan a table and one shuffle."""
    return quality.unique_values({name: (rows, UNIQUE[name]) for name, rows in tables.items()})


def column_checks(
    tables: dict[str, DataFrame], *, not_null: bool = True, accepted: bool = True,
    values: dict[str, dict[str, Sequence]] | None = None,
) -> DataFrame:
    """Not-null and accepted-values checks: one scan per table for all its columns.

    ``values`` replaces the accepted values of the columns it names.
    """
    results = []
    for name, rows in tables.items():
        filled = list(NOT_NULL[name]) if not_null else []
        allowed = {**ACCEPTED.get(name, {}), **(values or {}).get(name, {})} if accepted else {}
        if filled or allowed:
            results.append(quality.column_checks(rows, name, filled, allowed, WARNINGS))
    return quality.combine(results)


def relationship_checks(m: Marts) -> DataFrame:
    tables = mart_tables(m)
    name = "fct_purchase_order_lines"
    return quality.combine([
        quality.relationship(tables[name], name, column, tables[parent], field)
        for column, parent, field in RELATIONSHIPS
    ])


def freshness_checks(raw: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    return quality.combine([quality.freshness(rows, name, as_of) for name, rows in raw.items()])


def all_checks(raw: dict[str, DataFrame], m: Marts,
               values: dict[str, dict[str, Sequence]] | None = None) -> DataFrame:
    tables = {**raw, **mart_tables(m)}
    return quality.combine(
        [unique_checks(tables), column_checks(tables, values=values), relationship_checks(m)]
    )


def smoke_checks(m: Marts, bounds: dict[str, tuple[int | None, int | None]] | None = None
                 ) -> DataFrame:
    """Row and orphan counts against allowed bounds: (name, value, lower, upper, ok)."""
    bounds = {**SMOKE_BOUNDS, **(bounds or {})}
    everything = F.lit(True)
    measured = [
        (m.dates, {"dim_date rows": everything}),
        (m.departments, {"dim_departments rows": everything}),
        (m.items, {"dim_items rows": everything}),
        (m.vendors, {
            "dim_vendors current rows": F.col("is_current_record"),
            "dim_vendors rows": everything,
        }),
        (m.fact, {
            "fact rows": everything,
            "fact rows with receipt": F.col("has_goods_receipt"),
            **{
                f"fact {key} missing": F.col(key).isNull()
                for key in ("vendor_sk", "date_key_po_date", "item_sk", "department_sk")
            },
        }),
    ]
    return quality.combine([
        quality.within_bounds(
            table.agg(*[count_where(c).alias(name) for name, c in measures.items()]),
            {name: bounds[name] for name in measures},
        )
        for table, measures in measured
    ])
