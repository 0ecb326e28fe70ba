from __future__ import annotations

import os
import sys
from datetime import date

import pytest
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SAMPLE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# What a hand-made raw row holds unless a test says otherwise.
_DEFAULTS = {
    "departments": dict(department_id=1, department_name="Keuangan"),
    "vendors": dict(vendor_id=1, vendor_name="PT Satu", registered_date=date(2020, 1, 1)),
    "items": dict(item_id=1, item_name="Kertas", unit_price=1000, lead_time_days=5),
    "purchase_requests": dict(pr_id=1, pr_date=date(2024, 1, 1)),
    "purchase_orders": dict(
        po_id=1, po_date=date(2024, 1, 1), pr_id=1, vendor_id=1, department_id=1,
        expected_delivery_date=date(2024, 1, 11), status="Selesai",
    ),
    "purchase_order_lines": dict(
        line_id=1, po_id=1, item_id=1, line_number=1, quantity_ordered=10, unit_price=100,
        discount_pct=0, total_price=1000, delivery_date_expected=date(2024, 1, 11),
    ),
    "goods_receipts": dict(
        gr_id=1, gr_date=date(2024, 1, 9), po_id=1, po_line_id=1, item_id=1,
        quantity_ordered=10, quantity_received=10, quantity_variance=0, lead_time_days=8,
        is_on_time=True, unit_price=100.0, inspection_status="Lulus",
    ),
}


@pytest.fixture(scope="session")
def raw(spark):
    """Build a raw table from a few named values per row."""
    from ledgerlane.schemas import INGESTED_AT, RAW_SCHEMAS

    def build(table: str, *rows: dict):
        schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(INGESTED_AT, T.StringType())])
        empty = dict.fromkeys(schema.fieldNames())
        stamped = [
            {**empty, INGESTED_AT: "2025-01-01 00:00:00", **_DEFAULTS[table], **row}
            for row in rows or ({},)
        ]
        return spark.createDataFrame(
            [tuple(row[name] for name in schema.fieldNames()) for row in stamped], schema
        )

    return build


def values(rows: list[Row], name: str) -> list:
    return [row[name] for row in rows]
