"""Declared schemas of the raw tables and the label lists used across the package."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 0)
PRICE = T.DecimalType(30, 12)
PERCENT = T.DecimalType(18, 2)

_TYPES = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}

# Column names and types of the seven raw tables, parents before children.
_RAW_COLUMNS = {
    "departments": (
        "department_id long, department_code string, department_name string, cost_center string, "
        "location string, manager_name string, budget_annual long, created_at date"
    ),
    "vendors": (
        "vendor_id long, vendor_code string, vendor_name string, vendor_category string, "
        "vendor_type string, address string, city string, province string, postal_code long, "
        "phone string, email string, npwp string, payment_terms string, rating double, "
        "is_active boolean, registered_date date, created_at date"
    ),
    "items": (
        "item_id long, item_code string, item_name string, item_category string, "
        "unit_of_measure string, unit_price long, min_order_qty long, lead_time_days long, "
        "is_active boolean, created_at date"
    ),
    "purchase_requests": (
        "pr_id long, pr_number string, pr_date date, department_id long, requester_name string, "
        "requester_email string, purpose string, priority string, status string, "
        "approved_by string, approval_date date, notes string, created_at date, total_amount long"
    ),
    "purchase_orders": (
        "po_id long, po_number string, po_date date, pr_id long, vendor_id long, "
        "department_id long, expected_delivery_date date, payment_terms string, status string, "
        "shipping_address string, approved_by string, approval_date date, notes string, "
        "created_at date, total_amount long"
    ),
    "purchase_order_lines": (
        "line_id long, po_id long, item_id long, line_number long, quantity_ordered long, "
        "unit_of_measure string, unit_price long, discount_pct long, total_price long, "
        "delivery_date_expected date, line_status string, notes string, created_at date"
    ),
    "goods_receipts": (
        "gr_id long, gr_number string, gr_date date, po_id long, po_line_id long, item_id long, "
        "quantity_ordered long, quantity_received long, quantity_variance long, "
        "variance_pct double, receipt_status string, lead_time_days long, is_on_time boolean, "
        "unit_price double, total_received_value long, warehouse_location string, "
        "received_by string, inspection_status string, notes string, created_at date"
    ),
}

#: Parents come before children, so a reader of a half-finished load never sees a child alone.
LOAD_ORDER = tuple(_RAW_COLUMNS)

INGESTED_AT = "_ingested_at"


def _schema(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


#: Raw table name to its declared schema, without the audit column added at load.
RAW_SCHEMAS = {table: _schema(columns) for table, columns in _RAW_COLUMNS.items()}

# Statuses and categories as the source systems write them.
REQUEST_STATUSES = ("Disetujui", "Ditolak", "Pending Approval")
ORDER_STATUSES = ("Terbuka", "Sebagian Diterima", "Selesai", "Dibatalkan")
PRIORITIES = ("Rendah", "Sedang", "Tinggi", "Mendesak")
VENDOR_TYPES = ("Barang", "Jasa", "Barang & Jasa")
PAYMENT_TERMS = ("Net 15", "Net 30", "Net 45", "Net 60", "COD", "DP 50%")
RECEIPT_STATUSES = ("Lengkap", "Kurang", "Kurang Signifikan", "Barang Sangat Kurang", "Lebih")
INSPECTION_STATUSES = ("Lulus", "Perlu Pemeriksaan Ulang", "Ditolak")
ITEM_CATEGORIES = (
    "Alat Tulis Kantor",
    "IT & Teknologi",
    "Furnitur Kantor",
    "Peralatan Listrik",
    "Bahan Kebersihan",
    "Peralatan Keselamatan",
    "Spare Part & Mesin",
    "Bahan Promosi & Cetak",
)

# Labels of the derived columns.
PRICE_TIERS = ("Murah", "Menengah", "Mahal")
BUDGET_TIERS = ("Anggaran Besar", "Anggaran Menengah", "Anggaran Kecil")
DISCOUNT_TIERS = ("Tanpa Diskon", "Diskon Kecil", "Diskon Sedang", "Diskon Besar")
TIMELINESS = (
    "Tepat Waktu",
    "Terlambat ≤1 Minggu",
    "Terlambat ≤2 Minggu",
    "Terlambat ≤1 Bulan",
    "Terlambat >1 Bulan",
)
SHORTAGES = (
    "Tidak Ada Kekurangan",
    "Kurang Ringan (<10%)",
    "Kurang Sedang (10–25%)",
    "Kurang Parah (>25%)",
)
LIFECYCLE_STAGES = (
    "Dibatalkan",
    "Menunggu Penerimaan",
    "Ditutup Tanpa Penerimaan",
    "Selesai – Terpenuhi Penuh",
    "Selesai – Terpenuhi Sebagian",
    "Tidak Ada Penerimaan",
)
MONTHS_ID = (
    "Januari", "Februari", "Maret", "April", "Mei", "Juni",
    "Juli", "Agustus", "September", "Oktober", "November", "Desember",
)
DAYS_ID = ("Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu")
DAYS_SHORT_ID = ("Sen", "Sel", "Rab", "Kam", "Jum", "Sab", "Min")

#: The key by which a raw table is stored in buckets: lines meet receipts on it without a shuffle, and
#: each table its own former state.
BUCKET_KEYS = {
    "purchase_orders": "po_id",
    "purchase_order_lines": "line_id",
    "goods_receipts": "po_line_id",
}
