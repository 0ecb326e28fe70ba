"""The accumulating-snapshot fact: one row per order line, three milestones."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.text import packed_key, unpacked_key
from ledgerlane.operators.dimensions import surrogate_key
from ledgerlane.operators.lifecycle import latest_receipts, order_lifecycle
from ledgerlane.operators.tracking import among

# The columns of the fact in their published order.
FACT_COLUMNS = (
    "fct_po_line_sk", "date_key_po_date", "date_key_delivery_expected", "date_key_gr_date",
    "vendor_sk", "department_sk", "item_sk",
    "po_line_id", "po_id", "pr_id", "vendor_id", "department_id", "item_id", "gr_id",
    "po_date", "po_year", "po_month", "po_year_month", "delivery_date_expected", "gr_date",
    "quantity_ordered", "quantity_received", "quantity_received_calc", "quantity_variance_gr",
    "unfulfilled_qty", "fulfillment_pct",
    "unit_price_idr", "net_unit_price_idr", "discount_pct", "has_discount", "discount_tier",
    "discount_amount_idr", "gross_total_ordered_idr", "net_total_ordered_idr",
    "net_total_received_idr", "value_shortfall_idr", "rejected_goods_value_idr",
    "expected_lead_time_days", "actual_lead_time_days", "lead_time_variance_days",
    "po_status", "line_status", "lifecycle_stage", "receipt_status", "delivery_timeliness",
    "shortage_severity",
    "has_goods_receipt", "is_fully_fulfilled", "is_short_delivery", "is_over_delivery",
    "is_full_delivery", "is_on_time", "is_cancelled", "is_completed",
    "is_rejected_by_inspection", "needs_reinspection",
    "line_number", "unit_of_measure", "warehouse_location", "inspection_status",
    "payment_terms", "po_number", "gr_number",
)


def with_date_key(df: DataFrame, dates: DataFrame, day: str, key: str) -> DataFrame:
    """Look a date up in the calendar; NULL outside it.

    The calendar is broadcast: its size is fixed by its two end dates (3,652 rows by default).
    """
    role = dates.select(F.col("full_date").alias("_day"), F.col("date_key").alias(key))
    return df.join(F.broadcast(role), F.col(day) == F.col("_day"), "left").drop("_day")


def _with_key(df: DataFrame, dimension: DataFrame, natural: str, key: str) -> DataFrame:
    """Left lookup of a surrogate key. No broadcast hint: these dimensions grow with the business,
    so Spark compares their measured size with its threshold and splits skewed keys otherwise."""
    return df.join(dimension.select(natural, key), natural, "left")


def _with_key_apart(df: DataFrame, own: str, dimension: DataFrame, natural: str, key: str) -> DataFrame:
    """The same for rows that lie by their own key: this and the natural key alone go to the dimension, and
    the surrogate key comes back as bytes. The rows stay where they are. Repeated rows each get theirs."""
    pairs = df.select(own, natural).distinct()
    found = pairs.join(dimension.select(natural, key), natural, "left").select(
        F.col(own).alias("_own"), F.col(natural).alias("_natural"), packed_key(F.col(key)).alias("_key")
    )
    # no second equal key, as rows and pairs already lie by the first alone
    same = (F.col(own) == F.col("_own")) & (F.col(natural).bitwiseXOR(F.col("_natural")) == 0)
    return df.join(found, same, "left").withColumn(key, unpacked_key(F.col("_key"))).drop("_own", "_natural", "_key")


#: What a stored row remembers of its sources, besides the columns above.
SOURCE_HASH = "source_hash"

# Columns of staged tables that do not reach the fact.
_APART = frozenset({"loaded_at", "created_at", "notes"})


@dataclass(frozen=True)
class Sources:
    """Lines, orders and latest receipts with the keys and the hash the fact takes from each."""

    lines: DataFrame
    orders: DataFrame
    receipts: DataFrame

    def fact(self) -> DataFrame:
        """The whole fact with its source hash."""
        lifecycle = order_lifecycle(
            self.lines, self.orders, self.receipts,
            line_extras=("item_sk", "date_key_delivery_expected", "line_hash"),
            order_extras=("vendor_sk", "department_sk", "date_key_po_date", "order_hash"),
            receipt_extras=("date_key_gr_date", "receipt_hash"),
        )
        keyed = lifecycle.withColumnsRenamed({"quantity_received_coalesced": "quantity_received_calc"})
        return keyed.withColumns({
            "fct_po_line_sk": surrogate_key(F.col("po_line_id")),
            SOURCE_HASH: _joined_hash(),
        }).select(*FACT_COLUMNS, SOURCE_HASH)

    def hashes(self) -> DataFrame:
        """Per line of the fact: po_line_id, po_id, new_year, new_hash; moves a few numbers a row."""
        orders = self.orders.select("po_id", F.col("po_year").alias("new_year"), "order_hash")
        receipts = self.receipts.select("po_line_id", "receipt_hash")
        lines = self.lines.select(F.col("line_id").alias("po_line_id"), "po_id", "line_hash")
        joined = lines.join(orders, "po_id").join(receipts, "po_line_id", "left")
        return joined.select("po_line_id", "po_id", "new_year", _joined_hash().alias("new_hash"))

    def without(self, ids: DataFrame, count: int) -> Sources:
        """Without the lines of these ids (line_id), which are ``count``, so they are never joined."""
        return replace(self, lines=among(self.lines, ids, count, "line_id", "left_anti"))

    def only(self, changed: DataFrame) -> Sources:
        """Cut down to the changed lines, so only these are joined."""
        ids = changed.where("new_hash IS NOT NULL").select(F.col("po_line_id").alias("line_id"))
        orders = changed.where("new_hash IS NOT NULL").select("po_id").distinct()
        return Sources(
            self.lines.join(ids, "line_id", "left_semi"),
            self.orders.join(orders, "po_id", "left_semi"),
            self.receipts.join(ids.withColumnRenamed("line_id", "po_line_id"), "po_line_id", "left_semi"),
        )


def _joined_hash() -> Column:
    return F.xxhash64("line_hash", "order_hash", F.coalesce("receipt_hash", F.lit(0)))


def _hashed(rows: DataFrame, name: str) -> DataFrame:
    """Add a hash of all columns that reach the fact; a missing value counts as such."""
    parts = []
    for column in rows.columns:
        if column not in _APART:
            parts += [F.col(column), F.col(column).isNull()]
    return rows.withColumn(name, F.xxhash64(*parts))


def sources(
    lines: DataFrame,
    orders: DataFrame,
    receipts: DataFrame,
    dates: DataFrame,
    vendors: DataFrame,
    departments: DataFrame,
    items: DataFrame,
) -> Sources:
    """Look every dimension up on the smallest table that has its key.

    Vendor, department and order date on orders, item and promised date on lines, receipt date on
    the latest receipts. The wide joined rows are then never shuffled for a lookup.
    """
    current = vendors.filter("is_current_record")
    orders = with_date_key(orders, dates, "po_date", "date_key_po_date")
    orders = _with_key(orders, current, "vendor_id", "vendor_sk")
    orders = _with_key(orders, departments, "department_id", "department_sk")
    lines = with_date_key(lines, dates, "delivery_date_expected", "date_key_delivery_expected")
    lines = _with_key_apart(lines, "line_id", items, "item_id", "item_sk")
    newest = with_date_key(latest_receipts(receipts), dates, "gr_date", "date_key_gr_date")
    return Sources(
        _hashed(lines, "line_hash"), _hashed(orders, "order_hash"), _hashed(newest, "receipt_hash")
    )


def order_lines_fact(*tables: DataFrame) -> DataFrame:
    """Build the whole fact; the tables are those of ``sources``."""
    return sources(*tables).fact().select(*FACT_COLUMNS)


def changes(stored: DataFrame, given: Sources) -> DataFrame:
    """Lines that differ from the stored fact, are new, or are gone at the source.

    (po_line_id, po_id, old_year, new_year, new_hash): one full outer join of key and hash. A line
    that is gone has a null ``new_hash``, a new one a null ``old_year``.
    """
    old = stored.select(
        "po_line_id", F.col("po_year").alias("old_year"), F.col(SOURCE_HASH).alias("old_hash")
    )
    joined = old.join(given.hashes(), "po_line_id", "full_outer")
    differs = ~F.col("old_hash").eqNullSafe(F.col("new_hash"))
    return joined.where(differs).select("po_line_id", "po_id", "old_year", "new_year", "new_hash")


def merged(stored: DataFrame, changed: DataFrame, given: Sources) -> DataFrame:
    """The stored rows without those that changed or are gone, and the changed ones built anew.

    ``changed`` is used several times, so the caller stores it first. Only key columns meet the
    stored rows; the stored rows themselves are not sorted again.
    """
    kept = stored.join(changed.select("po_line_id"), "po_line_id", "left_anti")
    return kept.select(*FACT_COLUMNS, SOURCE_HASH).unionByName(given.only(changed).fact())


def touched_years(changed: DataFrame) -> list[int]:
    """The values of ``po_year`` whose rows an update must write, as many as there are years."""
    years = F.explode(F.array("old_year", "new_year"))
    return sorted(row[0] for row in changed.select(years).distinct().where("col IS NOT NULL").collect())
