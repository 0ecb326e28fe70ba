"""The seven raw purchasing tables derived from order/line test tables.

The given tables are retail-style (``orders``, ``lineitem``, ``part`` ...). Whole-number formulas
turn every one of their rows into purchasing rows, so any engine can derive the same ones. Blank
names, missing dates, zero and negative quantities are put in on purpose to reach the cleaning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.text import coded_label, document_number, label_code, pick, zero_filled
from ledgerlane.operators.documents import (
    RECEIVABLE,
    with_order_totals,
    with_receipt_measures,
    with_request_totals,
)
from ledgerlane.schemas import (
    BUCKET_KEYS,
    INGESTED_AT,
    INSPECTION_STATUSES,
    ORDER_STATUSES,
    PAYMENT_TERMS,
    RAW_SCHEMAS,
    VENDOR_TYPES,
)
from ledgerlane.sources.layers import shuffle_partitions

#: Moves the test data's 1995-2001 dates into the calendar, 1995-01-01 to 2018-01-01.
DAYS_FORWARD = 8401

#: Day and key of each table's load stamps; the hour is the key's remainder by 24.
LOAD_STAMPS = {
    "departments": ("2025-01-01", "department_id"),
    "vendors": ("2024-12-31", "vendor_id"),
    "items": ("2025-01-01", "item_id"),
    "purchase_requests": ("2024-12-30", "pr_id"),
    "purchase_orders": ("2025-01-01", "po_id"),
    "purchase_order_lines": ("2025-01-01", "line_id"),
    "goods_receipts": ("2024-12-31", "gr_id"),
}

NAME_TAILS = (" Tbk.", " PT Tbk", "", " (Persero) Tbk")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
UNITS = ("Pcs", "Unit", "Box", "Set", "Kg")
MINIMUM_ORDERS = (1, 2, 5, 10, 12, 24)
WAREHOUSES = ("WH-A01", "WH-A02", "WH-A03", "WH-B01", "WH-B02", "WH-C01", "WH-C02", "WH-D01")
NOTES = (None, "  ", " catatan ")


class SampleTables:
    """Lazy raw tables over one test-data folder.

    ``raw`` gives the finished raw tables, so one table can be derived from another: orders take
    their totals from the lines, requests from the orders, and receipts come from the lines. The
    order lines of the given tables are grouped once. ``to_buckets`` is for tables that are stored: lines
    go to the bucket of their key before they are written out.
    """

    def __init__(self, spark: SparkSession, folder: str, *, to_buckets: bool = False) -> None:
        self._spark, self._folder, self._to_buckets = spark, folder, to_buckets

    def _given(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def rows(self) -> int:
        """Rows of the largest given table, known from its files' footers."""
        return self._given("lineitem").count()

    def table(self, name: str, raw: Callable[[str], DataFrame]) -> DataFrame:
        """A raw table in its declared column order, with the audit column."""
        schema = RAW_SCHEMAS[name]
        rows = getattr(self, name)(raw)
        typed = [F.col(field.name).cast(field.dataType) for field in schema.fields]
        day, key = LOAD_STAMPS[name]
        stamp = F.concat(F.lit(f"{day} "), zero_filled(F.col(key) % 24, 2), F.lit(":00:00"))
        return rows.select(*typed, stamp.alias(INGESTED_AT))

    def departments(self, raw: Callable[[str], DataFrame]) -> DataFrame:
        joined = self._given("nation").join(
            self._given("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        number = F.col("n_nationkey") + 1
        return joined.select(
            number.alias("department_id"),
            F.concat(F.lit("DEPT"), zero_filled(number, 3)).alias("department_code"),
            F.when(F.col("n_nationkey") % 23 == 22, "   ")
            .otherwise(F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")))
            .alias("department_name"),
            F.concat(F.lit("CC"), zero_filled(number * 100, 6)).alias("cost_center"),
            F.col("r_name").alias("location"),
            F.concat(F.lit("Manager "), number).alias("manager_name"),
            (F.col("n_nationkey").cast("long") * 400_000_000 + 200_000_000)
            .alias("budget_annual"),
            F.date_add(F.lit("2018-01-01").cast("date"), F.col("n_nationkey"))
            .alias("created_at"),
        )

    def vendors(self, raw: Callable[[str], DataFrame]) -> DataFrame:
        key = F.col("s_suppkey")
        number = key + 1
        registered = F.date_add(F.lit("2018-01-01").cast("date"), ((key * 37) % 2000).cast("int"))
        joined = (
            self._given("supplier")
            .join(self._given("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self._given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return joined.select(
            number.alias("vendor_id"),
            F.concat(F.lit("VND"), zero_filled(number, 9)).alias("vendor_code"),
            F.when(key % 41 == 5, " ")
            .otherwise(F.concat(F.lit("PT "), F.col("s_name"), pick(key % 4, NAME_TAILS)))
            .alias("vendor_name"),
            pick(key % 6, PART_TYPES).alias("vendor_category"),
            pick(key % 3, VENDOR_TYPES).alias("vendor_type"),
            F.concat(F.lit("Jl. "), number).alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("province"),
            ((key * 7919) % 100_000).alias("postal_code"),
            F.concat(F.lit("0"), number).alias("phone"),
            F.concat(F.lit(" Sales"), number, F.lit("@Example.COM ")).alias("email"),
            zero_filled(number, 15).alias("npwp"),
            pick(key % 6, PAYMENT_TERMS).alias("payment_terms"),
            ((key % 26 + 25) / F.lit(10.0)).alias("rating"),
            (key % 12 != 0).alias("is_active"),
            registered.alias("registered_date"),
            registered.alias("created_at"),
        )

    def items(self, raw: Callable[[str], DataFrame]) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        return self._given("part").select(
            (key + 1).alias("item_id"),
            F.concat(F.lit("ITM"), zero_filled(key + 1, 9)).alias("item_code"),
            F.when(key % 211 == 7, "  ")
            .otherwise(F.concat(F.col("p_name"), F.lit(" #"), key)).alias("item_name"),
            F.col("p_type").alias("item_category"),
            pick(size % 5, UNITS).alias("unit_of_measure"),
            F.floor(F.col("p_retailprice") * size * size).alias("unit_price"),
            pick(size % 6, MINIMUM_ORDERS).alias("min_order_qty"),
            (size % 14 + 1).alias("lead_time_days"),
            (key % 20 != 0).alias("is_active"),
            F.lit("2018-01-01").cast("date").alias("created_at"),
        )

    def _given_orders(self, key: str) -> DataFrame:
        """What purchasing documents take from the given orders, moved to their key before it is written out."""
        rows = self._given("orders").select(
            (F.col("o_orderkey") + 1).alias(key), "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
        )
        return rows.repartition(key)

    def _order_day(self) -> Column:
        return F.date_add(F.col("o_orderdate").cast("date"), DAYS_FORWARD)

    def _department_count(self) -> Column:
        return self._given("nation").agg(F.count(F.lit(1))).scalar()

    def _requests(self) -> DataFrame:
        key = F.col("pr_id") - 1
        day = F.date_sub(self._order_day(), (key % 12 + 3).cast("int"))
        status = F.when(key % 10 == 0, "Ditolak").when(key % 10 == 1, "Pending Approval").otherwise(
            "Disetujui"
        )
        granted = status == "Disetujui"
        return self._given_orders("pr_id").select(
            "pr_id",
            document_number("PR", day, F.col("pr_id"), 9).alias("pr_number"),
            day.alias("pr_date"),
            (F.col("o_custkey") % self._department_count() + 1).alias("department_id"),
            F.concat(F.lit("Requester "), F.col("o_custkey")).alias("requester_name"),
            F.concat(F.lit(" R"), F.col("o_custkey"), F.lit("@Example.COM "))
            .alias("requester_email"),
            F.col("o_orderpriority").alias("purpose"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "Mendesak")
            .when(F.col("o_orderpriority") == "2-HIGH", "Tinggi")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Sedang")
            .otherwise("Rendah").alias("priority"),
            status.alias("status"),
            F.when(granted, F.concat(F.lit(" Approver "), key % 40)).alias("approved_by"),
            F.when(granted, F.date_add(day, (key % 7 + 1).cast("int"))).alias("approval_date"),
            pick(key % 3, NOTES).alias("notes"),
            day.alias("created_at"),
        )

    def purchase_requests(self, raw: Callable[[str], DataFrame]) -> DataFrame:
        return with_request_totals(self._requests(), raw("purchase_orders"))

    def _orders(self) -> DataFrame:
        """Orders of approved requests; some share a request, a few lack their date."""
        key, customer = F.col("po_id") - 1, F.col("o_custkey")
        opened, part, done, dropped = ORDER_STATUSES
        vendors = self._given("supplier").agg(F.count(F.lit(1))).scalar()
        day = F.when(key % 997 != 0, self._order_day())
        return self._given_orders("po_id").filter(key % 10 >= 2).select(
            "po_id",
            document_number("PO", day, F.col("po_id"), 9).alias("po_number"),
            day.alias("po_date"),
            F.when(key % 10 == 3, key).otherwise(F.col("po_id")).alias("pr_id"),
            (customer % vendors + 1).alias("vendor_id"),
            (customer % self._department_count() + 1).alias("department_id"),
            F.date_add(day, (key % 28 + 3).cast("int")).alias("expected_delivery_date"),
            pick(customer % 6, PAYMENT_TERMS).alias("payment_terms"),
            F.when(F.col("o_orderstatus") == "F", done)
            .when(F.col("o_orderstatus") == "P", part)
            .when(key % 5 < 2, dropped)
            .otherwise(opened).alias("status"),
            F.concat(F.lit("Gudang "), customer % 12).alias("shipping_address"),
            F.concat(F.lit(" Approver "), key % 40).alias("approved_by"),
            F.date_add(day, (key % 4).cast("int")).alias("approval_date"),
            pick(key % 3, NOTES).alias("notes"),
            self._order_day().alias("created_at"),
        )

    def purchase_orders(self, raw: Callable[[str], DataFrame]) -> DataFrame:
        return with_order_totals(self._orders(), raw("purchase_order_lines"))

    def _lines(self) -> DataFrame:
        """One line per order, line number and part, with what it takes from its order.

        Test rows that repeat all three are deliveries of one line: quantities and amounts are
        added up. No part of an order is lost, and the line key is built from the three numbers
        without numbering rows within an order. Rows are moved to their order, where they are added
        up and meet it, and then to their bucket if they have one, before anything is derived from them.
        """
        merged = self._given("lineitem").select(
            (F.col("l_orderkey") + 1).alias("po_id"), "l_linenumber", F.col("l_partkey").alias("part"),
            F.col("l_quantity").cast("long").alias("quantity"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
            F.round(F.col("l_discount") * 100).cast("long").alias("discount"),
        ).repartition("po_id").groupBy("po_id", "l_linenumber", "part").agg(
            F.sum("quantity").alias("quantity"),
            F.sum("cents").alias("cents"),
            F.max("discount").alias("discount"),
        )
        place, other = label_code(F.col("status"), ORDER_STATUSES)
        order = self._orders().select(
            "po_id", F.col("expected_delivery_date").alias("delivery_date_expected"), "created_at",
            place.alias("status_place"), other.alias("status_other"),
        )
        parts = self._given("part").agg(F.max("p_partkey") + 1).scalar()
        key = (F.col("po_id") * 10 + F.col("l_linenumber")) * parts + F.col("part")
        keyed = merged.join(order, "po_id").withColumn("line_id", key)
        if not self._to_buckets:
            return keyed
        return keyed.repartition(shuffle_partitions(self._spark), BUCKET_KEYS["purchase_order_lines"])

    def purchase_order_lines(self, raw: Callable[[str], DataFrame]) -> DataFrame:
        order, part, discount = F.col("po_id") - 1, F.col("part"), F.col("discount")
        price = F.call_function("div", F.col("cents"), F.col("quantity"))
        ordered = F.when((part + order) % 97 == 0, 0).otherwise(F.col("quantity"))
        return self._lines().select(
            "line_id",
            "po_id",
            (part + 1).alias("item_id"),
            F.col("l_linenumber").alias("line_number"),
            ordered.alias("quantity_ordered"),
            pick(part % 5, UNITS).alias("unit_of_measure"),
            price.alias("unit_price"),
            (discount + F.call_function("div", discount, F.lit(2))).alias("discount_pct"),
            (price * ordered).alias("total_price"),
            pick(part % 3, NOTES).alias("notes"),
            "delivery_date_expected",
            coded_label(F.col("status_place"), F.col("status_other"), ORDER_STATUSES).alias("line_status"),
            "created_at",
        )

    def goods_receipts(self, raw: Callable[[str], DataFrame]) -> DataFrame:
        """One receipt per receivable line and, for one line in ten, an earlier partial one.

        A line repeats its order's status and dates (no promised date means no order date), so
        receipts are derived line by line.
        """
        order, part, line = F.col("po_id") - 1, F.col("item_id") - 1, F.col("line_number")
        ordered = F.col("quantity_ordered")
        lines = raw("purchase_order_lines").filter(F.col("line_status").isin(*RECEIVABLE))
        lines = lines.withColumnRenamed("delivery_date_expected", "expected_delivery_date")
        day = F.when(F.col("expected_delivery_date").isNotNull(), F.col("created_at"))
        lines = lines.withColumns({
            "po_date": day,
            "h": (part * 31 + order * 17 + line * 7) % 100,
            "k": (part * 13 + line * 5) % 100,
        })
        day, expected = F.col("po_date"), F.col("expected_delivery_date")
        h, k = F.col("h"), F.col("k")

        def share(hundredths: int) -> Column:
            return F.greatest(F.lit(1), F.call_function("div", ordered * hundredths, F.lit(100)))

        arrived = F.when(
            k < 72, F.greatest(F.date_add(day, 1), F.date_sub(expected, (k % 4).cast("int")))
        ).otherwise(F.date_add(expected, (k % 45 + 1).cast("int")))
        received = (
            F.when((h * k) % 199 == 198, -1)
            .when(h < 55, ordered)
            .when(h < 75, share(95))
            .when(h < 90, share(80))
            .when(h < 97, share(60))
            .otherwise(F.call_function("div", ordered * 110, F.lit(100)))
        )
        last = F.struct(
            (F.col("line_id") * 10 + 2).alias("gr_id"),
            arrived.alias("gr_date"),
            received.alias("quantity_received"),
        )
        first = F.struct(
            (F.col("line_id") * 10 + 1).alias("gr_id"),
            F.when(h % 20 == 0, arrived).otherwise(F.date_sub(arrived, 1)).alias("gr_date"),
            F.call_function("div", ordered, F.lit(2)).alias("quantity_received"),
        )
        deliveries = F.when(h % 10 == 0, F.array(first, last)).otherwise(F.array(last))
        rows = lines.select("*", F.explode(deliveries).alias("delivery")).select(
            "*", "delivery.gr_id", "delivery.gr_date", "delivery.quantity_received"
        )
        # some measures lie just below a half of their last digit, some prices have five decimals
        near_half = F.when(h % 17 == 3, F.col("variance_pct") + F.lit(0.0049999996)).otherwise(F.col("variance_pct"))
        price = (F.col("unit_price") * 100_000 + part % 7 * 4) / F.lit(100_000.0)
        return with_receipt_measures(rows).select(
            "gr_id",
            document_number("GR", F.col("gr_date"), F.col("gr_id"), 10).alias("gr_number"),
            "gr_date",
            "po_id",
            F.col("line_id").alias("po_line_id"),
            "item_id",
            "quantity_ordered",
            "quantity_received",
            "quantity_variance",
            near_half.alias("variance_pct"),
            "receipt_status",
            "lead_time_days",
            "is_on_time",
            price.alias("unit_price"),
            (F.col("unit_price") * F.col("quantity_received")).alias("total_received_value"),
            pick(h % 8, WAREHOUSES).alias("warehouse_location"),
            F.concat(F.lit("Clerk "), part % 50).alias("received_by"),
            F.when(h % 14 == 0, INSPECTION_STATUSES[2])
            .when((h % 14).isin(1, 2), INSPECTION_STATUSES[1])
            .otherwise(INSPECTION_STATUSES[0]).alias("inspection_status"),
            pick(part % 3, NOTES).alias("notes"),
            F.col("gr_date").alias("created_at"),
        )
