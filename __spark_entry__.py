"""

Raw purchasing tables are derived from the given tables by whole-number formulas
(``ledgerlane/sources/sample.py``; the same formulas in SQL in ``oracle/tables.py``). Results leave
here with plain types, so that two engines can be compared: decimals as doubles, whole numbers as
longs, times as text; dates and flags stay what they are.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.text import document_number
from ledgerlane.operators import dimensions, documents, history, lifecycle, snapshot, staging, tracking
from ledgerlane.plans import checks, ingest
from ledgerlane.plans.reports import REPORTS, monthly_order_value
from ledgerlane.plans.stakeholders import STAKEHOLDER_REPORTS, payables_ageing
from ledgerlane.plans.warehouse import Warehouse, sample_warehouse
from ledgerlane.schemas import INGESTED_AT, LOAD_ORDER, RAW_SCHEMAS
from ledgerlane.sources.csv_files import infer_types, write_csv
from ledgerlane.sources.layers import RAW, LayerStore, shared_folder

try:  # the package may be left out
    from ledgerlane.llm.queries import ORACLE_SQL as _LLM_ORACLE_SQL
    from ledgerlane.llm.queries import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("ledgerlane.llm"):
        raise
    _LLM_QUERIES, _LLM_ORACLE_SQL = {}, {}

SMALLEST = "/root/testdata/sf0.001"
LOADED = datetime(2025, 1, 1)
CHECKED_AT = datetime(2025, 1, 2, 6)
PAYABLES_AS_OF = date(2024, 12, 31)
VENDOR_LOADS = (date(2024, 7, 1), date(2024, 7, 1), date(2024, 10, 1))
VENDOR_ARRIVALS = (2, 0, 1)


def portable(rows: DataFrame) -> DataFrame:
    """Reduce column types to long, double, string, date and boolean."""
    def plain(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
            return column.cast("double").alias(field.name)
        if isinstance(kind, T.IntegralType):
            return column.cast("long").alias(field.name)
        if isinstance(kind, (T.DateType, T.BooleanType)):
            return column.alias(field.name)
        return column.cast("string").alias(field.name)

    return rows.select(*[plain(field) for field in rows.schema.fields])


def _as_found_in_files(rows: DataFrame) -> DataFrame:
    """Cells as other programs write them: words for missing values, whole numbers with a point,
    line breaks inside texts."""
    first = F.col(rows.columns[0])
    word = F.element_at(F.array(*[F.lit(w) for w in ("", "NA", "NaN", "null")]), (first % 4 + 1).cast("int"))
    cells = {}
    for field in rows.schema.fields:
        cell = F.col(field.name)
        if field.name == "notes":
            cells[field.name] = F.coalesce(F.replace(cell, F.lit(" catatan "), F.lit(" cat\ntan ")), word)
        elif isinstance(field.dataType, T.LongType):
            whole = cell.cast("string")
            cells[field.name] = F.coalesce(F.when(first % 3 == 0, F.concat(whole, F.lit(".0"))).otherwise(whole), word)
        else:
            cells[field.name] = F.coalesce(cell.cast("string"), word)
    return rows.select(*[cell.alias(name) for name, cell in cells.items()])


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Write all raw tables as CSV, load them into a raw layer, summarise and measure the load."""
    w = sample_warehouse(spark, folder)
    root = f"{shared_folder(spark)}/ledgerlane-{spark.sparkContext.applicationId}/csv-{uuid.uuid4().hex}"
    store = LayerStore(spark, root, transient=True)
    with ingest.short_methods(spark):
        for name, rows in w.raw_tables().items():
            declared = rows.select(*RAW_SCHEMAS[name].fieldNames())
            write_csv(_as_found_in_files(declared), f"{root}/files/{name}.csv")
    loads = ingest.ingest(spark, store, f"{root}/files", LOADED, keep_bad_rows=True, multi_line=True)
    parts = [_measured(store.read(RAW, name), name) for name in LOAD_ORDER]
    measured = functools.reduce(DataFrame.unionByName, parts)
    sums = {name: F.sum(name).alias(name) for name in ("missing", "chars", "whole")}
    total = measured.agg(F.lit("GRAND TOTAL").alias("table"), *sums.values(), F.min("ingested_at").alias("ingested_at"))
    summary = loads.select("table", "rows", "bad_rows", "status")
    return summary.join(measured.unionByName(total), "table")


def _measured(rows: DataFrame, table: str) -> DataFrame:
    """Missing cells, characters of all texts, and whole numbers of one loaded table."""
    def total(columns):
        return functools.reduce(lambda a, b: a + b, columns, F.lit(0).cast("long"))

    fields = RAW_SCHEMAS[table].fields
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in fields if isinstance(f.dataType, T.LongType)]
    return rows.agg(
        F.lit(table).alias("table"),
        total([F.count(F.lit(1)) - F.count(f.name) for f in fields]).alias("missing"),
        total([F.coalesce(F.sum(F.length(name)), F.lit(0)) for name in texts]).alias("chars"),
        total([F.coalesce(F.sum(F.col(name) % 1_000_003), F.lit(0)) for name in numbers]).alias("whole"),
        F.min(INGESTED_AT).alias("ingested_at"),
    )


def _types(w: Warehouse) -> DataFrame:
    """The inferred type of every column of every raw table, from all its values as text."""
    found = []
    for name, rows in w.raw_tables().items():
        texts = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
        found.append(infer_types(texts).select(F.lit(name).alias("table"), "column", "type"))
    return functools.reduce(DataFrame.unionByName, found)


def _calendar_days(w: Warehouse) -> DataFrame:
    """The calendar's attributes of each order, promised and receipt date."""
    orders, receipts = w.raw("purchase_orders"), w.raw("goods_receipts")
    days = (
        orders.select(F.lit("order").alias("date_role"), F.col("po_id").alias("document_id"), F.col("po_date").alias("day"))
        .unionAll(orders.select(F.lit("promised"), "po_id", "expected_delivery_date"))
        .unionAll(receipts.select(F.lit("receipt"), "gr_id", "gr_date"))
    )
    calendar = w.dates()
    # the calendar's two end dates fix its size
    return days.join(F.broadcast(calendar), F.col("day") == F.col("full_date")).drop("day")


def _loaded_vendors(w: Warehouse) -> DataFrame:
    """The vendor history after three loads; those of July, the second of them in place of the first,
    arrive after that of October."""
    staged, key = w.staged("vendors"), F.col("vendor_id")
    staged = staged.unionByName(staged.filter(key % 11 == 0).withColumn("vendor_id", -key))
    number = F.abs(key)
    terms = F.when(number % 5 == 0, "Net 45").otherwise(F.col("payment_terms"))
    province = F.when(number % 13 == 0, "Sumatera").otherwise(F.col("province"))
    moved = (
        {"city": F.when(number % 7 == 0, "Bandung").otherwise(F.col("city"))},
        {"city": F.when(number % 7 == 0, "Medan").otherwise(F.col("city")), "province": province},
        {"city": F.when(number % 7 < 2, "Bogor").otherwise(F.col("city")), "province": province},
    )
    versions = w.vendors()
    for number in VENDOR_ARRIVALS:
        load = staged.withColumns({"payment_terms": terms, **moved[number]})
        # each state is stored, as between the days of a real history
        versions = w.keep("vendors", history.apply_load(versions, load, VENDOR_LOADS[number]))
    return versions.drop(history.SEEN_ON)


def _vendor_of_the_day(w: Warehouse) -> DataFrame:
    orders = w.staged("purchase_orders").select("po_id", "vendor_id", "po_date")
    return history.as_of(orders, w.vendors(), "po_date").select(
        "po_id", "vendor_sk", "record_version"
    )


def _merged_snapshot(w: Warehouse) -> DataFrame:
    """A fact of other sources brought up to date: older orders had another status, lines another
    quantity, some receipts were missing or had another count, and some lines are gone since."""
    lines, orders, receipts = (w.raw(table) for table in ("purchase_order_lines", "purchase_orders", "goods_receipts"))

    def earlier(part: DataFrame) -> DataFrame:
        return part.withColumn("quantity_ordered", F.col("quantity_ordered") + (F.col("line_id") % 11 == 0).cast("int"))

    # apart, so that the lines that are left stay in their buckets
    left = earlier(lines.where("line_id % 17 <> 0"))
    gone = earlier(lines.where("line_id % 13 = 0").withColumn("line_id", -F.col("line_id")))
    statuses = F.when(F.col("po_id") % 7 == 0, "Terbuka").otherwise(F.col("status"))
    other = receipts.where("gr_id % 5 <> 0").withColumn(
        "quantity_received", F.col("quantity_received") + (F.col("gr_id") % 19 == 0).cast("int")
    )
    former = orders.withColumn("status", statuses), other
    keyed = w.dates(), w.vendors(), w.departments(), w.items()
    known = w.track(tracking.fingerprints(left.unionByName(gone), *former, *keyed), f"former/{uuid.uuid4().hex}")
    cleaned = [
        getattr(staging, table)(rows) for table, rows in zip(("purchase_orders", "goods_receipts"), former, strict=True)
    ]
    parts = [snapshot.sources(staging.purchase_order_lines(part), *cleaned, *keyed) for part in (left, gone)]
    return w.refreshed_fact(parts, known)


def _eligible(w: Warehouse) -> DataFrame:
    approved = documents.approved_requests(w.raw("purchase_requests"))
    vendors, items = documents.active(w.raw("vendors")), documents.active(w.raw("items"))
    return (
        approved.select(F.lit("requests").alias("kind"), F.col("pr_id").alias("id"))
        .unionAll(vendors.select(F.lit("vendors"), "vendor_id"))
        .unionAll(items.select(F.lit("items"), "item_id"))
    )


def _sampled(w: Warehouse) -> DataFrame:
    """Half of the approved requests."""
    requests = documents.approved_requests(w.raw("purchase_requests"))
    half = requests.agg(F.call_function("div", F.count(F.lit(1)), F.lit(2))).scalar()
    return documents.sample_rows(requests, half, "pr_id", seed=42).select("pr_id")


def _sampled_again(w: Warehouse) -> DataFrame:
    """As many draws as there are orders, from the approved requests, with replacement: how often each
    request was drawn."""
    requests = documents.approved_requests(w.raw("purchase_requests"))
    wanted = w.raw("purchase_orders").count()
    drawn = documents.sample_with_replacement(requests, wanted, "pr_id", seed=42)
    return drawn.groupBy("pr_id").agg(F.count(F.lit(1)).alias("times"))


def _receipt_measures(w: Warehouse) -> DataFrame:
    orders = w.raw("purchase_orders").select("po_id", "po_date", "expected_delivery_date")
    receipts = w.raw("goods_receipts").select(
        "gr_id", "po_id", "gr_date", "quantity_ordered", "quantity_received"
    )
    return documents.with_receipt_measures(receipts.join(orders, "po_id")).select(
        "gr_id", "quantity_variance", "variance_pct", "receipt_status", "lead_time_days",
        "is_on_time",
    )


def _numbers(w: Warehouse) -> DataFrame:
    parts = (
        ("PR", "purchase_requests", "pr", 9),
        ("PO", "purchase_orders", "po", 9),
        ("GR", "goods_receipts", "gr", 10),
    )
    numbered = [
        w.raw(table).select(
            F.lit(prefix).alias("kind"),
            F.col(f"{stem}_id").alias("id"),
            document_number(prefix, F.col(f"{stem}_date"), F.col(f"{stem}_id"), width)
            .alias("number"),
        )
        for prefix, table, stem, width in parts
    ]
    return functools.reduce(DataFrame.unionByName, numbered)


def _order_totals(w: Warehouse) -> DataFrame:
    totals = documents.with_order_totals(w.raw("purchase_orders"), w.raw("purchase_order_lines"))
    return totals.select("po_id", "total_amount")


def _request_totals(w: Warehouse) -> DataFrame:
    totals = documents.with_request_totals(w.raw("purchase_requests"), w.raw("purchase_orders"))
    return totals.select("pr_id", "total_amount")


def _status_counts(w: Warehouse) -> DataFrame:
    return documents.value_counts(w.raw("purchase_orders"), "status").unionByName(
        documents.value_counts(w.raw("goods_receipts"), "receipt_status")
    )


def _checked_tables(w: Warehouse) -> dict[str, DataFrame]:
    return {**w.raw_tables(), **checks.mart_tables(w.marts())}


_OVER_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {
    "S3": _types,
    "T1": lambda w: w.staged("departments"),
    "T2": lambda w: w.staged("vendors"),
    "T3": lambda w: w.staged("items"),
    "T4": lambda w: w.staged("purchase_requests"),
    "T5": lambda w: w.staged("purchase_orders"),
    "T6": lambda w: w.staged("purchase_order_lines"),
    "T7": lambda w: w.staged("goods_receipts"),
    "L1": lambda w: lifecycle.latest_receipts(w.staged("goods_receipts")),
    "L2": lambda w: w.lifecycle(),
    "D1": _calendar_days,
    "D2": lambda w: dimensions.departments(w.staged("departments")),
    "D3": lambda w: dimensions.items(w.staged("items")),
    "D4": lambda w: dimensions.vendors(w.staged("vendors")),
    "D5": _loaded_vendors,
    "D6": _vendor_of_the_day,
    "X1": lambda w: w.build_fact(),
    "X6": _merged_snapshot,
    "V1": lambda w: checks.unique_checks(_checked_tables(w)),
    "V2": lambda w: checks.column_checks(_checked_tables(w), accepted=False),
    "V3": lambda w: checks.column_checks(_checked_tables(w), not_null=False),
    "V4": lambda w: checks.relationship_checks(w.marts(checks.KEY_COLUMNS)),
    "V5": lambda w: checks.quality.gate(checks.all_checks(w.raw_tables(), w.marts(checks.FACT_CHECKED))),
    "V6": lambda w: checks.freshness_checks(w.raw_tables(), CHECKED_AT),
    "V7": lambda w: checks.smoke_checks(w.marts()),
    "G1": _order_totals,
    "G2": _request_totals,
    "G3": _eligible,
    "G4": lambda w: documents.receivable_lines(
        w.raw("purchase_order_lines"), w.raw("purchase_orders")
    ).select("line_id", "po_id"),
    "G5": _sampled,
    "G5_replacement": _sampled_again,
    "G6": _receipt_measures,
    "G7": _numbers,
    "G8": _status_counts,
    "G9": lambda w: documents.receipt_profile(w.raw("goods_receipts")),
    "G10": lambda w: documents.shape_report(w.raw_tables()),
}


def entry(spark: SparkSession) -> DataFrame:
    """Order value per month at the smallest scale."""
    return monthly_order_value(sample_warehouse(spark, SMALLEST).marts())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator and report; each callable takes (spark, folder of the given tables)."""

    def over_warehouse(build):
        return lambda spark, folder: portable(build(sample_warehouse(spark, folder)))

    def over_marts(report):
        return lambda spark, folder: portable(report(sample_warehouse(spark, folder).marts()))

    reports = {
        **REPORTS,
        **STAKEHOLDER_REPORTS,
        "FIN2": functools.partial(payables_ageing, as_of=PAYABLES_AS_OF),
    }
    return {
        **_LLM_QUERIES,
        "S1": lambda spark, folder: portable(_csv_round_trip(spark, folder)),
        **{key: over_warehouse(build) for key, build in _OVER_WAREHOUSE.items()},
        **{key: over_marts(report) for key, report in reports.items()},
    }


def oracle_sql() -> dict[str, str]:
    """The expected result of each query in DuckDB SQL, where SQL can express it."""
    from oracle.statements import statements

    return {**_LLM_ORACLE_SQL, **statements()}
