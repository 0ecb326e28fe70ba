"""Rules over raw purchasing documents: totals, eligible rows, receipt measures, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.dates import days_between
from ledgerlane.functions.numeric import mean, percent
from ledgerlane.functions.text import is_status
from ledgerlane.schemas import RECEIPT_STATUSES

# Order statuses under which goods can arrive.
RECEIVABLE = ("Selesai", "Sebagian Diterima")

GRAND_TOTAL = "GRAND TOTAL"


def _with_total(parents: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """Left join of a total per key, 0 where a parent has no rows."""
    others = [name for name in parents.columns if name != "total_amount"]
    joined = parents.select(*others).join(totals, key, "left")
    return joined.select(*others, F.coalesce("total_amount", F.lit(0)).alias("total_amount"))


def with_order_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Fill each order's ``total_amount`` from its lines."""
    totals = lines.groupBy("po_id").agg(F.sum("total_price").alias("total_amount"))
    return _with_total(orders, totals, "po_id")


def with_request_totals(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """Fill each request's ``total_amount`` from its orders."""
    totals = orders.groupBy("pr_id").agg(F.sum("total_amount").alias("total_amount"))
    return _with_total(requests, totals, "pr_id")


def approved_requests(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("status") == "Disetujui")


def active(rows: DataFrame) -> DataFrame:
    """Active vendors or items."""
    return rows.filter("is_active")


def receivable_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines whose order is in a status under which goods can arrive."""
    eligible = orders.filter(is_status(F.col("status"), *RECEIVABLE)).select("po_id")
    return lines.join(eligible, "po_id", "left_semi")


#: Buckets of the sampling histogram: the first four hexadecimal digits.
_PREFIX = 4


def _numbered(rows: DataFrame, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows with hash and bucket, and per bucket (at most 16^4 of them, whatever the table holds) how
    many rows it holds and how many lie before it."""
    hashed = rows.withColumn("_hash", _hash(key, seed)).withColumn("_bucket", F.substring("_hash", 1, _PREFIX))
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_held"))
    order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return hashed, counts.withColumn("_before", F.coalesce(F.sum("_held").over(order), F.lit(0)))


def sample_rows(rows: DataFrame, wanted: int | Column, key: str, seed: int) -> DataFrame:
    """``wanted`` rows, chosen by the md5 of seed and key: the same ones however rows are dealt.

    Rows are taken in the order of that hash, then of the key, which must be unique. A histogram of
    hash prefixes finds the bucket in which the last row lies, and only that bucket is ordered, so
    no task ever sorts more than about one row in 65,536. ``wanted`` may be an expression of one
    row, such as a count taken in the same plan; the whole table comes if it is wanted or more.
    """
    hashed, before = _numbered(rows, key, seed)
    limit = wanted if isinstance(wanted, Column) else F.lit(wanted)
    reached = before.withColumn("_left", limit - F.col("_before")).where("_left > 0")
    # at most 16^4 rows, whatever the table holds
    dealt = hashed.join(F.broadcast(reached), "_bucket")
    inside = dealt.where("_left >= _held").select(*rows.columns)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    edge = dealt.where("_left < _held").withColumn("_rank", rank).where("_rank <= _left").select(*rows.columns)
    return inside.unionByName(edge)


def sample_with_replacement(rows: DataFrame, wanted: int, key: str, seed: int) -> DataFrame:
    """Exactly ``wanted`` rows drawn with replacement: each draw may take any row, so a row comes none,
    one or more times. The same ones however rows are dealt; none from an empty table.

    Rows are numbered from 0 in the order of ``sample_rows``, inside buckets of their hash and after the
    rows of the buckets before. Draw j takes the row whose number is the md5 of seed and j, of which
    sixty bits are taken, modulo the rows. Draws of one number are counted before they meet the row.
    """
    hashed, before = _numbered(rows, key, seed)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    placed = hashed.join(F.broadcast(before), "_bucket").withColumn("_number", F.col("_before") + rank - 1)
    held = rows.agg(F.count(F.lit(1))).scalar()
    drawn = F.md5(F.concat(F.lit(f"{seed}|draw|"), F.col("id").cast("string")).cast("binary"))
    number = F.conv(F.substring(drawn, 1, 15), 16, 10).cast("long") % F.nullif(held, F.lit(0))
    draws = rows.sparkSession.range(wanted).select(number.alias("_number"))
    times = draws.groupBy("_number").agg(F.count(F.lit(1)).alias("_times"))
    met = placed.join(times, "_number")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))
    return met.withColumn("_copy", copies).select(*rows.columns)


def _hash(key: str, seed: int) -> Column:
    """A missing key counts as an empty one."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}|"), text).cast("binary"))


def with_receipt_measures(receipts: DataFrame) -> DataFrame:
    """Derive lead days, punctuality, variance and status of a receipt.

    Needs ``po_date``, ``expected_delivery_date``, ``gr_date``, ``quantity_ordered`` and
    ``quantity_received``.
    """
    ordered = F.col("quantity_ordered")
    variance = F.col("quantity_received") - ordered
    full, short, shorter, shortest, over = RECEIPT_STATUSES
    # percent to two digits with the sign kept apart, so that halves round away from zero
    base = F.nullif(ordered * 2, F.lit(0))
    size = F.call_function("div", F.abs(variance) * 20000 + ordered, base)
    return receipts.withColumns({
        "quantity_variance": variance,
        "variance_pct": F.when(variance < 0, -size).otherwise(size) / F.lit(100.0),
        "receipt_status": F.when(variance == 0, full)
        .when(variance > 0, over)
        .when(F.abs(variance) * 10 <= ordered, short)
        .when(F.abs(variance) * 4 <= ordered, shorter)
        .otherwise(shortest),
        "lead_time_days": days_between(F.col("gr_date"), F.col("po_date")).cast("long"),
        "is_on_time": F.col("gr_date") <= F.col("expected_delivery_date"),
    })


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """How often each value occurs; missing values are not counted."""
    found = rows.filter(F.col(column).isNotNull())
    counts = found.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.lit(column).alias("column"), "value", "rows")


def receipt_profile(receipts: DataFrame) -> DataFrame:
    """Spread of lead days and quantity variance, in one pass.

    The exact median keeps one counter per distinct number of days, so its state is bounded by the
    span of the calendar, not by the rows.
    """
    lead, variance = F.col("lead_time_days"), F.col("variance_pct").cast("decimal(18,2)")
    return receipts.agg(
        F.min(lead).alias("lead_min"),
        F.median(lead).alias("lead_median"),
        mean(lead, 1).alias("lead_mean"),
        F.max(lead).alias("lead_max"),
        percent(F.count_if("is_on_time"), F.count("is_on_time"), 1).alias("on_time_pct"),
        F.min(variance).alias("variance_min"),
        mean(variance, 2, scale=2).alias("variance_mean"),
        F.max(variance).alias("variance_max"),
    )


def shape_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, and their grand total."""
    parts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(table.columns)).alias("columns")
        )
        for name, table in tables.items()
    ]
    shapes = reduce(DataFrame.unionByName, parts)
    totals = shapes.rollup("table").agg(
        F.sum("rows").alias("rows"), F.sum("columns").alias("columns")
    )
    return totals.fillna({"table": GRAND_TOTAL})
