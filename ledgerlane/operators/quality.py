"""Data checks. Every one yields rows of (check, table, column, severity, failing_rows, passed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.text import packed_key

ERROR, WARN = "error", "warn"


def _result(check: str, table: str, column: str, severity: str, failing: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        failing.alias("failing_rows"),
        (failing == 0).alias("passed"),
    ]


def _comparable(rows: DataFrame, column: str) -> tuple[Column, Column]:
    """A value as a whole number or as bytes, whichever tells its values apart; the other is missing."""
    kind, value = rows.schema[column].dataType, F.col(f"`{column}`")
    number, text = F.lit(None).cast("long"), F.lit(None).cast("binary")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        number = value.cast("long")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("long")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(value)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        text = (value + F.lit(0.0)).cast("string").cast("binary")  # both zeros are one value
    elif isinstance(kind, T.BinaryType):
        text = value
    else:
        text = packed_key(value.cast("string"))
    return number, text


def unique_values(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], severity: str = ERROR) -> DataFrame:
    """Values that occur more than once, for some columns of each table; missing values do not count.

    Each table is scanned once and all checks share one shuffle, of (check, value). A value is compared
    as a whole, so the result is exact. Counts are combined in each task before the shuffle, so one
    value held by many rows stays small. A table without columns gives no row.
    """
    declared = [(table, column) for table, (_, columns) in tables.items() for column in columns]
    scans = []
    for table, (rows, columns) in tables.items():
        values = []
        for column in columns:
            number, text = _comparable(rows, column)
            named = F.lit(declared.index((table, column))).alias("nth")
            values.append(F.struct(named, number.alias("number"), text.alias("text")))
        if values:
            scans.append(rows.select(F.inline(F.array(*values))))
    if not scans:
        raise ValueError("no column is named")
    repeated = (
        reduce(DataFrame.unionAll, scans)
        .where("number IS NOT NULL OR text IS NOT NULL")
        .groupBy("nth", "number", "text")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )
    counts = repeated.agg(*[F.count_if(F.col("nth") == i).alias(f"c{i}") for i in range(len(declared))])
    results = [
        F.struct(*_result("unique", table, column, severity, F.col(f"c{i}")))
        for i, (table, column) in enumerate(declared)
    ]
    return counts.select(F.inline(F.array(*results)))


def unique(rows: DataFrame, table: str, column: str, severity: str = ERROR) -> DataFrame:
    """Values of one column that occur more than once."""
    return unique_values({table: (rows, (column,))}, severity)


def column_checks(
    rows: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    severities: Mapping[str, str] | None = None,
) -> DataFrame:
    """All not-null and accepted-values checks of a table, in one scan of it."""
    severities = severities or {}
    conditions = [("not_null", name, F.col(name).isNull(), ERROR) for name in not_null]
    for name, values in (accepted or {}).items():
        outside = F.col(name).isNotNull() & ~F.col(name).isin(*values)
        conditions.append(("accepted_values", name, outside, severities.get(name, ERROR)))
    counts = rows.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad, _) in
                        enumerate(conditions)])
    results = [
        F.struct(*_result(check, table, name, severity, F.col(f"c{i}")))
        for i, (check, name, _, severity) in enumerate(conditions)
    ]
    return counts.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def relationship(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    field: str,
    severity: str = ERROR,
) -> DataFrame:
    """Child rows whose key no parent has; missing keys are not counted.

    The child is reduced to one counted row per key before it meets the parent, so a key held by
    a large part of the rows is shuffled as a handful of partial counts.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    known = parent.select(F.col(field).alias("key"))
    orphans = keys.join(known, "key", "left_anti")
    found = orphans.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("failing"))
    return found.select(*_result("relationships", table, column, severity, F.col("failing")))


def freshness(
    rows: DataFrame,
    table: str,
    as_of: datetime,
    *,
    loaded_at: str = "_ingested_at",
    warn_hours: int = 25,
    error_hours: int = 49,
) -> DataFrame:
    """Age of the newest load: (table, newest, age_hours, status)."""
    newest = F.max(F.col(loaded_at).cast("timestamp_ntz"))
    seconds = F.timestamp_diff("SECOND", F.col("newest"), F.lit(as_of).cast("timestamp_ntz"))
    hours = F.col("age_seconds")
    return (
        rows.agg(newest.alias("newest"))
        .withColumn("age_seconds", seconds)
        .select(
            F.lit(table).alias("table"),
            "newest",
            F.call_function("div", hours, F.lit(3600)).alias("age_hours"),
            F.when(hours > error_hours * 3600, ERROR)
            .when(hours > warn_hours * 3600, WARN)
            .when(hours.isNull(), ERROR)
            .otherwise("pass")
            .alias("status"),
        )
    )


def within_bounds(measures: DataFrame, bounds: Mapping[str, tuple[int | None, int | None]]
                  ) -> DataFrame:
    """Compare one row of named counts with allowed bounds: (name, value, lower, upper, ok)."""

    def bound(value: int | None) -> Column:
        return F.lit(value).cast("long")

    checks = []
    for name, (lower, upper) in bounds.items():
        value = F.col(name)
        above = value >= bound(lower) if lower is not None else F.lit(True)
        below = value <= bound(upper) if upper is not None else F.lit(True)
        checks.append(
            F.struct(
                F.lit(name).alias("name"), value.alias("value"), bound(lower).alias("lower"),
                bound(upper).alias("upper"), (above & below).alias("ok"),
            )
        )
    return measures.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def combine(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def gate(results: DataFrame) -> DataFrame:
    """The results that must stop a load: failed ones of severity ``error``."""
    return results.filter((F.col("severity") == ERROR) & ~F.col("passed"))
