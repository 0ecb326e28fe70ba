"""Full load of the raw layer from CSV files."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.schemas import BUCKET_KEYS, LOAD_ORDER, RAW_SCHEMAS
from ledgerlane.sources.csv_files import CORRUPT, nan_to_null, read_csv, with_ingest_time, write_csv
from ledgerlane.sources.layers import COMPILED_BYTES, LONGEST_METHOD, RAW, SCRATCH, LayerStore

SUMMARY = "table string, rows long, bad_rows long, status string, elapsed_s double"

#: Layer of the rows that did not fit, kept as text when a load is told to.
REJECTED = "rejected"


class TooManyBadRows(RuntimeError):
    """More rows of a file did not fit than the load allows; the table stays as it was."""


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    """Write each table's declared columns to ``<folder>/<table>.csv``."""
    for name, rows in tables.items():
        write_csv(rows.select(*RAW_SCHEMAS[name].fieldNames()), f"{folder}/{name}.csv")


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Have Spark deal a stage over methods that the JVM compiles, which it leaves out above 8,000 bytes.

    What is done with all cells of a table comes to more in one method and would be interpreted.
    """
    before = spark.conf.get(LONGEST_METHOD)
    spark.conf.set(LONGEST_METHOD, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.set(LONGEST_METHOD, before)


def load_table(
    spark: SparkSession, store: LayerStore, folder: str, table: str, loaded: datetime, *,
    keep_bad_rows: bool = False, multi_line: bool = False, most_bad: float = 1.0,
) -> tuple[str, int, int, str, float]:
    """Load one table; a missing file is skipped, any other failure raises and changes nothing.

    With ``keep_bad_rows`` rows that do not fit go to the layer ``rejected`` instead of failing the
    load, and the summary counts them. If they are more than the share ``most_bad`` of all rows the
    load fails before it is visible; the rows set aside can be looked at all the same. Both counts are
    taken while writing. The file is parsed once: its rows are stored and dealt to both layers from there.
    """
    started, parsed = time.perf_counter(), f"{SCRATCH}/{uuid.uuid4().hex}"
    try:
        rows = read_csv(spark, f"{folder}/{table}.csv", RAW_SCHEMAS[table],
                        keep_bad_rows=keep_bad_rows, multi_line=multi_line)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return table, 0, 0, "SKIPPED", 0.0
    bad = 0
    try:
        if keep_bad_rows:
            with short_methods(spark):
                store.write(parsed, table, rows)
            rows = store.read(parsed, table)
            unfit = rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
            bad = store.write(REJECTED, table, with_ingest_time(unfit, loaded))
            rows = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        with store.held(RAW):
            count = store.write(
                RAW, table, with_ingest_time(nan_to_null(rows), loaded), bucket_key=BUCKET_KEYS.get(table)
            )
            if bad > most_bad * (bad + count):
                raise TooManyBadRows(f"{table}: {bad} of {bad + count} rows do not fit")
    finally:
        store.drop(parsed)
    return table, count, bad, "OK", round(time.perf_counter() - started, 2)


def ingest(
    spark: SparkSession, store: LayerStore, folder: str, loaded: datetime, *,
    keep_bad_rows: bool = False, multi_line: bool = False, most_bad: float = 1.0,
) -> DataFrame:
    """Load all tables, parents first, and summarise: (table, rows, bad_rows, status, elapsed_s).

    The last row is the grand total. Each table is committed by itself, so a failing one leaves
    the earlier ones loaded and its own former content in place, unless the caller holds the layer.
    """
    loads = [
        load_table(spark, store, folder, table, loaded, keep_bad_rows=keep_bad_rows, multi_line=multi_line,
                   most_bad=most_bad)
        for table in LOAD_ORDER
    ]
    total = ("GRAND TOTAL", *(sum(load[k] for load in loads) for k in (1, 2)), "OK", sum(load[4] for load in loads))
    return spark.createDataFrame([*loads, total], SUMMARY)
