"""The flow from raw tables to marts."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.operators import dimensions, history, lifecycle, snapshot, staging, tracking
from ledgerlane.schemas import BUCKET_KEYS, LOAD_ORDER
from ledgerlane.sources.layers import MARTS, RAW, SCRATCH, LayerStore, deal_for, shared_folder
from ledgerlane.sources.sample import SampleTables

FACT = "fct_purchase_order_lines"

#: Layer of the fingerprints that belong to the stored fact.
TRACKED = "tracked"

#: Columns the fact is partitioned by when stored: reports on one year read that year only.
FACT_PARTITIONS = ("po_year",)


#: Gives a raw table by name; the second argument gives other raw tables it may be derived from.
Source = Callable[[str, Callable[[str], DataFrame]], DataFrame]


@dataclass(frozen=True)
class Marts:
    """The tables reports read."""

    dates: DataFrame
    departments: DataFrame
    items: DataFrame
    vendors: DataFrame
    fact: DataFrame


class Warehouse:
    """Raw tables, staging views and marts over one source.

    With a store, raw tables and dimensions are written once, on first use, and read back from then on;
    staging and lifecycle stay plans, and so does the fact until ``update_fact`` stores it: a report
    reads few of its columns, and only these are moved. Without a store everything stays a plan.
    ``keep_raw`` is off for a source that is stored already.
    """

    def __init__(self, spark: SparkSession, source: Source, store: LayerStore | None = None, *,
                 keep_raw: bool = True) -> None:
        self.spark, self._source, self._store = spark, source, store
        self._keep_raw = keep_raw
        self._building = threading.RLock()

    def _kept(self, layer: str, table: str, build: Callable[[], DataFrame],
              partition_by: Sequence[str] = (), bucket_key: str | None = None) -> DataFrame:
        if self._store is None:
            return build()
        with self._building:
            if not self._store.written(layer, table):
                self._store.write(layer, table, build(), partition_by, bucket_key)
        return self._store.read(layer, table)

    def raw(self, table: str) -> DataFrame:
        if not self._keep_raw:
            return self._source(table, self.raw)
        return self._kept(
            RAW, table, lambda: self._source(table, self.raw), bucket_key=BUCKET_KEYS.get(table)
        )

    def raw_tables(self) -> dict[str, DataFrame]:
        return {table: self.raw(table) for table in LOAD_ORDER}

    def staged(self, table: str) -> DataFrame:
        return getattr(staging, table)(self.raw(table))

    def lifecycle(self) -> DataFrame:
        return lifecycle.order_lifecycle(
            self.staged("purchase_order_lines"),
            self.staged("purchase_orders"),
            lifecycle.latest_receipts(self.staged("goods_receipts")),
        )

    def _dimension(self, name: str) -> DataFrame:
        return self._kept(
            MARTS, f"dim_{name}", lambda: getattr(dimensions, name)(self.staged(name))
        )

    def dates(self) -> DataFrame:
        return self._kept(MARTS, "dim_date", lambda: dimensions.calendar(self.spark))

    def departments(self) -> DataFrame:
        return self._dimension("departments")

    def items(self) -> DataFrame:
        return self._dimension("items")

    def vendors(self) -> DataFrame:
        return self._dimension("vendors").drop(history.SEEN_ON)

    def _staged_sources(self) -> tuple[DataFrame, ...]:
        return tuple(self.staged(t) for t in ("purchase_order_lines", "purchase_orders", "goods_receipts"))

    def _dimensions(self) -> tuple[DataFrame, ...]:
        return self.dates(), self.vendors(), self.departments(), self.items()

    def fact_sources(self) -> snapshot.Sources:
        return snapshot.sources(*self._staged_sources(), *self._dimensions())

    def build_fact(self) -> DataFrame:
        """The fact as a plan over raw tables and stored dimensions."""
        return self.fact_sources().fact().select(*snapshot.FACT_COLUMNS)

    def refreshed_fact(self, stored: DataFrame | Sequence[snapshot.Sources],
                       former: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """A fact of earlier sources, brought up to date with the present ones.

        With the earlier sources' fingerprints only what changed is looked at; without them the whole
        fact is compared with the present sources. A fact that is not stored is given by its sources, in
        parts by their lines: of these the changed lines are left out before they are joined.
        """
        if former is None:
            if not isinstance(stored, DataFrame):
                stored = reduce(DataFrame.unionByName, [part.fact() for part in stored])
            given = self.fact_sources()
            changed = snapshot.changes(stored, given)
            if self._store is not None:
                changed = self._scratch()("changed_lines", changed)[0]
            return snapshot.merged(stored, changed, given).select(*snapshot.FACT_COLUMNS)
        changes = tracking.Changes(former, self._fingerprints(), self._scratch())
        if changes.everything:
            return self.build_fact()
        if isinstance(stored, DataFrame):
            kept = [tracking.among(stored, changes.lines.toDF("po_line_id"), changes.count, "po_line_id", "left_anti")]
        else:
            kept = [part.without(changes.lines, changes.count).fact() for part in stored]
        parts = [rows.select(*snapshot.FACT_COLUMNS) for rows in (*kept, self._built(changes))]
        return reduce(DataFrame.unionByName, parts)

    def _fingerprints(self) -> dict[str, DataFrame]:
        sources = (self.raw(t) for t in ("purchase_order_lines", "purchase_orders", "goods_receipts"))
        return tracking.fingerprints(*sources, *self._dimensions())

    def track(self, given: Mapping[str, DataFrame], layer: str = TRACKED) -> dict[str, DataFrame]:
        """Store fingerprints in buckets of their keys."""
        def write(name: str) -> int:
            return self._store.write(layer, name, given[name], bucket_key=tracking.KEYS[name])

        with ThreadPoolExecutor(len(tracking.KEYS)) as pool:
            list(pool.map(write, given))
        return {name: self._store.read(layer, name) for name in given}

    def _scratch(self) -> Callable[[str, DataFrame], tuple[DataFrame, int]]:
        """Stores rows of one update; plans over them stay good until the store is discarded."""
        layer = f"{SCRATCH}/{uuid.uuid4().hex}"

        def keep(name: str, rows: DataFrame) -> tuple[DataFrame, int]:
            if self._store is None:
                return rows, rows.count()
            count = self._store.write(layer, name, rows)
            return self._store.read(layer, name), count

        return keep

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows of an intermediate state, stored if there is a store."""
        return rows if self._store is None else self._scratch()(name, rows)[0]

    def _built(self, changes: tracking.Changes) -> DataFrame:
        """The touched lines of the fact from the present sources, and no others."""
        lines, orders, receipts = self._staged_sources()
        ids, count = changes.lines, changes.count
        lines = tracking.among(lines, ids, count, "line_id")
        orders = tracking.among(orders, lines.select("po_id").distinct(), count, "po_id")
        receipts = tracking.among(receipts, ids.toDF("po_line_id"), count, "po_line_id")
        return snapshot.sources(lines, orders, receipts, *self._dimensions()).fact()

    def update_fact(self) -> list[int]:
        """Bring the stored fact up to date: only years that hold a changed line are written.

        Rows of these years that did not change are copied as they lie. Without a stored fact, or with
        another calendar, the whole one is built. Returns the years written.
        """
        with self._building:
            stored = self._store.exists(MARTS, FACT) and self._store.exists(TRACKED, "lines")
            since = self._store.version(MARTS, FACT)
            present = self._fingerprints()
            changes = stored and tracking.Changes(
                {name: self._store.read(TRACKED, name) for name in present}, present, self._scratch()
            )
            if not stored or changes.everything:
                self._store.write(MARTS, FACT, self.fact_sources().fact(), FACT_PARTITIONS)
                self.track(present)
                return []
            years = changes.years()
            if years:
                old = self._store.read(MARTS, FACT, since).where(F.col("po_year").isin(years))
                kept = tracking.among(old, changes.lines.toDF("po_line_id"), changes.count, "po_line_id", "left_anti")
                self._store.replace(MARTS, FACT, self._built(changes), "po_year", years,
                                    kept=kept.select(*old.columns), since=since)
            # a failure before this line has the next update build the same lines again
            self.track({name: present[name] for name in changes.sources})
            self._store.fresh.add((MARTS, FACT))
            return years

    def update_vendors(self, load_date: date) -> None:
        """Apply the staged vendors to the stored history, or begin one. Loads may come in any order."""
        with self._building:
            if self._store.exists(MARTS, "dim_vendors"):
                stored = self._store.read(MARTS, "dim_vendors")
                self._store.write(
                    MARTS, "dim_vendors", history.apply_load(stored, self.staged("vendors"), load_date)
                )
            else:
                first = history.observed(dimensions.vendors(self.staged("vendors")))
                self._store.write(MARTS, "dim_vendors", history.seen(first, self.staged("vendors"), load_date))

    def register_views(self) -> None:
        """Make staging, lifecycle and marts known to SQL under their model names."""
        for table in LOAD_ORDER:
            self.staged(table).createOrReplaceTempView(f"stg_{table}")
        self.lifecycle().createOrReplaceTempView("int_po_lifecycle")
        m = self.marts()
        m.dates.createOrReplaceTempView("dim_date")
        m.departments.createOrReplaceTempView("dim_departments")
        m.items.createOrReplaceTempView("dim_items")
        m.vendors.createOrReplaceTempView("dim_vendors")
        m.fact.createOrReplaceTempView("fct_purchase_order_lines")

    def fact(self) -> DataFrame:
        """The fact as it is stored, or a plan from which readers take the columns they name."""
        if self._store is not None and self._store.written(MARTS, FACT):
            return self._store.read(MARTS, FACT).select(*snapshot.FACT_COLUMNS)
        return self.build_fact()

    def marts(self, several_scans: Sequence[str] = ()) -> Marts:
        """What reports read. With ``several_scans`` the fact has these columns alone and is stored
        before it is read, for readers that scan it more than once."""
        fact = self.fact()
        if several_scans:
            key, line = "fct_po_line_sk", "po_line_id"
            if key in several_scans and line in several_scans:
                # the key is made of the line's, so it is made again in place of being stored
                kept = self.keep("fact_columns", fact.select(*(name for name in several_scans if name != key)))
                fact = kept.withColumn(key, dimensions.surrogate_key(F.col(line))).select(*several_scans)
            else:
                fact = self.keep("fact_columns", fact.select(*several_scans))
        return Marts(self.dates(), self.departments(), self.items(), self.vendors(), fact)

    def discard(self) -> None:
        """Delete the stored tables; they are written again on their next use."""
        if self._store is not None:
            with self._building:
                self._store.discard()


_warehouses: dict[tuple[str, str], Warehouse] = {}


def sample_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over a test-data folder; one per application and folder.

    Stored tables live under the shared folder in a directory named after the application, so
    tables of an earlier run are never read; the directory is deleted when the application ends.
    """
    application = spark.sparkContext.applicationId
    if (application, folder) not in _warehouses:
        root = f"{shared_folder(spark)}/ledgerlane-{application}/{len(_warehouses)}"
        tables = SampleTables(spark, folder, to_buckets=True)
        deal_for(spark, tables.rows())
        _warehouses[application, folder] = Warehouse(spark, tables.table, LayerStore(spark, root, transient=True))
    return _warehouses[application, folder]
