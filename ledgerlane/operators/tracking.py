"""What an update of the fact has to build anew: fingerprints of the sources, compared one by one.

A fingerprint holds a row's keys and a hash of its own columns. Fingerprints are stored in buckets of
the key, as the raw tables are, so a source meets its former state without a shuffle. Keys of other
tables are not hashed: a vendor, department or item whose surrogate key is another leads to its orders
and lines by itself. What is shuffled follows the changes, not the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fingerprints and their keys.
KEYS = {
    "lines": "line_id",
    "orders": "po_id",
    "receipts": "po_line_id",
    "vendors": "vendor_id",
    "departments": "department_id",
    "items": "item_id",
    "calendar": "full_date",
}

#: Changed keys that are sent to every task: at most so many numbers, a few megabytes.
FEW_KEYS = 200_000

# Columns of raw tables that do not reach the fact.
_APART = frozenset({"_ingested_at", "created_at", "notes"})


def _hash(rows: DataFrame) -> Column:
    """A hash of all columns that can reach the fact; a missing value counts as such."""
    parts = []
    for column in rows.columns:
        if column not in _APART:
            parts += [F.col(column), F.col(column).isNull()]
    return F.xxhash64(*parts)


def _hashed(rows: DataFrame, key: str, *further: Column | str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).select(key, *further, _hash(rows).alias("hash"))


def fingerprints(
    lines: DataFrame, orders: DataFrame, receipts: DataFrame, dates: DataFrame, vendors: DataFrame,
    departments: DataFrame, items: DataFrame,
) -> dict[str, DataFrame]:
    """Fingerprints of raw lines, orders and receipts and of the dimensions' keys.

    Raw rows are hashed, so nothing is cleaned to find out that it did not change. All receipts of a
    line count together.
    """
    together = F.xxhash64(F.bit_xor("hash"), F.count(F.lit(1))).alias("hash")
    current = vendors.where("is_current_record")
    return {
        "lines": _hashed(lines, "line_id", "po_id", "item_id"),
        "orders": _hashed(orders, "po_id", "vendor_id", "department_id", F.year("po_date").alias("po_year")),
        "receipts": _hashed(receipts, "po_line_id").groupBy("po_line_id").agg(together),
        "vendors": _hashed(current.select("vendor_id", "vendor_sk"), "vendor_id"),
        "departments": _hashed(departments.select("department_id", "department_sk"), "department_id"),
        "items": _hashed(items.select("item_id", "item_sk"), "item_id"),
        "calendar": _hashed(dates.select("full_date", "date_key"), "full_date"),
    }


def differing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys that are new, gone, or have another hash."""
    was, now = old.select(key, F.col("hash").alias("_was")), new.select(key, F.col("hash").alias("_now"))
    return was.join(now, key, "full_outer").where(~F.col("_was").eqNullSafe(F.col("_now"))).select(key)


def _number(key: str) -> Column:
    return F.unix_date(key).cast("long") if key == KEYS["calendar"] else F.col(key).cast("long")


class Changes:
    """Compares two states and expands changed keys to the lines of the fact.

    ``keep`` stores rows under a name and returns them with their count, so every set of changed keys
    is found once and its size is known before it is joined.
    """

    def __init__(self, old: Mapping[str, DataFrame], new: Mapping[str, DataFrame],
                 keep: Callable[[str, DataFrame], tuple[DataFrame, int]]) -> None:
        self._old, self._new = old, new
        parts = [
            differing(old[name], new[name], key).select(F.lit(name).alias("source"), _number(key).alias("key"))
            for name, key in KEYS.items()
        ]
        found, _ = keep("changed_keys", reduce(DataFrame.unionByName, parts))
        counts = dict(found.groupBy("source").count().collect())  # one row per source
        self._found = {
            name: (found.where(F.col("source") == name).select(F.col("key").alias(key)), counts.get(name, 0))
            for name, key in KEYS.items()
        }
        orders = self._all_of("orders", ("orders", "vendors", "departments"))
        touched = keep("touched_orders", orders.distinct())
        lines = [self._all_of("lines", ("lines", "items")), self._found["receipts"][0].toDF("line_id")]
        if touched[1]:
            lines.append(among(new["lines"], *touched, "po_id").select("line_id"))
        self.lines, self.count = keep("touched_lines", reduce(DataFrame.unionByName, lines).distinct())

    def _all_of(self, source: str, by: tuple[str, ...]) -> DataFrame:
        """Keys of a source that changed, and of its rows whose other keys did."""
        key = KEYS[source]
        parts = [self._found[source][0]]
        for name in by:
            found, count = self._found[name]
            if name != source and count:
                parts.append(among(self._new[source], found, count, KEYS[name]).select(key))
        return reduce(DataFrame.unionByName, parts)

    @property
    def sources(self) -> list[str]:
        """The sources that changed."""
        return [name for name, (_, count) in self._found.items() if count]

    @property
    def everything(self) -> bool:
        """Whether the calendar is another, on which any row may depend."""
        return self._found["calendar"][1] > 0

    def years(self) -> list[int]:
        """The years of the fact that hold a touched line before or after, as many as there are years."""
        parts = []
        for state in (self._old, self._new):
            ids = state["lines"].join(self.lines, "line_id", "left_semi").select("po_id")
            parts.append(state["orders"].join(ids, "po_id", "left_semi").select("po_year"))
        return sorted(row[0] for row in parts[0].unionByName(parts[1]).distinct().collect() if row[0] is not None)


def among(rows: DataFrame, keys: DataFrame, count: int, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (or, ``left_anti``, is not) one of the changed ones.

    Few keys are sent to every task and the rows stay where they are. More meet them by key; where the
    rows lie in buckets of that key they stay too.
    """
    return rows.join(F.broadcast(keys) if count <= FEW_KEYS else keys, key, how)
