"""Grouping a fact by attributes of its dimensions, reduced before the dimensions are met."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """A dimension, its key and the attributes wanted from it.

    ``bounded`` marks a table whose size does not grow with the data; only such a table is
    broadcast by request. For others Spark weighs the measured size.
    """

    table: DataFrame
    key: str
    attributes: Sequence[str]
    bounded: bool = False

    def columns(self) -> DataFrame:
        wanted = self.table.select(self.key, *self.attributes)
        return F.broadcast(wanted) if self.bounded else wanted


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def present(column: str) -> Column:
    return F.col(column).isNotNull().cast("int")


def hundredths(column: str) -> Column:
    """A two-decimal column as a whole number, so that its sums are long sums."""
    return (F.col(column) * 100).cast("long")


def _summed(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column],
            lows: Mapping[str, Column], highs: Mapping[str, Column], *counts: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()],
        *[F.min(column).alias(name) for name, column in lows.items()],
        *[F.max(column).alias(name) for name, column in highs.items()],
        *counts,
    )


def grouped(
    fact: DataFrame,
    own: Sequence[str],
    lookups: Sequence[Lookup],
    sums: Mapping[str, Column],
    *,
    extremes: Sequence[str] = (),
    distinct: Sequence[str] = (),
    reduce_first: bool = True,
    distinct_by_key: bool = False,
) -> DataFrame:
    """Sum ``sums`` by the fact columns ``own`` and the attributes of ``lookups``.

    The fact is first summed by the dimension keys (and the ``distinct`` columns), so the rows of
    a key that holds a large part of the fact are combined in every task before any shuffle, and
    the dimensions are joined to the reduced rows only. Then the attributes are grouped. Turn
    ``reduce_first`` off where those keys tell nearly all rows apart or the dimension is tiny.

    ``extremes`` adds ``min_<column>`` and ``max_<column>``; ``distinct`` adds ``n_<column>``, the
    exact count of distinct values. Rows whose key no dimension has are left out. With
    ``distinct_by_key`` a distinct value belongs to one set of keys alone, as an order to its
    vendor: it is then counted by key, so that one row per key meets the dimension.
    """
    lows = {f"min_{column}": F.col(column) for column in extremes}
    highs = {f"max_{column}": F.col(column) for column in extremes}
    keys = [lookup.key for lookup in lookups]
    groups = [*own, *(name for lookup in lookups for name in lookup.attributes)]
    counts = [F.countDistinct(column).alias(f"n_{column}") for column in distinct]
    if distinct_by_key:
        rows = _summed(fact, [*keys, *own], sums, lows, highs, *counts)
        sums, counts = {**sums, **{f"n_{column}": F.col(f"n_{column}") for column in distinct}}, []
    elif reduce_first:
        rows = _summed(fact, [*keys, *own, *distinct], sums, lows, highs)
    else:
        measures = {**sums, **lows, **highs}.items()
        rows = fact.select(*keys, *own, *distinct, *[c.alias(name) for name, c in measures])
    sums, lows, highs = ({name: F.col(name) for name in part} for part in (sums, lows, highs))
    for lookup in lookups:
        rows = rows.join(lookup.columns(), lookup.key)
    return _summed(rows, groups, sums, lows, highs, *counts)
