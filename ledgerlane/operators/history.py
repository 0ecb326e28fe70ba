"""Versioned (slowly changing type 2) tables: applying a load and looking up a past version."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.operators.dimensions import surrogate_key

# Attributes whose change opens a new vendor version.
TRACKED_VENDOR_COLUMNS = ("vendor_name", "city", "province", "payment_terms")

#: The days of the loads that found a version's values, kept with the stored history so that a load of
#: an earlier day can be put in its place.
SEEN_ON = "seen_on"


def _differs(tracked: Sequence[str]) -> Column:
    changed = F.lit(False)
    for name in tracked:
        changed = changed | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    return changed


def apply_changes(
    versions: DataFrame,
    incoming: DataFrame,
    load_date: date,
    *,
    key: str = "vendor_id",
    surrogate: str = "vendor_sk",
    tracked: Sequence[str] = TRACKED_VENDOR_COLUMNS,
) -> DataFrame:
    """Bring a versioned table up to date with one load of its source.

    A changed key has its open version closed the day before ``load_date`` and a new one opened on
    it; a new key opens its first version; an unchanged or vanished key keeps its version. Closed
    versions pass through untouched, outside the join. A second change on the day the open version
    began replaces that version in place, so a load can be run again with other values.

    Running the result fails if a key of the load has an open version that began after
    ``load_date`` (``apply_load`` takes such loads), or if rows of the load share a key and differ;
    equal ones count once. A column ``seen_on`` of the versions is kept up to date.
    """
    columns = versions.columns
    closed = versions.filter("NOT is_current_record")
    old = versions.filter("is_current_record").alias("old")
    new = _one_row_per_key(incoming, key).alias("new")
    known, arrived = F.col(f"old.{key}").isNotNull(), F.col(f"new.{key}").isNotNull()
    began, day = F.col("old.dbt_valid_from"), F.lit(load_date)
    changed = known & arrived & _differs(tracked)

    paired = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    marked = paired.withColumns({"_changed": changed, "_new": ~known, "_again": changed & (began == day)})

    version = F.coalesce(F.col("old.record_version"), F.lit(0))
    fresh = {
        "dbt_valid_from": day,
        "dbt_valid_to": F.lit(None).cast("date"),
        "is_current_record": F.lit(True),
        "record_version": version + F.when(F.col("_again"), 0).otherwise(1),
        surrogate: surrogate_key(F.col(f"new.{key}"), day),
        SEEN_ON: F.array(day),
    }
    confirmed = arrived & ~F.col("_changed")
    ended = {
        SEEN_ON: F.when(confirmed, F.array_union(f"old.{SEEN_ON}", F.array(day))).otherwise(F.col(f"old.{SEEN_ON}"))
        if SEEN_ON in columns else None,
        "dbt_valid_to": F.when(F.col("_changed"), F.date_sub(day, 1)).otherwise(F.col("old.dbt_valid_to")),
        "is_current_record": ~F.col("_changed"),
    }
    keep = F.struct(*[ended.get(c, F.col(f"old.{c}")).alias(c) for c in columns])
    opened = F.struct(*[fresh.get(c, F.col(f"new.{c}")).alias(c) for c in columns])
    late = F.concat(F.lit("load of "), day.cast("string"), F.lit(" is older than an open version of key "),
                    F.col(f"new.{key}").cast("string"))
    # one joined row yields its kept version, its new version, or both
    rows = (
        F.when(known & arrived & (began > day), F.array(keep, F.raise_error(late).cast(_type_of(keep, marked))))
        .when(F.col("_new") | F.col("_again"), F.array(opened))
        .when(F.col("_changed"), F.array(keep, opened))
        .otherwise(F.array(keep))
    )
    merged = marked.select(F.explode(rows).alias("version")).select("version.*")
    return closed.unionByName(merged)


def _type_of(column: Column, rows: DataFrame):
    return rows.select(column.alias("c")).schema["c"].dataType


def _one_row_per_key(incoming: DataFrame, key: str) -> DataFrame:
    """Equal rows once; an error when rows of one key differ."""
    whole = F.struct(*incoming.columns)
    grouped = incoming.groupBy(F.col(key).alias("_key")).agg(F.min(whole).alias("_low"), F.max(whole).alias("_high"))
    twice = F.concat(F.lit("several rows in one load for key "), F.col("_key").cast("string"))
    kind = grouped.schema["_low"].dataType
    only = F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(F.raise_error(twice).cast(kind))
    return grouped.select(only.alias("_row")).select("_row.*")


def observed(versions: DataFrame) -> DataFrame:
    """Versions with ``seen_on``: the day a version began, where nothing else is known."""
    if SEEN_ON in versions.columns:
        return versions
    return versions.withColumn(SEEN_ON, F.array("dbt_valid_from"))


def seen(versions: DataFrame, incoming: DataFrame, day: date, *, key: str = "vendor_id") -> DataFrame:
    """Mark the open versions of the keys of a first load as seen on its day, if they began before it."""
    keys = incoming.select(F.col(key).alias("_key")).distinct()
    joined = versions.join(keys, F.col(key) == F.col("_key"), "left")
    marked = F.col("is_current_record") & F.col("_key").isNotNull() & (F.col("dbt_valid_from") < F.lit(day))
    days = F.when(marked, F.array_union(SEEN_ON, F.array(F.lit(day)))).otherwise(F.col(SEEN_ON))
    return joined.select(*[days.alias(c) if c == SEEN_ON else F.col(c) for c in versions.columns])


def apply_load(
    versions: DataFrame,
    incoming: DataFrame,
    load_date: date,
    *,
    key: str = "vendor_id",
    surrogate: str = "vendor_sk",
    tracked: Sequence[str] = TRACKED_VENDOR_COLUMNS,
) -> DataFrame:
    """Apply a load of any day, also one that arrives after loads of later days.

    A key seen on no later day is brought up to date as by ``apply_changes``. The history of the other
    keys of the load, and of no others, is spliced: the version that covers ``load_date`` ends before
    it and goes on from the next day on which its values were seen, neighbours of equal values become
    one version, and numbers and keys follow. So loads in any order give one history; of two loads of a
    day the one applied last counts. Columns that are not tracked are those of the first row seen of a
    version, or of the version it was split off.
    """
    versions = observed(versions)
    arrived = incoming.select(key).distinct()
    last = versions.join(arrived, key, "left_semi").groupBy(key).agg(F.max(F.array_max(SEEN_ON)).alias("_last"))
    late = last.where(F.col("_last") > F.lit(load_date)).select(key)
    kinds = {"key": key, "surrogate": surrogate, "tracked": tracked}
    prompt = apply_changes(
        versions.join(late, key, "left_anti"), incoming.join(late, key, "left_anti"), load_date, **kinds
    )
    spliced = _spliced(
        versions.join(late, key, "left_semi"), incoming.join(late, key, "left_semi"), load_date, **kinds
    )
    return prompt.unionByName(spliced)


def _spliced(
    versions: DataFrame, incoming: DataFrame, load_date: date, *, key: str, surrogate: str, tracked: Sequence[str]
) -> DataFrame:
    """Fold the days on which values were seen, with those of the load, into versions again."""
    day = F.lit(load_date)
    made = {
        "dbt_valid_from": day, "dbt_valid_to": F.lit(None).cast("date"), "is_current_record": F.lit(True),
        "record_version": F.lit(0), surrogate: surrogate_key(F.col(key), day), SEEN_ON: F.array(day),
    }
    load = _one_row_per_key(incoming, key)
    load = load.select(*[made.get(c, F.col(c) if c in load.columns else F.lit(None)).alias(c) for c in versions.columns])
    seen = versions.select("*", F.explode(SEEN_ON).alias("_day"), F.lit(0).alias("_newer")).unionByName(
        load.select("*", day.alias("_day"), F.lit(1).alias("_newer"))
    )
    # what a load of the same day found before counts no more
    once = seen.withColumn("_place", F.row_number().over(Window.partitionBy(key, "_day").orderBy(F.desc("_newer"))))
    by_day = Window.partitionBy(key).orderBy("_day")
    values = F.struct(*tracked)
    began = F.coalesce(~F.lag(values).over(by_day).eqNullSafe(values), F.lit(True))
    parts = once.where("_place = 1").withColumn("_began", began).withColumn("_number", F.sum(F.col("_began").cast("int")).over(by_day))
    folded = parts.groupBy(key, "_number").agg(
        F.min_by(F.struct(*versions.columns), "_day").alias("_row"), F.min("_day").alias("_from"),
        F.array_sort(F.collect_list("_day")).alias("_days"),  # no more than there are days of loads
    )
    following = F.lead("_from").over(Window.partitionBy(key).orderBy("_from"))
    placed = folded.withColumn("_next", following)
    fresh = {
        "dbt_valid_from": F.col("_from"), "dbt_valid_to": F.date_sub("_next", 1), "is_current_record": F.col("_next").isNull(),
        "record_version": F.col("_number"), surrogate: surrogate_key(F.col(key), F.col("_from")), SEEN_ON: F.col("_days"),
    }
    kinds = dict(versions.dtypes)
    return placed.select(*[fresh.get(c, F.col(f"_row.{c}")).cast(kinds[c]).alias(c) for c in versions.columns])


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    day: str,
    *,
    key: str = "vendor_id",
    attributes: Sequence[str] = ("vendor_sk", "record_version"),
) -> DataFrame:
    """Attach the version that was valid on ``day``; NULL when none was. Versions do not overlap.

    The distinct days asked for are sorted in with the beginnings of the versions, and the last version
    is carried forward, so a day costs the same whether its key has one version or thousands. Facts then
    meet their day by key and day: a key that holds a third of them is dealt out over its days, and the
    facts themselves are never sorted together with the versions.
    """
    asked = facts.select(F.col(key).alias("_key"), F.col(day).alias("_day")).where(
        "_key IS NOT NULL AND _day IS NOT NULL"
    ).distinct()
    version = F.struct("dbt_valid_to", *attributes)
    begun = versions.select(F.col(key).alias("_key"), F.col("dbt_valid_from").alias("_day"), version.alias("_version"))
    both = begun.withColumn("_asked", F.lit(False)).unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    so_far = Window.partitionBy("_key").orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).where("_asked")
    ended = F.col("_version.dbt_valid_to")
    found = carried.where(ended.isNull() | (F.col("_day") <= ended)).select("_key", "_day", *[f"_version.{c}" for c in attributes])
    fact, found = facts.alias("fact"), found.alias("found")
    same = (F.col(f"fact.{key}") == F.col("found._key")) & (F.col(f"fact.{day}") == F.col("found._day"))
    return fact.join(found, same, "left").select("fact.*", *[f"found.{name}" for name in attributes])
