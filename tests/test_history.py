from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlane.operators import dimensions, staging
from ledgerlane.operators.history import SEEN_ON, apply_changes, apply_load, as_of

LOAD = date(2024, 7, 1)


@pytest.fixture()
def loaded(raw):
    before = staging.vendors(raw(
        "vendors",
        dict(vendor_id=1, city="Bandung"), dict(vendor_id=2, city=None), dict(vendor_id=3),
        dict(vendor_id=4, payment_terms="COD"), dict(vendor_id=5, address="lama"),
    ))
    after = staging.vendors(raw(
        "vendors",
        dict(vendor_id=1, city="Medan"), dict(vendor_id=2, city=None),
        dict(vendor_id=4, payment_terms=None), dict(vendor_id=5, address="baru"), dict(vendor_id=6),
    ))
    merged = apply_changes(dimensions.vendors(before), after, LOAD)
    rows = {}
    for row in merged.orderBy("vendor_id", "record_version").collect():
        rows.setdefault(row.vendor_id, []).append(row)
    return rows


def test_changed_vendor_gets_a_new_version(loaded):
    old, new = loaded[1]
    assert (old.city, old.dbt_valid_to, old.is_current_record) == ("Bandung", date(2024, 6, 30), False)
    assert (new.city, new.dbt_valid_from, new.dbt_valid_to) == ("Medan", LOAD, None)
    assert (new.record_version, new.is_current_record) == (2, True)
    assert old.vendor_sk != new.vendor_sk


def test_a_value_that_vanishes_is_a_change(loaded):
    old, new = loaded[4]
    assert (old.payment_terms, new.payment_terms) == ("COD", None)


def test_equal_missing_values_and_untracked_columns_are_no_change(loaded):
    assert len(loaded[2]) == 1 and len(loaded[5]) == 1
    assert loaded[5][0].address == "lama"


def test_closed_and_vanished_versions_stay(loaded):
    assert [row.is_current_record for row in loaded[3]] == [False, True]
    assert loaded[3][1].dbt_valid_to is None


def test_new_vendor_opens_its_first_version(loaded):
    (only,) = loaded[6]
    assert (only.record_version, only.dbt_valid_from, only.is_current_record) == (1, LOAD, True)


def test_applying_the_same_load_twice_changes_nothing(raw):
    staged = staging.vendors(raw("vendors", dict(vendor_id=1), dict(vendor_id=3)))
    versions = dimensions.vendors(staged)
    again = apply_changes(versions, staged, LOAD)
    assert again.exceptAll(versions).count() == versions.exceptAll(again).count() == 0


def test_as_of_finds_the_version_of_the_day(spark, raw):
    versions = dimensions.vendors(staging.vendors(raw("vendors", dict(vendor_id=3))))
    days = [date(2019, 12, 31), date(2020, 1, 1), date(2021, 12, 31), date(2022, 1, 1)]
    facts = spark.createDataFrame([(3, day) for day in days] + [(9, days[0])], "vendor_id long, day date")
    found = as_of(facts, versions, "day").orderBy("vendor_id", "day").collect()
    assert [row.record_version for row in found] == [None, 1, 1, 2, None]


def staged(raw, *rows):
    return staging.vendors(raw("vendors", *rows))


def test_a_second_load_of_the_same_day_replaces_the_first(raw):
    base = dimensions.vendors(staged(raw, dict(vendor_id=1, city="A"), dict(vendor_id=2, city="A")))
    once = apply_changes(base, staged(raw, dict(vendor_id=1, city="B"), dict(vendor_id=5, city="X")), LOAD)
    twice = apply_changes(once, staged(raw, dict(vendor_id=1, city="C"), dict(vendor_id=5, city="Y")), LOAD)
    rows = {(r.vendor_id, r.record_version): r for r in twice.collect()}
    assert (rows[1, 2].city, rows[1, 2].dbt_valid_from, rows[1, 2].is_current_record) == ("C", LOAD, True)
    assert rows[1, 1].dbt_valid_to == date(2024, 6, 30) and rows[5, 1].city == "Y"
    assert len(rows) == 4 == len({r.vendor_sk for r in rows.values()})


def test_an_earlier_load_is_refused(raw):
    base = dimensions.vendors(staged(raw, dict(vendor_id=1, city="A")))
    after = apply_changes(base, staged(raw, dict(vendor_id=1, city="B")), LOAD)
    with pytest.raises(Exception, match="older than an open version of key 1"):
        apply_changes(after, staged(raw, dict(vendor_id=1, city="C")), date(2019, 1, 1)).collect()


def test_rows_of_one_key(raw):
    base = dimensions.vendors(staged(raw, dict(vendor_id=1, city="A")))
    same = staged(raw, dict(vendor_id=1, city="B"), dict(vendor_id=1, city="B"))
    assert apply_changes(base, same, LOAD).count() == 2
    with pytest.raises(Exception, match="several rows in one load for key 1"):
        apply_changes(base, staged(raw, dict(vendor_id=1, city="B"), dict(vendor_id=1, city="C")), LOAD).collect()


@given(st.lists(st.tuples(st.integers(0, 3), st.lists(st.tuples(st.integers(1, 3), st.sampled_from("ABC")), max_size=4)),
                min_size=1, max_size=4))
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_versions_of_any_loads(raw, loads):
    """Keys are unique, intervals do not overlap, and each vendor has one open version."""
    versions, day = dimensions.vendors(staged(raw, dict(vendor_id=1), dict(vendor_id=2))), LOAD
    for days, cities in loads:
        day += timedelta(days=days)
        rows = [dict(vendor_id=k, city=c) for k, c in dict(cities).items()]
        if rows:
            versions = apply_changes(versions, staged(raw, *rows), day)
    found = versions.collect()
    assert len({r.vendor_sk for r in found}) == len(found)
    for vendor in {r.vendor_id for r in found}:
        own = sorted((r for r in found if r.vendor_id == vendor), key=lambda r: r.record_version)
        assert [r.is_current_record for r in own] == [False] * (len(own) - 1) + [True]
        assert own[-1].dbt_valid_to is None
        for a, b in zip(own, own[1:]):
            assert a.dbt_valid_from <= a.dbt_valid_to < b.dbt_valid_from


def plain(versions):
    return sorted(tuple(r) for r in versions.drop(SEEN_ON).select(
        "vendor_id", "record_version", "dbt_valid_from", "dbt_valid_to", "is_current_record", "city", "vendor_sk").collect())


@given(st.permutations(range(4)), st.lists(
    st.lists(st.tuples(st.integers(1, 3), st.sampled_from("AB")), max_size=4), min_size=4, max_size=4))
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
def test_loads_in_any_order_give_one_history(raw, order, loads):
    base = dimensions.vendors(staged(raw, dict(vendor_id=1), dict(vendor_id=2)))
    rows = [[dict(vendor_id=k, city=c) for k, c in dict(cities).items()] for cities in loads]

    def after(numbers):
        versions = base
        for k in numbers:
            if rows[k]:
                after_load = apply_load(versions, staged(raw, *rows[k]), LOAD + timedelta(days=k))
                versions = after_load.sparkSession.createDataFrame(after_load.collect(), after_load.schema)
        return plain(versions)

    assert after(order) == after(range(4))


def test_a_late_load_splits_the_version_that_covers_it(raw):
    """Seen before and after the late load, the old values come back on the day they were seen again."""
    versions = dimensions.vendors(staged(raw, dict(vendor_id=1, city="A"), dict(vendor_id=2, city="A")))
    versions = apply_load(versions, staged(raw, dict(vendor_id=1, city="A"), dict(vendor_id=2, city="A")), LOAD + timedelta(days=9))
    late = apply_load(versions, staged(raw, dict(vendor_id=1, city="B")), LOAD)
    rows = {r.vendor_id: [] for r in late.collect()}
    for r in late.orderBy("dbt_valid_from").collect():
        rows[r.vendor_id].append((r.city, r.record_version, r.dbt_valid_from, r.dbt_valid_to))
    began = rows[2][0][2]
    assert rows[2] == [("A", 1, began, None)]
    assert rows[1] == [
        ("A", 1, began, LOAD - timedelta(days=1)), ("B", 2, LOAD, LOAD + timedelta(days=8)), ("A", 3, LOAD + timedelta(days=9), None),
    ]


def test_a_thousand_versions_of_a_vendor_with_a_third_of_the_rows(spark):
    """The same versions as from comparing each row with all of them, without comparing."""
    first = date(2020, 1, 1)
    versions = spark.createDataFrame(
        [(1, k, first + timedelta(days=3 * k), first + timedelta(days=3 * k + 1 + k % 2), f"v{k}") for k in range(1000)]
        + [(v, 1, first, None, f"w{v}") for v in range(2, 50)] + [(60, 1, first + timedelta(days=5), None, "late")],
        "vendor_id long, record_version int, dbt_valid_from date, dbt_valid_to date, vendor_sk string",
    )
    facts = spark.createDataFrame(
        [(k, 1 if k % 3 == 0 else k % 64, first + timedelta(days=k * 7 % 3100 - 5)) for k in range(6000)]
        + [(-1, None, first), (-2, 1, None), (-3, 1, first), (-3, 1, first)],
        "id long, vendor_id long, day date",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = as_of(facts, versions, "day")
        assert found._jdf.queryExecution().optimizedPlan().toString().count(" Join ") == 1
        want = facts.alias("f").join(versions.alias("v"), F.expr(
            "f.vendor_id = v.vendor_id AND day >= dbt_valid_from AND (dbt_valid_to IS NULL OR day <= dbt_valid_to)"), "left")
        want = want.select("f.*", "v.vendor_sk", "v.record_version")
        got, expected = (sorted(map(tuple, rows.collect()), key=str) for rows in (found, want))
        assert got == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
