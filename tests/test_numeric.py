from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from math import isqrt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlane.functions.numeric import (
    at_least,
    deviations,
    fulfilment,
    in_units,
    mean,
    percent,
    rate_of,
    ratio,
    square,
    value_of,
)

PAIRS = st.lists(
    st.tuples(st.integers(-(10**15), 10**15), st.integers(0, 10**12)), min_size=1, max_size=200
)


def exact(number: Fraction, places: int) -> Decimal:
    """Half away from zero, on the exact fraction."""
    scaled = abs(number) * 10**places
    whole = int(scaled + Fraction(1, 2))
    return Decimal(whole if number >= 0 else -whole).scaleb(-places)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=PAIRS)
def test_ratio_is_the_exact_quotient(spark, pairs):
    rows = spark.createDataFrame(pairs, "a long, b long")
    found = rows.select("a", "b", ratio(F.col("a"), F.col("b"), 2).alias("r"),
                        percent(F.col("a"), F.col("b"), 1).alias("p")).collect()
    for a, b, r, p in found:
        if b == 0:
            assert r is None and p is None
        else:
            assert r == exact(Fraction(a, b), 2)
            assert p == exact(Fraction(100 * a, b), 1)


def test_mean_ignores_nulls_and_keeps_decimals(spark):
    rows = spark.createDataFrame([(Decimal("10.25"),), (Decimal("10.30"),), (None,)], "x decimal(18,2)")
    assert rows.agg(mean(F.col("x"), 1, scale=2)).first()[0] == Decimal("10.3")
    assert rows.filter("x IS NULL").agg(mean(F.col("x"), 1, scale=2)).first()[0] is None


def test_units_round_half_up(spark):
    rows = spark.createDataFrame([(Decimal(5_000_000),), (Decimal(4_999_999),)], "x decimal(28,0)")
    assert [r[0] for r in rows.select(in_units(F.col("x"), 9)).collect()] == [
        Decimal("0.01"), Decimal("0.00")
    ]


def test_fulfilment_rounds_to_hundredths(spark):
    rows = spark.createDataFrame([(1, 3), (2, 3), (1, 800), (0, 7)], "r long, o long")
    assert [r[0] for r in rows.select(fulfilment(F.col("r"), F.col("o"))).collect()] == [
        Decimal("33.33"), Decimal("66.67"), Decimal("0.13"), Decimal("0.00")
    ]


def test_rate_agrees_with_decimals_on_both_sides_of_the_fast_path(spark):
    cases = [
        (10, 1, 500), (7, 1, 9500), (3_000_000_000, 300_000, 9_999), (3_000_000_001, 300_001, 1_234),
        (10**12, 10**5, 3_333), (1, 1, 5_000),
    ]
    rows = spark.createDataFrame(cases, "p long, q long, h long")
    columns = (F.col("p"), F.col("q"), F.col("h"))
    for p, q, h, got in rows.select("*", rate_of(*columns).alias("got")).collect():
        want = (Decimal(p) * q * h / 10_000).quantize(Decimal(1), ROUND_HALF_UP)
        assert got == want


def test_value_is_exact_beyond_the_fast_path(spark):
    rows = spark.createDataFrame([(Decimal(10**12), 999_999), (Decimal(5), 3)], "p decimal(18,0), q long")
    assert [r[0] for r in rows.select(value_of(F.col("p"), F.col("q"))).collect()] == [
        Decimal(10**12 * 999_999), Decimal(15)
    ]


SERIES = st.lists(
    st.lists(st.one_of(st.integers(0, 50), st.integers(10**21, 10**21 + 9), st.integers(0, 10**22)),
             min_size=1, max_size=40),
    min_size=1, max_size=20,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series=SERIES)
def test_deviations_are_rounded_once(spark, series):
    """Against whole numbers of any size: z = d * sqrt(n / squares), also where doubles cannot tell."""
    given = [(g, i, Decimal(x)) for g, xs in enumerate([*series, [0, 0, 0, 0, 5], [3, 3]]) for i, x in enumerate(xs)]
    rows = spark.createDataFrame(given, "g int, i int, x decimal(28,0)")
    own = Window.partitionBy("g")
    rows = rows.withColumns({"n": F.count("i").over(own), "s": F.sum("x").over(own)})
    rows = rows.withColumn("d", F.col("x").cast("decimal(38,0)") * F.col("n") - F.col("s"))
    squares = tuple(F.sum(part).over(own) for part in square(F.col("d")))
    found = rows.withColumn("k", deviations(F.col("d"), squares, F.col("n"))).withColumn(
        "two", at_least(square(F.col("d")), F.col("n"), squares, F.lit(4))
    ).collect()
    for g in {row.g for row in found}:
        own_rows = [row for row in found if row.g == g]
        xs = [int(row.x) for row in own_rows]
        n, wide = len(xs), sum((len(xs) * x - sum(xs)) ** 2 for x in xs)
        for row in own_rows:
            d = n * int(row.x) - sum(xs)
            assert row.two == (n * d * d >= 4 * wide)
            if wide and d > 0:
                assert row.k == (isqrt(40_000 * n * d * d // wide) + 1) // 2
            elif not wide:
                assert row.k is None
