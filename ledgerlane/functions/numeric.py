"""Exact rounding.

Averages and percentages are rounded half away from zero on the exact quotient. Spark's decimal
division keeps a limited number of digits, so rounding its result would round twice; here the
quotient is taken once, with integer division.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlane.schemas import MONEY

_WIDE = "decimal(38,0)"


def exact(column: Column) -> Column:
    """A double's shortest decimal text as a decimal, so that one rounding of it is the only one."""
    return column.cast("string").cast("decimal(38,18)")


def ratio(numerator: Column, denominator: Column, places: int, times: int = 1) -> Column:
    """``times * numerator / denominator`` to ``places`` digits; NULL unless the divisor is above 0.

    Both operands are whole numbers (long, or decimal with scale 0).
    """
    top, bottom = numerator.cast(_WIDE), denominator.cast(_WIDE)
    doubled = F.abs(top) * F.lit(2 * times * 10**places) + bottom
    units = F.call_function("div", doubled, bottom * F.lit(2))
    signed = F.when(top < 0, -units).otherwise(units).cast("decimal(20,0)")
    return F.when(bottom > 0, signed * F.lit(Decimal(1).scaleb(-places)) if places else signed)


def percent(numerator: Column, denominator: Column, places: int) -> Column:
    """Share of ``denominator`` in percent."""
    return ratio(numerator, denominator, places, times=100)


def mean(column: Column, places: int, scale: int = 0) -> Column:
    """Rounded average over a group; ``scale`` is the number of decimals ``column`` carries."""
    total = F.sum(column) * F.lit(10**scale) if scale else F.sum(column)
    return ratio(total, F.count(column) * F.lit(10**scale), places)


def in_units(total: Column, exponent: int, places: int = 2) -> Column:
    """A whole-number total in units of ``10 ** exponent`` (6: millions, 9: billions)."""
    scaled = total.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-exponent))
    return F.round(scaled, places)


def fulfilment(received: Column, ordered: Column) -> Column:
    """``received`` in percent of ``ordered`` to 2 digits, per row and in long arithmetic.

    Both are non-negative counts and ``ordered`` is above 0; callers guard that.
    """
    hundredths = F.call_function("div", received * 20000 + ordered, ordered * 2)
    return (hundredths.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


# Within these bounds a price times a quantity times ten thousand fits a long.
_SMALL_COUNT, _SMALL_PRICE = 300_000, 3_000_000_000


def _small(price: Column, count: Column) -> Column:
    return price.between(0, _SMALL_PRICE) & count.between(0, _SMALL_COUNT)


def rate_of(price: Column, count: Column, hundredths: Column) -> Column:
    """A share of ``price * count`` in hundredths of a percent, rounded half up to whole money.

    All three are longs. Everyday sizes are computed in long arithmetic, which is several times
    faster than wide decimals; anything beyond takes the decimal way. Both are exact.
    """
    units = F.call_function("div", price * count * hundredths + 5000, F.lit(10_000))
    share = hundredths.cast("decimal(10,0)") * F.lit(Decimal("0.0001"))
    wide = F.round(price.cast(MONEY) * count.cast(MONEY) * share, 0)
    everyday = _small(price, count) & hundredths.between(0, 10_000)
    return F.when(everyday, units.cast(MONEY)).otherwise(wide.cast(MONEY))


def value_of(price: Column, count: Column) -> Column:
    """A whole price times a count, in long arithmetic where that is sure to fit."""
    plain = (price.cast("long") * count).cast(MONEY)
    wide = (price * count.cast(MONEY)).cast(MONEY)
    return F.when(_small(price, count), plain).otherwise(wide)


def count_where(condition: Column) -> Column:
    """Rows of a group for which ``condition`` is true; NULL counts as false."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


# Wide whole numbers as three parts (high, middle, low) in units of 10^26, 10^13 and 1.
_LIMB = 10**13


def square(number: Column) -> tuple[Column, Column, Column]:
    """The exact square, as three parts, of a whole number below 10^26 in size."""
    size = F.abs(number.cast(_WIDE))
    high = F.call_function("div", size, F.lit(_LIMB)).cast(_WIDE)
    low = (size - high * F.lit(_LIMB)).cast(_WIDE)
    parts = high * high, high * low * F.lit(2), low * low
    return tuple(part.cast(_WIDE) for part in parts)


def _part(column: Column) -> Column:
    return column.cast(_WIDE)


def at_least(left: tuple[Column, ...], times: Column, right: tuple[Column, ...], by: Column) -> Column:
    """``times * left >= by * right`` for wide numbers, without rounding; factors are below 10^8."""
    high, middle, low = (_part(_part(a * _part(times)) - _part(b * _part(by)))
                         for a, b in zip(left, right, strict=True))

    def carry(value: Column) -> Column:  # of the part below, rounded down; the quotient is whole
        return _part((value - F.pmod(value, F.lit(_LIMB).cast(_WIDE))) / F.lit(_LIMB))

    return high + carry(middle + carry(low)) >= 0


def deviations(distance: Column, squares: tuple[Column, ...], count: Column) -> Column:
    """``distance`` in population standard deviations, in hundredths, halves up; NULL if all are alike.

    Of ``count`` values x with the sum s, ``distance`` is ``count * x - s`` of one that lies above the
    average and ``squares`` the sum of the squares of these over all of them, as three parts. No figure
    is rounded but the last: the hundredths found in doubles are off by one at most, and the right
    ones are the largest k with (2k - 1)^2 * squares <= 40000 * count * distance^2.
    """
    own = square(distance)
    wide = sum(part.cast("double") * float(_LIMB) ** power for part, power in zip(squares, (2, 1, 0), strict=True))
    near = F.floor(F.lit(100.0) * distance.cast("double") * F.sqrt(count.cast("double") / F.nullif(wide, F.lit(0.0))))
    k = F.lit(0).cast("long")
    for step in (-1, 0, 1):
        tried = F.greatest(near + step, F.lit(0)).cast("long")
        odd = tried * 2 - 1
        reached = (tried == 0) | at_least(own, count * 40_000, squares, odd * odd)
        k = F.when(reached, F.greatest(k, tried)).otherwise(k)
    return F.when(wide > 0, k)
