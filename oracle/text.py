"""Small SQL fragments shared by the expected results."""

from __future__ import annotations


def ratio(top: str, bottom: str, places: int, times: int = 1) -> str:
    """``times * top / bottom`` rounded half away from zero, in whole numbers, as DOUBLE."""
    top, bottom = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    units = f"sign({top}) * ((2 * abs({top}) * {times * 10**places} + {bottom}) // (2 * {bottom}))"
    return f"(CASE WHEN {bottom} > 0 THEN CAST({units} AS DOUBLE) / {float(10**places)} END)"


def percent(top: str, bottom: str, places: int) -> str:
    return ratio(top, bottom, places, times=100)


def mean(column: str, places: int, scale: int = 0) -> str:
    """Rounded average of a group; a column with ``scale`` decimals enters as whole units."""
    whole = column if not scale else f"CAST(round({column} * {10**scale}) AS BIGINT)"
    return ratio(f"sum({whole})", f"count({column}) * {10**scale}", places)


def units(total: str, exponent: int, places: int = 2) -> str:
    return ratio(total, str(10**exponent), places)


def typed(columns: str) -> str:
    """``name:kind`` pairs to a select list.

    Kinds are i (BIGINT), d (DOUBLE), s (VARCHAR), b (BOOLEAN) and t (DATE).
    """
    kinds = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN", "t": "DATE"}
    pairs = (pair.split(":") for pair in columns.split())
    return ", ".join(f"CAST({name} AS {kinds[kind]}) AS {name}" for name, kind in pairs)


def pick(index: str, *labels: str | None) -> str:
    listed = ", ".join("NULL" if label is None else "'" + str(label) + "'" for label in labels)
    return f"list_extract([{listed}], CAST({index} AS BIGINT) + 1)"


def zero_filled(number: str, width: int) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"lpad({digits}, CAST(greatest(length({digits}), {width}) AS INTEGER), '0')"
