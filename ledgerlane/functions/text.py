"""Text and document-number helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_filled(column: str) -> Column:
    """True when the text is present and not blank."""
    return F.trim(F.col(column)) != ""


def trimmed(*columns: str) -> list[Column]:
    return [F.trim(F.col(column)).alias(column) for column in columns]


def blank_to_null(column: str) -> Column:
    return F.nullif(F.trim(F.col(column)), F.lit("")).alias(column)


def is_status(column: Column, *labels: str) -> Column:
    """True when the text is one of ``labels``; a missing status is false, not unknown."""
    return F.coalesce(column.isin(*labels), F.lit(False))


def zero_filled(number: Column, width: int) -> Column:
    """Digits padded with zeros to at least ``width``; longer numbers are never cut."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def document_number(prefix: str, day: Column, number: Column, width: int) -> Column:
    """``PREFIX-YYYYMM-000nn``."""
    return F.concat(F.lit(f"{prefix}-"), F.date_format(day, "yyyyMM"), F.lit("-"),
                    zero_filled(number, width))


def replace_first(column: Column, pattern: str, replacement: str) -> Column:
    """Replace only the first match; Spark's own ``regexp_replace`` replaces all of them."""
    return F.regexp_replace(column, rf"(?s)^(.*?)(?:{pattern})", f"$1{replacement}")


def pick(index: Column, labels: Sequence[str | None]) -> Column:
    """The label at a 0-based position."""
    return F.element_at(F.array(*[F.lit(label) for label in labels]), (index + 1).cast("int"))


def packed_key(text: Column) -> Column:
    """Text as bytes: hexadecimal digits, as of surrogate keys, two in a byte. A byte in front tells which,
    so different texts stay different."""
    digits = F.unhex(text)
    return F.when(F.lower(F.hex(digits)) == text, F.concat(F.lit(b"\x01"), digits)).otherwise(
        F.concat(F.lit(b"\x00"), text.cast("binary"))
    )


def unpacked_key(packed: Column) -> Column:
    """The text that ``packed_key`` was given."""
    rest = F.substring(packed, 2, 2**31 - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def label_code(text: Column, labels: Sequence[str]) -> tuple[Column, Column]:
    """A label's place among ``labels``, from 1, and any other text; one of the two is missing or both."""
    place = F.nullif(F.array_position(F.array(*[F.lit(label) for label in labels]), text), F.lit(0))
    return place.cast("tinyint"), F.when(place.isNull(), text)


def coded_label(place: Column, other: Column, labels: Sequence[str]) -> Column:
    """The text that ``label_code`` was given."""
    return F.coalesce(F.get(F.array(*[F.lit(label) for label in labels]), place - F.lit(1)), other)
