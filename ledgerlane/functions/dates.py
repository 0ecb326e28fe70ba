"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_parts(column: str, prefix: str) -> list[Column]:
    """Year, month and ``YYYY-MM`` of a date, named ``<prefix>_year`` and so on."""
    day = F.col(column)
    return [
        F.year(day).alias(f"{prefix}_year"),
        F.month(day).alias(f"{prefix}_month"),
        year_month(day).alias(f"{prefix}_year_month"),
    ]


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days; NULL when either date is missing."""
    return F.datediff(later, earlier)
