"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_parts(day: Column) -> dict[str, Column]:
    """Year, month, day, weekday (Monday = 0) and ISO week."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.weekday(day),
        "week_of_year": F.weekofyear(day),
    }


def first_of(unit: str, day: Column) -> Column:
    """First day of the natural week or month."""
    return F.trunc(day, unit)


def days_from(day: Column, count: int) -> Column:
    """Array of ``count`` consecutive days starting at ``day``."""
    return F.sequence(day, F.date_add(day, count - 1))
