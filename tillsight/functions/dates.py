"""Calendar parts as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_weekday(d: Column) -> Column:
    """1 = Monday ... 7 = Sunday (ISODOW)."""
    return (F.weekday(d) + 1).cast("int")


def iso_week(d: Column) -> Column:
    """ISO-8601 week number (PostgreSQL ``EXTRACT(WEEK)``)."""
    return F.weekofyear(d).cast("int")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")
