"""Date expressions with the boundary-counting semantics of the rental models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_date(text: str) -> Column:
    """Date from a column of ``YYYY-MM-DD`` text, NULL for anything else.

    The pattern pins the format; the cast alone would also take ``2026-7`` or a timestamp. It is
    half the cost of ``try_to_date``, which runs a date formatter.
    """
    return F.expr(f"CASE WHEN {text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' THEN try_cast({text} AS date) END")


def years_between(start: Column, end: Column) -> Column:
    """Calendar-year boundaries crossed, not completed years."""
    return F.year(end) - F.year(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def month_start(day: Column) -> Column:
    """First day of the month, as a date (``date_trunc`` would give a timestamp)."""
    return F.trunc(day, "month")
