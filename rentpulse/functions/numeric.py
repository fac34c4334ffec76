"""NULL-aware arithmetic, shares and indices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TERM = "decimal(38,6)"


def cap(value: Column, ceiling: Column) -> Column:
    """The smaller of both; NULL if either is NULL (``least`` alone would skip NULL)."""
    return F.when(value.isNotNull() & ceiling.isNotNull(), F.least(value, ceiling))


def null_if_zero(value: Column) -> Column:
    return F.when(value != 0, value)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL for a zero denominator."""
    return numerator / null_if_zero(denominator)


def exact_sum(value: Column) -> Column:
    """Aggregate: a sum of doubles that does not depend on the order in which tasks deliver them.

    The terms are added as decimals, so a rounding boundary cannot be missed by the last bits.
    """
    return F.sum(value.cast(_TERM)).cast("double")


def exact_avg(value: Column) -> Column:
    """Aggregate: the mean of the non-NULL values, by ``exact_sum``."""
    return safe_divide(exact_sum(value), F.count(value))


def share_pct(condition: Column) -> Column:
    """Aggregate: percentage of all rows that satisfy the condition, unrounded."""
    return safe_divide(F.count_if(condition), F.count(F.lit(1))) * 100


def weighted_score(*weighted: tuple[Column, float]) -> Column:
    """Sum of (share, weight) products over unrounded shares."""
    (share, weight), *rest = weighted
    score = share * weight
    for share, weight in rest:
        score = score + share * weight
    return score
