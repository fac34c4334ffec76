"""Data-quality checks. Each returns the violations; no rows means the check passed."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentpulse.functions.numeric import safe_divide


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass; also columns without any."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "violations")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return null_counts(df, columns).filter("violations > 0")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs may repeat."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their number of rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[str], severity: str = "error") -> DataFrame:
    """Values outside the domain with their number of rows; NULL is accepted."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("severity", F.lit(severity))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL foreign keys without a parent, with their number of child rows.

    Child keys are counted before the join, so a hot key is one row there.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("orphan"))
    counted = keys.agg(F.count(F.lit(1)).alias("n_rows"))
    parents = parent.select(F.col(parent_column).alias("orphan"))
    return counted.join(parents, "orphan", "left_anti")


def _one_decimal(number: Column) -> Column:
    return F.when(number.isNotNull(), F.format_string("%.1f", F.round(number, 1)))


def _filled(template: str, **values: Column) -> Column:
    """The template with each {name} replaced by a text column."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[part] if i % 2 else F.lit(part) for i, part in enumerate(parts)])


def count_reconciliation(
    mart: DataFrame, baseline: DataFrame, by: str, mart_name: str, max_pct_diff: float, message: str
) -> DataFrame:
    """Groups whose total in the mart is off the baseline by more than the tolerance.

    ``mart`` and ``baseline`` carry (by, n). A group that only one side has is a failure too. The
    message may name {fact}, {mart}, {diff} and {limit}.
    """
    sides = mart.select(by, F.col("n").alias("__mart")).join(
        baseline.select(by, F.col("n").alias("__fact")), by, "full_outer"
    )
    in_mart = F.coalesce("__mart", F.lit(0))
    in_fact = F.coalesce("__fact", F.lit(0))
    diff = safe_divide(F.abs(in_mart - in_fact), in_fact) * 100
    detail = _filled(
        message,
        fact=in_fact.cast("string"),
        mart=in_mart.cast("string"),
        diff=F.coalesce(_one_decimal(diff), F.lit("n/a")),
        limit=F.lit(f"{max_pct_diff:g}"),
    )
    failed = F.coalesce(diff > max_pct_diff, F.lit(True))
    return sides.filter(failed).select(F.lit(mart_name).alias("mart"), by, detail.alias("detail"))


def coverage_floor(mart: DataFrame, column: str, by: str, mart_name: str, min_pct: float, message: str) -> DataFrame:
    """Groups in which too few rows have a value in ``column``.

    The message may name {filled}, {all}, {pct} and {limit}.
    """
    counted = mart.groupBy(by).agg(F.count(column).alias("__filled"), F.count(F.lit(1)).alias("__all"))
    covered = safe_divide(F.col("__filled"), F.col("__all")) * 100
    detail = _filled(
        message,
        filled=F.col("__filled").cast("string"),
        all=F.col("__all").cast("string"),
        pct=_one_decimal(covered),
        limit=F.lit(f"{min_pct:g}"),
    )
    return counted.filter(covered < min_pct).select(F.lit(mart_name).alias("mart"), by, detail.alias("detail"))
