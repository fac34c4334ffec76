"""Capping outliers at a percentile of their group, without dropping rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentpulse.functions.numeric import cap
from rentpulse.operators.percentile import group_percentile
from rentpulse.sources.scratch import materialize


def group_caps(df: DataFrame, by: Sequence[str], value: str, p: float, out: str) -> DataFrame:
    """The cap per group as a small written table."""
    return materialize(group_percentile(df, by, value, p, out), "caps")


def apply_caps(df: DataFrame, caps: DataFrame, by: Sequence[str], value: str, ceiling: str, out: str) -> DataFrame:
    """Cap ``value``; rows without a value or whose group has no cap get NULL."""
    joined = df.join(caps, list(by), "left")
    return joined.withColumn(out, cap(F.col(value), F.col(ceiling))).drop(ceiling)


def winsorize(df: DataFrame, value: str, by: Sequence[str], p: float, out: str) -> DataFrame:
    """Add ``out``: ``value`` capped at the p-th percentile of its group."""
    caps = group_caps(df, by, value, p, "__cap")
    return apply_caps(df, caps, by, value, "__cap", out)
