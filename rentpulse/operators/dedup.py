"""Keeping one row per key, and the latest snapshot window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentpulse.sources.scratch import materialize


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Ties are broken by a hash of the whole row, so the pick does not depend on partitioning.
    The filter sits directly on the row number: the planner then cuts every map task down to
    one row per key before the shuffle, which also defuses hot keys.
    """
    tie_break = F.xxhash64(*df.columns)
    window = Window.partitionBy(*keys).orderBy(*order, tie_break)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") == 1).drop("__rn")


def within_latest(df: DataFrame, group: str, date: str, days: int) -> DataFrame:
    """Rows dated within ``days`` of their group's latest date.

    A snapshot is collected over several days, so the exact latest date would keep a sliver.
    The distinct (group, date) pairs, which a table partitioned by them has as folders, become a small
    written table with their distance from the group's latest date. The rows are joined with the near
    pairs on equal dates, so that a partitioned table is read only where the window lies.
    """
    dates = df.select(F.col(group).alias("__group"), F.col(date).alias("__date")).filter("__date IS NOT NULL").distinct()
    newest = F.max("__date").over(Window.partitionBy("__group"))
    pairs = materialize(dates.withColumn("__age", F.datediff(newest, "__date")), "snapshots").filter(F.col("__age") <= days)
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col(date) == F.col("__date"))
    return df.join(pairs, same, "left_semi")


def newest_per_key(df: DataFrame, group: str, key: str, date: str) -> DataFrame:
    """The newest row per (group, key)."""
    return keep_first(df, [group, key], [F.col(date).desc_nulls_last()])


def latest_window(df: DataFrame, group: str, key: str, date: str, days: int) -> DataFrame:
    """The latest snapshot of every group, one row per (group, key)."""
    return newest_per_key(within_latest(df, group, date, days), group, key, date)
