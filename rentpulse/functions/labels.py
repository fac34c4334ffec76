"""Display labels and number formatting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mapped_label(key: Column, labels: Mapping[str, str]) -> Column:
    """Label of a key; title case for keys without one."""
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.initcap(key))


def join_labels(df: DataFrame, labels: DataFrame, key: str, out: str) -> DataFrame:
    """As ``mapped_label``, with the labels (columns ``key`` and ``label``) as a table.

    The labels come from a written table, whose size is known: the planner sends a small one to every
    task and joins a large one by a shuffle, splitting skewed keys. Rows with a NULL key have no label
    and stay out of the join, so they do not gather in one task. A key has one label, its least.
    """
    one = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("label").alias("__label"))
    keyed = df.filter(F.col(key).isNotNull()).join(one, key, "left")
    named = keyed.withColumn(out, F.coalesce("__label", F.initcap(key))).select(*df.columns, out)
    return named.unionByName(df.filter(F.col(key).isNull()).withColumn(out, F.lit(None).cast("string")))


def format_count(number: Column) -> Column:
    """1234567 to ``1,234,567``."""
    return F.format_number(number, 0)


def format_pct(number: Column) -> Column:
    """12.34 to ``12.3%``."""
    return F.concat(F.format_number(number, 1), F.lit("%"))


def format_money(number: Column) -> Column:
    """1234.5 to ``$1,234``."""
    return F.concat(F.lit("$"), F.format_number(number, 0))
