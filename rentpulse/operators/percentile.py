"""Exact grouped percentiles whose work is spread over tasks even for one huge group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentpulse.sources.scratch import materialize

_BINS_PER_DOUBLING = 512
_SLICES = 4096
# Distinct values that are ordered together; a cell with more is cut into slices first.
CELL_VALUES = 200_000


def _log_bin(value: Column) -> Column:
    """Order-preserving coarse bin: about 0.14 % of the value wide, symmetric around zero."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) / math.log(2) * _BINS_PER_DOUBLING)).cast("int")


def _cells(values: DataFrame, cell: list[str]) -> DataFrame:
    """Rows, distinct values and bounds of each cell."""
    return values.groupBy(*cell).agg(
        F.sum("__n").alias("__n"),
        F.count(F.lit(1)).alias("__values"),
        F.min("__value").alias("__from"),
        F.max("__value").alias("__to"),
    )


def _holding_ranks(cells: DataFrame, within: list[str], inner: str) -> DataFrame:
    """The cells that hold one of the two wanted ranks, with the row count before them, as a written table."""
    order = Window.partitionBy(*within).orderBy(inner)
    upto = F.col("__before") + F.sum("__n").over(order)
    counted = cells.withColumn("__upto", upto)
    held = (F.col("__upto") > F.col("__lo_rank")) & (F.col("__upto") - F.col("__n") <= F.col("__hi_rank"))
    return materialize(counted.filter(held).withColumn("__before", F.col("__upto") - F.col("__n")).drop("__upto"), "cells")


def group_percentile(df: DataFrame, keys: Sequence[str], value: str, p: float, out: str) -> DataFrame:
    """Interpolated percentile (``PERCENTILE_CONT``) of ``value`` per group, NULLs ignored.

    One row per group that has a value; NULL keys form a group of their own.

    1. Equal values are counted with a map-side combine: the one shuffle of the values, spread by
       group and value, into a written table.
    2. Bin counts (a bounded number per group) locate the one or two bins with the wanted ranks. A
       bin that is counted to hold more than CELL_VALUES distinct values is cut into slices, and the
       slices with the wanted ranks likewise, until all fit.
    3. Only the values of those cells are ordered.

    The located cells are a small written table, so the values are joined with them where they lie
    (or shuffled, if there are too many groups for that), and no task holds a whole group.
    """
    group = F.struct(*[F.col(k) for k in keys]).alias("__group")
    counts = (
        df.filter(F.col(value).isNotNull())
        .select(group, F.col(value).cast("double").alias("__value"))
        .groupBy("__group", "__value")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    located = materialize(counts, "value_counts").withColumn("__cell0", _log_bin(F.col("__value")))
    cell = ["__group", "__cell0"]
    rank = (F.sum("__n").over(Window.partitionBy("__group")) - 1) * F.lit(p)
    ranked = (
        _cells(located, cell)
        .withColumn("__rank", rank)
        .withColumn("__lo_rank", F.floor("__rank"))
        .withColumn("__hi_rank", F.ceil("__rank"))
        .withColumn("__fraction", F.col("__rank") - F.floor("__rank"))
        .withColumn("__before", F.lit(0).cast("bigint"))
        .drop("__rank")
    )
    found = _holding_ranks(ranked, ["__group"], "__cell0")
    carried = ["__lo_rank", "__hi_rank", "__fraction", "__before", "__from", "__to"]

    def inside(values: DataFrame) -> DataFrame:
        return values.join(found.select(*cell, *carried), cell)

    located = inside(located)
    while (found.agg(F.max("__values")).first()[0] or 0) > CELL_VALUES:
        width = F.greatest(F.col("__to") - F.col("__from"), F.lit(5e-324))
        part = F.least(F.floor((F.col("__value") - F.col("__from")) / width * _SLICES), F.lit(_SLICES - 1)).cast("int")
        inner = f"__cell{len(cell) - 1}"
        sliced = located.withColumn(inner, part)
        bounds = ["__lo_rank", "__hi_rank", "__fraction", "__before"]
        ranks = sliced.groupBy(*cell).agg(*[F.first(c).alias(c) for c in bounds])
        parts = _cells(sliced, [*cell, inner]).join(ranks, cell)
        found = _holding_ranks(parts, cell, inner)
        cell = [*cell, inner]
        located = inside(sliced.drop(*carried))

    in_cell = Window.partitionBy(*cell).orderBy("__value")
    upto = F.col("__before") + F.sum("__n").over(in_cell)
    return (
        located.withColumn("__upto", upto)
        .groupBy("__group")
        .agg(
            F.min(F.when(F.col("__upto") > F.col("__lo_rank"), F.col("__value"))).alias("__low"),
            F.min(F.when(F.col("__upto") > F.col("__hi_rank"), F.col("__value"))).alias("__high"),
            F.max("__fraction").alias("__fraction"),
        )
        .select(
            *[F.col(f"__group.{k}").alias(k) for k in keys],
            (F.col("__low") * (1 - F.col("__fraction")) + F.col("__high") * F.col("__fraction")).alias(out),
        )
    )


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return group_percentile(df, keys, value, 0.5, out)
