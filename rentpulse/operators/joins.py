"""Joins that stay spread when keys are missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "__spread"


def left_join_known(df: DataFrame, right: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Left join on ``keys`` in which rows with a NULL key, which match nothing, are dealt by ``by``.

    In a plain shuffled join all of them meet in one task. Both sides carry a further key: nought for
    rows that may match, a hash of ``by`` for the others. The right side's is computed from its keys, or
    the planner would see a constant and drop it from the keys.
    """
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    dealt = df.withColumn(_SPREAD, F.when(missing, F.xxhash64(by)).otherwise(F.lit(0).cast("bigint")))
    known = right.withColumn(_SPREAD, F.xxhash64(*keys) * 0)
    return dealt.join(known, [*keys, _SPREAD], "left").drop(_SPREAD)
