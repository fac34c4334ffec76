"""Slowly changing dimension, type 2, with the check strategy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VALIDITY = ("valid_from", "valid_to", "is_current")


def scd2_first_load(dim: DataFrame, as_of: dt.date) -> DataFrame:
    """Every row as an open version."""
    return dim.select(
        "*",
        F.lit(as_of).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_step(
    open_versions: DataFrame,
    dim: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: dt.date,
    *,
    changes_only: bool = False,
) -> DataFrame:
    """What the open versions become when ``dim`` is seen on ``as_of``; with ``changes_only``, only the
    versions that are opened or closed.

    Changed keys close their version and open a new one, vanished keys close, new and returning
    keys open; unchanged keys keep their stored row. Only ``check_cols`` count as a change. One
    full outer join yields all cases.
    """
    attributes = dim.columns
    stored = open_versions.select(F.col(key).alias("__key"), F.struct(*open_versions.columns).alias("__old"))
    incoming = dim.select(F.col(key).alias("__key"), F.struct(*attributes).alias("__new"))

    changed = F.lit(False)
    for col in check_cols:
        changed = changed | ~F.col(f"__old.{col}").eqNullSafe(F.col(f"__new.{col}"))
    is_new = F.col("__old").isNull()
    is_gone = F.col("__new").isNull()

    def version(source: str, valid_from, valid_to, current: bool):
        return F.struct(
            *[F.col(f"{source}.{c}").alias(c) for c in attributes],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    open_end = F.lit(None).cast("date")
    kept = version("__old", F.col("__old.valid_from"), open_end, True)
    closed = version("__old", F.col("__old.valid_from"), F.lit(as_of), False)
    opened = version("__new", F.lit(as_of), open_end, True)
    versions = F.when(is_new, F.array(opened)).when(is_gone, F.array(closed)).when(changed, F.array(closed, opened))
    if not changes_only:  # else unchanged keys have no versions, and explode drops them
        versions = versions.otherwise(F.array(kept))
    return (
        stored.join(incoming, "__key", "full_outer")
        .select(F.explode(versions).alias("__version"))
        .select(*[F.col(f"__version.{c}").alias(c) for c in (*attributes, *_VALIDITY)])
    )


def scd2_apply(
    history: DataFrame, dim: DataFrame, key: str, check_cols: Sequence[str], as_of: dt.date
) -> DataFrame:
    """The whole history after seeing ``dim``: closed versions pass through untouched, so the join
    does not grow with the length of the history."""
    live = scd2_step(scd2_current(history), dim, key, check_cols, as_of)
    return history.filter(~F.col("is_current")).unionByName(live)


def scd2_from_log(log: DataFrame, key: str) -> DataFrame:
    """The history that a log of opened and closed versions tells: a closed version supersedes the row
    that once opened it."""
    closed = log.filter(F.col("valid_to").isNotNull())
    ended = closed.select(F.col(key).alias("__key"), F.col("valid_from").alias("__from"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("valid_from") == F.col("__from"))
    return log.filter(F.col("valid_to").isNull()).join(ended, same, "left_anti").unionByName(closed)


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def scd2_as_of(history: DataFrame, day: dt.date) -> DataFrame:
    """The versions that were valid on a day."""
    day_col = F.lit(day)
    return history.filter(
        (F.col("valid_from") <= day_col) & (F.col("valid_to").isNull() | (F.col("valid_to") > day_col))
    )


def scd2_changed(history: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """Closed versions beside their successor: what changed, and when."""
    before = history.filter(F.col("valid_to").isNotNull()).select(
        key, F.col("valid_to").alias("changed_on"), *[F.col(c).alias(f"old_{c}") for c in check_cols]
    )
    after = history.select(
        key, F.col("valid_from").alias("changed_on"), *[F.col(c).alias(f"new_{c}") for c in check_cols]
    )
    return before.join(after, [key, "changed_on"])
