"""Comparing the members of groups with one another, however large a group is."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROWS_AT_ONCE = 4000


def paired_blocks(rows: DataFrame, key: str, member: str, block_rows: int) -> DataFrame:
    """Rows of groups with two members or more, dealt so that every pair meets in exactly one unit.

    A group of n rows is cut by a hash of ``member`` into about n / block_rows blocks; every two blocks
    (and each block with itself) form a unit. Adds ``lo`` and ``hi``, which with ``key`` name the unit,
    and ``block``, the row's own block. A unit holds some 2 * block_rows rows, and a pair inside a
    single block is to be compared only where lo = hi.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / block_rows).cast("int")
    own = F.pmod(F.xxhash64(F.col(member), F.lit(7)), blocks.cast("bigint")).cast("int")
    return (
        rows.join(counts, key)
        .withColumn("block", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("lo", F.least("block", "_other"))
        .withColumn("hi", F.greatest("block", "_other"))
        .drop("_n", "_other")
    )


def map_units(
    rows: DataFrame,
    unit: list[str],
    fn: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame],
    schema: str,
    rows_at_once: int = _ROWS_AT_ONCE,
) -> DataFrame:
    """Apply ``fn`` to frames of whole units, which most often hold many small ones.

    Units are put together up to some ``rows_at_once``. ``fn`` gets the rows, sorted by unit, and an array that numbers the units from 0.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        for batch in batches:
            parts.append(batch)
            if sum(map(len, parts)) < rows_at_once:
                continue
            frame = pd.concat(parts, ignore_index=True) if len(parts) > 1 else batch
            number = _numbers(frame, unit)
            cut = int(np.searchsorted(number, number[-1]))  # the last unit may go on in the next batch
            if cut:
                yield fn(frame.iloc[:cut].reset_index(drop=True), number[:cut])
            parts = [frame.iloc[cut:]]
        frame = pd.concat(parts, ignore_index=True) if parts else None
        if frame is not None and len(frame):
            yield fn(frame, _numbers(frame, unit))

    return rows.repartition(*unit).sortWithinPartitions(*unit).mapInPandas(run, schema)


def _numbers(frame: pd.DataFrame, unit: list[str]) -> np.ndarray:
    first = np.zeros(len(frame), bool)
    for column in unit:
        values = frame[column].to_numpy()
        first[1:] |= values[1:] != values[:-1]
    return np.cumsum(first)


def neighbours_at(number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same unit, as arrays of places: first those one apart, then two, ..."""
    left = np.arange(len(number))
    step = 1
    while len(left := left[left + step < len(number)]):
        left = left[number[left] == number[left + step]]
        if len(left):
            yield left, left + step
        step += 1
