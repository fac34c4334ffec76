"""Loading only unseen (group, date) partitions into a partitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentpulse.sources.manifest import commit_load, live_partitions, read_live, versions
from rentpulse.sources.scratch import materialize


def unseen_partitions(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key combination does not occur in ``existing``.

    The check is per combination, so a group that arrives with an older date than another
    group's latest is still loaded. Rows with a NULL key never count as seen. ``existing`` may be the
    list of a table's partitions. The combinations are written first: their size is then known and
    decides how they are joined.
    """
    seen = materialize(existing.select(*keys).distinct(), "seen")
    return df.join(seen, list(keys), "left_anti")


def incremental_load(
    df: DataFrame, path: str, partition_by: Sequence[str], unique_key: Sequence[str]
) -> DataFrame:
    """Add the unseen partitions of ``df`` to the table at ``path`` and return the table.

    What is seen comes from the table's manifest; no stored row is read for it. The incoming rows are
    computed once, into a staged table. An incoming row replaces a stored row with the same unique key
    in another partition: the partitions that hold such rows are written again, without them, together
    with the incoming ones, and one manifest swaps all of it. A load that dies at any point leaves the
    table as it was.
    """
    spark = df.sparkSession
    keys = list(partition_by)
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    df = materialize(df, "incoming")
    if not df.filter(has_null).isEmpty():
        raise ValueError(f"NULL in the partition columns {keys}: such rows would load again on every run")

    if not versions(spark, path):
        commit_load(df, path, keys)
        return read_live(spark, path, df.schema, keys)

    fresh = materialize(unseen_partitions(df, live_partitions(spark, path, df.schema, keys), keys), "fresh")
    stored = read_live(spark, path, df.schema, keys)
    if fresh.isEmpty():
        return stored
    shared = [key for key in keys if key in unique_key]
    same_dates = stored.join(fresh.select(*shared).distinct(), shared, "left_semi") if shared else stored
    replaced = same_dates.join(fresh.select(*unique_key), list(unique_key), "left_semi")
    touched = materialize(replaced.select(*keys).distinct(), "touched")
    kept = stored.join(touched, keys, "left_semi").join(fresh.select(*unique_key), list(unique_key), "left_anti")
    commit_load(fresh.unionByName(kept), path, keys, touched)
    return read_live(spark, path, df.schema, keys)
