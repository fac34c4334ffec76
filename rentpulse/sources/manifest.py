"""Partitioned tables whose content is what a manifest lists, so that a load shows as a whole or not at all.

Under the base folder lies one folder per load, partitioned by the table's keys and never written again,
and in ``_manifests`` one small table per version: the live partitions and the load folder each lies in.
A version counts once Spark has put its success marker, the one file whose appearance swaps
the old state for the new one. Readers take the newest version that counts; a load that dies before
leaves folders that nothing refers to, which the next commit removes.

A plain read of the base folder works, but also shows what is being written or not yet removed; it is no
substitute for ``read_live``. One writer at a time. Readers may go on with the version before the newest; what only older ones
refer to goes with the next commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rentpulse.sources.tables import complete_versions, list_folder, remove_folder, table_exists, version_path

_FOLDER = "__folder"


def _manifests(base: str) -> str:
    return f"{base}/_manifests"


def versions(spark: SparkSession, base: str) -> list[int]:
    """The committed versions of the table, oldest first; none if there is no table."""
    return complete_versions(spark, _manifests(base))


def live_partitions(
    spark: SparkSession, base: str, schema: StructType, keys: Sequence[str], version: int | None = None
) -> DataFrame:
    """The partitions of a version (the newest, if none is given): the key columns and where they lie."""
    listed = StructType([*(schema[k] for k in keys), StructField(_FOLDER, StringType())])
    done = versions(spark, base)
    if not done:
        return spark.createDataFrame([], listed)
    return spark.read.schema(listed).parquet(version_path(_manifests(base), version or done[-1]))


def read_live(
    spark: SparkSession, base: str, schema: StructType, keys: Sequence[str], version: int | None = None
) -> DataFrame:
    """The rows of a version. The driver gets the list of partition folders, as it does for any partitioned table."""
    rows = live_partitions(spark, base, schema, keys, version).select(_FOLDER).toLocalIterator()
    folders = [f"{base}/{row[0]}" for row in rows]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = [f for f in schema.fields if f.name not in keys]
    found = StructType([*stored, StructField("load", StringType()), *(schema[k] for k in keys)])
    return spark.read.schema(found).option("basePath", base).parquet(*folders).select(*schema.names)


def commit_load(df: DataFrame, base: str, keys: Sequence[str], replaced: DataFrame | None = None) -> None:
    """Add the rows of ``df`` as one load; ``replaced`` names the partitions (keys) that give way to it.

    A partition of ``df`` that is live already gives way, too. The rows are written first, then the new
    manifest; nothing that is live is touched before its success marker stands.
    """
    spark, keys, schema = df.sparkSession, list(keys), df.schema
    done = versions(spark, base)
    number = done[-1] + 1 if done else 1
    load = f"load={number:08d}-{uuid.uuid4().hex[:8]}"
    path = f"{base}/{load}"
    _sweep(spark, base, done, schema, keys)
    # The hint gathers a partition's rows into few files and splits one that is far larger than the others.
    df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(path)
    new = _partitions_of(spark, path, load, schema, keys)
    live = new
    if done:
        before = live_partitions(spark, base, schema, keys)
        gone = new.select(*keys)
        if replaced is not None:
            gone = gone.unionByName(replaced.select(*keys))
        live = before.join(gone.distinct(), keys, "left_anti").unionByName(new)
    live.coalesce(1).write.mode("overwrite").parquet(version_path(_manifests(base), number))
    for old in done[:-1]:
        remove_folder(spark, version_path(_manifests(base), old))


def _partitions_of(spark: SparkSession, path: str, load: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The partitions a load has written, from its folder names and file footers; no column is read."""
    stored = [f for f in schema.fields if f.name not in keys]
    written = spark.read.schema(StructType([*stored, *(schema[k] for k in keys)])).parquet(path)
    # The path is percent-encoded, as it is in a URL, but with a plus for a plus.
    file = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    folder = F.regexp_extract(file, f"/({load}/.*)/[^/]*$", 1)
    return written.select(*keys, folder.alias(_FOLDER)).distinct()


def _sweep(spark: SparkSession, base: str, done: list[int], schema: StructType, keys: list[str]) -> None:
    """Remove the load folders, and the partitions of live loads, that no kept version refers to."""
    if not table_exists(spark, base):
        return
    kept = [live_partitions(spark, base, schema, keys, v) for v in done[-2:]]
    live = {row[0] for part in kept for row in part.select(_FOLDER).toLocalIterator()}
    loads = {folder.split("/", 1)[0] for folder in live}
    for load in list_folder(spark, base):
        if not load.startswith("load="):
            continue
        if load not in loads:
            remove_folder(spark, f"{base}/{load}")
            continue
        levels = [load]
        for _ in keys:
            levels = [f"{at}/{name}" for at in levels for name in list_folder(spark, f"{base}/{at}") if "=" in name]
        for folder in levels:
            if folder not in live:
                remove_folder(spark, f"{base}/{folder}")
