"""Parquet tables: group reload, partition overwrite, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rentpulse.sources.scratch import materialize

# Rows that a task of a reload sorts and writes.
ROWS_PER_TASK = 200_000


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _path(spark, path)
    return fs.exists(jvm_path)


def table_bytes(spark: SparkSession, path: str) -> int:
    jvm_path, fs = _path(spark, path)
    return fs.getContentSummary(jvm_path).getLength()


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    jvm_path, fs = _path(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(jvm_path) if status.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _path(spark, path)
    fs.delete(jvm_path, True)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table; the schema keeps partition values from being re-typed by their look."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, group_col: str, counts: Mapping[str, int]) -> None:
    """Replace exactly the partitions of the counted groups, by the rows of ``df``, which has no others.

    Tasks take about ROWS_PER_TASK rows, of one group or of small ones side by side: each row draws a place
    among those of its group. Wide rows that are mostly NULL are far larger in memory than when shuffled,
    so the sizes of a shuffle do not bound what a task holds.
    """
    before = [0, *accumulate(counts.values())]
    places = [(group, first, n) for (group, n), first in zip(counts.items(), before, strict=False)]
    kind = StructType([df.schema[group_col], StructField("_first", LongType()), StructField("_n", LongType())])
    place = F.col("_first") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_n"))
    task = F.floor(place / ROWS_PER_TASK).cast("int")
    dealt = df.join(F.broadcast(df.sparkSession.createDataFrame(places, kind)), group_col).withColumn("_task", task)
    (
        dealt.repartitionById(-(-before[-1] // ROWS_PER_TASK), "_task")
        .select(*df.columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(group_col)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, partitions: DataFrame, schema: StructType | None = None) -> None:
    """Remove the partition folders of a table that ``partitions`` names by their key columns.

    The folders are those Spark itself reads the rows from, so escaped names are met. Only folder
    names reach the driver, which lists them for every read anyway.
    """
    keys = partitions.columns
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    folders = read_table(spark, path, schema).select(*keys, folder).join(partitions, keys, "left_semi")
    for row in folders.select("folder").distinct().toLocalIterator():
        jvm_path, fs = _path(spark, spark._jvm.java.net.URI(row.folder))
        fs.delete(jvm_path, True)


def reload_group(
    df: DataFrame,
    path: str,
    group_col: str,
    groups: Sequence[str],
    *,
    allow_empty: bool = False,
    staged: bool = False,
) -> dict[str, int]:
    """Idempotent load: the rows of the named groups replace what the table holds for them.

    Other groups stay untouched, also when ``df`` carries rows of them. A group without
    incoming rows is an error, unless ``allow_empty`` says that its partition shall go. The incoming
    rows are staged (unless ``df`` is ``staged`` already) and counted first: nothing stored changes when
    the call fails its checks. Returns the loaded rows per group.
    """
    spark = df.sparkSession
    incoming = df.filter(F.col(group_col).isin(*groups))
    if not staged:
        incoming = materialize(incoming, "incoming")
    counted = {row[group_col]: row["n"] for row in group_counts(incoming, group_col).collect()}  # named groups only
    loaded = {group: counted.get(group, 0) for group in groups}
    empty = [g for g, n in loaded.items() if n == 0]
    if empty and not allow_empty:
        raise ValueError(f"no incoming rows for {group_col} in {empty}; all stored rows kept")
    if counted:
        overwrite_partitions(incoming, path, group_col, counted)
    if empty and table_exists(spark, path):
        named = spark.createDataFrame([(g,) for g in empty], f"{group_col} string")
        drop_partitions(spark, path, named, df.schema)
    return loaded


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Bulk append without looking at what is stored."""
    df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


@dataclass(frozen=True)
class ExportResult:
    name: str
    rows: int
    bytes: int
    error: str | None = None


def export_tables(tables: Mapping[str, DataFrame], out_dir: str) -> list[ExportResult]:
    """Write each table as snappy Parquet with lower-case columns.

    A failing table is reported and does not stop the others. The rows are counted by the job that
    writes them; the written table is not read again.
    """
    results = []
    for name, df in tables.items():
        path = f"{out_dir}/{name}.parquet"
        try:
            lowered = df.toDF(*[c.lower() for c in df.columns])
            written = Observation(f"export of {name}")
            counted = lowered.observe(written, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("overwrite").option("compression", "snappy").parquet(path)
            results.append(ExportResult(name, written.get["rows"], table_bytes(df.sparkSession, path)))
        except Exception as error:  # noqa: BLE001 - any failure of one table is part of the report
            results.append(ExportResult(name, 0, 0, str(error)))
    return results


def export_summary(results: Sequence[ExportResult]) -> dict[str, float]:
    """Tables written, total size and total rows."""
    done = [r for r in results if r.error is None]
    return {
        "tables": len(done),
        "megabytes": sum(r.bytes for r in done) / 1024 / 1024,
        "rows": sum(r.rows for r in done),
    }


def group_counts(df: DataFrame, group: str) -> DataFrame:
    """Rows per group, most first."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), group)


def null_counts_by_group(df: DataFrame, group: str, col: str) -> DataFrame:
    """Rows per group whose ``col`` is NULL, most first."""
    return group_counts(df.filter(F.col(col).isNull()), group)


def version_path(base: str, version: int) -> str:
    return f"{base}/version={version}"


def complete_versions(spark: SparkSession, base: str) -> list[int]:
    """The version folders that carry a success marker, oldest first."""
    if not table_exists(spark, base):
        return []
    found = [n for n in list_folder(spark, base) if n.startswith("version=") and table_exists(spark, f"{base}/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix("version=")) for n in found)


def publish_version(df: DataFrame, base: str) -> DataFrame:
    """Write a whole table as its next version and return it.

    A version counts once its success marker exists, so readers see the old table until the new one is
    complete, and a failed write leaves the old one. The version before stays for readers that have
    begun; older ones go.
    """
    spark = df.sparkSession
    done = complete_versions(spark, base)
    path = version_path(base, done[-1] + 1 if done else 1)
    df.write.mode("overwrite").parquet(path)
    for old in done[:-1]:
        remove_folder(spark, version_path(base, old))
    return read_table(spark, path, df.schema)


def latest_version(spark: SparkSession, base: str) -> DataFrame:
    """The newest complete version of a published table."""
    return read_table(spark, version_path(base, complete_versions(spark, base)[-1]))
