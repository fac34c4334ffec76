"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def temporary_dir() -> str:
    """A folder for a session on this machine alone; it goes when the process ends."""
    path = tempfile.mkdtemp(prefix="rentpulse-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names; a temporary one only for a single-process master that names none."""
    configured = spark.conf.get(_DIR_KEY, None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"{_DIR_KEY} must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = temporary_dir()
    return _local_dirs[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared path and read it back.

    Used where a result feeds several consumers (so that it is computed once, column-pruned
    on reading, and survives lost executors) and for small statistics that are joined back:
    a written table has a known size, so the planner broadcasts it when it is really small
    and falls back to a shuffled join when it is not.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch = path
    return written


def discard(*written: DataFrame) -> None:
    """Remove tables of ``materialize`` that nothing reads any more: neither a plan nor a lost task's repetition.

    For tables of past rounds, once what was computed from them is written itself.
    """
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
