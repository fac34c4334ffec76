"""Session settings the rental jobs want."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rentpulse.sources.scratch import temporary_dir

# A projection of many text conversions compiles to a method the JVM refuses to optimise
# (over 8000 bytes) and then runs interpreted, about four times slower. With this limit such a
# projection falls back to generated code that is split into small methods.
RUNTIME_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STATIC_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # Capturing the Python call site of every expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what a running session lets us set."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rentpulse")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", temporary_dir())
    )
    for key, value in {**STATIC_SETTINGS, **RUNTIME_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
