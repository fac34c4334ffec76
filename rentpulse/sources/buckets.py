"""Tables stored by the hash of a key, so that joins on it need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from rentpulse.sources.scratch import shared_dir


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` in ``buckets`` files by the hash of ``key``, each sorted by it, and read it back.

    Two such tables with the same number of buckets join on the key bucket by bucket: neither side is
    shuffled. Rows are dealt to the buckets before the write, one task per bucket, so there is one file
    for each. The table is entered into the session's catalog under a name of its own; a hot key makes a
    large bucket, so choose keys with few rows each, as listings are.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    where = path or f"{shared_dir(spark)}/{table}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", where).format("parquet").saveAsTable(table)
    return spark.table(table)
