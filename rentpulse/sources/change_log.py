"""A stored type-2 history: what each run opened and closed, and now and then a checkpoint of it all.

``<base>/version=N`` holds the changes of run N, ``<base>_checkpoint/version=N`` the whole history up to
run N, open and closed versions apart. A folder counts once its success marker exists. Reading takes the
newest checkpoint and the runs after it, so it opens a bounded number of folders however long the history
is, and a run reads the open versions only. Folders that the checkpoint before the newest made needless
are removed: readers that began with that one can finish.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rentpulse.operators.scd2 import scd2_current, scd2_from_log
from rentpulse.sources.tables import complete_versions, remove_folder, version_path

# Runs between two checkpoints: a read opens at most so many folders and the checkpoint.
RUNS_PER_CHECKPOINT = 10


class ChangeLog:
    def __init__(self, spark: SparkSession, base: str, key: str, schema: StructType, every: int = RUNS_PER_CHECKPOINT):
        self.spark, self.base, self.key, self.schema, self.every = spark, base, key, schema, every
        self.checkpoints = f"{base}_checkpoint"

    def runs(self) -> list[int]:
        return complete_versions(self.spark, self.base)

    def _checkpoint(self) -> int | None:
        done = complete_versions(self.spark, self.checkpoints)
        return done[-1] if done else None

    def folders(self) -> list[str]:
        """What a read opens: the checkpoint, if there is one, and the runs after it."""
        last = self._checkpoint()
        later = [version_path(self.base, v) for v in self.runs() if last is None or v > last]
        return later if last is None else [version_path(self.checkpoints, last), *later]

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path)

    def _opened(self, folders: list[str]) -> DataFrame:
        """The changes after the checkpoint, on top of the versions that were open then."""
        parts = [self._read(f) for f in folders]
        if folders[0].startswith(self.checkpoints):
            parts[0] = scd2_current(parts[0])
        return scd2_from_log(reduce(DataFrame.unionByName, parts), self.key)

    def history(self) -> DataFrame:
        """All versions, open and closed."""
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        live = self._opened(folders)
        if folders[0].startswith(self.checkpoints):
            return self._read(folders[0]).filter(~F.col("is_current")).unionByName(live)
        return live

    def open_versions(self) -> DataFrame:
        """The open versions; closed ones before the checkpoint are not read."""
        folders = self.folders()
        return scd2_current(self._opened(folders)) if folders else self.spark.createDataFrame([], self.schema)

    def append(self, changes: DataFrame) -> None:
        """Store what a run opened and closed; every so many runs, a checkpoint."""
        done = self.runs()
        number = done[-1] + 1 if done else 1
        changes.write.mode("overwrite").parquet(version_path(self.base, number))
        if number - (self._checkpoint() or 0) >= self.every:
            self.compact()

    def compact(self) -> None:
        """Write the history up to the newest run as a checkpoint; drop what the one before it made needless."""
        before, number = self._checkpoint(), self.runs()[-1]
        path = version_path(self.checkpoints, number)
        self.history().write.mode("overwrite").partitionBy("is_current").parquet(path)
        if before is None:
            return
        for run in self.runs():
            if run <= before:
                remove_folder(self.spark, version_path(self.base, run))
        for old in complete_versions(self.spark, self.checkpoints):
            if old < before:
                remove_folder(self.spark, version_path(self.checkpoints, old))
