"""Versions of a table: a new one is written beside the old, then a pointer moves. Nothing is changed in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """Versions under a folder on any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Versions that were written completely."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and self._fs.exists(self._path(f"{self.folder}/{n}/_SUCCESS")))

    def commit(self, df: DataFrame) -> int:
        """Write the next version; a crash before the end leaves no version."""
        version = max(self.versions(), default=0) + 1
        df.write.mode("overwrite").parquet(f"{self.folder}/v{version}")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        found = self.versions()
        if version is None:
            if not found:
                raise FileNotFoundError(f"no version in {self.folder}")
            version = found[-1]
        return self.spark.read.parquet(f"{self.folder}/v{version}")
