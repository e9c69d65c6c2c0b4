"""Results of calls that cost money or hours, in rounds: each is kept as soon as it is complete."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Journal:
    """Rounds of one kind of result under a folder on any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def rounds(self) -> list[int]:
        """Rounds that were written completely."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        return sorted(int(n[6:]) for n in names if n[:6] == "round=" and self._fs.exists(self._path(f"{self.folder}/{n}/_SUCCESS")))

    def rows(self, schema: str) -> DataFrame:
        """All rows with the number of their round in ``n``."""
        found = self.rounds()
        if not found:
            return self.spark.createDataFrame([], f"{schema}, n long")
        paths = [f"{self.folder}/round={k}" for k in found]
        rows = self.spark.read.schema(schema).option("basePath", self.folder).parquet(*paths)
        return rows.withColumn("n", F.regexp_extract("_metadata.file_path", r"/round=(\d+)/", 1).cast("long"))

    def add(self, rows: DataFrame) -> int:
        number = max(self.rounds(), default=0) + 1
        rows.write.mode("overwrite").parquet(f"{self.folder}/round={number}")
        return number


def in_rounds(journal: Journal, todo: DataFrame, ask: Callable[[DataFrame], DataFrame], key: str, per_round: int, calls: int) -> int:
    """Ask about all rows of ``todo``, about ``per_round`` of them in a round, with ``calls`` tasks at once over the whole cluster; the number of rounds.

    Rows are dealt to rounds by a hash of their key. A round's results are kept when it ends, so a job that dies asks again for
    that round only: what is left to do is ``todo`` without the keys of :meth:`Journal.rows`.
    """
    number = todo.count()
    rounds = -(-number // per_round)
    for k in range(rounds):
        part = todo.where(F.pmod(F.xxhash64(F.col(key), F.lit(number)), F.lit(rounds)) == k).repartition(calls)
        journal.add(ask(part))
    return rounds
