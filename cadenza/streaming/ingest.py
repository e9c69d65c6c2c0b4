"""Incremental ingest: new segment files are taken up once, and the episodes they touch are packed anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza.operators import grouping, segments

SCHEMA = "idx long, i long, start_ms long, end_ms long, kept boolean"
#: Parts of the store by episode; a batch reads those that its episodes are in.
BUCKETS = 256


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).parquet(path)


def ingest(source: DataFrame, store: str, groups: str, checkpoint: str, rules: grouping.Packing = grouping.Packing()) -> StreamingQuery:
    """Take up what is there and stop. ``store`` keeps all segments, ``groups`` a version of each touched episode.

    The store is parted by episode, so a batch reads the history of the parts that its episodes are in, not all of it. A batch that is run
    again after a crash overwrites its own files, so nothing counts twice.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        dealt = batch.withColumn("bucket", F.pmod(F.xxhash64("idx"), F.lit(BUCKETS)).cast("int"))
        dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/batch={number}")
        everything = spark.read.schema(f"{SCHEMA}, batch long, bucket int").option("basePath", store).parquet(f"{store}/batch=*")
        new = everything.where(F.col("batch") == number)
        buckets = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # BUCKETS at most
        rows = everything.where((F.col("batch") <= number) & F.col("bucket").isin(buckets))
        rows = rows.join(new.select("idx").distinct(), "idx", "left_semi").drop("batch", "bucket").dropDuplicates(["idx", "i"])
        packed = grouping.pack(segments.gaps(rows), rules)
        packed.write.mode("overwrite").parquet(f"{groups}/batch={number}")

    return source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_groups(spark: SparkSession, groups: str) -> DataFrame:
    """The newest groups of each episode."""
    rows = spark.read.option("basePath", groups).parquet(f"{groups}/batch=*")
    newest = rows.groupBy("idx").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["idx", "batch"]).drop("batch")
