"""The test tables, projected to the shapes of a speech corpus (integer milliseconds)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import ordered

DAY_US = 86_400_000_000
BUCKET = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_i(column: str = "i"):
    """Buckets of an integer order."""
    return F.expr(f"{column} div {BUCKET}")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idx, i, start_ms, end_ms, kept: a timeline for each user; four hours of events are one second."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("idx"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id", "event_type", "value")
    day = F.expr(f"us div {DAY_US}")
    order = ["us", "event_id"]
    e = ordered.extended(e, ["idx"], order, day, rank="i", ahead={"us": "next_us"})
    dur = F.lit(1000) + F.round(F.col("value") * 1000).cast("long") % 17000
    e = e.withColumn("dur", dur).withColumn("step", F.col("dur") + F.coalesce(F.expr("(next_us - us) div 14400000"), F.lit(0)))
    e = ordered.running_sum(e, ["idx"], order, day, F.col("step"), "start_ms", inclusive=False)
    return e.select("idx", (F.col("i") - 1).alias("i"), F.col("start_ms").cast("long").alias("start_ms"), (F.col("start_ms") + F.col("dur")).cast("long").alias("end_ms"), (F.col("event_type") != "error").alias("kept"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sid, frame, ms: mean square of four samples, 16 frames for each vector."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sid"), F.posexplode("embedding").alias("k", "x"))
    x = F.col("x").cast("double")
    return v.groupBy("sid", F.expr("cast(k div 4 as int)").alias("frame")).agg((F.sum(x * x) / 4).alias("ms"), F.max(F.abs(x)).alias("peak"))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """utt, pos, emb, speaker: ten vectors for each utterance."""
    v = table(spark, sf_dir, "embeddings")
    return v.select(F.expr("vec_id div 10").alias("utt"), F.col("vec_id").alias("pos"), F.transform("embedding", lambda x: x.cast("double")).alias("emb"), F.col("label").alias("speaker"))


def metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat_ws("|", F.col("doc_id").cast("string"), F.replace("text", F.lit("\n"), F.lit(" "))).alias("line"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, pos, token, start_ms, end_ms, between: words of conversations with times.

    A word lasts 40 ms a character; a pause of 90 ms times its length modulo 7 follows.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", " ").alias("tokens"))
    c = c.select("conv_id", "turn", F.posexplode("tokens").alias("pos", "token")).withColumn("pos", F.col("pos").cast("long"))
    size = F.length("token").cast("long")
    c = ordered.running_sum(c, ["conv_id", "turn"], ["pos"], by_i("pos"), 40 * size + (size % 7) * 90, "start_ms", inclusive=False)
    return c.select(
        "conv_id", "turn", "pos", "token", F.col("start_ms").cast("long").alias("start_ms"), (F.col("start_ms") + 40 * size).cast("long").alias("end_ms"),
        F.regexp_extract("token", r"([^\p{L}\p{N}]*)$", 1).alias("between"),
    )


def clip_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    loud = F.lit(-40.0) + (F.col("o_totalprice") % 2000) / 100
    return o.select(F.col("o_orderkey").alias("clip"), (F.col("o_custkey") % 20).cast("int").alias("episode"), loud.alias("loud"), (loud + F.col("o_orderkey") % 15).alias("peak"))
