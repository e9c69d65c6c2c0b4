"""Silence checks on aligned words: gaps, bounds, flags and distributions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import ordered
from cadenza.functions.quantiles import percentiles
from cadenza.functions.text import boundary
from cadenza.sources.fixtures import by_i
from cadenza.sources.scratch import Scratch


@dataclass(frozen=True)
class Pauses:
    """The length from which a pause at a mark is flagged."""

    fixed_gap_ms: int = 1150


KINDS = ("head", "tail", "mid", "fin", "none")


def token_gaps(items: DataFrame, keys: list[str]) -> DataFrame:
    """Gap from each word to the next and the class of the boundary, by the marks in between."""
    nxt = ordered.neighbour(items, keys, ["pos"], by_i("pos"), {"start_ms": "next_start", "pos": "next_pos"})
    return nxt.where("next_start is not null").select(*keys, "pos", "next_pos", (F.col("next_start") - F.col("end_ms")).alias("gap_ms"), boundary(F.col("between")).alias("kind"))


def head_tail(items: DataFrame, durations: DataFrame, keys: list[str]) -> DataFrame:
    """Silence before the first and after the last aligned word; ``durations`` has ``dur_ms``."""
    ends = items.groupBy(*keys).agg(F.min("start_ms").alias("head_ms"), F.max("end_ms").alias("last_ms"))
    return ends.join(durations, keys).select(*keys, "head_ms", (F.col("dur_ms") - F.col("last_ms")).alias("tail_ms"))


def upper_bound(rows: DataFrame, values: Column, name: str) -> DataFrame:
    """One row (n, ``name``): third quartile and one and a half times the distance of the quartiles, interpolated; null without values."""
    q = F.col("p")
    return percentiles(rows, values, [0.25, 0.75]).select("n", (q[1] + 1.5 * (q[1] - q[0])).alias(name))


def long_form(gaps: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """kind, ms of all gaps, heads and tails."""
    both = ends.select(*keys, F.explode(F.array(F.struct(F.lit("head").alias("kind"), F.col("head_ms").alias("ms")), F.struct(F.lit("tail").alias("kind"), F.col("tail_ms").alias("ms")))).alias("x"))
    return gaps.select(*keys, "pos", "kind", F.col("gap_ms").alias("ms")).unionByName(both.select(*keys, F.lit(None).cast("long").alias("pos"), "x.kind", "x.ms"))


def distribution(rows: DataFrame) -> DataFrame:
    """n, mean, median, p90 and max of each kind; kinds without rows have n = 0 and nulls."""
    spark = rows.sparkSession
    kinds = spark.createDataFrame([(k,) for k in KINDS], "kind string")
    rows = Scratch(spark, "silence").write(rows.select("kind", "ms"), "rows")
    p = percentiles(rows, F.col("ms"), [0.5, 0.9], ["kind"]).select("kind", F.col("p")[0].alias("median"), F.col("p")[1].alias("p90"))
    stats = rows.groupBy("kind").agg(F.count("*").alias("n"), F.avg("ms").alias("mean"), F.max("ms").alias("max")).join(F.broadcast(p), "kind", "left")
    return F.broadcast(kinds).join(stats, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "mean", "median", "p90", "max")


def bounds(ends: DataFrame) -> DataFrame:
    """One row: head_bound and tail_bound, from one look at ``ends``."""
    sides = F.explode(F.array(*(F.struct(F.lit(c).alias("side"), F.col(f"{c}_ms").cast("double").alias("v")) for c in ("head", "tail")))).alias("x")
    p = percentiles(ends.select(sides).select("x.side", "x.v"), F.col("v"), [0.25, 0.75], ["side"])
    bound = F.col("p")[1] + 1.5 * (F.col("p")[1] - F.col("p")[0])
    return p.agg(*(F.max(F.when(F.col("side") == c, bound)).alias(f"{c}_bound") for c in ("head", "tail")))


def flags(gaps: DataFrame, ends: DataFrame, keys: list[str], fixed_gap_ms: int = 1150) -> DataFrame:
    """A row for each reason: head or tail over its bound, a mid or fin gap of ``fixed_gap_ms`` or more."""
    ends = Scratch(ends.sparkSession, "silence").write(ends, "ends")
    rows = ends.crossJoin(F.broadcast(bounds(ends)))

    def seconds(ms):
        return F.format_string("%.2f", F.col(ms) / 1000.0)

    parts = []
    for name in ("head", "tail"):
        reason = F.concat(F.lit(f"{name}="), seconds(f"{name}_ms"), F.lit("s>"), seconds(f"{name}_bound"))
        parts.append(rows.where(F.col(f"{name}_ms") > F.col(f"{name}_bound")).select(*keys, reason.alias("reason")))
    wide = gaps.where((F.col("gap_ms") >= fixed_gap_ms) & F.col("kind").isin("mid", "fin"))
    at = F.concat(F.col("kind"), F.lit("_gap="), seconds("gap_ms"), F.lit("s@"), F.col("pos").cast("string"), F.lit("-"), F.col("next_pos").cast("string"))
    parts.append(wide.select(*keys, at.alias("reason")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
