"""Exact interpolated percentiles without one task that holds all values.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. Here a sketch (``percentile_approx``,
bounded) gives an interval around each percentile, a second pass counts what lies below it, and only the few values
within are grouped and ranked. The values are written once and read three times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadenza.sources.scratch import Scratch

#: The sketch errs by 1 / ACCURACY of the rows at most; the interval is three times as wide on both sides.
ACCURACY, NEAR = 10_000, 3e-4
#: Groups whose bounds are broadcast, at most; beyond it they join by a shuffle.
BROADCAST_ROWS = 100_000


def percentiles(df: DataFrame, value: Column, at: list[float], keys: list[str] = ()) -> DataFrame:
    """(keys..., n, p ARRAY<DOUBLE>): the percentiles ``at`` of the values that aren't null, interpolated in a straight line.

    Without keys always one row; without values n is 0 and ``p`` holds nulls. Groups of values that are all null are left out.
    """
    scratch, keys = Scratch(df.sparkSession, "quantiles"), list(keys)
    names = [f"k{i}" for i in range(max(1, len(keys)))]
    own = [F.col(k).alias(n) for k, n in zip(keys, names)] or [F.lit(0).alias("k0")]
    rows = scratch.write(df.select(*own, value.cast("double").alias("v")).where("v is not null"), "values")
    low, high = (F.percentile_approx("v", [min(1.0, max(0.0, q + d)) for q in at], ACCURACY) for d in (-NEAR, NEAR))
    bounds = scratch.write(rows.groupBy(*names).agg(F.count("*").alias("n"), low.alias("low"), high.alias("high")), "bounds")
    small = F.broadcast(bounds) if not keys or bounds.count() <= BROADCAST_ROWS else bounds
    rows = rows.join(small, names)
    which = range(len(at))

    def each(f) -> Column:
        return F.array(*(f(i) for i in which))

    below = rows.groupBy(*names).agg(
        F.first("n").alias("n"), each(lambda i: F.count_if(F.col("v") < F.col("low")[i])).alias("below"),
        each(lambda i: F.max(F.when(F.col("v") < F.col("low")[i], F.col("v")))).alias("prev"), each(lambda i: F.min(F.when(F.col("v") > F.col("high")[i], F.col("v")))).alias("next"),
    )
    inside = F.explode(F.filter(F.array(*(F.lit(i) for i in which)), lambda i: (F.col("v") >= F.get("low", i)) & (F.col("v") <= F.get("high", i)))).alias("i")
    counts = rows.select(*names, "v", inside).groupBy(*names, "i", "v").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*names, "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    place = F.get(F.array(*(F.lit(float(q)) for q in at)), F.col("i")) * (F.col("n") - 1)
    ranked = counts.withColumn("upto", upto).join(below, names).withColumn("place", place)
    total = F.get("below", F.col("i")) + F.col("upto")  # values up to this one
    found = ranked.groupBy(*names, "i").agg(
        F.first("place").alias("place"), F.first(F.get("below", F.col("i"))).alias("b"), F.max(total).alias("t"), F.first(F.get("prev", F.col("i"))).alias("prev"), F.first(F.get("next", F.col("i"))).alias("next"),
        F.min(F.when(total > F.floor("place"), F.col("v"))).alias("x"), F.min(F.when(total > F.ceil("place"), F.col("v"))).alias("y"),
    )
    x = F.when(F.floor("place") < F.col("b"), F.col("prev")).otherwise(F.coalesce("x", "next"))
    y = F.when(F.ceil("place") < F.col("b"), F.col("prev")).otherwise(F.coalesce("y", "next"))
    share = F.col("place") - F.floor("place")
    values = found.select(*names, F.struct("i", F.when(share == 0, x).otherwise((1 - share) * x + share * y).alias("p")).alias("s"))
    p = values.groupBy(*names).agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["p"]).alias("p"))
    p = p.join(bounds.select(*names, "n"), names)
    if keys:
        return p.select(*(F.col(n).alias(k) for k, n in zip(keys, names)), "n", "p")
    one = p.agg(F.coalesce(F.first("n"), F.lit(0)).alias("n"), F.first("p").alias("p"))
    nothing = F.array(*(F.lit(None).cast("double") for _ in at))
    return one.select("n", F.coalesce("p", nothing).alias("p"))
