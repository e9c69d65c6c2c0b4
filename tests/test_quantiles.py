"""Exact percentiles against Spark's own."""

import random

import pytest
from pyspark.sql import functions as F

from cadenza.functions import quantiles

AT = [0.0, 0.1, 0.25, 0.5, 0.8, 0.85, 0.9, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 11, 4000])
def test_percentiles(spark, n):
    rng = random.Random(n)
    rows = [(k % 3, rng.choice((float(rng.randrange(4)), rng.gauss(0, 100), None if n > 2 else 1.0))) for k in range(n)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(4)
    want = df.agg(F.count("v").alias("n"), F.percentile("v", F.array(*(F.lit(q) for q in AT))).alias("p")).first()
    got = quantiles.percentiles(df, F.col("v"), AT).first()
    assert got["n"] == want["n"] and got["p"] == pytest.approx(want["p"], abs=1e-9)
    by_key = {r["k"]: r["p"] for r in quantiles.percentiles(df, F.col("v"), AT, ["k"]).collect()}
    for r in df.where("v is not null").groupBy("k").agg(F.percentile("v", F.array(*(F.lit(q) for q in AT))).alias("p")).collect():
        assert by_key.pop(r["k"]) == pytest.approx(r["p"], abs=1e-9)
    assert not by_key


def test_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "k int, v double")
    r = quantiles.percentiles(df, F.col("v"), [0.5, 0.9]).first()
    assert (r["n"], r["p"]) == (0, [None, None])
    assert quantiles.percentiles(df, F.col("v"), [0.5], ["k"]).count() == 0
