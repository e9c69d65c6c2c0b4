"""Speaker vectors: centroids, the choice of a target cluster, similarities and runs of foreign windows.

Vectors are averaged by position, so that every sum is a partial aggregate; one-row
tables (a centroid, a bound) are joined to all rows by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadenza.functions.quantiles import percentiles
from cadenza.sources.scratch import Scratch


@dataclass(frozen=True)
class Purity:
    """Windows below ``low_sim`` are foreign; runs of them are flagged, long runs and very foreign windows are severe."""

    low_sim: float = 0.45
    flag_run: int = 2
    severe_run: int = 4
    severe_min: float = 0.05


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: x / norm)


def mean_vector(df: DataFrame, keys: list[str], vec: str = "emb") -> DataFrame:
    """The mean vector of each key (or of all rows), of length 1."""
    flat = df.select(*keys, F.posexplode(vec).alias("k", "x")).groupBy(*keys, "k").agg(F.avg("x").alias("x"))
    whole = flat.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("v"))
    return whole.where(F.size("v") > 0).select(*keys, unit(F.transform("v", lambda e: e["x"])).alias("centroid"))


def cluster_stats(segs: DataFrame) -> DataFrame:
    """(idx, label, emb, dur) to (idx, label, dur, n, centroid)."""
    stats = segs.groupBy("idx", "label").agg(F.sum("dur").alias("dur"), F.count("*").alias("n"))
    return stats.join(mean_vector(segs, ["idx", "label"]), ["idx", "label"])


def target_cluster(stats: DataFrame, reference: DataFrame | None = None, max_dist: float = 0.6) -> DataFrame:
    """(idx, label, ref_dist): the longest cluster, or the one nearest to the reference vector (one row, ``ref``).

    Ties go to the smallest label; beyond ``max_dist`` the label is null.
    """
    if reference is None:
        best = stats.groupBy("idx").agg(F.min(F.struct((-F.col("dur")).alias("d"), "label")).alias("m"))
        return best.select("idx", F.col("m.label").alias("label"), F.lit(None).cast("double").alias("ref_dist"))
    near = stats.crossJoin(F.broadcast(reference.select("ref").limit(1))).withColumn("dist", 1 - dot(F.col("centroid"), F.col("ref")))
    best = near.groupBy("idx").agg(F.min(F.struct("dist", "label")).alias("m"))
    return best.select("idx", F.when(F.col("m.dist") <= max_dist, F.col("m.label")).alias("label"), F.col("m.dist").alias("ref_dist"))


def robust_centroid(utts: DataFrame) -> DataFrame:
    """One row: the mean of all vectors, then of those above the lowest tenth of similarities to it."""
    scratch = Scratch(utts.sparkSession, "vectors")
    first = scratch.write(mean_vector(utts, []), "first")
    sims = utts.crossJoin(F.broadcast(first)).withColumn("sim", dot(F.col("emb"), F.col("centroid")))
    cut = percentiles(sims, F.col("sim"), [0.1]).select(F.col("p")[0].alias("p10"))
    return scratch.write(mean_vector(sims.crossJoin(F.broadcast(cut)).where("sim > p10"), []), "robust")


def upper_half(sims: DataFrame) -> DataFrame:
    """Of (utt, sim) the floor(n / 2) of highest similarity, ties by utt.

    The similarity of the last row that counts is found by a percentile, then only its ties are ranked.
    """
    sims = Scratch(sims.sparkSession, "vectors").write(sims.select("utt", "sim"), "sims")
    n = percentiles(sims, F.col("sim"), [0.5]).select("n", F.col("p")[0].alias("p50"))
    rows = sims.crossJoin(F.broadcast(n))
    above = rows.where("sim > p50")
    taken = above.agg(F.count("*").alias("k"))
    ties = rows.where("sim = p50").crossJoin(F.broadcast(taken))
    rank = F.row_number().over(Window.partitionBy("sim").orderBy("utt"))
    return above.select("utt", "sim").union(ties.withColumn("r", rank).where("r <= n div 2 - k").select("utt", "sim"))


def mean_micros(sims: DataFrame) -> DataFrame:
    """(utt, sim) of windows to (utt, sim): the mean in whole millionths, of similarities in whole millionths, halves upwards.

    All sums are of integers, so the result doesn't depend on the order of rows.
    """
    k = F.round(F.col("sim") * 1_000_000).cast("long")
    twice = 2 * F.sum(k) + F.count("*")
    per = sims.groupBy("utt").agg(twice.alias("a"), (2 * F.count("*")).alias("b"))
    return per.select("utt", (F.expr("(a - pmod(a, b)) div b") / 1_000_000).alias("sim"))


def second_centroid(windows: DataFrame, half: DataFrame) -> DataFrame:
    """One row: the mean of all windows of the utterances in ``half``, of length 1."""
    return mean_vector(windows.join(half.select("utt"), "utt", "left_semi"), [])


def window_similarity(windows: DataFrame, centroid: DataFrame) -> DataFrame:
    return windows.crossJoin(F.broadcast(centroid)).withColumn("sim", dot(F.col("emb"), F.col("centroid"))).drop("centroid", "emb")


def purity(sims: DataFrame, low_sim: float = 0.45, flag_run: int = 2, severe_run: int = 4, severe_min: float = 0.05) -> DataFrame:
    """(utt, pos, sim) to (utt, n, min_sim, mean_sim, longest, flagged, severe): the longest run of windows below ``low_sim``.

    Windows that were left out before don't break a run.
    """
    w = Window.partitionBy("utt").orderBy("pos")
    low = (F.col("sim") < low_sim).cast("int")
    rows = sims.withColumn("low", low).withColumn("island", F.row_number().over(w) - F.row_number().over(Window.partitionBy("utt", "low").orderBy("pos")))
    runs = rows.groupBy("utt", "low", "island").agg(F.count("*").alias("run"), F.min("sim").alias("min_sim"), F.sum("sim").alias("sum_sim"))
    per = runs.groupBy("utt").agg(F.sum("run").alias("n"), F.min("min_sim").alias("min_sim"), F.sum("sum_sim").alias("s"), F.max(F.when(F.col("low") == 1, F.col("run")).otherwise(0)).alias("longest"))
    flagged = F.col("longest") >= flag_run
    severe = flagged & ((F.col("longest") >= severe_run) | (F.col("min_sim") <= severe_min))
    return per.select("utt", "n", "min_sim", (F.col("s") / F.col("n")).alias("mean_sim"), "longest", flagged.alias("flagged"), severe.alias("severe"))


def average_linkage(vectors: np.ndarray, most: float) -> np.ndarray:
    """Clusters by average cosine distance below ``most``; labels in the order of their first members. One episode's segments."""
    n = len(vectors)
    unit_ = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    d = 1 - unit_ @ unit_.T
    np.fill_diagonal(d, np.inf)
    size, alive, label = np.ones(n), np.ones(n, bool), np.arange(n)
    while alive.sum() > 1:
        i, j = divmod(int(np.argmin(d)), n)
        if not d[i, j] < most:
            break
        i, j = min(i, j), max(i, j)
        d[i] = d[:, i] = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
        size[i] += size[j]
        alive[j] = False
        label[label == j] = i
    return np.unique(label, return_inverse=True)[1]


def cluster_episodes(segs: DataFrame, most: float = 0.6) -> DataFrame:
    """(idx, i, emb) with a label for each segment; clustering compares all segments of an episode, so an episode is a group."""

    def run(pdf):
        pdf = pdf.sort_values("i")
        labels = average_linkage(np.array(pdf.emb.tolist(), float), most)
        return pdf[["idx", "i"]].assign(label=labels.astype("int64"))

    kinds = dict(segs.dtypes)
    return segs.select("idx", "i", "emb").groupBy("idx").applyInPandas(run, f"idx {kinds['idx']}, i {kinds['i']}, label long")


def previews(segs: DataFrame, each_ms: int = 5000, enough_ms: int = 12000) -> DataFrame:
    """(idx, label, i, start_ms, end_ms): for each cluster the first segments, cut to ``each_ms``, until they last ``enough_ms``."""
    from cadenza.functions import ordered
    from cadenza.sources.fixtures import by_i

    cut = segs.withColumn("end_ms", F.least("end_ms", F.col("start_ms") + each_ms))
    run = ordered.running_sum(cut, ["idx", "label"], ["i"], by_i(), F.col("end_ms") - F.col("start_ms"), "before", inclusive=False)
    return run.where(F.col("before") < enough_ms).drop("before")
