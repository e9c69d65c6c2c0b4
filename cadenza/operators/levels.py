"""Frame levels, noise floors, active speech, and loudness plans.

Five floors keep silence finite in decibels, and they differ; ``db`` names them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadenza.functions.quantiles import percentiles
from cadenza.sources.scratch import Scratch


@dataclass(frozen=True)
class Loudness:
    """Where levels go: to ``target_db`` or the median of episodes, each clip by its episode's gain or keeping ``pass_ratio`` of its deviation."""

    target_db: float | None = None
    pass_ratio: float | None = None
    ceiling_db: float = -1.0


# How a mean square becomes decibels in each place.
FLOORS = {"export": "rms+1e-10", "frame": "-120 at 0", "prosody": "sqrt(ms+1e-12)", "loudness": "sqrt(ms)+1e-12", "peak": "peak+1e-12"}


def db(ms: Column, floor: str = "frame") -> Column:
    """Decibels of a mean square (for ``peak``, of a peak)."""
    rms = F.sqrt(ms)
    level = {
        "export": lambda: 20 * F.log10(rms + 1e-10),
        "frame": lambda: F.when(ms <= 0, F.lit(-120.0)).otherwise(20 * F.log10(rms)),
        "prosody": lambda: 20 * F.log10(F.sqrt(ms + 1e-12)),
        "loudness": lambda: 20 * F.log10(rms + 1e-12),
        "peak": lambda: 20 * F.log10(ms + 1e-12),
    }
    return level[floor]()


def noise_floor(frames: DataFrame) -> DataFrame:
    """(sid, frame, ms) to (sid, n, floor_db): the mean of the quietest fifth; -120 below five frames. A clip is a bounded group."""
    level = F.round(db(F.col("ms")), 6).alias("db")
    rows = frames.select("sid", "frame", level)
    w = Window.partitionBy("sid")
    ranked = rows.withColumn("n", F.count("*").over(w)).withColumn("r", F.row_number().over(w.orderBy("db", "frame")))
    low = F.avg(F.when(F.col("r") <= F.greatest(F.lit(1), F.expr("n div 5")), F.col("db")))
    return ranked.groupBy("sid").agg(F.max("n").alias("n"), low.alias("low")).select("sid", "n", F.when(F.col("n") < 5, F.lit(-120.0)).otherwise(F.col("low")).alias("floor_db"))


def active_level(frames: DataFrame, above: float = 15.0) -> DataFrame:
    """(sid, noise_db, active_db, peak_db): the median of frames over the 5th percentile plus ``above``, or of all frames."""
    rows = frames.select("sid", F.round(db(F.col("ms"), "loudness"), 6).alias("db"), "peak")
    noise = rows.groupBy("sid").agg(F.percentile("db", 0.05).alias("noise_db"), F.percentile("db", 0.5).alias("all_db"), F.max("peak").alias("peak"))
    voiced = rows.join(noise, "sid").where(F.col("db") > F.col("noise_db") + above).groupBy("sid").agg(F.percentile("db", 0.5).alias("voiced_db"))
    out = noise.join(voiced, "sid", "left")
    return out.select("sid", "noise_db", F.coalesce("voiced_db", "all_db").alias("active_db"), db(F.col("peak"), "peak").alias("peak_db"))


def loudness_plan(levels: DataFrame, target_db: float | None = None, pass_ratio: float | None = None, ceiling_db: float = -1.0) -> DataFrame:
    """(clip, episode, loud, peak) to clip, episode, gain, clamped and noop.

    The target is the median of episode medians unless given. A clip gets its episode's gain or, with ``pass_ratio``,
    the gain that leaves this share of its deviation; the peak may not pass ``ceiling_db``.
    """
    by_episode = percentiles(levels, F.col("loud"), [0.5], ["episode"]).select("episode", F.col("p")[0].alias("ep"))
    by_episode = Scratch(levels.sparkSession, "levels").write(by_episode, "episodes")  # the target and the gains read it
    goal = percentiles(by_episode, F.col("ep"), [0.5]).select(F.col("p")[0].alias("target")) if target_db is None else by_episode.limit(1).select(F.lit(target_db).alias("target"))
    rows = levels.join(by_episode, "episode").crossJoin(F.broadcast(goal))
    wanted = F.col("target") - F.col("ep") if pass_ratio is None else F.col("target") - F.col("loud") + (F.col("loud") - F.col("ep")) * pass_ratio
    gain = F.least(wanted, F.lit(ceiling_db) - F.col("peak"))
    return rows.select("clip", "episode", "loud", gain.alias("gain"), (gain < wanted - 1e-9).alias("clamped"), (F.abs(gain) < 0.01).alias("noop"))


def episode_rollup(plan: DataFrame) -> DataFrame:
    plan = Scratch(plan.sparkSession, "levels").write(plan, "plan")
    out = plan.groupBy("episode").agg(F.count("*").alias("n_utts"), F.count_if("clamped").alias("n_clamped"))
    values = {"measured": F.col("loud"), "gain": F.col("gain"), "achieved": F.col("loud") + F.col("gain")}
    long = plan.select("episode", F.explode(F.array(*(F.struct(F.lit(n).alias("what"), v.alias("v")) for n, v in values.items()))).alias("x")).select("episode", "x.what", "x.v")
    p = percentiles(long, F.col("v"), [0.5], ["episode", "what"])  # all three in one pass
    medians = p.groupBy("episode").agg(*(F.max(F.when(F.col("what") == n, F.col("p")[0])).alias(n) for n in values))
    return out.join(medians, "episode", "left")


def enhancement_summary(enhanced: DataFrame) -> DataFrame:
    """(sid, sim, floor_gain, accepted) to one row: n_ok, n_low, and the medians of similarity and of what the floor sank by."""
    enhanced = Scratch(enhanced.sparkSession, "levels").write(enhanced.select("sim", "floor_gain", "accepted"), "enhanced")
    out = enhanced.agg(F.count_if("accepted").alias("n_ok"), F.count_if(~F.col("accepted")).alias("n_low"))
    for name, column in (("sim_median", "sim"), ("floor_gain_median", "floor_gain")):
        out = out.crossJoin(F.broadcast(percentiles(enhanced, F.col(column), [0.5]).select(F.col("p")[0].alias(name))))
    return out


def separation_guard(levels: DataFrame) -> DataFrame:
    """(sid, full_db, vocals_db) with ``silent`` (audio went in, nothing came out) and ``passed`` (loud enough, near the whole)."""
    silent = (F.col("full_db") > -40) & (F.col("vocals_db") < -60)
    passed = (F.col("vocals_db") > -45) & (F.col("vocals_db") >= F.col("full_db") - 15)
    return levels.select("sid", "full_db", "vocals_db", silent.alias("silent"), passed.alias("passed"))
