"""Audible sounds that no word accounts for: finding them between words, planning cuts, and moving times."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import ordered
from cadenza.operators.levels import db

FRAME_S = 0.02


@dataclass(frozen=True)
class Cutting:
    """Sounds without words: frames of ``frame_ms`` over ``floor_db``, joined over ``merge_frames``, ``least_frames`` long, ``guard`` frames
    from words; pauses keep ``residual_ms``."""

    frame_ms: int = 20
    floor_db: float = -42.0
    guard: int = 4
    merge_frames: int = 6
    least_frames: int = 8
    guard_ms: int = 80
    min_cut_ms: int = 150
    residual_ms: int = 250

    def of_gaps(self) -> dict:
        return {k: getattr(self, k) for k in ("frame_ms", "floor_db", "guard", "merge_frames", "least_frames")}


def frame_events(frames: DataFrame, floor_db: float, merge_frames: int, least_frames: int) -> DataFrame:
    """(sid, frame, ms) to (sid, first, end): runs of frames over the floor; runs closer than ``merge_frames`` are one, short ones go."""
    loud = frames.where(db(F.col("ms")) > floor_db).select("sid", "frame")
    bucket = F.expr("frame div 4096")
    rows = ordered.neighbour(loud, ["sid"], ["frame"], bucket, {"frame": "prev"}, -1)
    opens = (F.col("prev").isNull() | ((F.col("frame") - F.col("prev") > 1) & (F.col("frame") - F.col("prev") - 1 >= merge_frames))).cast("int")
    rows = ordered.running_sum(rows, ["sid"], ["frame"], bucket, opens, "island")
    runs = rows.groupBy("sid", "island").agg(F.min("frame").alias("first"), (F.max("frame") + 1).alias("end"))
    return runs.where(F.col("end") - F.col("first") >= least_frames).select("sid", "first", "end")


def gap_windows(words: DataFrame, clips: DataFrame, guard_ms: int = 80, min_cut_ms: int = 150) -> DataFrame:
    """(sid, pos, start_ms, end_ms) and (sid, dur_ms) to (sid, kind, g0, g1): before, between and after the words.

    Between words only pauses wider than two guards and the shortest cut count.
    """
    nxt = ordered.neighbour(words, ["sid"], ["pos"], F.expr("pos div 4096"), {"start_ms": "next_start"})
    mid = nxt.where(F.col("next_start") - F.col("end_ms") > 2 * guard_ms + min_cut_ms).select("sid", F.lit("mid").alias("kind"), F.col("end_ms").alias("g0"), F.col("next_start").alias("g1"))
    ends = words.groupBy("sid").agg(F.min_by("start_ms", "pos").alias("a"), F.max_by("end_ms", "pos").alias("b")).join(clips, "sid")
    head = ends.select("sid", F.lit("head").alias("kind"), F.lit(0).cast("long").alias("g0"), F.col("a").alias("g1"))
    tail = ends.select("sid", F.lit("tail").alias("kind"), F.col("b").alias("g0"), F.col("dur_ms").alias("g1"))
    return head.unionByName(mid).unionByName(tail)


def gap_events(frames: DataFrame, gaps: DataFrame, frame_ms: int, floor_db: float, guard: int, merge_frames: int, least_frames: int) -> DataFrame:
    """Sounds within each gap, with a verdict: ``cut``, or why not (the sound runs on into speech on one side).

    Frames join the gaps by clip and by frame number; a sound at the very start or end of a clip may be cut off.
    """
    n = frames.groupBy("sid").agg((F.max("frame") + 1).alias("nf"))
    g = gaps.join(n, "sid")
    lo = F.expr(f"least(g0 div {frame_ms}, nf)") + F.when(F.col("kind") != "head", guard).otherwise(0)
    hi = F.expr(f"least(g1 div {frame_ms}, nf)") - F.when(F.col("kind") != "tail", guard).otherwise(0)
    g = g.withColumn("w0", lo.cast("long")).withColumn("w1", hi.cast("long")).where("w1 > w0")
    loud = frames.where(db(F.col("ms")) > floor_db).select("sid", "frame")
    rows = g.join(loud, "sid").where("frame >= w0 and frame < w1")
    keys = ["sid", "kind", "g0", "g1", "w0", "w1", "nf"]
    bucket = F.expr("frame div 4096")
    rows = ordered.neighbour(rows, keys, ["frame"], bucket, {"frame": "prev"}, -1)
    opens = (F.col("prev").isNull() | ((F.col("frame") - F.col("prev") > 1) & (F.col("frame") - F.col("prev") - 1 >= merge_frames))).cast("int")
    rows = ordered.running_sum(rows, keys, ["frame"], bucket, opens, "island")
    runs = rows.groupBy(*keys, "island").agg(F.min("frame").cast("long").alias("first"), (F.max("frame") + 1).cast("long").alias("end")).where(F.col("end") - F.col("first") >= least_frames)
    left = (F.col("first") <= F.col("w0")) & ~((F.col("kind") == "head") & (F.col("w0") == 0))
    right = (F.col("end") >= F.col("w1")) & ~((F.col("kind") == "tail") & (F.col("w1") == F.col("nf")))
    verdict = F.when(left, "no_valley_left").when(right, "no_valley_right").otherwise("cut")
    return runs.select("sid", "kind", "g0", "g1", "first", "end", verdict.alias("verdict"))


def cuts(events: DataFrame, frame_ms: int, residual_ms: int = 250) -> DataFrame:
    """(sid, kind, t0, t1, pad): a frame more on both sides; pauses between words keep ``residual_ms``."""
    t0 = F.greatest((F.col("first") - 1) * frame_ms, F.when(F.col("kind") == "head", F.lit(0)).otherwise(F.col("g0")))
    t1 = F.least((F.col("end") + 1) * frame_ms, F.col("g1"))
    t1 = F.when(F.col("kind") == "tail", F.least((F.col("end") + 1) * frame_ms, F.col("g1"))).otherwise(F.when(F.col("kind") == "head", (F.col("end") + 1) * frame_ms).otherwise(t1))
    rows = events.where("verdict = 'cut'").withColumn("t0", t0.cast("long")).withColumn("t1", t1.cast("long"))
    left = (F.col("t0") - F.col("g0")) + (F.col("g1") - F.col("t1"))
    pad = F.when(F.col("kind") == "mid", F.greatest(F.lit(0), residual_ms - left)).otherwise(F.lit(0))
    return rows.select("sid", "kind", "t0", "t1", pad.cast("long").alias("pad"))


def totals(edits: DataFrame) -> DataFrame:
    """(sid, kind, t0, t1, pad) to kind, n, cut_ms, pad_ms and the number of clips."""
    return edits.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.col("t1") - F.col("t0")).alias("cut_ms"), F.sum("pad").alias("pad_ms"), F.countDistinct("sid").alias("clips"))


def leftovers(words: DataFrame, edits: DataFrame, frames_after: DataFrame, clips_after: DataFrame, rules: dict, guard_ms: int = 80, min_cut_ms: int = 150) -> DataFrame:
    """(sid, n): clips that were cut and still have something to cut, measured anew on the frames after the cuts; none is good.

    ``rules`` are the arguments of :func:`gap_events` behind its tables.
    """
    gaps = gap_windows(shifted(words, edits), clips_after, guard_ms, min_cut_ms)
    found = gap_events(frames_after, gaps, **rules).where("verdict = 'cut'")
    return found.join(edits.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.count("*").alias("n"))


def shifted(words: DataFrame, edits: DataFrame) -> DataFrame:
    """Words in the time after the cuts: each cut that ends before a time moves it by what it took."""
    lost = F.col("t1") - F.col("t0") - F.col("pad")
    joined = words.join(edits.select("sid", "t0", "t1", "pad"), "sid", "left")
    agg = joined.groupBy("sid", "pos", "start_ms", "end_ms").agg(
        F.coalesce(F.sum(F.when(F.col("t1") <= F.col("start_ms"), lost)), F.lit(0)).alias("ds"), F.coalesce(F.sum(F.when(F.col("t1") <= F.col("end_ms"), lost)), F.lit(0)).alias("de")
    )
    return agg.select("sid", "pos", (F.col("start_ms") - F.col("ds")).cast("long").alias("start_ms"), (F.col("end_ms") - F.col("de")).cast("long").alias("end_ms"))


def cut_samples(x: np.ndarray, sr: int, edits: list[tuple[float, float, float]], xfade_s: float = 0.02) -> np.ndarray:
    """Take (t0, t1, pad) seconds out of a clip, the last first; ends are crossfaded in a straight line, at least 8 samples."""
    for t0, t1, pad in sorted(edits, reverse=True):
        a, b = max(0, int(t0 * sr)), min(len(x), int(t1 * sr))
        tail = np.r_[np.zeros(int(pad * sr), x.dtype), x[b:]] if pad > 0 else x[b:]
        k = min(max(8, int(xfade_s * sr)), a, len(tail))
        ramp = np.linspace(1, 0, k, dtype=x.dtype)
        x = np.concatenate([x[: a - k], x[a - k : a] * ramp + tail[:k] * (1 - ramp), tail[k:]])
    return x
