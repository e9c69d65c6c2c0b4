"""Prosody scores and speech-rate outliers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.quantiles import percentiles
from cadenza.operators.silence import upper_bound

METRICS = ("f0_std", "f0_range", "energy_std")


def scores(metrics: DataFrame, names: tuple[str, ...] = METRICS) -> DataFrame:
    """prosody_score, the mean z-score of the metrics (population deviation plus 1e-9), and prosody_level 1 to 5.

    A score lies in level k if it is over the (k-1)th fifth's border and not over the kth.
    """
    stats = metrics.agg(*(F.struct(F.avg(c).alias("m"), (F.stddev_pop(c) + 1e-9).alias("s")).alias(f"z_{c}") for c in names))
    z = sum(((F.col(c) - F.col(f"z_{c}.m")) / F.col(f"z_{c}.s") for c in names), F.lit(0.0)) / len(names)
    scored = metrics.crossJoin(F.broadcast(stats)).withColumn("prosody_score", z).drop(*(f"z_{c}" for c in names))
    cuts = percentiles(scored, F.col("prosody_score"), [0.2, 0.4, 0.6, 0.8]).select(F.col("p").alias("cuts"))
    level = F.aggregate("cuts", F.lit(1), lambda k, q: k + F.when(F.col("prosody_score") > q, 1).otherwise(0))
    return scored.crossJoin(F.broadcast(cuts)).withColumn("prosody_level", level.cast("int")).drop("cuts")


def rate_outliers(rates: DataFrame, least: int = 4) -> DataFrame:
    """(sid, cps) over the upper bound of all rates; none below ``least`` values."""
    bound = upper_bound(rates, F.col("cps"), "bound")
    rows = rates.crossJoin(F.broadcast(bound)).where((F.col("n") >= least) & (F.col("cps") > F.col("bound")))
    return rows.select("sid", "cps", "bound", F.format_string("cps=%.2f>%.2f", "cps", "bound").alias("reason"))


def measure(samples: np.ndarray, sr: int, f0: np.ndarray, n_chars: int) -> dict:
    """Metrics of one clip from its samples and a pitch track (0 where unvoiced); ``error`` instead where there are too few voiced frames."""
    voiced = f0[f0 > 0]
    if len(voiced) < 10:
        return {"error": "no_voiced_f0"}
    tones = 12 * np.log2(voiced / np.median(voiced))
    size, hop = int(0.025 * sr), int(0.010 * sr)
    # Frames of 25 ms every 10 ms, loud 15 dB over the 5th percentile, pitch from the 5th to the 95th; roundings.
    n = (len(samples) - size) // hop
    if n <= 0:
        return {"error": "too_short"}
    total = np.r_[0.0, np.cumsum(np.asarray(samples, float) ** 2)]
    at = np.arange(n) * hop
    level = 20 * np.log10(np.sqrt((total[at + size] - total[at]) / size + 1e-12))
    loud = level > np.percentile(level, 5) + 15
    if not loud.any():
        return {"error": "silent"}
    first, last = np.flatnonzero(loud)[[0, -1]]
    spoken = (last - first + 1) * hop / sr
    return {
        "f0_mean": round(float(voiced.mean()), 1), "f0_std": round(float(tones.std()), 3), "f0_range": round(float(np.percentile(tones, 95) - np.percentile(tones, 5)), 3),
        "energy_std": round(float(level[loud].std()), 3), "pause_ratio": round(float(1 - loud[first : last + 1].mean()), 4), "cps": round(n_chars / spoken, 2) if n_chars and spoken > 0.2 else None,
    }


def of_clips(clips: DataFrame, texts: DataFrame) -> DataFrame:
    """(sid, sr, pcm) and (sid, text) to the metrics of :func:`measure` for each clip that has a text; what can't be measured has a reason in ``error``."""
    import pandas as pd

    from cadenza.functions.text import n_chars
    from cadenza.operators.audio import pitch

    names = ["f0_mean", "f0_std", "f0_range", "energy_std", "pause_ratio", "cps"]

    def run(batches):
        for pdf in batches:
            rows = []
            for sid, sr, pcm, chars in pdf.itertuples(index=False):
                x = np.frombuffer(pcm, "<i2").astype(np.float32) / 32768
                got = measure(x, int(sr), pitch(x, int(sr)), int(chars))
                rows.append((sid, *(got.get(n) for n in names), got.get("error")))
            yield pd.DataFrame(rows, columns=["sid", *names, "error"]).astype(dict.fromkeys(names, "float64"))

    rows = clips.where("pcm is not null").join(texts.select("sid", n_chars(F.col("text")).alias("chars")), "sid")
    kind = dict(clips.dtypes)["sid"]
    return rows.select("sid", "sr", "pcm", F.coalesce("chars", F.lit(0)).alias("chars")).mapInPandas(run, f"sid {kind}, {', '.join(n + ' double' for n in names)}, error string")
