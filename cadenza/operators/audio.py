"""Cutting utterances out of episodes: slices, pressed pauses, joins, fades and tails.

The helpers work on one utterance's samples. :func:`materialise` deals (idx, sid)
slices over the tasks, so a long episode isn't one task's job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_S = 0.02


# The defaults that decide where an utterance's samples start, end and join.
@dataclass(frozen=True)
class Slicing:
    """Seconds and decibels: edges are sought over ``search_s`` for sound over ``loud_db`` and keep ``rest_s``; pauses are pressed
    to ``gap_s``, or keep ``gap_share`` of what is over it; pieces join over ``join_s``; ``fades_s`` at both ends; ``tail_s`` of silence, if given."""

    search_s: float = 0.80
    loud_db: float = -42.0
    rest_s: float = 0.08
    gap_s: float = 0.80
    gap_share: float | None = None
    join_s: float = 0.02
    fades_s: tuple[float, float] = (0.06, 0.06)
    tail_s: float | None = None


def _levels(x: np.ndarray, size: int, floor: float) -> np.ndarray:
    """Whether each whole frame, from the first sample on, is over ``floor`` decibels."""
    n = len(x) // size
    ms = np.square(x[: n * size].astype(float)).reshape(n, size).mean(1) if n else np.zeros(0)
    return 20 * np.log10(np.sqrt(ms) + 1e-10) > floor


def quiet_end(x: np.ndarray, t: float, sr: int, c: Slicing) -> float:
    """Where the sound before ``t`` really ends: a pad behind the last loud frame, searched back for a while."""
    size, at = int(FRAME_S * sr), int(t * sr)
    lo = max(0, at - int(c.search_s * sr))
    if at - lo < size:
        return t
    loud = np.flatnonzero(_levels(x[lo:at], size, c.loud_db))
    return min(t, lo / sr + (loud[-1] + 1) * FRAME_S + c.rest_s) if len(loud) else t - c.search_s


def quiet_start(x: np.ndarray, t: float, sr: int, c: Slicing) -> float:
    """Where the sound after ``t`` really starts."""
    size, at = int(FRAME_S * sr), int(t * sr)
    part = x[at : at + int(c.search_s * sr)]
    if len(part) < size:
        return t
    loud = np.flatnonzero(_levels(part, size, c.loud_db))
    return max(t, at / sr + loud[0] * FRAME_S - c.rest_s) if len(loud) else t + c.search_s


def crossfade(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Join two pieces over n samples in a straight line; end to end if one is shorter."""
    if min(len(a), len(b)) < n or n == 0:
        return np.concatenate([a, b])
    up = np.linspace(0, 1, n, dtype=np.float32)
    return np.concatenate([a[:-n], a[-n:] * (1 - up) + b[:n] * up, b[n:]])


def pieces(x: np.ndarray, members: list[tuple[float, float]], start: float, end: float, sr: int, c: Slicing) -> list[tuple[int, int]]:
    """The sample ranges of an utterance: members in order, long pauses pressed around their quiet middle."""
    out, cursor = [], start
    for (_, e), (s, _) in zip(members, members[1:]):
        gap = s - e
        if gap > c.gap_s:
            keep = c.gap_s if c.gap_share is None else c.gap_s + (gap - c.gap_s) * c.gap_share
            out.append((int(cursor * sr), int((quiet_end(x, e, sr, c) + keep / 2) * sr)))
            cursor = quiet_start(x, s, sr, c) - keep / 2
        else:
            out.append((int(cursor * sr), int(e * sr)))
            cursor = e
    return [*out, (int(cursor * sr), int(end * sr))]


def cut_utterance(x: np.ndarray, members: list[tuple[float, float]], start: float, end: float, sr: int, c: Slicing) -> np.ndarray:
    parts = [x[max(0, a) : max(0, b)] for a, b in pieces(x, members, start, end, sr, c)]
    out = parts[0]
    for part in parts[1:]:
        out = crossfade(out, part, int(c.join_s * sr))
    return out


def tail_silence(x: np.ndarray, sr: int, least: float | None, floor: float, from_tail: bool = True) -> tuple[np.ndarray, bool]:
    """At least ``least`` seconds of silence at the end, by measured level; zeros are added behind a short fade.

    Frames are counted from the tail and zeros rounded up; or, for clips that sounds were cut out of, from the head
    and rounded down.
    """
    size = int(FRAME_S * sr)
    n = len(x) // size
    if not least or n == 0:
        return x, False
    if from_tail:
        loud = np.flatnonzero(_levels(x[len(x) - n * size :], size, floor))
        have = (n - 1 - loud[-1]) * size / sr if len(loud) else len(x) / sr
    else:
        ms = np.square(x[: n * size].astype(float)).reshape(n, size).mean(1)
        loud = np.flatnonzero(np.where(ms > 0, 10 * np.log10(np.maximum(ms, 1e-30)), -120.0) > floor)
        have = (n - 1 - loud[-1] if len(loud) else n) * FRAME_S
    if have >= least:
        return x, False
    short = (least - have) * sr
    zeros = int(np.ceil(short)) if from_tail else int(short)
    k = min(int(0.02 * sr), len(x))
    out = np.concatenate([x, np.zeros(zeros, x.dtype)])
    out[len(x) - k : len(x)] *= np.linspace(1, 0, k, dtype=np.float32)
    return out, True


def edge_fades(x: np.ndarray, sr: int, fade_in: float, fade_out: float) -> np.ndarray:
    """Half-cosine fades; a copy."""
    out = np.array(x, copy=True)
    for seconds, side in ((fade_in, 1), (fade_out, -1)):
        n = min(int(seconds * sr), len(out))
        if n > 1:
            ramp = (0.5 - 0.5 * np.cos(np.pi * np.arange(n) / n)).astype(out.dtype)
            if side > 0:
                out[:n] *= ramp
            else:
                out[-n:] *= (0.5 + 0.5 * np.cos(np.pi * np.arange(n) / n)).astype(out.dtype)
    return out


def apply_gain(x: np.ndarray, gain_db: float) -> np.ndarray:
    return np.clip(x * 10 ** (gain_db / 20), -1, 1).astype(x.dtype)


#: Zeros of the filter on each side, how much of the lower rate's band it lets through, and the shape of its window.
RESAMPLE_ZEROS, RESAMPLE_BAND, RESAMPLE_BETA = 32, 0.9, 9.0


@lru_cache(maxsize=8)
def _filters(up: int, down: int) -> tuple[np.ndarray, int]:
    """The windowed sinc between samples, a row of weights for each of the ``up`` places, and how many samples it reaches."""
    scale = max(1.0, down / up)
    reach = int(np.ceil(RESAMPLE_ZEROS * scale))
    away = np.arange(-reach + 1, reach + 1)[None] - (np.arange(up) / up)[:, None]
    inside = np.clip(1 - np.square(away / reach), 0, None)
    weights = np.sinc(away * RESAMPLE_BAND / scale) * np.i0(RESAMPLE_BETA * np.sqrt(inside))
    return weights / weights.sum(1, keepdims=True), reach


def resampled_span(x: np.ndarray, first: int, sr: int, to: int, start: int, end: int) -> np.ndarray:
    """Samples ``start`` to ``end`` at the rate ``to`` of a recording of which ``x`` has those from ``first`` on; others are silent.

    Polyphase: new samples that lie at the same place between old ones share their weights, so each place is one product.
    """
    common = gcd(sr, to)
    up, down = to // common, sr // common
    weights, reach = _filters(up, down)
    low, high = start * down // up - reach, (max(start, end - 1) * down) // up + reach + 1
    near = np.zeros(high - low + 1)
    a, b = max(low, first), min(high, first + len(x))
    if a < b:
        near[a - low : b - low] = x[a - first : b - first]
    out = np.empty(max(0, end - start), np.float32)
    for at in range(start, min(end, start + up)):  # every up-th new sample
        whole, place = divmod(at * down, up)
        count = (end - at + up - 1) // up
        begin = whole - reach + 1 - low
        rows = np.lib.stride_tricks.as_strided(near[begin:], (count, 2 * reach), (down * near.itemsize, near.itemsize), writeable=False)
        out[at - start :: up] = rows @ weights[place]
    return out


def resampled(x: np.ndarray, sr: int, to: int) -> np.ndarray:
    """Samples at another rate through a windowed sinc; what the lower rate can't hold is at least 60 dB down."""
    if sr == to or not len(x):
        return x
    return resampled_span(x, 0, sr, to, 0, round(len(x) * to / sr))


def of_length(x: np.ndarray, n: int) -> np.ndarray:
    """Cut off or filled up with silence to n samples, as a model's output is brought back to its input's length."""
    return x[:n] if len(x) >= n else np.concatenate([x, np.zeros(n - len(x), x.dtype)])


def _each_clip(clips: DataFrame, change: Callable[[dict, np.ndarray], tuple[int, np.ndarray]]) -> DataFrame:
    """(sid, sr, pcm) with new samples for each clip that has some; ``change`` gives rate and samples."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                if r["pcm"] is None:
                    rows.append((r["sid"], None, None))
                    continue
                sr, y = change(r, np.frombuffer(r["pcm"], "<i2").astype(np.float32) / 32768)
                rows.append((r["sid"], sr, np.round(np.clip(y, -1, 32767 / 32768) * 32768).astype("<i2").tobytes()))
            yield pd.DataFrame(rows, columns=["sid", "sr", "pcm"]).astype({"sr": "Int32"})

    return clips.mapInPandas(run, f"sid {dict(clips.dtypes)['sid']}, sr int, pcm binary")


def at_rate(clips: DataFrame, to: int) -> DataFrame:
    """Clips (sid, sr, pcm) at the rate ``to``; a clip without samples stays without."""
    return _each_clip(clips.select("sid", "sr", "pcm"), lambda r, x: (to, resampled(x, int(r["sr"]), to)))


def like(made: DataFrame, clips: DataFrame) -> DataFrame:
    """Clips (sid, sr, pcm) that a model made, brought back to the rate and to the number of samples of ``clips``."""
    goal = clips.select("sid", F.col("sr").cast("int").alias("goal"), F.expr("octet_length(pcm) div 2").alias("n"))
    rows = made.select("sid", "sr", "pcm").join(goal, "sid")
    return _each_clip(rows, lambda r, x: (int(r["goal"]), of_length(resampled(x, int(r["sr"]), int(r["goal"])), int(r["n"]))))


def with_gains(clips: DataFrame, gains: DataFrame) -> DataFrame:
    """Clips (sid, sr, pcm) with the gain of (sid, gain_db) applied; clips without one stay as they are."""
    rows = clips.select("sid", "sr", "pcm").join(gains.select("sid", F.col("gain_db").cast("double").alias("gain_db")), "sid", "left")
    return _each_clip(rows.fillna(0.0, ["gain_db"]), lambda r, x: (int(r["sr"]), apply_gain(x, r["gain_db"])))


def windows(n: int, win: int, hop: int) -> list[tuple[int, int]]:
    """Sliding windows; one more may start as long as half a window is left."""
    return [(s, min(s + win, n)) for s in range(0, max(1, n - win // 2), hop)]


def audible(x: np.ndarray, win: int) -> bool:
    return len(x) >= win / 2 and bool(np.sqrt(np.mean(np.square(x.astype(float)))) > 0.01)


def energy_speech(x: np.ndarray, sr: int, floor: float = -42.0, least_s: float = 0.25, gap_s: float = 0.15, pad_s: float = 0.06) -> list[tuple[float, float]]:
    """Spans over a level: a stand-in for a voice activity model."""
    on = np.flatnonzero(_levels(x, int(FRAME_S * sr), floor))
    if not len(on):
        return []
    cut = np.flatnonzero(np.diff(on) * FRAME_S > gap_s)
    first, last = on[np.r_[0, cut + 1]], on[np.r_[cut, len(on) - 1]] + 1
    return [(max(0.0, a * FRAME_S - pad_s), min(len(x) / sr, b * FRAME_S + pad_s)) for a, b in zip(first, last) if (b - a) * FRAME_S >= least_s]


def pitch(x: np.ndarray, sr: int, low: float = 80.0, high: float = 600.0) -> np.ndarray:
    """A pitch track by autocorrelation of 40 ms frames every 10 ms, 0 where unvoiced: a stand-in for a pitch model."""
    size, hop = int(0.04 * sr), int(0.01 * sr)
    out = []
    for s in range(0, len(x) - size, hop):
        f = x[s : s + size].astype(float)
        f = f - f.mean()
        r = np.fft.irfft(np.abs(np.fft.rfft(f, 2 * size)) ** 2)[:size]
        lo, hi = int(sr / high), min(int(sr / low), size - 1)
        k = lo + int(np.argmax(r[lo:hi])) if hi > lo else 0
        out.append(sr / k if r[0] > 1e-6 and k and r[k] > 0.5 * r[0] else 0.0)
    return np.array(out)


def materialise(clips: DataFrame, c: Slicing = Slicing()) -> DataFrame:
    """(sid, sr, pcm, offset_s, members ARRAY<STRUCT<start, end>>, start, end) to (sid, sr, pcm, padded).

    ``pcm`` holds the 16-bit samples around the utterance and ``offset_s`` where they start in the episode.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for sid, sr, pcm, offset, members, start, end in pdf.itertuples(index=False):
                x = np.frombuffer(pcm, "<i2").astype(np.float32) / 32768
                spans = [(m["start"] - offset, m["end"] - offset) for m in members]
                y = cut_utterance(x, spans, start - offset, end - offset, sr, c)
                y, padded = tail_silence(y, sr, c.tail_s, c.loud_db)
                y = edge_fades(y, sr, *c.fades_s)
                out.append((sid, sr, np.round(np.clip(y, -1, 1) * 32767).astype("<i2").tobytes(), padded))
            yield pd.DataFrame(out, columns=["sid", "sr", "pcm", "padded"])

    return clips.select("sid", "sr", "pcm", "offset_s", "members", "start", "end").mapInPandas(run, "sid string, sr int, pcm binary, padded boolean")


def clip_frames(clips: DataFrame, frame_s: float = FRAME_S, hop_s: float | None = None) -> DataFrame:
    """(sid, sr, pcm) to (sid, frame, ms, peak) of whole frames; with ``hop_s`` of overlapping ones, (samples - frame) div hop of them.

    Without ``hop_s`` ``peak`` is a frame's, else the clip's.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for sid, sr, pcm in pdf.itertuples(index=False):
                x = np.frombuffer(pcm, "<i2").astype(float) / 32768
                size = int(frame_s * sr)
                if hop_s is None:
                    n = len(x) // size
                    f = x[: n * size].reshape(n, size)
                    yield pd.DataFrame({"sid": sid, "frame": np.arange(n), "ms": np.square(f).mean(1), "peak": np.abs(f).max(1) if n else []})
                    continue
                hop = int(hop_s * sr)
                at = np.arange(max(0, (len(x) - size) // hop)) * hop
                total = np.r_[0.0, np.cumsum(np.square(x))]
                yield pd.DataFrame({"sid": sid, "frame": np.arange(len(at)), "ms": (total[at + size] - total[at]) / size, "peak": np.abs(x).max() if len(x) else 0.0})

    rows = clips.select("sid", F.col("sr").cast("int"), "pcm").where("pcm is not null")
    return rows.mapInPandas(run, f"sid {dict(clips.dtypes)['sid']}, frame long, ms double, peak double")


def clip_windows(clips: DataFrame, win_s: float = 2.0, hop_s: float = 0.5) -> DataFrame:
    """(sid, sr, pcm) to (utt, pos, sr, pcm): sliding windows that hold sound; the last ones may be shorter, silent ones are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for sid, sr, pcm in pdf.itertuples(index=False):
                x, win = np.frombuffer(pcm, "<i2"), int(win_s * sr)
                spans = [(k, a, b) for k, (a, b) in enumerate(windows(len(x), win, int(hop_s * sr)))]
                rows = [(sid, k, sr, x[a:b].tobytes()) for k, a, b in spans if audible(x[a:b] / 32768, win)]
                yield pd.DataFrame(rows, columns=["utt", "pos", "sr", "pcm"])

    rows = clips.select("sid", F.col("sr").cast("int"), "pcm").where("pcm is not null")
    return rows.mapInPandas(run, f"utt {dict(clips.dtypes)['sid']}, pos long, sr int, pcm binary")


def padded_batch(inputs: list[dict]) -> np.ndarray:
    """The samples of a provider's inputs as rows of one array, short ones filled up with zeros, as a model of vectors takes them."""
    rows = [np.frombuffer(x["pcm"], "<i2").astype(np.float32) / 32768 for x in inputs]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.float32)
    for row, x in zip(out, rows):
        row[: len(x)] = x
    return out


def softened(clips: DataFrame, edges: DataFrame, c: Slicing = Slicing()) -> DataFrame:
    """Clips after cuts: where (sid, head, tail) says that an end was cut, it gets its silence and its fade again."""
    rows = clips.select("sid", "sr", "pcm").join(edges.select("sid", "head", "tail"), "sid", "left").fillna(False, ["head", "tail"])

    def change(r: dict, x: np.ndarray) -> tuple[int, np.ndarray]:
        sr = int(r["sr"])
        if r["tail"]:
            x, _ = tail_silence(x, sr, c.tail_s, c.loud_db, from_tail=False)
        return sr, edge_fades(x, sr, c.fades_s[0] if r["head"] else 0.0, c.fades_s[1] if r["tail"] else 0.0)

    return _each_clip(rows, change)
