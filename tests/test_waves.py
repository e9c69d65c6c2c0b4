"""Long recordings in chunks against the same work on whole arrays."""

import numpy as np
import pytest

from cadenza.operators import audio, events, waves

KIND = "sid string, sr int, pcm binary"


def _noise(seed, n):
    return (np.random.default_rng(seed).normal(size=n) * 6000).clip(-32768, 32767).astype("<i2")


def _whole(chunks):
    return {r["sid"]: np.frombuffer(bytes(r["pcm"]), "<i2") for r in waves.joined(chunks).collect()}


def test_chunks_and_slices(spark):
    x = {"a": _noise(1, 1000), "b": _noise(2, 256), "c": _noise(3, 1)}
    clips = spark.createDataFrame([(k, 100, v.tobytes()) for k, v in x.items()] + [("none", 100, None), ("empty", 100, b"")], KIND)
    chunks = waves.chunked(clips, 128)
    assert chunks.count() == 8 + 2 + 1
    assert all((got == x[k]).all() for k, got in _whole(chunks).items()) and {r["sid"]: r["n"] for r in waves.lengths(chunks).collect()} == {k: len(v) for k, v in x.items()}
    ranges = [(0, "a", -5, 3), (1, "a", 120, 390), (2, "a", 990, 2000), (3, "b", 128, 256), (4, "a", 5, 5), (5, "zz", 0, 9)]
    got = {r["key"]: np.frombuffer(bytes(r["pcm"]), "<i2") for r in waves.sliced(chunks, spark.createDataFrame(ranges, "key int, sid string, a long, b long"), 128).collect()}
    assert got.keys() == {0, 1, 2, 3} and all((got[k] == x[s][max(0, a) : b]).all() for k, s, a, b in ranges if k in got)


@pytest.mark.parametrize("size", [64, 1000])
def test_cuts_equal_one_task(spark, size):
    """Edits at both ends, a join apart, and with silence; in chunks much shorter than the clip."""
    sr, edits = 1000, {"a": [(0.5, 0.7, 0.0), (0.72, 0.9, 0.05), (1.5, 1.9, 0.3), (2.95, 3.0, 0.0)], "b": [(0.0, 0.2, 0.0), (0.3, 0.4, 0.1)], "c": [(0.004, 0.4, 0.0), (0.425, 0.43, 0.0), (0.45, 0.5, 0.02)], "whole": [(0.0, 1.0, 0.0)]}
    x = {"a": _noise(1, 3000), "b": _noise(2, 1000), "c": _noise(3, 700), "same": _noise(4, 500), "whole": _noise(5, 1000)}
    clips = spark.createDataFrame([(k, sr, v.tobytes()) for k, v in x.items()], KIND)
    rows = [(k, *e) for k, es in edits.items() for e in es]
    got = _whole(waves.cut(waves.chunked(clips, size), spark.createDataFrame(rows, "sid string, t0 double, t1 double, pad double"), size=size))
    for k, v in x.items():
        want = events.cut_samples(v.astype(np.float32) / 32768, sr, edits.get(k, []))
        have = got.get(k, np.zeros(0)).astype(int)
        assert len(have) == len(want) and (not len(want) or np.abs(have - np.frombuffer(waves.pcm16(want), "<i2")).max() <= 1), k
    with pytest.raises(ValueError):
        waves.cut_plan(1000, 100, [(0, 5, 0), (4, 6, 0)], 0.02)
    runs, n = waves.cut_plan(700, 1000, [(0.1, 0.4, 0.0), (0.405, 0.5, 0.0), (0.5, 0.6, 0.0)], 0.02)
    assert [r["out"][1] for r in runs] == [20, 5, 0, 0] and n == 100 + 5 + 100 - 25  # joins as long as what lies between


@pytest.mark.parametrize(("sr", "to"), [(44100, 16000), (16000, 44100), (8000, 7919)])
def test_resampling(sr, to):
    """A tone that both rates hold stays, one above the new band is at least 60 dB down, levels don't change."""
    t = np.arange(sr) / sr
    keep = audio.resampled(np.sin(2 * np.pi * 1000 * t).astype(np.float32), sr, to)
    want = np.sin(2 * np.pi * 1000 * np.arange(to) / to)
    inner = slice(to // 10, -to // 10)
    assert len(keep) == to and np.abs(keep - want)[inner].max() < 1e-3
    if to < sr:
        high = (sr + to) / 4
        alias = audio.resampled(np.sin(2 * np.pi * high * t).astype(np.float32), sr, to)[inner]
        assert 20 * np.log10(np.sqrt(np.mean(alias**2)) + 1e-12) < -60
    assert np.abs(audio.resampled(np.ones(sr, np.float32), sr, to)[inner] - 1).max() < 1e-5


def test_rates_in_chunks(spark):
    x = {"a": _noise(1, 5000), "b": _noise(2, 37), "c": _noise(3, 1024)}
    clips = spark.createDataFrame([(k, 441, v.tobytes()) for k, v in x.items()], KIND)
    for to in (160, 1000):
        got = _whole(waves.at_rate(waves.chunked(clips, 256), to, 256))
        for k, v in x.items():
            want = np.frombuffer(waves.pcm16(audio.resampled(v.astype(np.float32) / 32768, 441, to)), "<i2")
            assert (got[k] == want).all(), (k, to)


@pytest.mark.parametrize(("frame", "hop"), [(25, 10), (10, 10), (8, 20), (7, 3)])
def test_overlapping_frames(spark, frame, hop):
    x = {"a": _noise(1, 500), "b": _noise(2, frame), "c": _noise(3, frame + hop)}
    clips = spark.createDataFrame([(k, 100, v.tobytes()) for k, v in x.items()], KIND)
    got = {(r["sid"], r["frame"]): r["ms"] for r in waves.overlapping_frames(waves.sample_rows(waves.chunked(clips, 64), 64), frame, hop).collect()}
    want = {(k, f): np.square(v[f * hop : f * hop + frame] / 32768).mean() for k, v in x.items() for f in range(max(0, (len(v) - frame) // hop))}
    assert got == pytest.approx(want)


class Failing(waves.MiddleOut):
    def __call__(self, inputs):
        if any(np.frombuffer(x["pcm"], "<i2")[0] == 7 for x in inputs):
            raise RuntimeError("no")
        return super().__call__(inputs)


class Silent:
    batch = 2

    def __call__(self, inputs):
        return [{"vocals": bytes(len(x["pcm"]))} for x in inputs]


def test_separation_in_windows(spark):
    """A model that changes nothing gives back the input; a window that fails takes its own recording only; a lost voice is seen."""
    x = {"a": _noise(1, 5000), "b": np.full(1, 9, "<i2"), "bad": np.r_[_noise(2, 900), np.full(600, 7, "<i2")].astype("<i2")}
    chunks = waves.chunked(spark.createDataFrame([(k, 100, v.tobytes()) for k, v in x.items()], KIND), 256)
    for window, overlap in ((1000, 100), (300, 150), (256, 0)):
        vocals, failed = waves.separated(chunks, Failing, window, overlap, 256)
        got = _whole(vocals)
        assert got.keys() == {"a", "b"} and np.abs(got["a"].astype(int) - x["a"]).max() <= 1 and got["b"][0] == 9
        assert [r["sid"] for r in failed.collect()] == ["bad"]
    assert {r["sid"]: (r["silent"], r["passed"]) for r in waves.guarded(chunks, chunks).collect()}["a"] == (False, True)
    lost, _ = waves.separated(chunks, Silent, 1000, 100, 256)
    assert {r["sid"]: r["silent"] for r in waves.guarded(chunks, lost).collect()}["a"]
