"""Samples: fades, joins, tails, cuts of sounds between words; levels and events as tables."""

import numpy as np
import pytest

from cadenza.operators import audio, events, levels, prosody, silence, vectors
from cadenza.sources import wav

SR = 16000


def test_fades():
    x = np.ones(SR, np.float32)
    y = audio.edge_fades(x, SR, 0.06, 0.06)
    assert y[0] == 0 and y[-1] < 0.01 and y[SR // 2] == 1 and x[0] == 1
    assert np.array_equal(audio.edge_fades(x, SR, 0, 0), x) and len(audio.edge_fades(np.ones(10, np.float32), SR, 0.06, 0.06)) == 10


def test_joins_lose_the_crossfade():
    a, b = np.ones(1000, np.float32), np.ones(500, np.float32)
    assert len(audio.crossfade(a, b, 320)) == 1180 and np.allclose(audio.crossfade(a, b, 320), 1)
    assert len(audio.crossfade(a, b[:100], 320)) == 1100


def test_long_pauses_are_pressed():
    rng = np.random.default_rng(0)
    x = np.zeros(6 * SR, np.float32)
    for s, e in ((0.5, 1.5), (4.0, 5.0)):
        x[int(s * SR) : int(e * SR)] = rng.normal(0, 0.2, int((e - s) * SR))
    c = audio.Slicing()
    y = audio.cut_utterance(x, [(0.5, 1.8), (3.8, 5.0)], 0.3, 5.2, SR, c)
    assert 3.0 < len(y) / SR < 3.5  # two seconds of sound, 0.8 of pause, pads
    short = audio.cut_utterance(x, [(0.5, 1.5), (2.0, 2.5)], 0.5, 2.5, SR, c)
    assert abs(len(short) / SR - (2.0 - c.join_s)) < 0.001


def test_quiet_edges():
    x = np.zeros(2 * SR, np.float32)
    x[: SR // 2] = 0.3
    c = audio.Slicing()
    assert abs(audio.quiet_end(x, 1.0, SR, c) - 0.58) < 0.021
    assert audio.quiet_end(np.zeros(SR, np.float32), 1.0, SR, c) == pytest.approx(0.2)
    assert audio.quiet_end(x, 0.01, SR, c) == 0.01
    assert audio.quiet_start(x[::-1].copy(), 1.0, SR, c) == pytest.approx(1.42, abs=0.021)


def test_tails():
    loud = np.full(SR + 100, 0.3, np.float32)
    y, padded = audio.tail_silence(loud, SR, 0.3, -42)
    assert padded and len(y) - len(loud) == int(np.ceil(0.3 * SR)) and y[len(loud) - 1] == 0
    z, _ = audio.tail_silence(loud, SR, 0.3, -42, from_tail=False)
    assert abs((len(z) - len(loud)) - 0.3 * SR) <= 1
    same, padded = audio.tail_silence(np.r_[loud, np.zeros(SR, np.float32)], SR, 0.3, -42)
    assert not padded and len(same) == 2 * SR + 100
    assert audio.tail_silence(loud[:10], SR, 0.3, -42)[1] is False and audio.tail_silence(loud, SR, None, -42)[1] is False


def test_windows_and_gain():
    assert audio.windows(10, 4, 2) == [(0, 4), (2, 6), (4, 8), (6, 10)] and audio.windows(1, 4, 2) == [(0, 1)]
    assert audio.audible(np.full(4, 0.1), 4) and not audio.audible(np.full(1, 0.1), 4) and not audio.audible(np.zeros(4), 4)
    assert np.allclose(audio.apply_gain(np.array([0.1, 0.9], np.float32), 6.0), [0.19953, 1.0], atol=1e-4)


def _bursts(glued=False):
    rng = np.random.default_rng(3)
    x = np.zeros(4 * SR, np.float32)
    for s, e, a in ((0.2, 1.2, 0.3), (1.2 if glued else 1.6, 2.2, 0.2), (2.6, 3.6, 0.3)):
        x[int(s * SR) : int(e * SR)] += rng.normal(0, a, int((e - s) * SR)).astype(np.float32)
    return x


@pytest.mark.parametrize("glued", [False, True])
def test_sound_between_words_is_cut(spark, glued):
    x = _bursts(glued)
    clip = spark.createDataFrame([("c", SR, (np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())], "sid string, sr int, pcm binary")
    words = spark.createDataFrame([("c", 0, 200, 700), ("c", 1, 700, 1200), ("c", 2, 2600, 3100), ("c", 3, 3100, 3600)], "sid string, pos long, start_ms long, end_ms long")
    gaps = events.gap_windows(words, spark.createDataFrame([("c", 4000)], "sid string, dur_ms long"))
    frames = audio.clip_frames(clip)
    found = events.gap_events(frames, gaps, 20, -42.0, 4, 6, 8).where("kind = 'mid'").collect()
    if glued:
        assert [r["verdict"] for r in found] == ["no_valley_left"]
        return
    edits = events.cuts(events.gap_events(frames, gaps, 20, -42.0, 4, 6, 8), 20)
    (e,) = edits.collect()
    assert e["kind"] == "mid" and abs(e["t0"] - 1580) <= 20 and abs(e["t1"] - 2220) <= 20 and e["pad"] == 0
    y = events.cut_samples(x, SR, [(e["t0"] / 1000, e["t1"] / 1000, e["pad"] / 1000)])
    assert abs(len(y) / SR - (4 - (e["t1"] - e["t0"]) / 1000)) < 0.03
    moved = {r["pos"]: (r["start_ms"], r["end_ms"]) for r in events.shifted(words, edits).collect()}
    assert moved[1] == (700, 1200) and moved[2] == (2600 - (e["t1"] - e["t0"]), 3100 - (e["t1"] - e["t0"]))
    again = spark.createDataFrame([("c", SR, (np.clip(y, -1, 1) * 32767).astype("<i2").tobytes())], clip.schema)
    gaps = events.gap_windows(events.shifted(words, edits), spark.createDataFrame([("c", round(len(y) / SR * 1000))], "sid string, dur_ms long"))
    assert events.gap_events(audio.clip_frames(again), gaps, 20, -42.0, 4, 6, 8).where("verdict = 'cut'").count() == 0


def test_materialised_clips(spark):
    x = (np.random.default_rng(1).normal(0, 0.2, 3 * SR).clip(-1, 1) * 32767).astype("<i2").tobytes()
    rows = [("a", SR, x, 10.0, [(10.5, 11.0), (11.2, 12.0)], 10.4, 12.1)]
    df = spark.createDataFrame(rows, "sid string, sr int, pcm binary, offset_s double, members array<struct<start: double, end: double>>, start double, end double")
    (r,) = audio.materialise(df, audio.Slicing(tail_s=0.3)).collect()
    y = np.frombuffer(r["pcm"], "<i2")
    assert r["padded"] and abs(len(y) / SR - (1.7 - 0.02 + 0.3)) < 0.01 and y[0] == 0 and y[-1] == 0


def test_floors_differ(spark):
    df = spark.createDataFrame([(0.0,), (0.25,)], "ms double")
    from pyspark.sql import functions as F

    silent = df.select(*(F.round(levels.db(F.col("ms"), k), 3) for k in ("export", "frame", "prosody", "loudness"))).first()
    assert tuple(silent) == (-200.0, -120.0, -120.0, -240.0)


def test_noise_floor_of_short_clips(spark):
    rows = [("a", k, 0.01) for k in range(4)] + [("b", k, 10.0 ** -(k % 5)) for k in range(10)]
    got = {r["sid"]: r["floor_db"] for r in levels.noise_floor(spark.createDataFrame(rows, "sid string, frame int, ms double")).collect()}
    assert got["a"] == -120.0 and got["b"] == pytest.approx(-40.0)


def test_loudness_is_clamped_by_the_peak(spark):
    rows = [("a", 1, -30.0, -20.0), ("b", 1, -30.0, -0.5), ("c", 2, -20.0, -10.0)]
    p = {r["clip"]: r for r in levels.loudness_plan(spark.createDataFrame(rows, "clip string, episode int, loud double, peak double")).collect()}
    assert p["a"]["gain"] == pytest.approx(5.0) and not p["a"]["clamped"] and p["b"]["clamped"] and p["b"]["gain"] == pytest.approx(-0.5) and p["c"]["gain"] == pytest.approx(-5.0)


def test_target_cluster(spark):
    rows = [(0, 0, [1.0, 0.0, 0.0], 10), (0, 0, [1.0, 0.0, 0.0], 13), (0, 1, [0.0, 1.0, 0.0], 2), (0, 1, [0.0, 1.0, 0.0], 3)]
    stats = vectors.cluster_stats(spark.createDataFrame(rows, "idx int, label int, emb array<double>, dur int"))

    def ref(v):
        return spark.createDataFrame([(v,)], "ref array<double>")

    assert vectors.target_cluster(stats).first()["label"] == 0
    assert vectors.target_cluster(stats, ref([0.0, 1.0, 0.0])).first()["label"] == 1
    assert vectors.target_cluster(stats, ref([0.0, 0.0, 1.0])).first()["label"] is None


def test_average_linkage():
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 0.05, (6, 8)) + np.eye(8)[0], rng.normal(0, 0.05, (5, 8)) + np.eye(8)[1]
    assert vectors.average_linkage(np.r_[a, b], 0.6).tolist() == [0] * 6 + [1] * 5
    assert vectors.average_linkage(a[:1], 0.6).tolist() == [0]


def test_purity_runs(spark):
    sims = [0.9, 0.1, 0.2, 0.9, 0.1, 0.1, 0.1, 0.04]
    df = spark.createDataFrame([(1, k, s) for k, s in enumerate(sims)] + [(2, 0, 0.9)], "utt int, pos int, sim double")
    got = {r["utt"]: (r["longest"], r["flagged"], r["severe"]) for r in vectors.purity(df).collect()}
    assert got == {1: (4, True, True), 2: (0, False, False)}


def test_small_datasets_have_bounds_or_none(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "utt long, emb array<double>")
    assert vectors.robust_centroid(one).count() == 0  # nothing lies above the lowest tenth of one
    empty = spark.createDataFrame([], "head_ms long, tail_ms long")
    assert tuple(silence.bounds(empty).first()) == (None, None)
    rates = spark.createDataFrame([("a", 1.0), ("b", 99.0), ("c", 1.0)], "sid string, cps double")
    assert prosody.rate_outliers(rates).count() == 0


def test_levels_are_fifths(spark):
    df = spark.createDataFrame([(k, float(k), float(k), float(k)) for k in range(10)], "sid int, f0_std double, f0_range double, energy_std double")
    got = {r["sid"]: r["prosody_level"] for r in prosody.scores(df).collect()}
    q = np.percentile(np.arange(10), [20, 40, 60, 80])
    assert got == {k: int(np.searchsorted(q, k) + 1) for k in range(10)}


def test_prosody_of_a_tone():
    t = np.arange(2 * SR) / SR
    x = (0.3 * np.sin(2 * np.pi * 200 * t) * (np.abs(t - 1) > 0.2)).astype(np.float32)
    f0 = audio.pitch(x, SR)
    m = prosody.measure(x, SR, f0, 12)
    assert m["f0_mean"] == pytest.approx(200, rel=0.02) and 0.1 < m["pause_ratio"] < 0.3 and m["cps"] == pytest.approx(6, rel=0.1)
    assert prosody.measure(x, SR, np.zeros(5), 1) == {"error": "no_voiced_f0"}


def test_speech_spans():
    spans = audio.energy_speech(_bursts(), SR)
    assert len(spans) == 3 and abs(spans[0][0] - 0.14) < 0.03
    assert audio.energy_speech(np.zeros(SR, np.float32), SR) == []


def test_previews(spark):
    rows = [(1, 0, i, i * 10000, i * 10000 + d) for i, d in enumerate((9000, 4000, 4000, 4000, 4000))]
    df = spark.createDataFrame(rows, "idx int, label int, i long, start_ms long, end_ms long")
    got = sorted((r["i"], r["end_ms"] - r["start_ms"]) for r in vectors.previews(df).collect())
    assert got == [(0, 5000), (1, 4000), (2, 4000)]


def test_other_rates_and_lengths():
    t = np.arange(16000) / 16000
    x = np.sin(2 * np.pi * 200 * t).astype(np.float32)
    for to in (8000, 44100):
        y = audio.resampled(x, 16000, to)
        assert len(y) == to and np.abs(y - np.sin(2 * np.pi * 200 * np.arange(to) / to))[: to - to // 100].max() < 0.02
    high = audio.resampled(np.tile(np.float32([1, -1]), 8000), 16000, 8000)
    assert np.abs(high[1:-1]).max() < 0.5
    assert audio.resampled(x[:0], 16000, 8000).size == 0 and audio.resampled(x, 16000, 16000) is x
    assert audio.of_length(x, 5).tolist() == x[:5].tolist() and audio.of_length(x[:2], 4).tolist() == [*x[:2].tolist(), 0, 0]


def test_clips_change_rate_and_gain(spark):
    pcm = np.arange(-400, 400, dtype="<i2")
    clips = spark.createDataFrame([("a", 16000, pcm.tobytes()), ("b", 8000, pcm.tobytes()), ("c", None, None)], "sid string, sr int, pcm binary")
    got = {r["sid"]: r for r in audio.at_rate(clips, 8000).collect()}
    assert len(got["a"]["pcm"]) == len(pcm) and got["a"]["sr"] == 8000 and bytes(got["b"]["pcm"]) == pcm.tobytes() and got["c"]["pcm"] is None
    gains = spark.createDataFrame([("a", 20.0), ("b", None)], "sid string, gain_db double")
    got = {r["sid"]: r for r in audio.with_gains(clips, gains).collect()}
    assert np.abs(np.frombuffer(got["a"]["pcm"], "<i2") - 10 * pcm.astype(int)).max() <= 1
    assert bytes(got["b"]["pcm"]) == pcm.tobytes() and got["c"]["sr"] is None


def test_clips_become_files(spark, tmp_path):
    pcm = {f"c{k}": np.arange(-k, 50 * k, dtype="<i2").tobytes() for k in range(20)}
    rows = [(k, 16000, v) for k, v in pcm.items()] + [("none", 16000, None), (None, 16000, b"")]
    clips = spark.createDataFrame(rows, "sid string, sr int, pcm binary").repartition(4)
    folder = tmp_path / "wavs"
    for _ in range(2):  # writing again replaces
        assert wav.write_files(clips, folder.as_uri()) == len(pcm)
        assert sorted(p.name for p in folder.iterdir()) == sorted(f"{k}.wav" for k in pcm)
    for k, v in pcm.items():
        assert folder.joinpath(f"{k}.wav").read_bytes() == wav.encode(16000, v)
    got = {r["sid"]: r for r in wav.read_clips(spark, str(folder)).collect()}
    assert got.keys() == pcm.keys() and all(r["error"] is None and r["sr"] == 16000 and len(r["pcm"]) == len(pcm[k]) for k, r in got.items())
    twice = clips.where("sid = 'c3'")
    assert wav.write_files(twice.union(twice), folder.as_uri()) == 2 and len(list(folder.iterdir())) == len(pcm)
    assert wav.write_files(clips.limit(0), folder.as_uri()) == 0
    with pytest.raises(Exception, match="slash"):
        wav.write_files(spark.createDataFrame([("../x", 16000, b"")], clips.schema), folder.as_uri())
