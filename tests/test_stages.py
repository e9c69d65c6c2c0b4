"""From WAV files to clips, stage by stage; commits of several tables, staleness, and jobs that die."""

import numpy as np
import pytest

from cadenza import config, providers
from cadenza.operators import freshness, waves
from cadenza.plans import pipeline
from cadenza.sources import generations, journal, wav, wavsource
from cadenza.sources.generations import Generations

SR = 8000
KIND = "sid string, sr int, pcm binary"


class Voices:
    """Vectors by pitch: the share of crossings of zero."""

    batch = 8

    def __call__(self, inputs):
        out = []
        for x in inputs:
            y = np.frombuffer(x["pcm"], "<i2").astype(float)
            a = np.pi * min(1.0, 8 * np.mean(np.diff(np.sign(y)) != 0))
            out.append({"emb": [float(np.cos(a)), float(np.sin(a))]})
        return out


class Writer:
    batch = 4

    def __call__(self, inputs):
        return [{"text": " 你好。"} for _ in inputs]


class Aligner:
    """The characters stand where the sound is loud."""

    batch = 2

    def __call__(self, inputs):
        out = []
        for x in inputs:
            chars = [c for c in x["text"] if c not in "，。,"]
            y = np.abs(np.frombuffer(x["pcm"], "<i2").astype(float))
            on = np.flatnonzero(y > 3000)
            cut = np.flatnonzero(np.diff(on) > SR // 5)
            spans = list(zip(on[np.r_[0, cut + 1]], on[np.r_[cut, len(on) - 1]]))
            spans = [(a, b) for a, b in spans if b - a > SR]  # words are long, clicks are short
            per = len(chars) // len(spans)
            items = [{"token": chars[k * per + j], "start": (a + (b - a) * j / per) / SR, "end": (a + (b - a) * (j + 1) / per) / SR} for k, (a, b) in enumerate(spans) for j in range(per)]
            out.append({"items": items})
        return out


class Listener:
    batch = 1

    def __call__(self, inputs):
        return [{"reply": '{"verdict": "%s"}' % ("drop" if "0001" in x["sid"] else "keep")} for x in inputs]


class Softer:
    batch = 4

    def __call__(self, inputs):
        return [{"new_sr": x["sr"], "new_pcm": (np.frombuffer(x["pcm"], "<i2") // 2).astype("<i2").tobytes()} for x in inputs]


MODELS = {"speech": providers.EnergySpeech, "vectors": Voices, "recognise": Writer, "align": Aligner, "listen": Listener, "enhance": Softer}


def _tone(seconds, hz, loud=0.3):
    return loud * np.sin(2 * np.pi * hz * np.arange(int(seconds * SR)) / SR)


def _episode(k):
    """Seven stretches of one voice and one of another, a second apart; a click in one of the pauses."""
    parts = [_tone(0.5, 100, 0.0)]
    for n in range(8):
        parts += [_tone(3, 1510 if n == 5 else 213 + 10 * k), _tone(1, 100, 0.0)]
        if n == 1:
            parts[-1][int(0.4 * SR) : int(0.65 * SR)] = _tone(0.25, 300, 0.2)
    return np.concatenate(parts).astype(np.float32)


@pytest.fixture
def w(spark, tmp_path):
    (tmp_path / "src").mkdir()
    for k in range(2):
        (tmp_path / "src" / f"{k:03d}.wav").write_bytes(wav.encode(SR, waves.pcm16(_episode(k))))
    project = config.Project("p", out_root=str(tmp_path / "out"), prefix="p")
    w = pipeline.Workspace(spark, project, MODELS)
    w.table("episodes").commit(wavsource.chunks(spark, str(tmp_path / "src"), samples=waves.SIZE))
    return w


def test_from_recordings_to_clips(spark, w, tmp_path, monkeypatch):
    done = pipeline.run_all(w, pipeline.MAIN)
    assert list(done) == list(pipeline.MAIN)
    segs = w.read("segments").collect()
    assert {(r["idx"], r["kept"]) for r in segs} == {("000", True), ("000", False), ("001", True), ("001", False)} and sum(not r["kept"] for r in segs) == 2
    clips = {r["sid"]: np.frombuffer(bytes(r["pcm"]), "<i2").astype(float) / 32768 for r in w.clips().collect()}
    manifest = {r["sid"]: r for r in w.read("manifest").collect()}
    assert clips.keys() == manifest.keys() and len(clips) >= 4
    for sid, x in clips.items():
        assert 2 <= len(x) / SR <= 30 and abs(x[0]) < 1e-3 and abs(x[-1]) < 1e-3
        assert abs(len(x) / SR * 1000 - (manifest[sid]["length_ms"] + 400)) < 450  # pads on both sides
    assert w.read("previews").count() == 4 and w.tables.report("export/summary").first()["n"] == len(clips)
    texts = {r["sid"]: r["text"] for r in w.read("metadata").collect()}
    assert texts.keys() == clips.keys(), texts
    assert all(t.replace("，", "").startswith("你好") and ",," not in t for t in texts.values()), texts
    assert wav.write_files(w.clips(), f"{tmp_path}/wavs") == len(clips)
    heads = {r["sid"]: r["frames"] for r in wav.read_headers(spark, f"{tmp_path}/wavs").collect()}
    assert heads == {s: len(x) for s, x in clips.items()}

    # a click between words goes; the alignments of cut clips go with it and are stale until they are made anew
    pipeline.apply(w, "silence")
    pipeline.apply(w, "remove-nonspeech")
    after = {r["sid"]: len(r["pcm"]) // 2 for r in w.clips().collect()}
    cut = {s for s in after if after[s] < len(clips[s])}
    assert cut and cut == {r["sid"] for r in w.read("cuts").select("sid").distinct().collect()} and w.tables.report("nonspeech/edited").first()["n"] == len(cut)
    assert {r["sid"] for r in w.read("alignments").collect()} == clips.keys() - cut
    for stage in ("punct", "silence", "nonspeech"):
        with pytest.raises(freshness.StaleArtifact):
            pipeline.apply(w, stage)
    before = w.read("alignments").count()
    pipeline.apply(w, "align")
    assert w.tables.report("align/coverage").first()["asked"] == len(cut) and w.read("alignments").count() == before + len(cut)
    assert pipeline.plan(w, "nonspeech")["cuts"].isEmpty()

    pipeline.apply(w, "loudnorm")
    gains = {r["clip"]: r for r in w.read("gains").collect()}
    loud = {r["sid"]: np.abs(np.frombuffer(bytes(r["pcm"]), "<i2")).max() for r in w.clips().collect()}
    assert gains.keys() == clips.keys() and all(abs(20 * np.log10(loud[s] / 32768) - (g["gain"] + 20 * np.log10(0.3))) < 0.5 for s, g in gains.items())
    pipeline.apply(w, "denoise")
    assert w.read("enhanced").where("accepted").count() == len(clips) and all(np.abs(np.frombuffer(bytes(r["pcm"]), "<i2")).max() < 0.6 * loud[r["sid"]] for r in w.clips().collect())
    assert pipeline.apply(w, "speaker") and pipeline.apply(w, "prosody")
    assert w.read("prosody").count() + w.tables.report("prosody/failed").count() == len(clips)

    # the audit is kept round by round; what is dropped leaves every table
    monkeypatch.setattr(pipeline, "AUDIT_ROUND", 2)
    pipeline.apply(w, "qa-llm")
    dropped = {r["sid"] for r in w.read("audits").where("verdict = 'drop'").collect()}
    assert dropped and w.read("audits").count() == len(clips)
    w.table("flags").commit(w.read("flags").where("source = 'audit'"))
    pipeline.apply(w, "prune")
    for t in ("manifest", "metadata", "clips", "alignments", "members"):
        assert {r["sid"] for r in w.read(t).select("sid").collect()} == clips.keys() - dropped, t
    pipeline.apply(w, "silence")  # what was removed leaves the rest fresh


def test_a_job_that_dies_leaves_the_old_generation(spark, tmp_path, monkeypatch):
    g = Generations(spark, str(tmp_path))
    g.commit({"a": spark.range(1), "b": spark.range(1)}, "one")
    broken = spark.range(5).selectExpr("if(id < 3, id, cast(raise_error('assert') as bigint)) as x")
    with pytest.raises(Exception, match="(?i)assert"):
        g.commit({"a": spark.range(2), "b": broken}, "two")
    assert (g.read("a").count(), g.read("b").count(), g.numbers()) == (1, 1, [1])
    monkeypatch.setattr(Generations, "_publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        g.commit({"a": spark.range(3), "b": spark.range(3)}, "three")
    monkeypatch.undo()
    assert (g.read("a").count(), g.read("b").count(), g.numbers()) == (1, 1, [1])
    new = g.commit({"a": spark.range(4)}, "four", ("b",), reports={"sizes": spark.range(2)})
    assert new["number"] == 2 and g.read("a").count() == 4 and g.read("b").count() == 1 and g.report("four/sizes").count() == 2
    assert g.table("a").versions() == [1, 4] and g.behind() == {}
    g.table("b").commit(spark.range(7))
    assert g.behind() == {"a": ["b"]}
    with pytest.raises(generations.ConcurrentCommit):
        g._publish(2, "{}")
    g.commit({}, drop=("a",))
    assert not g.has("a") and g.vacuum(1) == ["a/v1", "a/v2", "a/v3", "a/v4", "b/v1", "b/v2", "b/v3"] and g.read("b").count() == 7


def test_rounds_are_asked_once(spark, tmp_path):
    """Killed in the second of several rounds: only what had no complete round is asked again."""
    schema = "sid string, verdict string"
    todo, book = spark.createDataFrame([(f"s{k}",) for k in range(40)], "sid string"), journal.Journal(spark, str(tmp_path / "j"))
    calls = []

    def ask(part):
        calls.append(part.count())
        if len(calls) == 2:
            raise RuntimeError("killed")
        return part.selectExpr("sid", "'keep' as verdict")

    with pytest.raises(RuntimeError):
        journal.in_rounds(book, todo, ask, "sid", 10, 2)
    assert book.rows(schema).count() == calls[0] and 0 < calls[0] < 40
    left = todo.join(book.rows(schema), "sid", "left_anti")
    assert journal.in_rounds(book, left, ask, "sid", 10, 2) == -(-(40 - calls[0]) // 10)
    rows = book.rows(schema).collect()
    assert sorted(r["sid"] for r in rows) == sorted(f"s{k}" for k in range(40)) and {r["n"] for r in rows} <= {*book.rounds()}


def test_order_follows_tables():
    assert pipeline.order(("export", "group-apply", "group", "extract")) == ["extract", "group", "group-apply", "export"]
    assert pipeline.order(pipeline.MAIN) == list(pipeline.MAIN) and pipeline.order(("cut", "stage1")) == ["extract", "export"]
    assert pipeline.order() == list(pipeline.ALL) and pipeline.makers()["metadata"] == "export" and pipeline.makers()["alignments"] == "align"


def test_separation_smoke(spark):
    from cadenza.__main__ import separation_smoke

    class Silent:
        batch = 1

        def __call__(self, inputs):
            return [{"vocals": bytes(len(x["pcm"]))} for x in inputs]

    assert separation_smoke(spark) and not separation_smoke(spark, Silent)
