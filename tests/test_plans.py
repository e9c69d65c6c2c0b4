"""Sources, snapshots, providers, the pipeline, streaming, freshness, and the registered queries."""

import json

import numpy as np
import pytest

from cadenza import config, providers
from cadenza.operators import export, freshness, levels, removal, segments
from cadenza.plans import pipeline
from cadenza.sources import metadata as md
from cadenza.sources import wav
from cadenza.sources.snapshots import Snapshots
from cadenza.streaming import ingest
from tests.test_segments import SCHEMA, gapped, made, packed


def test_metadata_keeps_later_pipes(spark, tmp_path):
    rows = [("b_2", "x|y|z"), ("a_1", "hello\nthere")]
    meta = spark.createDataFrame(rows, "sid string, text string")
    lines = md.filelist_lines(meta, "spk")
    md.write_lines(lines, str(tmp_path / "list"))
    got = spark.read.text(str(tmp_path / "list")).withColumnRenamed("value", "line")
    assert sorted(tuple(r) for r in md.parse_filelist(got).select("sid", "speaker", "text").collect()) == [("a_1", "spk", "hello there"), ("b_2", "spk", "x|y|z")]
    raw = spark.createDataFrame([("a|b|c",), ("alone",)], "line string")
    assert [tuple(r) for r in md.parse_metadata(raw).collect()] == [("a", "b|c"), ("alone", None)]


def test_alignments(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    lines = [{"id": "x", "text": "old", "items": []}, {"id": "x", "text": "new", "items": [["n", 0.0, 0.5], ["ew", 0.5, 1]]}]
    path.write_text("\n".join(json.dumps(x) for x in lines) + '\n{"id": "y", "te')
    (r,) = md.read_alignments(spark, str(path), strict=False).collect()
    assert r["text"] == "new" and [tuple(i) for i in r["items"]] == [("n", 0.0, 0.5), ("ew", 0.5, 1.0)]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        md.read_alignments(spark, str(path)).collect()


def test_alignments_of_several_runs(spark, tmp_path):
    path, schema = str(tmp_path / "aligned"), "id string, text string, items array<struct<token: string, start: double, end: double>>"
    first = spark.createDataFrame([("x", 'a "q" \\', [("你", 0.0, 0.5), ("\n", 0.5, None)]), ("y", None, None)], schema)
    md.append_alignments(first, path, 1)
    md.append_alignments(spark.createDataFrame([("z", "", [])], schema), path, 10)
    for _ in range(2):  # a run that is repeated leaves no lines twice
        md.append_alignments(spark.createDataFrame([("z", "newer", [("n", 0.0, 1e-7)])], schema), path, 11)
    assert spark.read.text(path).count() == 4
    got = {r["id"]: (r["text"], r["items"] and [tuple(i) for i in r["items"]]) for r in md.read_alignments(spark, path).collect()}
    assert got == {"x": ('a "q" \\', [("你", 0.0, 0.5), ("\n", 0.5, None)]), "y": (None, None), "z": ("newer", [("n", 0.0, 1e-7)])}
    ids = spark.createDataFrame([("x",), ("w",)], "id string")
    assert [r["id"] for r in removal.todo(ids, md.read_alignments(spark, path, strict=False), "id").collect()] == ["w"]


def test_reports(spark, tmp_path):
    seg = {"i": 0, "start": 0.5, "end": 1.25, "text": "你好", "logprob": -0.1, "kept": True, "cluster": 0}
    (tmp_path / "r1.json").write_text(json.dumps({"episode": "001", "segments": [seg], "spk_clusters": {"0": {"dur": 1.0, "n": 1}}}, indent=1))
    (tmp_path / "r2.json").write_text(json.dumps({"episode": "002", "segments": []}))
    rows = md.report_segments(md.read_reports(spark, str(tmp_path))).collect()
    assert [(r["idx"], r["start_ms"], r["end_ms"]) for r in rows] == [("001", 500, 1250)]


def test_ids(spark, tmp_path):
    (tmp_path / "ids").write_text("b\n\n a \nc\n")
    assert [r["id"] for r in md.first_ids(md.read_ids(spark, str(tmp_path / "ids")), 2).collect()] == ["a", "b"]


def test_wav_files(spark, tmp_path):
    x = (np.sin(np.arange(16000) / 10) * 20000).astype("<i2")
    (tmp_path / "a.wav").write_bytes(wav.encode(16000, x.tobytes()))
    (tmp_path / "bad.wav").write_bytes(b"nothing")
    (clip,) = [r for r in wav.read_clips(spark, str(tmp_path)).collect() if r["sid"] == "a"]
    assert clip["sr"] == 16000 and np.abs(np.frombuffer(clip["pcm"], "<i2").astype(int) - x).max() <= 1
    assert [r["error"] is not None for r in wav.read_clips(spark, str(tmp_path)).where("sid = 'bad'").collect()] == [True]
    (tmp_path / "bad.wav").unlink()
    assert [tuple(r) for r in wav.read_headers(spark, str(tmp_path)).collect()] == [("a", 16000, 1, 16000)]
    out = str(tmp_path / "packed")
    clips = wav.read_clips(spark, str(tmp_path)).drop("error")
    assert wav.write_wavs(clips, out) == 1
    assert wav.decode(bytes(wav.read_packed(spark, out).first()["content"]))[0] == 16000


def test_snapshots_never_bring_rows_back(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        s.read()
    s.commit(spark.range(5).withColumnRenamed("id", "sid"))
    for gone in (1, 3):
        s.commit(removal.without(s.read(), spark.createDataFrame([(gone,)], "sid long"), "sid"))
    assert sorted(r["sid"] for r in s.read().collect()) == [0, 2, 4] and s.versions() == [1, 2, 3] and s.read(1).count() == 5
    (tmp_path / "t/v4").mkdir()
    assert s.versions() == [1, 2, 3]  # not written completely


def test_freshness(spark):
    kind = "sid string, frames long"
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], kind)
    freshness.require_fresh(spark.createDataFrame([("a", 1), ("b", 2)], kind), old, "x")
    for now in ([("a", 9)], [("d", 1)], [("a", -1)]):
        with pytest.raises(freshness.StaleArtifact):
            freshness.require_fresh(spark.createDataFrame(now, kind), old, "x")
    with pytest.raises(freshness.StaleArtifact):
        freshness.require_fresh(old, None, "x")
    fp = freshness.dataset_fingerprint(spark.createDataFrame([("a",), ("z",)], "sid string"), old)
    assert sorted(tuple(r) for r in fp.collect()) == [("a", 1), ("z", -1)]
    import hashlib

    files = spark.createDataFrame([("b", "2"), ("a", "1")], "name string, hash string")
    assert freshness.files_hash(files).first()["fp"] == hashlib.sha1(b"a:1|b:2").hexdigest()[:16]


def test_config(tmp_path):
    p = config.parse_project('{"name": "p", "group": {"max_gap": 3000}, "loudness": {"target_db": -20.0}}')
    assert p.of("group").max_gap == 3000 and p.of("group").max_dur == 29000 and p.of("loudness").target_db == -20.0 and p.of("export").pad_ms == 200
    for bad in ('{"name": "p", "group": {"nope": 1}}', '{"name": "p", "nope": 1}'):
        with pytest.raises(TypeError):
            config.parse_project(bad)
    for name in ("b", "a"):
        (tmp_path / f"{name}.json").write_text("{}")
    assert config.list_projects(str(tmp_path)) == ["a", "b"]


def _workspace(spark, tmp_path, rows):
    w = pipeline.Workspace(spark, config.Project("p", out_root=str(tmp_path), prefix="p"))
    w.table("segments").commit(spark.createDataFrame(rows, SCHEMA))
    return w


def test_pipeline_plans_then_applies(spark, tmp_path):
    rows = [r for r in made(3, 60) if r[3] - r[2] <= 15000]
    w = _workspace(spark, tmp_path, rows)
    before = pipeline.plan(w, "merge-prep")["packed"].count()
    assert w.table("packed").versions() == [] and before == len(packed(gapped(rows), w.project.of("group")))
    assert pipeline.run_all(w) == {"group": 1, "group-apply": 1, "export": 1}
    manifest = w.table("manifest").read()
    sids = [r["sid"] for r in manifest.collect()]
    assert len(set(sids)) == len(sids) > 5 and all(s.startswith("p") for s in sids)
    w.table("flags").commit(spark.createDataFrame([(sids[0],)], "sid string"))
    assert pipeline.apply(w, "prune") == 2 and w.table("manifest").read().count() == len(sids) - 1
    assert [r["sid"] for r in w.read("removed").collect()] == [sids[0]]
    w.table("manifest").commit(manifest.withColumn("length_ms", manifest["length_ms"] + 1))
    with pytest.raises(freshness.StaleArtifact):
        pipeline.apply(w, "prune")


def test_tails_need_one_generation(spark, tmp_path):
    """Texts whose clip ends by force get a comma; groups of another generation are refused before anything is changed."""
    w = _workspace(spark, tmp_path, [r for r in made(3, 60) if r[3] - r[2] <= 15000])
    pipeline.run_all(w)
    ends = {r["sid"]: r["forced"] for r in export.forced_ends(w.read("manifest"), segments.gaps(w.read("segments"))).collect()}
    w.table("metadata").commit(spark.createDataFrame([(s, "好。") for s in ends], "sid string, text string"))
    assert pipeline.apply(w, "fix-tail-punct") == 2
    assert {r["sid"]: r["text"] for r in w.read("metadata").collect()} == {s: "好," if f else "好。" for s, f in ends.items()} and 0 < sum(ends.values()) < len(ends)
    groups = w.read("groups")
    for other in (groups.where("pos > 0"), groups.withColumn("i", groups["i"] + 1), groups.where("gid > 2")):
        w.table("groups").commit(other)
        with pytest.raises(ValueError, match="generations"):
            pipeline.apply(w, "tails")
    assert w.table("metadata").versions() == [1, 2]


def test_checks_fill_the_flags(spark, tmp_path):
    """Silence and speaker flags stand side by side, and a second run replaces those of its own source."""
    w = pipeline.Workspace(spark, config.Project("p", out_root=str(tmp_path)))
    times = {f"s{k}": [(0, 80), (1000, 1080), (2400, 2480)] if k == 3 else [(100 * p, 100 * p + 80) for p in range(3)] for k in range(12)}
    w.table("metadata").commit(spark.createDataFrame([(s, "甲，乙，丙。") for s in times], "sid string, text string"))
    w.table("durations").commit(spark.createDataFrame([(f"s{k}", 2400 if k == 5 else 400 if k != 3 else 2600) for k in range(12)], "sid string, dur_ms long"))
    pipeline.take_alignments(w, spark.createDataFrame([(s, "甲，乙，丙。", [(c, a / 1000, b / 1000) for c, (a, b) in zip("甲乙丙", t)]) for s, t in times.items()], f"sid string, text string, items {pipeline.ITEMS}"))
    rng = np.random.default_rng(1)
    base, other = rng.normal(size=8), rng.normal(size=8)
    vecs = [(f"s{k}", p, ((other if k == 7 else base) + rng.normal(size=8) * 0.05).tolist()) for k in range(12) for p in range(6)]
    w.table("windows").commit(spark.createDataFrame(vecs, "utt string, pos long, emb array<double>"))
    w.table("metrics").commit(spark.createDataFrame([(f"s{k}", float(k), 1.0, 2.0) for k in range(12)], "sid string, f0_std double, f0_range double, energy_std double"))
    w.table("levels").commit(spark.createDataFrame([(f"s{k}", k % 2, -20.0 - k % 2 * 6, -3.0) for k in range(12)], "clip string, episode int, loud double, peak double"))
    assert pipeline.run_all(w) == {"punct": 2, "silence": 1, "speaker": 2, "prosody": 1, "loudness": 1}
    flags = {(r["sid"], r["source"]) for r in w.read("flags").collect()}
    assert ("s3", "silence") in flags and ("s5", "silence") in flags and {x for x in flags if x[1] == "speaker"} == {("s7", "speaker")}
    again = pipeline._flagged(w, "silence", w.read("flags").where("source = 'silence'").select("sid", "reason"))
    assert {(r["sid"], r["source"]) for r in again.collect()} == flags
    assert {r["prosody_level"] for r in w.read("prosody").collect()} == {1, 2, 3, 4, 5}
    assert {(r["episode"], round(r["gain"], 6)) for r in w.read("gains").collect()} == {(0, -3.0), (1, 2.0)}  # the peak allows 2 dB


def test_cuts_are_verified(spark, tmp_path):
    """A sound between words is cut; frames after the cut must hold nothing more to cut, or nothing is applied."""
    w = pipeline.Workspace(spark, config.Project("p", out_root=str(tmp_path)))
    w.table("metadata").commit(spark.createDataFrame([("a", "甲乙")], "sid string, text string"))
    w.table("durations").commit(spark.createDataFrame([("a", 2400)], "sid string, dur_ms long"))
    pipeline.take_alignments(w, spark.createDataFrame([("a", "甲乙", [("甲", 0.0, 0.4), ("乙", 2.0, 2.4)])], f"sid string, text string, items {pipeline.ITEMS}"))
    loud = {*range(0, 20), *range(50, 65), *range(100, 120)}
    w.table("frames").commit(spark.createDataFrame([("a", k, 0.1 if k in loud else 1e-9) for k in range(120)], "sid string, frame int, ms double"))
    (cut,) = pipeline.plan(w, "para-cut")["cuts"].collect()
    assert (cut["t0"], cut["t1"]) == (980, 1320)
    for after, good in (([k for k in range(120) if not 49 <= k < 66], True), (list(range(120)), False)):
        w.table("frames-after").commit(spark.createDataFrame([("a", n, 0.1 if k in loud else 1e-9) for n, k in enumerate(after)], "sid string, frame int, ms double"))
        w.table("durations-after").commit(spark.createDataFrame([("a", 20 * len(after))], "sid string, dur_ms long"))
        assert pipeline.plan(w, "nonspeech")["leftovers"].isEmpty() == good
    with pytest.raises(ValueError, match="leftovers"):
        pipeline.apply(w, "nonspeech")


def test_marks_are_repaired_by_stage(spark, tmp_path):
    w = pipeline.Workspace(spark, config.Project("p", out_root=str(tmp_path)))
    w.table("metadata").commit(spark.createDataFrame([("a", "你好"), ("b", "旧")], "sid string, text string"))
    pipeline.take_alignments(w, spark.createDataFrame([("a", "你好", [("你", 0.0, 0.2), ("好", 1.0, 1.2)])], f"sid string, text string, items {pipeline.ITEMS}"))
    out = pipeline.plan(w, "fix-punct")
    assert {r["sid"]: r["text"] for r in out["metadata"].collect()} == {"a": "你，好", "b": "旧"} and out["samples"].count() == 1
    assert pipeline.apply(w, "punct") == 2


def test_pipeline_refuses_broken_groups(spark, tmp_path):
    w = _workspace(spark, tmp_path, [(0, 0, 0, 40000, True)])
    pipeline.apply(w, "group")
    with pytest.raises(ValueError, match="break rules"):
        pipeline.apply(w, "group-apply")


def test_streaming_ingest(spark, tmp_path):
    rows = made(4, 40)
    src, store, groups, check = (str(tmp_path / n) for n in ("src", "store", "groups", "check"))
    for part in ([r for r in rows if r[1] < 25], [r for r in rows if r[1] >= 25 and r[0] != 1], rows[:5]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(src)
        ingest.ingest(ingest.read_segments(spark, src), store, groups, check).awaitTermination()
    seen = [r for r in rows if r[1] < 25 or r[0] != 1]
    assert sorted(tuple(r) for r in ingest.latest_groups(spark, groups).select("idx", "gid", "pos", "i").collect()) == packed(gapped(seen), ingest.grouping.Packing())


class Flaky:
    batch = 4

    def __call__(self, inputs):
        if any(x["n"] == 3 for x in inputs):
            raise RuntimeError("bad item")
        return [{"twice": 2 * x["n"]} for x in inputs]


def test_a_bad_item_takes_no_others_with_it(spark):
    got = {r["n"]: (r["twice"], r["error"]) for r in providers.apply(spark.range(8).withColumnRenamed("id", "n"), Flaky, "twice long", "n", 2, wait_s=0).collect()}
    assert got[3] == (None, "RuntimeError: bad item") and all(got[k] == (2 * k, None) for k in range(8) if k != 3)


class Listener:
    batch = 2

    def __call__(self, inputs):
        return [{"reply": x["reply"]} for x in inputs]


def test_audits_never_end_in_nothing(spark):
    rows = [("a", '```json\n{"verdict": "keep", "reason": "fine"}\n```'), ("b", '{"verdict": "odd"}'), ("c", "no json")]
    got = {r["sid"]: r["verdict"] for r in providers.audits(spark.createDataFrame(rows, "sid string, reply string"), Listener, attempts=1, wait_s=0).collect()}
    assert got == {"a": "keep", "b": "error", "c": "error"}
    assert sorted(tuple(r) for r in removal.verdicts(spark.createDataFrame(list(got.items()), "sid string, verdict string")).collect()) == [("error", 2), ("keep", 1)]


def test_stand_ins():
    a, b, c = providers.HashVectors()([{"voice": "x"}, {"voice": "x"}, {"voice": "y"}])
    assert a == b != c
    (e,) = providers.EvenAlignment()([{"text": "你，好", "dur_s": 1.0}])
    assert [i["token"] for i in e["items"]] == ["你", "好"] and e["items"][1]["end"] == 1.0
    x = np.r_[np.zeros(8000), np.full(8000, 3000)].astype("<i2").tobytes()
    assert len(providers.EnergySpeech()([{"sr": 16000, "pcm": x}])[0]["spans"]) == 1


def test_enhanced_clips(spark):
    rows = [("a", 0.95, -40.0, -60.0), ("b", 0.5, -40.0, -70.0), ("c", None, -40.0, -50.0)]
    got = {r["sid"]: (r["accepted"], r["floor_gain"]) for r in providers.accept_enhanced(spark.createDataFrame(rows, "sid string, sim double, floor_before double, floor_after double")).collect()}
    assert got == {"a": (True, 20.0), "b": (False, 30.0), "c": (False, 10.0)}


def test_enhancement_summary(spark):
    rows = [("a", 0.9, -40.0, -60.0), ("b", 0.5, -40.0, -70.0), ("c", None, -40.0, -45.0)]
    df = providers.accept_enhanced(spark.createDataFrame(rows, "sid string, sim double, floor_before double, floor_after double"))
    assert tuple(levels.enhancement_summary(df).first()) == (1, 2, 0.7, 20.0)
    assert tuple(levels.enhancement_summary(df.where("false")).first()) == (0, 0, None, None)
