"""Stages of the corpus: a graph of tables, a report first and an apply step, freshness stamps, and one commit for all that changes.

``plan`` of a stage gives DataFrames and changes nothing (a stage that asks a paid model keeps its answers in a journal);
``apply`` commits all tables that the stage changes at once, with its reports as JSON and the versions it was made from. A
stage refuses to apply to something stale: clips that are new or of another length since they were exported or aligned.

Tables, of which a stage reads the newest generation: episodes (sid = idx, chunk, sr, pcm: recordings in chunks), segments (idx, i,
start_ms, end_ms, kept), transcripts (idx, i, text), packed and groups (idx, gid, pos, i), splits-1, -2 and -model (idx, gid, part, pos, i),
manifest, members (sid, pos, i), metadata (sid, text), clips (sid, sr, pcm), alignments (sid, text, items), flags (sid, source, reason),
and, where there are no clips to measure, durations (sid, dur_ms), frames (sid, frame, ms), windows (utt, pos, emb), metrics
(sid, f0_std, f0_range, energy_std) and levels (clip, episode, loud, peak).

Models are given to the workspace by name, as functions without arguments that make a provider: speech (sr, pcm; spans), vectors
(sr, pcm; emb), recognise (sr, pcm; text), group (messages; reply), align (sr, pcm, text, dur_s; text, items), enhance (sr, pcm; sr, pcm) and
listen (sr, pcm, prompt; reply).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadenza import providers
from cadenza.config import Project
from cadenza.functions import ordered
from cadenza.functions.text import join_texts
from cadenza.operators import audio, events, export, freshness, grouping, levels, prosody, removal, segments, semantic, silence, text, vectors, waves, words
from cadenza.sources.generations import Generations, Table
from cadenza.sources.journal import Journal, in_rounds
from cadenza.sources.scratch import Scratch

ALL = ("extract", "group", "group-llm", "group-apply", "export", "align", "punct", "tails", "silence", "speaker", "denoise", "prosody", "nonspeech", "loudness", "audit", "prune")
#: What ``all`` runs: from recordings to repaired transcripts. The other stages are asked for one by one.
MAIN = ("extract", "group", "group-apply", "export", "align", "punct")
# Names under which scripts call these stages.
ALIASES = {
    "stage1": "extract", "merge-prep": "group", "merge-llm": "group-llm", "merge-apply": "group-apply", "cut": "export", "qa": "prune", "fix-punct": "punct", "punct-fix": "punct",
    "fix-tail-punct": "tails", "tail-punct": "tails", "qa-silence": "silence", "silence-qa": "silence", "qa-speaker": "speaker", "qa-prosody": "prosody", "remove-nonspeech": "nonspeech",
    "para-cut": "nonspeech", "loudnorm": "loudness", "qa-llm": "audit", "llm-audit": "audit",
}
ITEMS = "array<struct<token: string, start: double, end: double>>"
Outputs = dict[str, DataFrame]


@dataclass
class Workspace:
    """Tables of a project that change together, and its models."""

    spark: SparkSession
    project: Project
    models: dict[str, Callable[[], providers.Provider]] = field(default_factory=dict)

    def __post_init__(self):
        self.tables = Generations(self.spark, self.project.out_root)

    def table(self, name: str) -> Table:
        return self.tables.table(name)

    def read(self, name: str) -> DataFrame:
        return self.tables.read(name)

    def has(self, *names: str) -> bool:
        return self.tables.has(*names)

    def clips(self) -> DataFrame:
        return self.read("clips").select("sid", "sr", "pcm")

    def durations(self) -> DataFrame:
        """(sid, dur_ms) of the clips as they are."""
        if not self.has("clips"):
            return self.read("durations").select("sid", "dur_ms")
        return self.clips().select("sid", F.expr("octet_length(pcm) div 2 * 1000 div sr").cast("long").alias("dur_ms"))

    def fingerprint(self) -> DataFrame:
        """(sid, frames) of what is exported: samples of the clips, or lengths where there is no audio."""
        sids = self.read("metadata" if self.has("metadata") else "manifest").select(F.col("sid").cast("string").alias("sid"))
        if self.has("clips"):
            known = self.clips().select("sid", F.expr("octet_length(pcm) div 2").alias("frames"))
        elif self.has("durations"):
            known = self.read("durations").select("sid", F.col("dur_ms").alias("frames"))
        else:
            known = sids.select("sid", F.lit(None).cast("long").alias("frames"))
        return freshness.dataset_fingerprint(sids, known)


def _written(w: Workspace, name: str, rows: DataFrame) -> DataFrame:
    """Rows that a model made and several tables read: the model is asked once."""
    return Scratch(w.spark, "stage").write(rows, name)


def plan_extract(w: Workspace) -> Outputs:
    """Recordings to segments of the target speaker with transcripts; each step deals chunks or segments, not recordings."""
    chunks = w.read("episodes")
    heard = providers.apply(chunks.select(F.concat_ws("/", "sid", "chunk").alias("id"), "sr", "pcm"), w.models["speech"], "spans array<struct<start: double, end: double>>", "id")
    heard = _written(w, "spans", heard)
    start = F.expr(f"chunk * {waves.SIZE} * 1000 / sr")
    spans = heard.join(chunks.select(F.concat_ws("/", "sid", "chunk").alias("id"), F.col("sid").alias("idx"), start.alias("at")), "id").select("idx", "at", F.explode("spans").alias("s"))
    spans = spans.select("idx", *(F.round(F.col("at") + F.col(f"s.{c}") * 1000).cast("long").alias(f"{c}_ms") for c in ("start", "end")))
    whole = segments.coalesce_spans(spans, pauses=True).select("idx", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"), "pauses")
    parts = segments.split_long(whole).select("idx", *(F.round(F.col(c) * 1000).cast("long").alias(f"{c}_ms") for c in ("start", "end")))
    numbered = ordered.ranked(segments.long_enough(parts), ["idx"], ["start_ms"], F.expr("start_ms div 600000"), "i").withColumn("i", F.col("i") - 1)
    segs = _written(w, "segments", numbered.select("idx", "i", "start_ms", "end_ms"))
    rates = waves.lengths(chunks).select(F.col("sid").alias("idx"), "sr")
    ranges = segs.join(rates, "idx").select(F.struct("idx", "i").alias("key"), F.col("idx").alias("sid"), F.expr("start_ms * sr div 1000").alias("a"), F.expr("end_ms * sr div 1000").alias("b"))
    sound = _written(w, "sound", waves.sliced(chunks, ranges).select("key.idx", "key.i", F.concat_ws("/", "key.idx", "key.i").alias("id"), "sr", "pcm"))
    out, kept = {}, segs.withColumn("kept", F.lit(True))
    if "vectors" in w.models:
        emb = providers.apply(sound.select("id", "sr", "pcm"), w.models["vectors"], "emb array<double>", "id").where("error is null").join(sound.select("id", "idx", "i"), "id")
        emb = _written(w, "vectors", emb.select("idx", "i", "emb"))
        labels = _written(w, "labels", vectors.cluster_episodes(emb))
        timed = labels.join(segs, ["idx", "i"]).join(emb, ["idx", "i"]).withColumn("dur", F.col("end_ms") - F.col("start_ms"))
        stats = vectors.cluster_stats(timed)
        target = vectors.target_cluster(stats, w.read("reference") if w.has("reference") else None).select("idx", F.col("label").alias("target"))
        mine = labels.join(target, "idx").where("label = target").select("idx", "i", F.lit(True).alias("mine"))
        kept = segs.join(mine, ["idx", "i"], "left").withColumn("kept", F.coalesce("mine", F.lit(False))).drop("mine")
        shown = vectors.previews(timed.select("idx", "label", "i", "start_ms", "end_ms"))
        out |= {"clusters": stats.drop("centroid"), "previews": preview_clips(chunks, shown)}
    said = kept.where("kept").select("idx", "i").join(sound, ["idx", "i"])
    found = providers.apply(said.select("id", "sr", "pcm"), w.models["recognise"], "text string", "id").join(sound.select("id", "idx", "i"), "id")
    found = _written(w, "transcripts", found.select("idx", "i", F.trim("text").alias("text"), "error"))
    marked = segments.keep_transcribed(kept.join(found.select("idx", "i", "text"), ["idx", "i"], "left"), F.col("text"))
    per = marked.groupBy("idx").agg(F.count("*").alias("n_seg_vad"), F.count_if("kept").alias("kept"), F.count_if("dropped_asr").alias("dropped_asr"))
    failed = heard.select("id", "error").union(found.select(F.concat_ws("/", "idx", "i"), "error")).where("error is not null")
    return out | {"segments": marked.select("idx", "i", "start_ms", "end_ms", "kept"), "transcripts": found.select("idx", "i", "text"), "episodes-report": per, "failed": failed}


def preview_clips(chunks: DataFrame, shown: DataFrame) -> DataFrame:
    """(idx, label, i, start_ms, end_ms) to a clip (sid, sr, pcm) for each cluster: its first segments, end to end."""
    rates = waves.lengths(chunks).select(F.col("sid").alias("idx"), "sr")
    ranges = shown.join(rates, "idx").select(F.struct("idx", "label", "i").alias("key"), F.col("idx").alias("sid"), F.expr("start_ms * sr div 1000").alias("a"), F.expr("end_ms * sr div 1000").alias("b"))
    parts = waves.sliced(chunks, ranges).select(F.concat_ws("_", F.col("key.idx"), F.col("key.label")).alias("sid"), F.col("key.i").alias("chunk"), "sr", "pcm")
    return waves.joined(parts)


def plan_group(w: Workspace) -> Outputs:
    gapped = segments.gaps(w.read("segments"))
    packed = grouping.pack(gapped, w.project.of("group"))
    return {"packed": packed, "review": grouping.review(packed, gapped)}


def plan_group_llm(w: Workspace) -> Outputs:
    """What a language model would join, as splits of the packed groups; rules decide, see :mod:`cadenza.operators.semantic`."""
    texts = w.read("transcripts")
    found = _written(w, "proposed", semantic.groups(segments.gaps(w.read("segments")), texts, w.models["group"], w.project.of("group")))
    return {"splits-model": semantic.as_splits(found, w.read("packed")), "sources": found.groupBy("source").agg(F.count("*").alias("n"))}


def plan_group_apply(w: Workspace) -> Outputs:
    """Packed groups with their splits: the second table by hand before the first, both before a model's."""
    gapped, groups = segments.gaps(w.read("segments")), w.read("packed")
    splits = [w.read(n) for n in ("splits-2", "splits-1", "splits-model") if w.has(n)]
    if splits:
        groups = grouping.apply_splits(groups, *splits)
    return {"groups": groups, "violations": grouping.violations(groups.select("idx", "gid", "pos", "i"), gapped, w.project.of("group")), "group-review": grouping.review(groups, gapped)}


def _utterances(w: Workspace) -> DataFrame:
    c = w.project.of("export")
    return export.utterances(w.read("groups").select("idx", "gid", "pos", "i"), segments.gaps(w.read("segments")), c.max_gap_ms, c.pass_ratio, c.xfade_ms)


def plan_export(w: Workspace) -> Outputs:
    """Utterances within the limits: manifest, transcripts, and the clips cut out of the recordings, where these are there."""
    c, utts = w.project.of("export"), _utterances(w)
    good = _written(w, "good", export.exported(utts, c.min_ms, c.max_ms))
    sids = export.manifest(good, w.project.prefix).select("sid", "idx", "gid")
    rows = _written(w, "manifest", export.padded(good, c.pad_ms).join(sids, ["idx", "gid"]))
    members = rows.select("sid", "idx", "gid").join(w.read("groups"), ["idx", "gid"]).select("sid", "idx", "pos", "i")
    out = {"manifest": rows, "members": members.select("sid", "pos", "i"), "summary": export.summary(good), "histogram": export.histogram(good), "episode-stats": export.episode_stats(utts)}
    if w.has("transcripts"):
        said = members.join(w.read("transcripts"), ["idx", "i"], "left").groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
        out["metadata"] = said.select("sid", F.regexp_replace(join_texts(F.transform("t", lambda x: x["text"])), r"[\r\n]+", " ").alias("text"))
    if w.has("episodes"):
        chunks, seconds = w.read("episodes"), {c: (F.col(c) / 1000).alias(n) for c, n in (("start_ms", "start"), ("end_ms", "end"))}
        times = members.join(w.read("segments").select("idx", "i", "start_ms", "end_ms"), ["idx", "i"])
        times = times.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("pos", *seconds.values()))).alias("members"))
        rates = waves.lengths(chunks).select(F.col("sid").alias("idx"), "sr")
        ranges = rows.join(rates, "idx").select(F.col("sid").alias("key"), F.col("idx").alias("sid"), F.expr("(pad_start_ms - 100) * sr div 1000").alias("a"), F.expr("(pad_end_ms + 100) * sr div 1000").alias("b"))
        sound = waves.sliced(chunks, ranges).select(F.col("key").alias("sid"), "sr", "pcm", (F.col("a") / F.col("sr")).alias("offset_s"))
        spans = rows.select("sid", (F.col("pad_start_ms") / 1000).alias("start"), (F.col("pad_end_ms") / 1000).alias("end"))
        out["clips"] = audio.materialise(sound.join(times, "sid").join(spans, "sid"), w.project.slicing())
    return out | {"stamp-export": rows.select("sid", F.col("length_ms").alias("frames"))}


def plan_align(w: Workspace) -> Outputs:
    """Clips that have no alignment of their length yet are aligned, the others keep theirs; a clip that fails is reported and asked again next time."""
    now = _written(w, "now", w.fingerprint())
    old = w.read("alignments") if w.has("alignments") else w.spark.createDataFrame([], f"sid string, text string, items {ITEMS}")
    if w.has("alignments", "stamp-align"):
        fresh = w.read("stamp-align").join(now, ["sid", "frames"], "left_semi")
        old = old.join(fresh, "sid", "left_semi")
    else:
        old = old.where("false")
    todo = removal.todo(now, old, "sid").join(w.clips(), "sid").join(w.read("metadata").select("sid", "text"), "sid")
    todo = todo.select("sid", "sr", "pcm", "text", F.expr("octet_length(pcm) / 2 / sr").alias("dur_s"))
    found = _written(w, "aligned", providers.apply(todo, w.models["align"], f"text string, items {ITEMS}", "sid").join(todo.select("sid", F.col("text").alias("known")), "sid"))
    good = found.where("error is null").select("sid", F.coalesce("text", "known").alias("text"), "items")
    return {"alignments": old.unionByName(good), "stamp-align": now, "coverage": found.agg(F.count("*").alias("asked"), F.count("error").alias("failed")), "failed": found.where("error is not null").select("sid", "error")}


def plan_punct(w: Workspace) -> Outputs:
    """Recognised transcripts with marks by pauses in place of the old texts; clips without an alignment keep theirs."""
    old = w.read("metadata").select(F.col("sid").alias("id"), F.col("text").alias("old"))
    rows = old.join(w.read("alignments").select(F.col("sid").alias("id"), "text", "items"), "id", "left")
    fixed = _written(w, "repaired", text.repair(rows))
    new = fixed.select(F.col("id").alias("sid"), "text")
    return {"metadata": new, "outcomes": fixed.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("n_deleted").alias("deleted"), F.sum("n_inserted").alias("inserted")), "samples": removal.changed_samples(w.read("metadata"), new, "sid")}


def plan_tails(w: Workspace) -> Outputs:
    """Full stops where a clip was cut by force become commas; the manifest must be of the groups' generation."""
    manifest = w.read("manifest")
    export.require_same_generation(manifest, w.read("members"), w.read("groups").select("idx", "gid", "pos", "i"))
    ends = export.forced_ends(manifest, segments.gaps(w.read("segments")), w.project.of("export").forced_gap_ms)
    new = text.rewrite_tails(w.read("metadata"), ends)
    return {"metadata": new.select("sid", "text"), "changed": new.where("changed")}


def _flagged(w: Workspace, source: str, rows: DataFrame) -> DataFrame:
    """The flags of other sources and the new ones (sid, reason) of this one."""
    new = rows.select(F.col("sid").cast("string").alias("sid"), F.lit(source).alias("source"), "reason")
    return w.read("flags").where(F.col("source") != source).unionByName(new) if w.has("flags") else new


def plan_silence(w: Workspace) -> Outputs:
    """Pauses between the words of clips whose alignment can be judged."""
    rows = _written(w, "words", words.judged(w.read("metadata"), w.read("alignments")))
    gaps, ends = silence.token_gaps(rows, ["sid"]), silence.head_tail(rows, w.durations(), ["sid"])
    found = silence.flags(gaps, ends, ["sid"], w.project.of("silence").fixed_gap_ms)
    return {"flags": _flagged(w, "silence", found), "distribution": silence.distribution(silence.long_form(gaps, ends, ["sid"])), "judged": rows.agg(F.count_distinct("sid").alias("n"))}


def _windows(w: Workspace) -> DataFrame:
    """Vectors of sliding windows that hold sound."""
    if not w.has("clips") or "vectors" not in w.models:
        return w.read("windows")
    parts = audio.clip_windows(w.clips()).withColumn("id", F.concat_ws("/", "utt", "pos"))
    found = providers.apply(parts.select("id", "sr", "pcm"), w.models["vectors"], "emb array<double>", "id").where("error is null").select("id", "emb")
    place = F.expr("length(id) - instr(reverse(id), '/')")
    return _written(w, "windows", found.select(F.substring("id", F.lit(1), place).alias("utt"), F.substring("id", place + 2, F.length("id")).cast("long").alias("pos"), "emb"))


def plan_speaker(w: Workspace) -> Outputs:
    """Clips with runs of windows far from the second centroid, that of the upper half."""
    windows, r = _windows(w), w.project.of("speaker")
    first = vectors.window_similarity(windows, vectors.robust_centroid(windows))
    half = vectors.upper_half(vectors.mean_micros(first))
    found = vectors.purity(vectors.window_similarity(windows, vectors.second_centroid(windows, half)), r.low_sim, r.flag_run, r.severe_run, r.severe_min)
    severe = found.where("severe").select(F.col("utt").alias("sid"), F.format_string("run=%d", "longest").alias("reason"))
    return {"flags": _flagged(w, "speaker", severe), "speakers": found}


def plan_denoise(w: Workspace) -> Outputs:
    """Enhanced clips take the place of those whose voice they keep; all others stay as they are."""
    clips = w.clips()
    made = providers.apply(clips, w.models["enhance"], "new_sr int, new_pcm binary", "sid")
    made = made.where("error is null and new_pcm is not null").select("sid", F.col("new_sr").alias("sr"), F.col("new_pcm").alias("pcm"))
    new = _written(w, "enhanced", audio.like(made, clips))
    both = clips.select(F.concat(F.lit("a/"), "sid").alias("id"), "sr", "pcm").unionByName(new.select(F.concat(F.lit("b/"), "sid").alias("id"), "sr", "pcm"))
    emb = providers.apply(both, w.models["vectors"], "emb array<double>", "id").where("error is null").select(F.substring("id", 1, 1).alias("side"), F.expr("substring(id, 3)").alias("sid"), vectors.unit(F.col("emb")).alias("emb"))
    sides = [emb.where(F.col("side") == s).select("sid", F.col("emb").alias(s)) for s in "ab"]
    floors = [levels.noise_floor(audio.clip_frames(c)).select("sid", F.col("floor_db").alias(n)) for c, n in ((clips, "floor_before"), (new, "floor_after"))]
    rows = new.select("sid").join(sides[0], "sid", "left").join(sides[1], "sid", "left").join(floors[0], "sid", "left").join(floors[1], "sid", "left")
    judged = _written(w, "judged", providers.accept_enhanced(rows.select("sid", vectors.dot(F.col("a"), F.col("b")).alias("sim"), "floor_before", "floor_after")))
    good = new.join(judged.where("accepted").select("sid"), "sid", "left_semi")
    return {"clips": clips.join(good.select("sid"), "sid", "left_anti").unionByName(good), "enhanced": judged, "enhancement": levels.enhancement_summary(judged)}


def plan_prosody(w: Workspace) -> Outputs:
    if not w.has("clips"):
        return {"prosody": prosody.scores(w.read("metrics"))}
    measured = _written(w, "metrics", prosody.of_clips(w.clips(), w.read("metadata")))
    rates = measured.where("cps is not null").select("sid", "cps")
    return {"prosody": prosody.scores(measured.where("error is null").drop("error")), "fast": prosody.rate_outliers(rates), "failed": measured.where("error is not null").select("sid", "error")}


def plan_nonspeech(w: Workspace) -> Outputs:
    """Sounds between words are cut out of clips, and measured again: a clip that still holds some stays as it was.

    The alignments of cut clips leave, so they are stale until they are aligned anew. Without clips the cuts are planned only.
    """
    r, known = w.project.of("nonspeech"), words.heard(w.read("metadata"), w.read("alignments"))
    known = _written(w, "words", known.select("sid", "pos", "start_ms", "end_ms"))
    frames = audio.clip_frames(w.clips(), r.frame_ms / 1000) if w.has("clips") else w.read("frames")
    found = events.gap_events(frames, events.gap_windows(known, w.durations(), r.guard_ms, r.min_cut_ms), **r.of_gaps())
    edits = _written(w, "cuts", events.cuts(found, r.frame_ms, r.residual_ms))
    out = {"cuts": edits, "words-after": events.shifted(known, edits), "totals": events.totals(edits)}
    if not w.has("clips"):
        if w.has("frames-after", "durations-after"):
            out["leftovers"] = events.leftovers(known, edits, w.read("frames-after"), w.read("durations-after"), r.of_gaps(), r.guard_ms, r.min_cut_ms)
        return out
    some = edits.groupBy("sid").agg(F.bool_or(F.col("kind") == "head").alias("head"), F.bool_or(F.col("kind") == "tail").alias("tail"))
    before = w.clips().join(some, "sid", "left_semi")
    seconds = edits.select("sid", *((F.col(c) / 1000).alias(c) for c in ("t0", "t1", "pad")))
    slicing = w.project.slicing()
    after = _written(w, "clips", audio.softened(waves.joined(waves.cut(waves.chunked(before), seconds, slicing.join_s)), some, slicing))
    lasting = after.select("sid", F.expr("octet_length(pcm) div 2 * 1000 div sr").cast("long").alias("dur_ms"))
    failed = _written(w, "failed", events.leftovers(known, edits, audio.clip_frames(after, r.frame_ms / 1000), lasting, r.of_gaps(), r.guard_ms, r.min_cut_ms))
    good = after.join(failed, "sid", "left_anti")
    return out | {
        "clips": w.clips().join(good.select("sid"), "sid", "left_anti").unionByName(good), "alignments": w.read("alignments").join(good.select("sid"), "sid", "left_anti"),
        "rolled-back": failed, "edited": good.agg(F.count("*").alias("n")),
    }


def plan_loudness(w: Workspace) -> Outputs:
    r = w.project.of("loudness")
    if not w.has("clips"):
        gains = levels.loudness_plan(w.read("levels"), r.target_db, r.pass_ratio, r.ceiling_db)
        return {"gains": gains, "episodes-loudness": levels.episode_rollup(gains)}
    found = levels.active_level(audio.clip_frames(w.clips(), 0.025, 0.010))
    measured = found.select(F.col("sid").alias("clip"), F.regexp_extract("sid", "^(.*)_[^_]*$", 1).alias("episode"), F.col("active_db").alias("loud"), F.col("peak_db").alias("peak"))
    gains = _written(w, "gains", levels.loudness_plan(_written(w, "levels", measured), r.target_db, r.pass_ratio, r.ceiling_db))
    louder = gains.where("not noop").select(F.col("clip").alias("sid"), F.col("gain").alias("gain_db"))
    return {"gains": gains, "episodes-loudness": levels.episode_rollup(gains), "clips": audio.with_gains(w.clips(), louder)}


#: Clips of a round of the audit, and calls at once over the whole cluster.
AUDIT_ROUND, AUDIT_CALLS = 2000, 24
AUDITS = "sid string, verdict string, reason string, error string"


def plan_audit(w: Workspace) -> Outputs:
    """Verdicts of a listening model on clips that have none yet but an error; answers are kept round by round, so a job that dies doesn't ask again."""
    journal = Journal(w.spark, f"{w.project.out_root}/_journal/audit")
    ids = w.read("metadata").select("sid", "text")
    done = journal.rows(AUDITS).where("verdict <> 'error'").select("sid")
    todo = ids.join(removal.todo(ids, done, "sid"), "sid").join(w.clips(), "sid")
    todo = todo.select("sid", "sr", "pcm", providers.audit_prompt(w.project.speaker, F.expr("octet_length(pcm) / 2 / sr"), F.col("text")).alias("prompt"))
    in_rounds(journal, todo, lambda part: providers.audits(part, w.models["listen"]).select("sid", "verdict", "reason", "error"), "sid", AUDIT_ROUND, AUDIT_CALLS)
    found = _written(w, "audits", removal.kept_results(journal.rows(AUDITS), ids, done, "sid"))
    bad = found.where("verdict = 'drop'").select("sid", "reason")
    return {"audits": found, "flags": _flagged(w, "audit", bad), "verdicts": removal.verdicts(found)}


def plan_prune(w: Workspace) -> Outputs:
    """Flagged clips leave every table that has a row for each clip; their rows of the manifest stay in ``removed``."""
    flags = w.read("flags").select("sid").distinct()
    gone = w.read("manifest").join(flags, "sid")
    out = {t: w.read(t).join(flags, "sid", "left_anti") for t in ("manifest", "members", "metadata", "clips", "alignments") if w.has(t)}
    old = w.read("removed") if w.has("removed") else None
    return out | {"removed": gone if old is None else old.unionByName(gone, allowMissingColumns=True)}


@dataclass(frozen=True)
class Stage:
    """A node of the graph: what it makes, changes if it is there, needs and refuses without a fresh stamp, and which tables end with it."""

    plan: Callable[[Workspace], Outputs]
    targets: tuple[str, ...]
    needs: tuple[str, ...] = ()
    also: tuple[str, ...] = ()
    models: tuple[str, ...] = ()
    fresh: tuple[str, ...] = ()
    ends: tuple[str, ...] = ()
    #: Any of these tables will do for what isn't measured on clips.
    either: tuple[str, ...] = ()


STAGES = {
    "extract": Stage(plan_extract, ("segments", "transcripts"), ("episodes",), ("previews",), ("speech", "recognise"), ends=("splits-1", "splits-2", "splits-model")),
    "group": Stage(plan_group, ("packed",), ("segments",)),
    "group-llm": Stage(plan_group_llm, ("splits-model",), ("segments", "transcripts", "packed"), models=("group",)),
    "group-apply": Stage(plan_group_apply, ("groups",), ("segments", "packed"), ("splits-1", "splits-2", "splits-model")),
    "export": Stage(plan_export, ("manifest", "members", "stamp-export"), ("segments", "groups"), ("metadata", "clips"), ends=("alignments", "stamp-align", "flags", "removed", "cuts", "words-after", "gains", "enhanced", "audits", "prosody", "speakers")),
    "align": Stage(plan_align, ("alignments", "stamp-align"), ("metadata", "clips"), models=("align",)),
    "punct": Stage(plan_punct, ("metadata",), ("metadata", "alignments"), fresh=("align",)),
    "tails": Stage(plan_tails, ("metadata",), ("metadata", "manifest", "members", "groups", "segments"), fresh=("export",)),
    "silence": Stage(plan_silence, ("flags",), ("metadata", "alignments"), fresh=("align",), either=("clips", "durations")),
    "speaker": Stage(plan_speaker, ("flags", "speakers"), either=("windows", "clips")),
    "denoise": Stage(plan_denoise, ("clips", "enhanced"), ("clips",), models=("enhance", "vectors")),
    "prosody": Stage(plan_prosody, ("prosody",), either=("clips", "metrics")),
    "nonspeech": Stage(plan_nonspeech, ("cuts", "words-after"), ("metadata", "alignments"), ("clips", "alignments"), fresh=("align",), either=("clips", "frames")),
    "loudness": Stage(plan_loudness, ("gains",), (), ("clips",), either=("clips", "levels")),
    "audit": Stage(plan_audit, ("audits", "flags"), ("metadata", "clips"), models=("listen",)),
    "prune": Stage(plan_prune, ("manifest", "removed"), ("manifest", "flags"), ("members", "metadata", "clips", "alignments"), fresh=("export",)),
}
#: Outputs that must be empty for a stage to be applied.
MUST_BE_EMPTY = ("violations", "leftovers")


def _name(stage: str) -> str:
    return ALIASES.get(stage, stage)


def missing(w: Workspace, stage: str) -> list[str]:
    """Tables and models that a stage lacks."""
    s = STAGES[_name(stage)]
    out = [t for t in s.needs if not w.has(t)] + [f"model {m}" for m in s.models if m not in w.models]
    if s.either and not any(w.has(t) for t in s.either):
        out.append(" or ".join(s.either))
    if s.plan is plan_speaker and w.has("clips") and not w.has("windows") and "vectors" not in w.models:
        out.append("model vectors")
    return out


def _lengths(manifest: DataFrame) -> DataFrame:
    return manifest.select("sid", F.col("length_ms").alias("frames"))


def require_fresh(w: Workspace, stage: str) -> None:
    """An error if what a stage reads isn't of the clips as they are."""
    for stamp in STAGES[_name(stage)].fresh:
        now = _lengths(w.read("manifest")) if stamp == "export" else w.fingerprint()
        freshness.require_fresh(now, w.read(f"stamp-{stamp}") if w.has(f"stamp-{stamp}") else None, stamp)


def take_alignments(w: Workspace, rows: DataFrame) -> int:
    """Alignments (sid, text, items) that were made elsewhere, of the clips as they are now: the table and its stamp in one commit."""
    return w.tables.commit({"alignments": rows, "stamp-align": w.fingerprint()}, "align", ("metadata", "clips"))["number"]


def plan(w: Workspace, stage: str) -> Outputs:
    """What a stage would do."""
    return STAGES[_name(stage)].plan(w)


def apply(w: Workspace, stage: str) -> int:
    """Do it, all tables at once: the version of the stage's first table. What else the plan has is kept as JSON reports."""
    stage = _name(stage)
    node = STAGES[stage]
    require_fresh(w, stage)
    out = plan(w, stage)
    for name in MUST_BE_EMPTY:
        if name in out and not out[name].isEmpty():
            raise ValueError(f"{stage}: there are {name}; they break rules, see plan()[{name!r}]")
    tables = {t: out[t] for t in (*node.targets, *node.also) if t in out}
    reports = {n: rows for n, rows in out.items() if n not in tables}
    inputs = tuple(dict.fromkeys((*node.needs, *node.either, *node.also)))
    done = w.tables.commit(tables, stage, inputs, tuple(t for t in node.ends if t not in tables), reports)
    return done["tables"][node.targets[0]]["version"]


def makers() -> dict[str, str]:
    """Of each table the stage that makes it; later stages only change it."""
    out: dict[str, str] = {}
    for s in ALL:
        for t in (*STAGES[s].targets, *STAGES[s].also):
            out.setdefault(t, s)
    return out


def order(stages: tuple[str, ...] = ALL) -> list[str]:
    """Stages so that each stands behind those that make what it needs; otherwise as they are given."""
    left, out, made = [_name(s) for s in stages], [], makers()
    while left:
        ready = next((s for s in left if all(made.get(t, s) == s or made[t] not in left for t in STAGES[s].needs)), left[0])
        out.append(ready)
        left.remove(ready)
    return out


def run_all(w: Workspace, stages: tuple[str, ...] = ALL) -> dict[str, int]:
    """Every stage whose inputs are there, in order, and the version of its first table."""
    return {s: apply(w, s) for s in order(stages) if not missing(w, s)}
