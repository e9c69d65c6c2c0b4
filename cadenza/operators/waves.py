"""Long recordings in chunks: slices, cuts, rates, levels and separation without one task for a whole recording.

A recording is a row for each chunk of ``size`` samples (sid, chunk, sr, pcm of 16 bits). What changes samples works on ranges
that meet chunks by equal (sid, chunk), gives weighted pieces of the result with their place, and adds up the pieces of
each new chunk. Joins that cross the edge of a chunk are therefore whole: both sides add to the same samples.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators import audio
from cadenza.operators.levels import db
from cadenza.providers import Provider, apply

#: Samples of a chunk: some six seconds.
SIZE = 1 << 18


def floats(pcm: bytes) -> np.ndarray:
    return np.frombuffer(pcm, "<i2").astype(np.float32) / 32768


def pcm16(x: np.ndarray) -> bytes:
    return np.round(np.clip(x, -1, 32767 / 32768) * 32768).astype("<i2").tobytes()


def chunked(clips: DataFrame, size: int = SIZE) -> DataFrame:
    """(sid, sr, pcm) to chunks; a clip without samples has none. Long files are better read in ranges, see :mod:`cadenza.sources.wavsource`."""
    n = F.expr(f"cast(ceil(octet_length(pcm) / {2 * size}) as int)")
    rows = clips.where(F.octet_length("pcm") > 0).select("sid", F.col("sr").cast("int").alias("sr"), "pcm", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    return rows.select("sid", F.col("chunk").cast("long").alias("chunk"), "sr", F.expr(f"substring(pcm, chunk * {2 * size} + 1, {2 * size})").alias("pcm"))


def lengths(chunks: DataFrame) -> DataFrame:
    """(sid, sr, n): samples of each recording."""
    return chunks.groupBy("sid").agg(F.first("sr").alias("sr"), F.expr("sum(octet_length(pcm)) div 2").cast("long").alias("n"))


def _together(parts: Column) -> Column:
    """The samples of an array of (place, pcm) in order."""
    return F.aggregate(F.array_sort(parts), F.lit(b""), lambda done, p: F.concat(done, p["pcm"]))


def joined(chunks: DataFrame) -> DataFrame:
    """Chunks to (sid, sr, pcm), for clips that are short enough to be a row."""
    parts = chunks.groupBy("sid").agg(F.first("sr").alias("sr"), F.collect_list(F.struct("chunk", "pcm")).alias("parts"))
    return parts.select("sid", "sr", _together(F.col("parts")).alias("pcm"))


def sliced(chunks: DataFrame, ranges: DataFrame, size: int = SIZE) -> DataFrame:
    """(key, sid, a, b) to (key, sid, a, sr, pcm): the samples from a to b, as far as there are some. A slice is short enough to be a row."""
    asked = ranges.where("b > a and b > 0").withColumn("a", F.greatest("a", F.lit(0)))
    asked = asked.select("key", "sid", "a", "b", F.explode(F.expr(f"sequence(a div {size}, (b - 1) div {size})")).alias("chunk"))
    rows = asked.join(chunks, ["sid", "chunk"])
    part = F.expr(f"substring(pcm, cast(2 * greatest(a - chunk * {size}, 0) + 1 as int), cast(2 * (least(b - chunk * {size}, {size}) - greatest(a - chunk * {size}, 0)) as int))")
    parts = rows.select("key", "sid", "a", "sr", F.struct("chunk", part.alias("pcm")).alias("p")).groupBy("key", "sid", "a").agg(F.first("sr").alias("sr"), F.collect_list("p").alias("parts"))
    return parts.select("key", "sid", "a", "sr", _together(F.col("parts")).alias("pcm"))


def _pieces(at: int, x: np.ndarray, size: int) -> Iterator[tuple[int, int, bytes]]:
    """Samples that start at ``at`` of a result, cut at the edges of its chunks: chunk, place in it, 32-bit samples."""
    done = 0
    while done < len(x):
        chunk, place = divmod(at + done, size)
        n = min(size - place, len(x) - done)
        yield chunk, place, x[done : done + n].astype("<f4").tobytes()
        done += n


def added(pieces: DataFrame, totals: DataFrame, size: int = SIZE) -> DataFrame:
    """Pieces (sid, chunk, place, x of 32-bit samples) and (sid, sr, n) to chunks: what lies at one place is added up, what no piece covers is silent."""
    whole = totals.where("n > 0").select("sid", "sr", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {size})")).alias("chunk"))
    rows = whole.join(pieces, ["sid", "chunk"], "left").select("sid", "sr", "n", "chunk", F.coalesce("place", F.lit(0)).cast("long").alias("place"), "x")
    kind = dict(totals.dtypes)["sid"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, chunk = int(pdf["n"].iloc[0]), int(pdf["chunk"].iloc[0])
        out = np.zeros(min(size, n - chunk * size), np.float32)
        for place, x in sorted(zip(pdf["place"], pdf["x"]), key=lambda p: p[0]):
            if x is not None:
                part = np.frombuffer(x, "<f4")[: len(out) - place]
                out[place : place + len(part)] += part
        return pd.DataFrame([(pdf["sid"].iloc[0], chunk, pdf["sr"].iloc[0], pcm16(out))], columns=["sid", "chunk", "sr", "pcm"])

    return rows.groupBy("sid", "chunk").applyInPandas(run, f"sid {kind}, chunk long, sr int, pcm binary")


def cut_plan(n: int, sr: int, edits: list[tuple[float, float, float]], join_s: float) -> tuple[list[dict], int]:
    """The runs that stay when (t0, t1, pad) seconds go, and the samples of the result.

    A run has its source range (a, b), the distance from there to its place, and the joins it fades in at and fades out at
    (place, length). A join lasts ``join_s`` and 8 samples at least, but no longer than the run before it, so nothing that
    was cut is heard in it. Lengths of joins follow from the right, places from the left. Edits must not overlap.
    """
    cuts = [(max(0, int(t0 * sr)), min(n, int(t1 * sr)), int(pad * sr) if pad > 0 else 0) for t0, t1, pad in sorted(edits)]
    before = [0, *(b for _, b, _ in cuts)]
    if any(b > a for b, (a, _, _) in zip(before, cuts)):
        raise ValueError("edits overlap")
    fade, after = [], n
    for (a, b, pad), start in reversed([*zip(cuts, before)]):
        tail = pad + max(0, after - b)
        fade.insert(0, min(max(8, int(join_s * sr)), a - start, tail))
        after = a - fade[0] + tail
    runs, source, base, ramps = [], 0, 0, []
    for (a, b, pad), k in [*zip(cuts, fade), ((n, n, 0), 0)]:
        end = base + a - source - k  # where what follows starts
        runs.append({"a": source, "b": a, "shift": base - source, "ins": [r for r in ramps if r[0] + r[1] > base], "out": (end, k)})
        ramps.append((end, k))
        source, base = b, end + pad
    return runs, after


def _weighted(x: np.ndarray, at: int, ins: list, out: tuple[int, int]) -> np.ndarray:
    """Samples at place ``at`` faded in and out over straight lines."""
    place, x = np.arange(at, at + len(x)), x.copy()
    for start, k in ins:
        inside = (place >= start) & (place < start + k)
        if inside.any():
            x[inside] *= 1 - np.linspace(1, 0, k, dtype=np.float32)[place[inside] - start]
    start, k = out
    inside = (place >= start) & (place < start + k)
    if inside.any():
        x[inside] *= np.linspace(1, 0, k, dtype=np.float32)[place[inside] - start]
    return x


def cut(chunks: DataFrame, edits: DataFrame, join_s: float = 0.02, size: int = SIZE) -> DataFrame:
    """Chunks without what (sid, t0, t1, pad) in seconds takes out.

    Equal to :func:`cadenza.operators.events.cut_samples` on the whole recording where edits are a join apart or more.
    Recordings without edits stay as they are. The edits of a recording are planned together, its samples are not.
    """
    kind, n = dict(chunks.dtypes)["sid"], lengths(chunks)
    wanted = edits.select("sid", *(F.col(c).cast("double").alias(c) for c in ("t0", "t1", "pad")))
    ramp = "struct<at: long, len: long>"
    schema = f"sid {kind}, sr int, n long, run long, a long, b long, shift long, ins array<{ramp}>, out {ramp}"

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        sid, sr, total = pdf["sid"].iloc[0], int(pdf["sr"].iloc[0]), int(pdf["n"].iloc[0])
        runs, left = cut_plan(total, sr, list(pdf[["t0", "t1", "pad"]].itertuples(index=False, name=None)), join_s)
        rows = [(sid, sr, left, k, r["a"], r["b"], r["shift"], [{"at": s, "len": m} for s, m in r["ins"]], {"at": r["out"][0], "len": r["out"][1]}) for k, r in enumerate(runs)]
        return pd.DataFrame(rows, columns=["sid", "sr", "n", "run", "a", "b", "shift", "ins", "out"])

    runs = wanted.join(n, "sid").groupBy("sid").applyInPandas(plan, schema)

    def fade(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for r in pdf.to_dict("records"):
                start, x = r["chunk"] * size, floats(r["pcm"])
                a, b = max(r["a"], start), min(r["b"], start + len(x))
                if a < b:
                    y = _weighted(x[a - start : b - start], a + r["shift"], [(i["at"], i["len"]) for i in r["ins"]], (r["out"]["at"], r["out"]["len"]))
                    made += [(r["sid"], *p) for p in _pieces(a + r["shift"], y, size)]
            yield pd.DataFrame(made, columns=["sid", "chunk", "place", "x"])

    touched = runs.where("b > a").withColumn("chunk", F.explode(F.expr(f"sequence(a div {size}, (b - 1) div {size})")))
    both = touched.join(chunks.select("sid", "chunk", "pcm"), ["sid", "chunk"])
    pieces = both.select("sid", "chunk", "pcm", "a", "b", "shift", "ins", "out").mapInPandas(fade, f"sid {kind}, chunk long, place long, x binary")
    changed = added(pieces, runs.where("run = 0").select("sid", "sr", "n"), size)
    same = chunks.join(edits.select("sid").distinct(), "sid", "left_anti")
    return changed.unionByName(same.select("sid", "chunk", "sr", "pcm"))


def at_rate(chunks: DataFrame, to: int, size: int = SIZE) -> DataFrame:
    """Chunks at the rate ``to``: each chunk of the result is made from the samples around it, so it is what the whole recording would give."""
    kind, n = dict(chunks.dtypes)["sid"], lengths(chunks)
    after = n.select("sid", "sr", "n", F.round(F.col("n") * to / F.col("sr")).cast("long").alias("m")).where("m > 0")
    goal = after.select("sid", "sr", "n", "m", F.explode(F.expr(f"sequence(0L, (m - 1) div {size})")).alias("key"))
    reach = F.lit(audio.RESAMPLE_ZEROS + 1) * F.greatest(F.lit(1.0), F.col("sr") / to)
    a = F.floor(F.col("key") * size * F.col("sr") / to - reach).cast("long")
    b = F.least(F.ceil((F.col("key") + 1) * size * F.col("sr") / to + reach).cast("long"), F.col("n"))
    near = sliced(chunks, goal.select("key", "sid", a.alias("a"), b.alias("b")), size).join(after.select("sid", "n", "m"), "sid")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for key, sid, first, sr, pcm, m in pdf[["key", "sid", "a", "sr", "pcm", "m"]].itertuples(index=False):
                y = audio.resampled_span(floats(pcm), int(first), int(sr), to, int(key) * size, min((int(key) + 1) * size, int(m)))
                made.append((sid, key, to, pcm16(y)))
            yield pd.DataFrame(made, columns=["sid", "chunk", "sr", "pcm"])

    return near.mapInPandas(run, f"sid {kind}, chunk long, sr int, pcm binary")


def overlapping_frames(samples: DataFrame, frame: int, hop: int) -> DataFrame:
    """(sid, k, x) to (sid, frame, ms): mean squares of frames of ``frame`` samples, one every ``hop``; as many as (samples - frame) div hop.

    Squares are summed over buckets as long as the greatest common measure of both, and each bucket goes to the few frames it is
    part of: sums by key, without a window or one task for a clip.
    """
    step = int(np.gcd(frame, hop))
    wide, far = frame // step, hop // step
    x = F.col("x").cast("double")
    buckets = samples.groupBy("sid", F.expr(f"k div {step}").alias("b")).agg(F.sum(x * x).alias("s"))
    count = samples.groupBy("sid").agg(F.expr(f"cast(floor((max(k) + 1 - {frame}) / {hop}) as bigint)").alias("n")).where("n > 0")
    low, high = f"greatest(0L, cast(ceil((b - {wide - 1}) / {far}) as bigint))", f"b div {far}"
    parts = buckets.where(f"{low} <= {high}").select("sid", F.explode(F.expr(f"sequence({low}, {high})")).alias("frame"), "s")
    frames = parts.groupBy("sid", "frame").agg((F.sum("s") / frame).alias("ms"))
    return frames.join(count, "sid").where("frame < n").select("sid", "frame", "ms")


def overlapping_levels(samples: DataFrame, frame: int, hop: int, floor: str = "loudness") -> DataFrame:
    """(sid, frame, db) of :func:`overlapping_frames`."""
    return overlapping_frames(samples, frame, hop).select("sid", "frame", db(F.col("ms"), floor).alias("db"))


def audible_windows(samples: DataFrame, win: int, hop: int, least_rms: float = 0.01) -> DataFrame:
    """(sid, k, x) to (sid, pos, a, b, rms): sliding windows from sample a to b that hold sound.

    A window starts every ``hop`` samples as long as half a window is left, so the last ones are shorter; one of less than half
    a window counts as silent. Squares are summed as in :func:`overlapping_frames`.
    """
    step = int(np.gcd(win, hop))
    wide, far = win // step, hop // step
    x = F.col("x").cast("double")
    buckets = samples.groupBy("sid", F.expr(f"k div {step}").alias("b")).agg(F.sum(x * x).alias("s"))
    count = samples.groupBy("sid").agg((F.max("k") + 1).alias("n"))
    low, high = f"greatest(0L, cast(ceil((b - {wide - 1}) / {far}) as bigint))", f"b div {far}"
    parts = buckets.where(f"{low} <= {high}").select("sid", F.explode(F.expr(f"sequence({low}, {high})")).alias("pos"), "s")
    sums = parts.groupBy("sid", "pos").agg(F.sum("s").alias("s")).join(count, "sid").where(f"pos * {hop} < greatest(1, n - {win // 2})")
    a, b = F.col("pos") * hop, F.least(F.col("pos") * hop + win, F.col("n"))
    rows = sums.select("sid", "pos", a.alias("a"), b.alias("b"), F.sqrt(F.col("s") / (b - a)).alias("rms"))
    return rows.where((2 * (F.col("b") - F.col("a")) >= win) & (F.col("rms") > least_rms))


def sample_rows(chunks: DataFrame, size: int = SIZE) -> DataFrame:
    """Chunks to (sid, k, x), a row for each sample."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for sid, chunk, pcm in pdf.itertuples(index=False):
                x = floats(pcm)
                for at in range(0, len(x), 1 << 16):  # batches of bounded size
                    part = x[at : at + (1 << 16)]
                    yield pd.DataFrame({"sid": sid, "k": chunk * size + at + np.arange(len(part)), "x": part.astype(float)})

    return chunks.select("sid", "chunk", "pcm").mapInPandas(run, f"sid {dict(chunks.dtypes)['sid']}, k long, x double")


class MiddleOut:
    """Separation of a stand-in: with two channels in turn what both share is the voice, with one everything is. Inputs sr, pcm; output vocals."""

    batch = 4

    def __call__(self, inputs: list[dict]) -> list[dict]:
        return [{"vocals": x["pcm"]} for x in inputs]


def separated(chunks: DataFrame, make: Callable[[], Provider], window: int, overlap: int, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """Vocals as chunks, and (sid, error) of recordings of which a window failed; those have no vocals.

    A model (inputs sr, pcm; output ``vocals`` of as many samples) sees windows of ``window`` samples that overlap by ``overlap``;
    where two meet, one fades into the other. A model that changes nothing gives back the input.
    """
    if not 0 <= overlap <= window // 2:
        raise ValueError("windows overlap by half of their length at most")
    hop, n = window - overlap, lengths(chunks)
    starts = n.select("sid", "n", F.explode(F.expr(f"sequence(0L, greatest(0L, (n - {overlap} - 1) div {hop}))")).alias("w"))
    asked = starts.select(F.struct("sid", "w").alias("key"), "sid", (F.col("w") * hop).alias("a"), F.least(F.col("w") * hop + window, F.col("n")).alias("b"))
    windows = sliced(chunks, asked, size).select(F.concat_ws("/", F.col("sid").cast("string"), F.col("key.w").cast("string")).alias("id"), "sid", "key.w", "sr", "pcm")
    found = apply(windows.select("id", "sr", "pcm"), make, "vocals binary", "id").join(windows.select("id", "sid", "w", F.octet_length("pcm").alias("size")), "id")
    wrong = F.when(F.col("error").isNotNull(), F.col("error")).when(F.octet_length("vocals") != F.col("size"), "another length")
    from cadenza.sources.scratch import Scratch

    found = Scratch(chunks.sparkSession, "separated").write(found.select("sid", "w", "vocals", wrong.alias("error")), "windows")  # models are asked once
    failed = found.where("error is not null").groupBy("sid").agg(F.min("error").alias("error"))
    good = found.join(failed.select("sid"), "sid", "left_anti").join(n, "sid")
    kind = dict(chunks.dtypes)["sid"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up = (np.arange(overlap, dtype=np.float32) + 0.5) / max(1, overlap)
        for pdf in batches:
            made = []
            for sid, w, vocals, total in pdf[["sid", "w", "vocals", "n"]].itertuples(index=False):
                x, at = floats(vocals), int(w) * hop
                if w:
                    x[:overlap] *= up[: len(x)]
                if overlap and at + len(x) < total:
                    x[len(x) - overlap :] *= 1 - up
                made += [(sid, *p) for p in _pieces(at, x, size)]
            yield pd.DataFrame(made, columns=["sid", "chunk", "place", "x"])

    pieces = good.select("sid", "w", "vocals", "n").mapInPandas(run, f"sid {kind}, chunk long, place long, x binary")
    return added(pieces, n.join(failed.select("sid"), "sid", "left_anti"), size), failed


def mean_levels(chunks: DataFrame) -> DataFrame:
    """(sid, db): the level of all samples of each recording."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(sid, float(np.square(x := floats(pcm).astype(float)).sum()), len(x)) for sid, pcm in pdf.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["sid", "s", "n"])

    sums = chunks.select("sid", "pcm").mapInPandas(run, f"sid {dict(chunks.dtypes)['sid']}, s double, n long")
    return sums.groupBy("sid").agg(db(F.sum("s") / F.sum("n")).alias("db"))


def guarded(full: DataFrame, vocals: DataFrame) -> DataFrame:
    """Whether separation lost the voice: both as chunks, see :func:`cadenza.operators.levels.separation_guard`."""
    from cadenza.operators.levels import separation_guard

    levels = mean_levels(full).withColumnRenamed("db", "full_db").join(mean_levels(vocals).withColumnRenamed("db", "vocals_db"), "sid", "left")
    return separation_guard(levels.fillna(-120.0, ["vocals_db"]))
