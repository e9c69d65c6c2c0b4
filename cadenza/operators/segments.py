"""Speech segments: numbering, gaps, coalescing and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadenza.functions import ordered
from cadenza.sources.fixtures import by_i
from cadenza.sources.scratch import Scratch

MINUTE_MS = 600_000


def episode_index(paths: DataFrame, mode: str = "sequential", order: list[str] | None = None) -> DataFrame:
    """(path) to (idx, path); repeated paths count once.

    ``prefix3`` takes three characters of the file name, ``sequential`` the rank of the path or, with ``order``,
    the rank of the file's stem in it; a stem that ``order`` lacks is an error.
    """
    paths = paths.select("path").distinct()
    name = F.element_at(F.split("path", "/"), -1)
    if mode == "prefix3":
        return paths.select(F.substring(name, 1, 3).alias("idx"), "path")
    if mode != "sequential":
        raise ValueError(f"unknown idx_mode {mode!r}")
    if order is not None:
        stem = F.regexp_replace(name, r"\.[^.]*$", "")
        place = F.array_position(F.lit(order), stem)
        known = F.when(place > 0, place - 1).otherwise(F.raise_error(F.concat(F.lit("not in the episode order: "), stem)).cast("long"))
        return paths.select(F.lpad(known.cast("string"), 3, "0").alias("idx"), "path")
    ranges = Scratch(paths.sparkSession, "episodes").write(paths.repartitionByRange("path").withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = ranges.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = ranges.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("path"))).join(F.broadcast(offsets), "part")
    number = (F.col("r") + F.col("before") - 1).cast("string")
    return rank.select(F.lpad(number, F.greatest(F.length(number), F.lit(3)), "0").alias("idx"), "path")


def gaps(segments: DataFrame) -> DataFrame:
    """Kept segments with dur, gap_to_next (null at the end) and next_is_adjacent."""
    kept = segments.where("kept")
    kept = ordered.neighbour(kept, ["idx"], ["i"], by_i(), {"i": "next_i", "start_ms": "next_start"})
    return kept.select(
        "idx", "i", "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("dur_ms"), (F.col("next_start") - F.col("end_ms")).alias("gap_ms"),
        F.coalesce(F.col("next_i") == F.col("i") + 1, F.lit(False)).alias("next_is_adjacent"),
    )


def coalesce_spans(spans: DataFrame, split_gap_ms: int = 800, pauses: bool = False) -> DataFrame:
    """(idx, start_ms, end_ms) in order and disjoint; spans whose gap is ``split_gap_ms`` at most become one.

    With ``pauses`` each has the gaps inside it, ARRAY<STRUCT<a, b>> in seconds, for :func:`split_long`.
    """
    bucket = F.expr(f"start_ms div {MINUTE_MS}")
    spans = ordered.neighbour(spans.select("idx", "start_ms", "end_ms"), ["idx"], ["start_ms"], bucket, {"end_ms": "prev_end"}, -1)
    opens = (F.col("prev_end").isNull() | (F.col("start_ms") - F.col("prev_end") > split_gap_ms)).cast("int")
    spans = ordered.running_sum(spans, ["idx"], ["start_ms"], bucket, opens, "island")
    gap = F.when((opens == 0) & (F.col("start_ms") > F.col("prev_end")), F.struct((F.col("prev_end") / 1000).alias("a"), (F.col("start_ms") / 1000).alias("b")))
    inside = [F.sort_array(F.collect_list(gap)).alias("pauses")] if pauses else []
    return spans.groupBy("idx", "island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n"), *inside)


def long_enough(spans: DataFrame, least_ms: int = 1000) -> DataFrame:
    return spans.where(F.col("end_ms") - F.col("start_ms") >= least_ms)


def keep_transcribed(segments: DataFrame, text: Column) -> DataFrame:
    """kept and dropped_asr: a transcript of two characters or more, with a Chinese one."""
    from cadenza.functions.text import has_chinese

    good = (F.length(text) >= 2) & has_chinese(text)
    return segments.withColumn("dropped_asr", F.col("kept") & ~F.coalesce(good, F.lit(False))).withColumn("kept", F.col("kept") & F.coalesce(good, F.lit(False)))


def bisect(start: float, end: float, pauses: list[tuple[float, float]], most: float = 18.0, tiers: tuple[float, ...] = (0.5, 0.3, 0.15)) -> list[tuple[float, float]]:
    """Halve a segment longer than ``most`` at the pause that is long and central, then its halves.

    The first tier with a pause of its length inside decides; the pause of least ``|middle - centre| - 2 * length``
    wins, the earliest among equals. Without any, the segment stays whole.
    """
    if end - start <= most:
        return [(start, end)]
    inside = [(a, b) for a, b in pauses if a > start and b < end]
    centre = (start + end) / 2
    for tier in tiers:
        some = [p for p in inside if p[1] - p[0] >= tier]
        if some:
            a, b = min(some, key=lambda p: abs((p[0] + p[1]) / 2 - centre) - 2 * (p[1] - p[0]))
            return bisect(start, a, pauses, most, tiers) + bisect(b, end, pauses, most, tiers)
    return [(start, end)]


def split_long(spans: DataFrame, most: float = 18.0, tiers: tuple[float, ...] = (0.5, 0.3, 0.15)) -> DataFrame:
    """(idx, start, end, pauses ARRAY<STRUCT<a, b>>) to the pieces of each span; a span is a unit, so nothing is shuffled."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(i, s, e) for i, a, b, p in zip(pdf.idx, pdf.start, pdf.end, pdf.pauses) for s, e in bisect(a, b, [(x["a"], x["b"]) for x in (p if p is not None else [])], most, tiers)]
            yield pd.DataFrame(rows, columns=["idx", "start", "end"])

    kinds = dict(spans.dtypes)
    return spans.select("idx", "start", "end", "pauses").mapInPandas(run, f"idx {kinds['idx']}, start double, end double")
