"""From groups to utterances: lengths, filters, pads, numbers, and summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import ordered
from cadenza.functions.quantiles import percentiles
from cadenza.operators import grouping
from cadenza.sources.fixtures import by_i
from cadenza.sources.scratch import Scratch


@dataclass(frozen=True)
class Limits:
    """How pauses are pressed and joins faded, which lengths are exported, and how much is left around them."""

    max_gap_ms: int = 800
    pass_ratio: float | None = None
    xfade_ms: int = 20
    min_ms: int = 2000
    max_ms: int = 30000
    pad_ms: int = 200
    forced_gap_ms: int = 800


#: Edges of the histogram in seconds; the last one is a little over the cap.
EDGES = (2, 5, 10, 15, 20, 25, 30.01)


def pressed(gap: Column, max_gap_ms: int = 800, pass_ratio: float | None = None) -> Column:
    """A pause of over ``max_gap_ms`` is cut to it, or keeps ``pass_ratio`` of the rest."""
    target = F.lit(max_gap_ms) if pass_ratio is None else F.lit(max_gap_ms) + (gap - max_gap_ms) * pass_ratio
    return F.when(gap > max_gap_ms, target).otherwise(gap)


def utterances(groups: DataFrame, gapped: DataFrame, max_gap_ms: int = 800, pass_ratio: float | None = None, xfade_ms: int = 20) -> DataFrame:
    """A row for each group: times, members, and the length after pauses are pressed and joins crossfaded."""
    rows = grouping.group_rows(groups, gapped)
    last = F.max("pos")
    agg = rows.groupBy("idx", "gid").agg(
        F.count("*").alias("n_segs"), F.min("i").alias("first_i"), F.max("i").alias("last_i"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"),
        F.sum("dur_ms").alias("speech"), F.sum(pressed(F.col("gap_ms"), max_gap_ms, pass_ratio)).alias("pauses"), F.max_by(pressed(F.col("gap_ms"), max_gap_ms, pass_ratio), "pos").alias("after"),
        (last * xfade_ms).alias("lost"),
    )
    length = F.col("speech") + F.coalesce("pauses", F.lit(0)) - F.coalesce("after", F.lit(0)) - F.col("lost")
    return agg.select("idx", "gid", "n_segs", "first_i", "last_i", "start_ms", "end_ms", length.cast("long").alias("length_ms"))


def exported(utts: DataFrame, min_ms: int = 2000, max_ms: int = 30000) -> DataFrame:
    """Utterances of a length within the limits, before any pad."""
    return utts.where(F.col("length_ms").between(min_ms, max_ms))


def padded(utts: DataFrame, pad_ms: int = 200) -> DataFrame:
    """Pads on both sides, at most to the middle of the pause to the neighbour among ``utts``."""
    more = ordered.extended(utts, ["idx"], ["first_i"], by_i("first_i"), ahead={"start_ms": "next_start"}, behind={"end_ms": "prev_end"})
    left = F.when(F.col("start_ms") > F.col("prev_end"), F.expr("(start_ms + prev_end) div 2"))
    right = F.when(F.col("next_start") > F.col("end_ms"), F.expr("(end_ms + next_start) div 2"))
    start = F.greatest(F.col("start_ms") - pad_ms, left, F.lit(0))
    end = F.least(F.col("end_ms") + pad_ms, right)
    return more.select(*utts.columns, start.cast("long").alias("pad_start_ms"), end.cast("long").alias("pad_end_ms"))


def _padded(number: Column, least: int) -> Column:
    """At least so many digits; all of a longer number."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(least)), "0")


def manifest(utts: DataFrame, prefix: str = "s") -> DataFrame:
    """sid = prefix, episode, and a number from 1 over the utterances that are left; longer ones aren't cut, so no two clips share a sid."""
    numbered = ordered.ranked(utts, ["idx"], ["first_i"], by_i("first_i"), "n")
    sid = F.concat(F.lit(prefix), _padded(F.col("idx"), 3), F.lit("_"), _padded(F.col("n"), 4))
    return numbered.select(sid.alias("sid"), "idx", "gid", "n_segs", "first_i", "last_i", "start_ms", "end_ms")


def histogram(utts: DataFrame) -> DataFrame:
    """bin, n: how many lengths lie in each bin; lengths outside count nowhere."""
    seconds = F.col("length_ms") / 1000
    cells = [F.count_if((seconds >= a) & (seconds < b)).alias(f"[{a},{b})") for a, b in zip(EDGES, EDGES[1:])]
    one = utts.agg(*cells)
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("bin"), F.col(f"`{c}`").alias("n")) for c in one.columns))).alias("x")).select("x.bin", "x.n")


def summary(utts: DataFrame) -> DataFrame:
    """One row; zero and nulls without utterances."""
    d = F.col("length_ms")
    utts = Scratch(utts.sparkSession, "summary").write(utts.select("length_ms"), "lengths")
    one = utts.agg(F.count("*").alias("n"), F.coalesce(F.sum(d), F.lit(0)).cast("long").alias("total_ms"), F.min(d).alias("min_ms"), F.max(d).alias("max_ms"))
    median = percentiles(utts, d, [0.5]).select(F.col("p")[0].alias("median_ms"))
    return one.crossJoin(F.broadcast(median)).select("n", "total_ms", "min_ms", "median_ms", "max_ms")


def episode_stats(utts: DataFrame, min_ms: int = 2000, max_ms: int = 30000) -> DataFrame:
    good = F.col("length_ms").between(min_ms, max_ms)
    return utts.groupBy("idx").agg(F.count("*").alias("groups"), F.count_if(good).alias("exported"), F.count_if(F.col("length_ms") < min_ms).alias("too_short"), F.count_if(F.col("length_ms") > max_ms).alias("too_long"))


def manifest_mismatches(manifest: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """(sid, idx, gid) of the manifest, its members (sid, pos, i), and groups (idx, gid, pos, i), to the sids that differ, with ``why``.

    Both are of one generation only if each manifest row's group is there and has the same members in the same order.
    Members meet by (idx, gid, pos), so no group is gathered.
    """
    named = manifest.select("sid", "idx", "gid").hint("merge")  # all sides grow with the corpus
    ours = members.join(named, "sid").select("sid", "idx", "gid", "pos", F.col("i").alias("own_i"))
    theirs = groups.join(named, ["idx", "gid"]).select("sid", "idx", "gid", "pos", F.col("i").alias("their_i"))
    both = ours.join(theirs, ["sid", "idx", "gid", "pos"], "full")
    per = both.groupBy("sid").agg(F.count("own_i").alias("own"), F.count("their_i").alias("their"), F.count_if(~F.col("own_i").eqNullSafe(F.col("their_i"))).alias("differ"))
    rows = named.join(per, "sid", "left")
    why = F.when(F.coalesce("their", F.lit(0)) == 0, "no_group").when(F.col("own") != F.col("their"), "size").when(F.col("differ") > 0, "members")
    return rows.select("sid", "idx", "gid", why.alias("why")).where("why is not null")


def require_same_generation(manifest: DataFrame, members: DataFrame, groups: DataFrame) -> None:
    """An error, before anything is changed, if the manifest and the groups don't belong together."""
    wrong = manifest_mismatches(manifest, members, groups)
    if first := wrong.first():
        raise ValueError(f"manifest and groups are of different generations ({first['sid']}: {first['why']})")


def forced_ends(utts: DataFrame, gapped: DataFrame, most_ms: int = 800) -> DataFrame:
    """Whether each utterance ends at a forced boundary: the next segment is adjacent and closer than ``most_ms``."""
    last = gapped.select("idx", F.col("i").alias("last_i"), "gap_ms", "next_is_adjacent")
    joined = utts.join(last.hint("merge"), ["idx", "last_i"], "left")
    forced = F.coalesce(F.col("next_is_adjacent") & (F.col("gap_ms") < most_ms), F.lit(False))
    return joined.select(*utts.columns, forced.alias("forced"))
