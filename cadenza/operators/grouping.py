"""Packing segments into utterances, and checking and changing the groups.

Whatever the packing has open, a segment that isn't adjacent or follows a gap
over ``max_gap`` starts a new group. Runs between such breaks are independent,
so they, not episodes, are dealt over the tasks; within a run, rows stream in
order and only the open group is held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import ordered
from cadenza.sources.fixtures import by_i
from cadenza.sources.scratch import Scratch


@dataclass(frozen=True)
class Packing:
    """Limits in milliseconds; without ``pref_max`` groups fill up to ``max_dur``."""

    max_gap: int = 2500
    max_dur: int = 29000
    pref_max: int | None = 20000
    pref_min: int = 5000
    good_gap: int = 500


class OpenGroup:
    """The group that a run has open: (i, start, end, gap to the next) of its members."""

    def __init__(self, rules: Packing):
        self.rules, self.members = rules, []

    def add(self, row: tuple[int, int, int, int]) -> list[list[int]]:
        """Take a segment; gives the groups that it closes."""
        rules, members = self.rules, self.members
        if not members:
            members.append(row)
            return []
        first, last = members[0][1], members[-1]
        span = row[2] - first
        if span <= (rules.max_dur if rules.pref_max is None else rules.pref_max):
            members.append(row)
            return []
        if rules.pref_max is not None:
            natural = last[2] - first >= rules.pref_min and last[3] >= rules.good_gap
            if not natural and span <= rules.max_dur:
                members.append(row)
                return []
            if not natural:
                return self._back(row)
        self.members = [row]
        return [[m[0] for m in members]]

    def _back(self, row) -> list[list[int]]:
        """Part at the largest gap inside, the last among equals, or else before ``row``."""
        members, first = self.members, self.members[0][1]
        gaps = [(m[3], k) for k, m in enumerate(members[:-1]) if m[2] - first >= self.rules.pref_min]
        if not gaps:
            self.members = [row]
            return [[m[0] for m in members]]
        k = max(gaps)[1] + 1
        head, rest = members[:k], members[k:]
        if row[2] - rest[0][1] <= self.rules.max_dur:
            self.members = [*rest, row]
            return [[m[0] for m in head]]
        self.members = [row]
        return [[m[0] for m in head], [m[0] for m in rest]]

    def flush(self) -> list[list[int]]:
        out, self.members = [[m[0] for m in self.members]] if self.members else [], []
        return out


def pack(gapped: DataFrame, rules: Packing = Packing()) -> DataFrame:
    """(idx, gid, pos, i) from the rows of :func:`cadenza.operators.segments.gaps`; gid and pos count from 0 in each episode."""
    hard = ~(F.col("next_is_adjacent") & (F.col("gap_ms") <= rules.max_gap))
    rows = gapped.withColumn("breaks", F.coalesce(hard, F.lit(True)).cast("int"))
    runs = ordered.running_sum(rows, ["idx"], ["i"], by_i(), F.col("breaks"), "run", inclusive=False)
    kinds = dict(gapped.dtypes)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, group = None, OpenGroup(rules)
        for pdf in batches:
            out = []
            for idx, run, i, start, end, gap in pdf.itertuples(index=False):
                if at != (idx, run):
                    out += [(at[0], g[0], p, m) for g in group.flush() for p, m in enumerate(g)] if at else []
                    at = (idx, run)
                out += [(idx, g[0], p, m) for g in group.add((i, start, end, gap)) for p, m in enumerate(g)]
            yield pd.DataFrame(out, columns=["idx", "head", "pos", "i"])
        yield pd.DataFrame([(at[0], g[0], p, m) for g in group.flush() for p, m in enumerate(g)] if at else [], columns=["idx", "head", "pos", "i"])

    dealt = runs.select("idx", "run", "i", "start_ms", "end_ms", F.coalesce("gap_ms", F.lit(0)).alias("gap_ms")).repartition("idx", "run").sortWithinPartitions("idx", "run", "i")
    packed = dealt.mapInPandas(fold, f"idx {kinds['idx']}, head long, pos long, i long")
    packed = Scratch(gapped.sparkSession, "packed").write(packed, "groups")  # numbering reads it twice
    numbered = ordered.running_sum(packed, ["idx"], ["i"], by_i(), (F.col("pos") == 0).cast("long"), "gid")
    return numbered.select("idx", (F.col("gid") - 1).alias("gid"), "pos", "i")


def group_rows(groups: DataFrame, gapped: DataFrame) -> DataFrame:
    """Members with their times; a group is bounded, so (idx, gid) is a safe key.

    Both sides grow with the segments, and their files don't tell their size in memory, so neither is broadcast.
    """
    return groups.join(gapped.hint("merge"), ["idx", "i"])


def review(groups: DataFrame, gapped: DataFrame) -> DataFrame:
    """Groups of several members, a row for each: gid, pos, i, gap_after_ms (null for the last) and the group's length."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("idx", "gid")
    rows = group_rows(groups, gapped).withColumn("n", F.count("*").over(w)).withColumn("dur_ms", F.max("end_ms").over(w) - F.min("start_ms").over(w))
    return rows.where("n > 1").select("idx", "gid", "pos", "i", F.when(F.col("pos") < F.col("n") - 1, F.col("gap_ms")).alias("gap_after_ms"), "n", "dur_ms")


def violations(groups: DataFrame, gapped: DataFrame, rules: Packing = Packing()) -> DataFrame:
    """Broken rules, (idx, gid, rule, i): cover, order, adjacency, gap, span. None where the groups are sound."""
    from pyspark.sql.window import Window

    member = groups.groupBy("idx", "i").agg(F.count("*").alias("times"))
    cover = gapped.select("idx", "i").join(member, ["idx", "i"], "full").where("times is null or times <> 1")
    lost = cover.select("idx", F.lit(None).cast("long").alias("gid"), F.lit("cover").alias("rule"), "i")
    unknown = groups.join(gapped.select("idx", "i").hint("merge"), ["idx", "i"], "left_anti").select("idx", "gid", F.lit("cover").alias("rule"), "i")
    rows = group_rows(groups, gapped)
    w = Window.partitionBy("idx", "gid").orderBy("pos")
    rows = rows.withColumn("next_i", F.lead("i").over(w)).withColumn("start0", F.first("start_ms").over(w))
    inner = rows.where("next_i is not null")
    order = inner.where("next_i <= i").select("idx", "gid", F.lit("order").alias("rule"), "i")
    apart = inner.where(~F.col("next_is_adjacent")).select("idx", "gid", F.lit("adjacency").alias("rule"), "i")
    wide = inner.where(F.col("next_is_adjacent") & (F.col("gap_ms") > rules.max_gap)).select("idx", "gid", F.lit("gap").alias("rule"), "i")
    long = rows.where("next_i is null").where(F.col("end_ms") - F.col("start0") > rules.max_dur).select("idx", "gid", F.lit("span").alias("rule"), "i")
    return lost.unionByName(unknown).unionByName(order).unionByName(apart).unionByName(wide).unionByName(long).distinct()


def apply_splits(groups: DataFrame, *splits: DataFrame) -> DataFrame:
    """Replace groups by their splits (idx, gid, part, pos, i); of several tables the first that has the group decides.

    A split counts only if its parts, put together, are exactly the group; else the group stays. Groups are numbered
    anew in their order, and ``source`` tells where each came from.
    """
    whole = groups.groupBy("idx", "gid").agg(F.sort_array(F.collect_list(F.struct("pos", "i"))).alias("g"))
    whole = whole.select("idx", "gid", F.transform("g", lambda x: x["i"]).alias("members"))
    chosen = whole.withColumn("source", F.lit("packed")).withColumn("parts", F.array(F.col("members")))
    for k, table in enumerate(reversed(splits)):
        parts = table.repartition("idx", "gid").groupBy("idx", "gid", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "i"))).alias("p"))
        parts = parts.groupBy("idx", "gid").agg(F.sort_array(F.collect_list(F.struct("part", "p"))).alias("ps"))
        parts = parts.select("idx", "gid", F.transform("ps", lambda x: F.transform(x["p"], lambda y: y["i"])).alias("new"))
        fits = F.col("new").isNotNull() & (F.flatten("new") == F.col("members")) & ~F.exists("new", lambda x: F.size(x) == 0)
        chosen = chosen.join(parts.hint("merge"), ["idx", "gid"], "left").withColumn("source", F.when(fits, F.lit(f"split{len(splits) - k}")).otherwise(F.col("source")))
        chosen = chosen.withColumn("parts", F.when(fits, F.col("new")).otherwise(F.col("parts"))).drop("new")
    rows = chosen.select("idx", "source", F.explode("parts").alias("part")).select("idx", "source", F.posexplode("part").alias("pos", "i"))
    rows = Scratch(groups.sparkSession, "splits").write(rows.withColumn("pos", F.col("pos").cast("long")), "rows")  # numbering reads it twice
    numbered = ordered.running_sum(rows, ["idx"], ["i"], by_i(), (F.col("pos") == 0).cast("long"), "gid")
    return numbered.select("idx", (F.col("gid") - 1).alias("gid"), "pos", "i", "source")
