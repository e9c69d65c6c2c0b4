"""Ordered helpers, segments, packing and export, against plain versions."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cadenza.functions import ordered
from cadenza.operators import export, grouping, segments

SCHEMA = "idx long, i long, start_ms long, end_ms long, kept boolean"


def made(seed, n, episodes=3):
    rng, rows = random.Random(seed), []
    for idx in range(episodes):
        t = 0
        for i in range(n):
            t += rng.choice((50, 200, 450, 500, 900, 2500, 2600, 7000))
            d = rng.choice((800, 2000, 4000, 6000, 9000, 15000, 31000))
            rows.append((idx, i, t, t + d, rng.random() > 0.1))
            t += d
    return rows


def gapped(rows):
    out = []
    for idx in sorted({r[0] for r in rows}):
        kept = sorted(r for r in rows if r[0] == idx and r[4])
        for a, b in zip(kept, [*kept[1:], None]):
            out.append((idx, a[1], a[2], a[3], b[2] - a[3] if b else None, bool(b) and b[1] == a[1] + 1))
    return out


def packed(rows, rules):
    """The packing as it is defined, segment by segment."""
    out = []
    for idx in sorted({r[0] for r in rows}):
        groups, cur = [], []
        for r in (x for x in rows if x[0] == idx):
            if not cur:
                cur = [r]
                continue
            prev, span = cur[-1], r[3] - cur[0][2]
            if not (prev[5] and prev[4] <= rules.max_gap):
                groups.append(cur)
                cur = [r]
            elif rules.pref_max is None:
                if span <= rules.max_dur:
                    cur.append(r)
                else:
                    groups.append(cur)
                    cur = [r]
            elif span <= rules.pref_max:
                cur.append(r)
            elif prev[3] - cur[0][2] >= rules.pref_min and prev[4] >= rules.good_gap:
                groups.append(cur)
                cur = [r]
            elif span <= rules.max_dur:
                cur.append(r)
            else:
                able = [k for k in range(len(cur) - 1) if cur[k][3] - cur[0][2] >= rules.pref_min]
                if able:
                    k = max(able, key=lambda k: (cur[k][4], k))
                    groups.append(cur[: k + 1])
                    cur = cur[k + 1 :]
                    if r[3] - cur[0][2] <= rules.max_dur:
                        cur.append(r)
                    else:
                        groups.append(cur)
                        cur = [r]
                else:
                    groups.append(cur)
                    cur = [r]
        if cur:
            groups.append(cur)
        out += [(idx, g, p, m[1]) for g, group in enumerate(groups) for p, m in enumerate(group)]
    return out


@pytest.mark.parametrize("rules", [grouping.Packing(), grouping.Packing(pref_max=None), grouping.Packing(pref_max=9000, max_dur=14000, pref_min=2000)])
def test_packing(spark, rules):
    rows = made(1, 120)
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    g = segments.gaps(df)
    assert sorted(tuple(r) for r in g.select("idx", "i", "start_ms", "end_ms", "gap_ms", "next_is_adjacent").collect()) == sorted(gapped(rows))
    got = grouping.pack(g, rules)
    assert sorted(tuple(r) for r in got.collect()) == packed(gapped(rows), rules)
    broken = {r["rule"] for r in grouping.violations(got, g, rules).collect()}
    assert broken <= {"span"}  # only a single segment can be longer than the cap


def _chain(spark, parts):
    """Segments of (length, gap to the next) in seconds."""
    t, rows = 0, []
    for i, (d, gap) in enumerate(parts):
        rows.append((0, i, t, t + round(d * 1000), True))
        t += round((d + (gap or 0)) * 1000)
    g = grouping.pack(segments.gaps(spark.createDataFrame(rows, SCHEMA)))
    out = {}
    for r in sorted(g.collect(), key=lambda r: (r["gid"], r["pos"])):
        out.setdefault(r["gid"], []).append(r["i"])
    return list(out.values())


def test_packing_zones(spark):
    assert _chain(spark, [(18, 0.2), (6, 0.6), (5, 0.2), (5, None)]) == [[0, 1], [2, 3]]  # over the preferred length up to a good gap
    assert _chain(spark, [(10, 0.1), (8, 0.4), (8, 0.1), (8, 0.1), (5, None)])[0] == [0, 1]  # back to the widest gap
    assert _chain(spark, [(3, 5.0), (3, None)]) == [[0], [1]]  # too far apart


def test_empty_segments(spark):
    empty = spark.createDataFrame([], SCHEMA)
    g = segments.gaps(empty)
    groups = grouping.pack(g)
    assert groups.count() == 0 and grouping.violations(groups, g).count() == 0
    one = export.summary(export.utterances(groups, g)).first()
    assert (one["n"], one["total_ms"], one["min_ms"], one["median_ms"]) == (0, 0, None, None)
    assert {r["n"] for r in export.histogram(export.utterances(groups, g)).collect()} == {0}


def test_splits(spark):
    rows = [(0, i, 1000 * i, 1000 * i + 900, True) for i in range(6)]
    groups = grouping.pack(segments.gaps(spark.createDataFrame(rows, SCHEMA)))
    assert groups.select("gid").distinct().count() == 1
    kind = "idx long, gid long, part long, pos long, i long"
    good = spark.createDataFrame([(0, 0, 0, 0, 0), (0, 0, 0, 1, 1), (0, 0, 1, 0, 2), (0, 0, 1, 1, 3), (0, 0, 1, 2, 4), (0, 0, 1, 3, 5)], kind)
    bad = spark.createDataFrame([(0, 0, 0, 0, 0), (0, 0, 1, 0, 2)], kind)
    assert [(r["gid"], r["i"], r["source"]) for r in grouping.apply_splits(groups, good).orderBy("i").collect()] == [(int(i > 1), i, "split1") for i in range(6)]
    assert {r["source"] for r in grouping.apply_splits(groups, bad).collect()} == {"packed"}
    assert {r["source"] for r in grouping.apply_splits(groups, bad, good).collect()} == {"split2"}


def test_violations(spark):
    rows = [(0, i, 1000 * i, 1000 * i + 900, True) for i in range(5)]
    g = segments.gaps(spark.createDataFrame(rows, SCHEMA))
    wrong = spark.createDataFrame([(0, 0, 0, 1), (0, 0, 1, 0), (0, 1, 0, 2), (0, 1, 1, 2), (0, 2, 0, 9)], "idx long, gid long, pos long, i long")
    found = {(r["rule"], r["i"]) for r in grouping.violations(wrong, g).collect()}
    assert {("cover", 3), ("cover", 4), ("cover", 2), ("cover", 9), ("order", 1), ("order", 2)} <= found


def test_ordered_helpers_across_buckets(spark):
    rng = random.Random(5)
    rows = [(k, t, rng.randrange(10)) for k in (1, 2, None) for t in rng.sample(range(200), 60)]
    df = spark.createDataFrame(rows, "k long, t long, v long").repartition(5)
    bucket = F.expr("t div 17")
    out = ordered.ranked(df, ["k"], ["t"], bucket, "r")
    out = ordered.running_sum(out, ["k"], ["t"], bucket, F.col("v"), "s")
    out = ordered.running_sum(out, ["k"], ["t"], bucket, F.col("v"), "before", inclusive=False)
    out = ordered.neighbour(out, ["k"], ["t"], bucket, {"t": "next_t"})
    out = ordered.neighbour(out, ["k"], ["t"], bucket, {"t": "prev_t"}, -1)
    got = {(r["k"], r["t"]): (r["r"], r["s"], r["before"], r["next_t"], r["prev_t"]) for r in out.collect()}
    for k in (1, 2, None):
        own, total = sorted(r for r in rows if r[0] == k), 0
        for n, (_, t, v) in enumerate(own):
            want = (n + 1, total + v, total, own[n + 1][1] if n + 1 < len(own) else None, own[n - 1][1] if n else None)
            assert got[k, t] == want
            total += v


def test_episode_numbers(spark):
    p = spark.createDataFrame([("a/002_x.wav",), ("a/001_y.wav",), ("a/001_y.wav",)], "path string")
    assert [(r["idx"], r["path"][-9:]) for r in segments.episode_index(p).orderBy("path").collect()] == [("000", "001_y.wav"), ("001", "002_x.wav")]
    assert {r["idx"] for r in segments.episode_index(p, "prefix3").collect()} == {"001", "002"}
    order = segments.episode_index(p, order=["002_x", "001_y"])
    assert {(r["idx"], r["path"]) for r in order.collect()} == {("000", "a/002_x.wav"), ("001", "a/001_y.wav")}
    with pytest.raises(Exception, match="not in the episode order"):
        segments.episode_index(p, order=["001_y"]).collect()
    with pytest.raises(ValueError):
        segments.episode_index(p, "odd")


def test_bisecting():
    pauses = [(4.0, 4.6), (9.0, 9.4), (10.2, 10.8), (15.0, 15.5)]
    got = segments.bisect(0.0, 20.0, pauses, most=8.0)
    assert got[0][0] == 0.0 and got[-1][1] == 20.0 and all(b - a <= 8.0 for a, b in got)
    assert segments.bisect(0.0, 20.0, [], most=8.0) == [(0.0, 20.0)]
    assert segments.bisect(0.0, 9.0, [(4.0, 4.1)], most=8.0) == [(0.0, 9.0)]  # no tier has so short a pause
    tie = segments.bisect(0.0, 10.0, [(2.0, 3.0), (7.0, 8.0)], most=8.0)
    assert tie[0] == (0.0, 2.0)  # the first of equals


def test_split_long(spark):
    rows = [(1, 0.0, 20.0, [(9.0, 10.0)]), (1, 30.0, 31.0, []), (2, 0.0, 50.0, None)]
    df = spark.createDataFrame(rows, "idx long, start double, end double, pauses array<struct<a: double, b: double>>")
    assert sorted(tuple(r) for r in segments.split_long(df).collect()) == [(1, 0.0, 9.0), (1, 10.0, 20.0), (1, 30.0, 31.0), (2, 0.0, 50.0)]


def test_pads_stop_half_way(spark):
    u = spark.createDataFrame([(0, 0, 0, 0, 1000), (0, 1, 3, 1100, 2000), (0, 2, 9, 9000, 9900)], "idx long, gid long, first_i long, start_ms long, end_ms long")
    got = {r["gid"]: (r["pad_start_ms"], r["pad_end_ms"]) for r in export.padded(u).collect()}
    assert got == {0: (0, 1050), 1: (1050, 2200), 2: (8800, 10100)}


def test_pressed_pauses(spark):
    g = spark.createDataFrame([(500,), (800,), (1800,), (None,)], "g long")
    assert [r[0] for r in g.select(export.pressed(F.col("g"), 800)).collect()] == [500, 800, 800, None]
    assert [r[0] for r in g.select(export.pressed(F.col("g"), 800, 0.3)).collect()] == [500, 800, 1100, None]


def test_sids_of_many_episodes_differ(spark):
    utts = spark.createDataFrame([(x, 0, 1, 0, 0, 0, 900) for x in (1, 100, 1000, 1001)], "idx long, gid long, n_segs long, first_i long, last_i long, start_ms long, end_ms long")
    assert sorted(r["sid"] for r in export.manifest(utts).collect()) == ["s001_0001", "s1000_0001", "s1001_0001", "s100_0001"]


def test_buckets_meet_rows_where_these_are(spark):
    """The rows are dealt once, for the windows; pairs of keys with nulls meet their buckets."""
    rows = [(a, b, t) for a in (1, None) for b in ("x", None) for t in range(10)]
    out = ordered.ranked(spark.createDataFrame(rows, "a long, b string, t long"), ["a", "b"], ["t"], F.expr("t div 3"), "r")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Broadcast" not in plan
    assert sorted(map(str, out.collect())) == sorted(str(Row(a=a, b=b, t=t, r=t + 1)) for a, b, t in rows)
