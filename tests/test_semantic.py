"""Grouping by a language model, with replies that are sound, broken, repaired or missing."""

import json

import pytest

from cadenza.operators import grouping, segments, semantic
from cadenza.operators.grouping import Packing

ROWS = [(0, 0, 1000, "a"), (1, 1200, 2000, "b"), (2, 2500, 4000, None)]
RULES = Packing(max_dur=3000)


def said(*groups):
    return json.dumps({"groups": list(groups)})


class Scripted:
    """Gives prepared replies in turn; an exception is raised."""

    batch = 1

    def __init__(self, *replies):
        self.replies, self.seen = list(replies), []

    def __call__(self, inputs):
        self.seen.append(inputs[0]["messages"])
        reply = self.replies.pop(0)
        if isinstance(reply, Exception):
            raise reply
        return [{"reply": reply}]


class Pairs:
    """Joins segments two by two, as the question lists them."""

    batch = 1

    def __call__(self, inputs):
        rows = [json.loads(x)["i"] for x in inputs[0]["messages"][0]["content"].split("\n\n", 1)[1].splitlines()]
        return [{"reply": "```json\n" + said(*(rows[k : k + 2] for k in range(0, len(rows), 2))) + "\n```"}]


class Mute:
    batch = 1

    def __call__(self, inputs):
        raise RuntimeError("no answer")


@pytest.mark.parametrize(
    ("groups", "part"),
    [([[0, 1], [2]], None), ([[0], [1]], "missing"), ([[0, 0], [1, 2]], "twice"), ([[1, 0], [2]], "order"), ([[0, 1, 2]], "4.0 s"), ([[0], [1, 2], [7]], "new")],
)
def test_faults(groups, part):
    found = semantic.fault(groups, ROWS, RULES)
    assert found is None if part is None else part in found


def test_a_long_segment_alone_is_no_fault():
    assert semantic.fault([[0]], [(0, 0, 99_000, "x")], RULES) is None


@pytest.mark.parametrize("reply", ["[]", '{"groups": 3}', '{"groups": [[]]}', '{"groups": [[true]]}', "nothing"])
def test_replies_of_another_form(reply):
    with pytest.raises(ValueError):
        semantic.proposed(reply)


def test_the_model_is_told_what_was_wrong():
    model = Scripted(said([0, 1, 2]), "not JSON", said([0, 1], [2]))
    assert semantic.ask(model, ROWS, RULES, 3, 0) == ([[0, 1], [2]], "model")
    assert "4.0 s" in model.seen[1][-1]["content"] and len(model.seen[2]) == 5


def test_no_sound_reply_leaves_single_segments():
    model = Scripted(RuntimeError("busy"), said([2, 1, 0]), said([0]))
    assert semantic.ask(model, ROWS, RULES, 3, 0) == ([[0], [1], [2]], "fallback")


def _gapped(spark):
    # 0..4 in a row, a hard break, 5 alone, 7 and 8 in another episode
    rows = [("a", i, 2000 * i, 2000 * i + 1500, True) for i in range(5)] + [("a", 5, 60_000, 61_000, True), ("b", 7, 0, 900, True), ("b", 8, 1000, 1900, True)]
    return segments.gaps(spark.createDataFrame(rows, "idx string, i long, start_ms long, end_ms long, kept boolean"))


def _texts(spark):
    return spark.createDataFrame([("a", 0, "x")], "idx string, i long, text string")


def _found(df):
    return sorted(tuple(r) for r in df.select("idx", "head", "pos", "i", "source").collect())


def test_runs_are_grouped(spark):
    got = _found(semantic.groups(_gapped(spark), _texts(spark), Pairs))
    m = "model"
    assert got == [("a", 0, 0, 0, m), ("a", 0, 1, 1, m), ("a", 2, 0, 2, m), ("a", 2, 1, 3, m), ("a", 4, 0, 4, m), ("a", 5, 0, 5, "single"), ("b", 7, 0, 7, m), ("b", 7, 1, 8, m)]
    parts = _found(semantic.groups(_gapped(spark), _texts(spark), Pairs, most_rows=3))
    assert [r[1] for r in parts if r[0] == "a"] == [0, 0, 2, 2, 4, 5]  # equal pauses: parted at the last one
    far = _gapped(spark).selectExpr("idx", "i", "start_ms + if(i >= 2 and i < 5, 900, 0) as start_ms", "end_ms + if(i >= 2 and i < 5, 900, 0) as end_ms", "dur_ms", "gap_ms", "next_is_adjacent")
    assert [r[1] for r in _found(semantic.groups(far, _texts(spark), Pairs, most_rows=4)) if r[0] == "a"] == [0, 0, 2, 2, 4, 5]


def test_nothing_is_lost_without_a_model(spark):
    got = _found(semantic.groups(_gapped(spark), _texts(spark), Mute, wait_s=0))
    assert [(r[0], r[3], r[4]) for r in got] == [("a", i, "fallback") for i in range(5)] + [("a", 5, "single"), ("b", 7, "fallback"), ("b", 8, "fallback")]
    assert semantic.groups(_gapped(spark).where("false"), _texts(spark), Mute).count() == 0


def test_model_groups_split_packed_ones(spark):
    gapped = _gapped(spark)
    packed = grouping.pack(gapped)
    splits = semantic.as_splits(semantic.groups(gapped, _texts(spark), Pairs), packed)
    new = grouping.apply_splits(packed, splits)
    assert grouping.violations(new.select("idx", "gid", "pos", "i"), gapped).count() == 0
    assert {(r["idx"], r["i"]) for r in new.where("pos = 0").collect()} == {("a", 0), ("a", 2), ("a", 4), ("a", 5), ("b", 7)}
