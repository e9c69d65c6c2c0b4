"""Near-duplicates against all pairs."""

import random

import pytest

from cadenza.llm import near_dup
from tests.llm import helpers


def _got(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in df.collect())


def _want(rows):
    return sorted((i is None, i or 0, n, c if c is not None else -1) for i, n, c in helpers.near_components(rows))


def _copies(seed, base_words, copies, edits):
    rng = random.Random(seed)
    base = helpers.prose(seed, base_words).split()
    out = []
    for _ in range(copies):
        w = base[:]
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in helpers.awkward()]
    assert _got(near_dup.near_duplicates(helpers.table(spark))) == _want(rows)


def test_empty(spark):
    assert near_dup.near_duplicates(helpers.table(spark, [])).count() == 0
    assert near_dup.drop_near_duplicates(helpers.table(spark, [])).count() == 0


def test_chain_of_copies_near_the_threshold(spark):
    texts = _copies(11, 150, 120, 9) + _copies(12, 90, 60, 4) + _copies(13, 40, 40, 2) + [helpers.prose(100 + k, 70) for k in range(40)]
    shared = helpers.prose(99, 40)
    texts += [shared + " " + helpers.prose(200 + k, 60) for k in range(80)] + texts[:30]
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _got(near_dup.near_duplicates(df)) == _want(rows)


@pytest.mark.parametrize("leaf", [8, 4])
def test_deep_nodes_and_blocks(spark, monkeypatch, leaf):
    """Tiny leaves, so that nodes branch on and end in blocks, and no circles to help."""
    monkeypatch.setattr(near_dup, "LEAF", leaf)
    monkeypatch.setattr(near_dup, "LEVELS", 2)
    monkeypatch.setattr(near_dup, "MET", 17)
    rows = list(enumerate(_copies(21, 100, 40, 5) + [helpers.prose(300, 30) + " " + helpers.prose(400 + k, 50) for k in range(40)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(near_dup.near_duplicates(df)) == _want(rows)


def test_small_circle_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "OPEN_BLOCK", 3)
    monkeypatch.setattr(near_dup, "CIRCLE_BLOCK", 5)
    rows = list(enumerate(_copies(31, 120, 60, 8)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(near_dup.near_duplicates(df)) == _want(rows)


def test_one_row_of_each_group_stays(spark):
    kept = near_dup.drop_near_duplicates(helpers.table(spark))
    rows = [(i, t) for i, t, *_ in helpers.awkward()]
    want = helpers.near_components(rows)
    # rows without shingles are linked with nothing, so each of them stays
    groups = {c if n else ("row", k) for k, (i, n, c) in enumerate(want)}
    assert kept.count() == len(groups)
    assert kept.columns == helpers.table(spark).columns
    assert {r["language"] for r in kept.collect()} == {"clash"}


def test_shuffle_path_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 0)
    rows = list(enumerate(_copies(41, 80, 25, 4)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(near_dup.near_duplicates(df)) == _want(rows)


def test_hot_keys(spark, monkeypatch):
    """Every key counts as hot, so that all joins deal rows over copies; many equal texts, and texts without words."""
    monkeypatch.setattr(near_dup, "HOT", 3)
    rows = list(enumerate(_copies(51, 100, 40, 6) + [helpers.prose(52, 60)] * 30 + [None, "", " "] * 5 + [helpers.prose(53, 30) + " " + helpers.prose(500 + k, 50) for k in range(20)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(near_dup.near_duplicates(df)) == _want(rows)


def test_components_must_get_stable(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "STEPS", 1)
    df = spark.createDataFrame(list(enumerate(_copies(61, 60, 6, 2))), "doc_id long, text string")
    with pytest.raises(RuntimeError, match="stable"):
        near_dup.near_duplicates(df)


def test_pairs_at_the_threshold_stay_together(spark, monkeypatch):
    """Nodes of over four members branch on through all levels; pairs hardly over 0.75, among texts that share half of their words."""
    assert near_dup.loss(0.75) < 3e-6 and near_dup.loss(0.8) < 4e-8
    monkeypatch.setattr(near_dup, "LEAF", 4)
    monkeypatch.setattr(near_dup, "MET", 17)
    rng, shared, rows = random.Random(71), helpers.prose(72, 60), []
    for k in range(60):
        words = (shared + " " + helpers.prose(700 + k, 80)).split()
        other, at = words[:], 60 + rng.randrange(5)
        while True:  # edits as long as the similarity stays over the threshold
            trial = other[:]
            trial[at % 140] = f"new{rng.randrange(10**6)}"
            a, b = helpers.shingles(" ".join(words)), helpers.shingles(" ".join(trial))
            if 100 * len(a & b) < 75 * len(a | b):
                break
            other, at = trial, at + 17
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(near_dup.near_duplicates(df)) == _want(rows)
    assert len({c for *_, c in _want(rows)}) == 60
