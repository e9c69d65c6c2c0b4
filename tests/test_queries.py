"""Every registered query of the core at the smallest size, against its SQL; plans of the main ones."""

import glob
import os
from difflib import SequenceMatcher
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.plans.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    if name not in oracle_sql():
        assert got
        return
    want = duck.sql(oracle_sql()[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=_key)


@pytest.fixture(scope="module")
def many_episodes(spark, tmp_path_factory):
    """The events of the smallest size, with episodes 100 to 102 and 1000 to 1029: three digits don't tell them apart."""
    folder = str(tmp_path_factory.mktemp("many"))
    events = spark.read.parquet(f"{DATA}/events.parquet")
    number = F.when(F.col("user_id") < 3, F.col("user_id") + 100).otherwise(F.col("user_id") + 1000)
    events.withColumn("user_id", number).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def _equals_sql(spark, folder, name):
    df, con = queries()[name](spark, folder), duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    want = con.sql(oracle_sql()[name]).project(", ".join(df.columns)).fetchall()
    return want and sorted((tuple(r) for r in df.collect()), key=_key) == sorted(want, key=_key)


@pytest.mark.parametrize("name", ["manifest", "manifest_check", "tail_mark_rewrite"])
def test_episodes_over_three_digits(spark, many_episodes, name):
    assert _equals_sql(spark, many_episodes, name)


def test_everything_but_text_matching_has_sql():
    assert queries().keys() - oracle_sql().keys() == {"text_similarity", "char_alignment", "punct_rewrite", "alignment_scores"}


def test_plans(spark):
    def plan(name):
        return queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()

    assert "Python" not in plan("segment_gaps") and "Arrow" not in plan("loudness_plan") and "Pandas" not in plan("silence_flags")
    assert "BroadcastNestedLoopJoin" in plan("prosody_score") and "CartesianProduct" not in plan("prosody_score")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan("loudness_plan")


@pytest.mark.parametrize(("name", "table", "most"), [("segment_gaps", "events", 1), ("gap_event_plan", "embeddings", 8), ("cut_totals", "embeddings", 8), ("silence_bounds", "conversations", 1), ("silence_flags", "conversations", 1), ("split_override", "events", 0), ("manifest_check", "events", 0), ("loudness_plan", "orders", 1)])
def test_source_tables_are_read_a_few_times(spark, name, table, most):
    """Scans of the source in the result's own plan; bucket tables and written inputs are small or read instead."""
    plan = queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"sf0.001/{table}.parquet") <= most, plan.count(f"sf0.001/{table}.parquet")


def test_alignments_are_scored(spark):
    """Against difflib and a walk along the text, on whole turns."""
    from cadenza.functions import matching
    from cadenza.plans import queries as q

    metadata, alignments = (df.collect() for df in q._transcripts(spark, DATA))
    texts, got = {r["sid"]: r["text"] for r in metadata}, {r["sid"]: r for r in queries()["alignment_scores"](spark, DATA).collect()}
    assert got.keys() == {r["sid"] for r in alignments} and {r["eligible"] for r in got.values()} == {True, False}
    for r in alignments:
        sim, met = SequenceMatcher(None, texts[r["sid"]], r["text"]).ratio(), matching.match_tokens(texts[r["sid"]], [x["token"] for x in r["items"]])[1]
        want = (round(sim, 6), len(r["items"]), met, sim >= 0.5 and met >= 0.8 * len(r["items"]) and met >= 2)
        have = got[r["sid"]]
        assert (have["n_items"], have["aligned"], have["eligible"]) == want[1:] and have["sim"] == pytest.approx(want[0], abs=1.01e-6)


def test_turns_are_compared_whole(spark):
    """Against difflib, on whole texts of all turns."""
    texts = {(r["conv_id"], r["turn"]): r["text"] for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()}
    want = {(c, t): SequenceMatcher(None, a, texts[c, t - 1]).ratio() for (c, t), a in texts.items() if (c, t - 1) in texts}
    got = {(r["conv_id"], r["turn"]): r["sim"] for r in queries()["text_similarity"](spark, DATA).collect()}
    assert any("." in a[:-1] for a in texts.values()) and got == pytest.approx(want, abs=1.01e-6)


def test_splits_are_made_once(spark):
    """The result numbers written rows: it reads these and the table of buckets, and gathers no group again."""
    plan = queries()["split_override"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 2 and "Aggregate" not in plan


@pytest.mark.parametrize("name", ["segment_gaps", "vad_coalesce", "greedy_groups", "group_review", "group_validation", "split_override", "pad_clip", "manifest", "forced_ends", "manifest_check", "token_gaps"])
def test_no_table_that_grows_is_broadcast(spark, monkeypatch, name):
    """Whatever the files of written tables weigh: neither tables of buckets nor members, on the way or in the result."""
    from cadenza.sources.scratch import Scratch

    plans, write = [], Scratch.write

    def plan(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    def noted(self, df, table):
        plan(df)
        return write(self, df, table)

    monkeypatch.setattr(Scratch, "write", noted)
    plan(queries()[name](spark, DATA))
    assert len(plans) > 1 and "SortMergeJoin" in plans[-1] and not any("Broadcast" in p for p in plans)
