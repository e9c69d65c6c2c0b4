"""Transcript repair and alignment over whole tables; one utterance is a row, so nothing is shuffled but the joins by id."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import matching
from cadenza.functions.rowwise import mapped
from cadenza.functions.text import CHINESE, tail_mark

ITEMS = "array<struct<token: string, start: double, end: double>>"


def compare(pairs: DataFrame) -> DataFrame:
    """(id, a, b) with sim, the ratio of matching characters; null if either text is."""

    @F.pandas_udf("double")
    def sim(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else matching.similarity(x, y) for x, y in zip(a, b)], dtype="float64")

    return pairs.withColumn("sim", sim("a", "b"))


def repair(rows: DataFrame, chinese_only: bool = True) -> DataFrame:
    """(id, old, text, items) to (id, text, outcome, n_deleted, n_inserted).

    The transcript replaces the old text, with its marks repaired, if it is similar to it, two characters long, has a
    Chinese one, and four fifths of its items are met; a row without an alignment keeps its text.
    """

    def run(sid, old, text, tokens, starts, ends) -> tuple:
        if text is None or tokens is None:
            return sid, old, "no_alignment", 0, 0
        good = len(text) >= 2 and (not chinese_only or any(CHINESE[0] <= c <= CHINESE[2] for c in text))
        if not good or matching.similarity(old or "", text) < 0.5:
            return sid, old, "unlike", 0, 0
        owner, coverage = matching.match_chars(text, tokens)
        if coverage < 0.8:
            return sid, old, "not_covered", 0, 0
        fixed, deleted, inserted = matching.repair_punctuation(text, list(zip(tokens, starts, ends)), owner)
        return sid, fixed, "repaired", deleted, inserted

    kinds = dict(rows.dtypes)
    return mapped(rows.select("id", "old", "text", "items.token", "items.start", "items.end"), run, f"id {kinds['id']}, text string, outcome string, n_deleted long, n_inserted long")


def align(rows: DataFrame) -> DataFrame:
    """(id, text, tokens) to coverage by characters, and matched and n_items by the pointer walk."""

    def run(sid, text, tokens) -> tuple:
        text, tokens = text or "", tokens or []
        return sid, matching.match_chars(text, tokens)[1], len(matching.aligned_tokens(text, tokens)), len(tokens)

    return mapped(rows.select("id", "text", "tokens"), run, f"id {dict(rows.dtypes)['id']}, coverage double, matched long, n_items long")


def rewrite_tails(texts: DataFrame, forced: DataFrame) -> DataFrame:
    """(sid, text) with the tail mark rewritten where (sid, forced) says so; ``changed`` tells which."""
    rows = texts.join(forced.select("sid", "forced"), "sid", "left")
    new = tail_mark(F.col("text"), F.coalesce("forced", F.lit(False)))
    return rows.select("sid", new.alias("text"), (~new.eqNullSafe(F.col("text"))).alias("changed"))


def pair_groups(texts: DataFrame, groups: DataFrame, least: float = 0.85) -> DataFrame:
    """(idx, n, text) and (idx, gid, text) to (idx, n, gid), for datasets without a manifest.

    Texts and groups of an episode are in order, and groups may be left out; without punctuation a pair must be alike
    by ``least``. A text without a group is an error. An episode's transcripts are one group of rows.
    """
    from cadenza.functions.text import strip_punct

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("n"), b.sort_values("gid")
        at = matching.pair_in_order(a["bare"].tolist(), b["bare"].tolist(), least)
        return pd.DataFrame({"idx": a["idx"].tolist(), "n": a["n"].tolist(), "gid": [b["gid"].iloc[k] for k in at]})

    kinds = dict(texts.dtypes)
    left = texts.select("idx", "n", strip_punct(F.col("text")).alias("bare")).groupBy("idx")
    right = groups.select("idx", "gid", strip_punct(F.col("text")).alias("bare")).groupBy("idx")
    return left.cogroup(right).applyInPandas(run, f"idx {kinds['idx']}, n {kinds['n']}, gid {dict(groups.dtypes)['gid']}")
