"""Removing, resuming and refreshing by id; always against the current snapshot, so nothing removed comes back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without(rows: DataFrame, flagged: DataFrame, key: str) -> DataFrame:
    return rows.join(flagged.select(key).distinct(), key, "left_anti")


def todo(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is left to do."""
    return ids.select(key).distinct().join(done.select(key), key, "left_anti")


def kept_results(results: DataFrame, ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Results of what is in the table now or was finished before; of repeated ones the last by ``n``."""
    keep = ids.select(key).union(done.select(key)).distinct()
    last = results.groupBy(key).agg(F.max_by(F.struct(*(c for c in results.columns if c not in (key, "n"))), "n").alias("r"))
    return last.join(keep, key, "left_semi").select(key, "r.*")


def changed_samples(before: DataFrame, after: DataFrame, key: str, n: int = 12) -> DataFrame:
    """The first ``n`` changed texts by id, as a report shows them: old and new."""
    both = before.select(key, F.col("text").alias("old")).join(after.select(key, F.col("text").alias("new")), key)
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).orderBy(key).limit(n)


def of_episodes(rows: DataFrame, episodes: DataFrame, key: str = "idx") -> DataFrame:
    """The rows of some episodes only; an episode that has no row is an error."""
    missing = episodes.select(key).distinct().join(rows.select(key), key, "left_anti").first()
    if missing:
        raise ValueError(f"no such episode: {missing[key]}")
    return rows.join(episodes.select(key).distinct(), key, "left_semi")


def with_audio(metadata: DataFrame, headers: DataFrame, key: str = "sid") -> DataFrame:
    """Rows whose audio is there; the others are left out, as a measurement skips them."""
    return metadata.join(headers.select(key).distinct(), key, "left_semi")


def refreshed(rows: DataFrame, texts: DataFrame, key: str, column: str = "text") -> DataFrame:
    """New texts by id; a row without one keeps its own."""
    new = texts.select(key, F.col(column).alias("__new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def verdicts(audits: DataFrame, marks: tuple[str, ...] = ()) -> DataFrame:
    """verdict, n: how often each verdict was given, errors included; and of how many of these each mark is true."""
    return audits.groupBy("verdict").agg(F.count("*").alias("n"), *(F.count_if(m).alias(m) for m in marks))
