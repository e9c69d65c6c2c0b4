"""Fingerprints and stamps: is an artefact newer than what it was made from?

Freshness is by (id, frames): removals and text edits stay fresh, changed lengths
and new ids are stale, and so is a missing stamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class StaleArtifact(RuntimeError):
    """Raised by :func:`require_fresh`."""


def part_hashes(files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., name, hash) to one hash of sixteen digits for each key: of all its names and hashes, in order."""
    entry = F.concat_ws(":", "name", "hash")
    return files.groupBy(*keys).agg(F.substring(F.sha1(F.array_join(F.array_sort(F.collect_list(entry)), "|")), 1, 16).alias("fp"))


def files_hash(files: DataFrame) -> DataFrame:
    """(name, hash) of a stage's few input files to one hash; for the rows of a corpus use :func:`part_hashes`."""
    return part_hashes(files, [])


def dataset_fingerprint(metadata: DataFrame, headers: DataFrame) -> DataFrame:
    """(sid, frames); -1 where there is no audio."""
    return metadata.select("sid").distinct().join(headers.select("sid", "frames"), "sid", "left").select("sid", F.coalesce("frames", F.lit(-1)).cast("long").alias("frames"))


def stale(current: DataFrame, stamped: DataFrame) -> DataFrame:
    """Ids that are new or whose length changed; ids that only the stamp has are removals, and fresh."""
    old = stamped.select("sid", F.col("frames").alias("was"), F.lit(True).alias("known"))
    rows = current.join(old, "sid", "left")
    why: Column = F.when(F.col("known").isNull(), "new").when(~F.col("frames").eqNullSafe(F.col("was")), "changed")
    return rows.withColumn("why", why).where("why is not null").select("sid", "frames", "was", "why")


def require_fresh(current: DataFrame, stamped: DataFrame | None, stage: str) -> None:
    if stamped is None:
        raise StaleArtifact(f"{stage}: no stamp; run it again")
    n = stale(current, stamped).count()
    if n:
        raise StaleArtifact(f"{stage}: {n} ids are new or changed since the stamp; run it again")
