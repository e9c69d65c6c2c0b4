"""Recordings of any format as chunks, through a decoder that plugs in; WAV files need none, see :mod:`cadenza.sources.wavsource`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import providers
from cadenza.operators import audio, waves
from cadenza.sources.scratch import Scratch


def decoded(spark: SparkSession, path: str, globs: tuple[str, ...], make: Callable[[], providers.Provider], done: DataFrame | None = None, to: int | None = None, size: int = waves.SIZE) -> tuple[DataFrame, DataFrame]:
    """Chunks (sid, chunk, sr, pcm) of the files below ``path`` that one of ``globs`` matches, and (sid, error) of those that can't be decoded.

    The decoder sees ``path`` and ``content`` and gives ``sr`` and mono ``pcm`` of 16 bits. Files whose sid is in ``done`` are
    left out before they are opened; with ``to`` all come out at that rate. A file that several globs match counts once.
    """
    files = None
    for glob in globs:
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")
        files = found if files is None else files.unionByName(found.join(files.select("path"), "path", "left_anti"))
    sid = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    rows = files.withColumn("sid", sid)
    if done is not None:
        rows = rows.join(done.select("sid").distinct(), "sid", "left_anti")
    found = Scratch(spark, "decoded").write(providers.apply(rows.select("sid", "path", "content"), make, "sr int, pcm binary", "sid"), "files")
    good = found.where("error is null").select("sid", "sr", "pcm")
    return waves.chunked(good if to is None else audio.at_rate(good, to), size), found.where("error is not null").select("sid", "error")
