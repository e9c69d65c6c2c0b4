"""WAV files as tables: headers without samples, clips with 16-bit mono samples; writers of files and of packed tables."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.sources.wavsource import headers, layout

def header(head: bytes, size: int) -> tuple[int, int, int, int]:
    """Rate, channels, bytes a sample, frames; from the head of a RIFF file of ``size`` bytes."""
    found = layout(lambda at, n: head[at : at + n], size)
    return found.sr, found.channels, found.width, found.frames


def decode(data: bytes) -> tuple[int, np.ndarray]:
    """Rate and mono samples in [-1, 1); several channels are averaged."""
    with wave.open(io.BytesIO(data)) as w:
        rate, channels, width = w.getframerate(), w.getnchannels(), w.getsampwidth()
        raw = w.readframes(w.getnframes())
    if width not in (1, 2, 4):
        raise ValueError(f"{8 * width}-bit samples aren't supported")
    x = np.frombuffer(raw, {1: "u1", 2: "<i2", 4: "<i4"}[width]).astype(np.float32)
    x = (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1))
    return rate, x.reshape(-1, channels).mean(1) if channels > 1 else x


def encode(rate: int, pcm: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(pcm)
    return out.getvalue()


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(path)


def _sid():
    return F.regexp_extract("path", r"([^/]*)\.wav$", 1).alias("sid")


def read_headers(spark: SparkSession, path: str, globs: tuple[str, ...] = ("*.wav",)) -> DataFrame:
    """sid, sr, channels, frames; only the head of each file is read, and one that can't be read is an error."""
    rows = headers(spark, path, globs)
    good = F.when(F.col("error").isNull(), F.col("sid")).otherwise(F.raise_error(F.concat("path", F.lit(": "), "error")))
    return rows.select(good.alias("sid"), "sr", "channels", "frames")


def read_clips(spark: SparkSession, path: str) -> DataFrame:
    """sid, sr, pcm: mono, 16 bits. A file that can't be read has nulls and the reason in ``error``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for sid, content in pdf.itertuples(index=False):
                try:
                    sr, x = decode(content)
                    rows.append((sid, sr, np.round(np.clip(x, -1, 1) * 32767).astype("<i2").tobytes(), None))
                except (ValueError, wave.Error, EOFError) as e:
                    rows.append((sid, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["sid", "sr", "pcm", "error"]).astype({"sr": "Int32"})

    return _files(spark, path).select(_sid(), "content").mapInPandas(run, "sid string, sr int, pcm binary, error string")


def write_wavs(clips: DataFrame, path: str) -> int:
    """One file for each (sid, sr, pcm), through Hadoop's file systems by way of the tasks' own part files.

    Tasks return the encoded files; they are stored as a table of (path, content), the form in which object stores
    and :func:`read_packed` take them. Gives the number of clips.
    """

    @F.pandas_udf("binary")
    def wav(sr: pd.Series, pcm: pd.Series) -> pd.Series:
        return pd.Series([encode(int(s), p) for s, p in zip(sr, pcm)])

    packed = clips.select(F.concat("sid", F.lit(".wav")).alias("path"), wav("sr", "pcm").alias("content"))
    packed.write.mode("overwrite").parquet(path)
    return clips.sparkSession.read.parquet(path).count()


def write_files(clips: DataFrame, uri: str) -> int:
    """A file ``<sid>.wav`` for each (sid, sr, pcm), written by the tasks to a folder that all of them reach (file, hdfs, s3, gs).

    A file is written under a name of the task attempt's own and then moved, so an attempt that is run again replaces
    whole files, and no reader sees half of one. Clips without an id, a rate or samples are left out; of repeated ids one
    file stays; ids with a slash are an error. Gives the number of clips.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folder, root = fs.FileSystem.from_uri(uri)
        folder.create_dir(root, recursive=True)
        part = f"{root}/_{TaskContext.get().taskAttemptId()}.part"
        for pdf in batches:
            for sid, sr, pcm in pdf.itertuples(index=False):
                if "/" in sid:
                    raise ValueError(f"an id can't have a slash: {sid!r}")
                with folder.open_output_stream(part) as f:
                    f.write(encode(int(sr), pcm))
                folder.move(part, f"{root}/{sid}.wav")
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = clips.select(F.col("sid").cast("string"), "sr", "pcm").dropna()
    return rows.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
