"""WAV files as a data source, ``spark.read.format("wav")``: headers by ranged reads, samples in chunks.

Options: ``path`` (a folder that all tasks reach: file, hdfs, s3, gs), ``globs`` (names, separated by commas; a file that
several match is there once), ``samples`` (of a chunk). The schema that is asked for decides what is read: without ``chunk``
and ``pcm`` a row for each file and its first bytes only, with them a row for each chunk of samples. Files are dealt
over partitions by number or by bytes, and a long file is several partitions. A file that can't be read is a row with the
reason in ``error``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes that are read first; headers mostly lie in there.
HEAD = 4096
#: Files of a partition of headers; bytes of a partition of samples.
FILES, BYTES = 512, 64 << 20
SAMPLES = 1 << 18
HEADERS = "path string, sid string, sr int, channels int, width int, frames long, bytes long, head_bytes long, error string"
CHUNKS = "path string, sid string, sr int, frames long, chunk long, pcm binary, error string"


@dataclass(frozen=True)
class Layout:
    """What a header says: rate, channels, bytes a sample, frames, and where the samples start."""

    sr: int
    channels: int
    width: int
    frames: int
    start: int


def layout(read: Callable[[int, int], bytes], size: int) -> Layout:
    """The layout of a RIFF file of ``size`` bytes; ``read(at, n)`` gives bytes of it. Large chunks before the samples are passed over, not read."""
    head = read(0, min(HEAD, size))
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, sr, channels, width = 12, 0, 0, 0
    while at + 8 <= size:
        part = head[at : at + 24] if at + 24 <= len(head) else read(at, min(24, size - at))
        kind, n = part[:4], int.from_bytes(part[4:8], "little")
        if kind == b"fmt " and len(part) == 24:
            channels, sr, width = int.from_bytes(part[10:12], "little"), int.from_bytes(part[12:16], "little"), int.from_bytes(part[22:24], "little") // 8
        elif kind == b"data":
            if not (sr and channels and width):
                raise ValueError("samples of an unknown kind")
            return Layout(sr, channels, width, min(n, size - at - 8) // (channels * width), at + 8)
        at += 8 + n + n % 2
    raise ValueError("no samples")


def mono16(data: bytes, found: Layout) -> bytes:
    """Samples of any width up to 32 bits as 16-bit ones, channels averaged."""
    if found.width == 1:
        x = (np.frombuffer(data, "u1").astype(np.float32) - 128) / 128
    elif found.width in (2, 4):
        x = np.frombuffer(data, f"<i{found.width}").astype(np.float32) / float(1 << (8 * found.width - 1))
    elif found.width == 3:
        three = np.frombuffer(data, "u1").reshape(-1, 3)
        x = (np.c_[np.zeros(len(three), "u1"), three].reshape(-1).view("<i4") / float(1 << 31)).astype(np.float32)
    else:
        raise ValueError(f"{8 * found.width}-bit samples aren't supported")
    x = x.reshape(-1, found.channels).mean(1) if found.channels > 1 else x
    return np.round(np.clip(x, -1, 32767 / 32768) * 32768).astype("<i2").tobytes()


@dataclass
class Part(InputPartition):
    """Files (path, bytes) of which the chunks are read that start between two places; all of them if these are None."""

    files: list[tuple[str, int]]
    low: int | None = None
    high: int | None = None


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.root, self.columns = options.get("path") or "", schema.fieldNames()
        self.globs = [g.strip() for g in (options.get("globs") or "*.wav").split(",") if g.strip()]
        self.samples = int(options.get("samples") or SAMPLES)
        self.deep = bool({"chunk", "pcm"} & {*self.columns})
        known = {f.split()[0] for kind in (HEADERS, CHUNKS) for f in kind.split(", ")}
        if unknown := {*self.columns} - known:
            raise ValueError(f"no such columns: {sorted(unknown)}")

    def partitions(self) -> list[Part]:
        store, root = fs.FileSystem.from_uri(self.root)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and any(fnmatchcase(f.base_name, g) for g in self.globs))
        if not self.deep:
            return [Part(files[k : k + FILES]) for k in range(0, len(files), FILES)] or [Part([])]
        out, held, size = [], [], 0
        for path, n in files:
            if n > BYTES:
                out += [Part([(path, n)], low, low + BYTES) for low in range(0, n, BYTES)]
                continue
            if held and size + n > BYTES:
                out.append(Part(held))
                held, size = [], 0
            held.append((path, n))
            size += n
        return [*out, Part(held)]

    def read(self, partition: Part) -> Iterator[tuple]:
        store, _ = fs.FileSystem.from_uri(self.root)
        for path, size in partition.files:
            row = dict.fromkeys(self.columns) | {"path": path, "sid": path.rsplit("/", 1)[-1].rsplit(".", 1)[0], "bytes": size}
            told = 0
            try:
                with store.open_input_file(path) as f:

                    def read(at: int, n: int) -> bytes:
                        nonlocal told
                        told += n
                        return f.read_at(n, at)

                    found = layout(read, size)
                    row |= {"sr": found.sr, "channels": found.channels, "width": found.width, "frames": found.frames, "head_bytes": told}
                    if not self.deep:
                        yield tuple(row[c] for c in self.columns)
                        continue
                    frame = found.width * found.channels
                    for chunk in range(-(-found.frames // self.samples)):
                        at = found.start + chunk * self.samples * frame
                        if partition.low is not None and not partition.low <= at < partition.high:
                            continue
                        n = min(self.samples, found.frames - chunk * self.samples)
                        row |= {"chunk": chunk, "pcm": mono16(f.read_at(n * frame, at), found) if "pcm" in self.columns else None}
                        yield tuple(row[c] for c in self.columns)
            except (ValueError, OSError) as error:
                if not partition.low:  # told once for each file
                    yield tuple((row | {"error": str(error), "head_bytes": told})[c] for c in self.columns)


class WavSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> str:
        return HEADERS

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options, schema)


def _read(spark: SparkSession, path: str, globs: tuple[str, ...], schema: str, **options) -> DataFrame:
    spark.dataSource.register(WavSource)
    return spark.read.format("wav").schema(schema).options(globs=",".join(globs), **options).load(path)


def headers(spark: SparkSession, path: str, globs: tuple[str, ...] = ("*.wav",)) -> DataFrame:
    """A row of :data:`HEADERS` for each file; only the first bytes of a file are read."""
    return _read(spark, path, globs, HEADERS)


def chunks(spark: SparkSession, path: str, globs: tuple[str, ...] = ("*.wav",), samples: int = SAMPLES) -> DataFrame:
    """(sid, chunk, sr, pcm) for :mod:`cadenza.operators.waves`, mono, 16 bits; files that can't be read have none, see :func:`headers` for why."""
    found = _read(spark, path, globs, "sid string, chunk long, sr int, pcm binary, error string", samples=samples)
    return found.where("error is null").drop("error")
