"""URL filters: a sorted array of 64-bit digests, mapped into memory and probed by binary search.

Rules (host, path, verdict) are written as one file: the xxhash64 of ``host +
path`` in ascending order, then the full strings. Spark hands the file to every
executor (``addFile``); tasks map it and share its pages. A url probes the
digests of the suffixes of its host with as many labels, and the starts of its path
with as many bytes, as some rule has, so a host of any length takes a bounded number
of probes; the stored string must equal the probe, so a collision of digests
can't give a wrong rule. The longest string wins, at equal lengths that of the
longer host; of repeated rules the first.

Null, or a url without ``://``: empty host and path, no rule. A url that no
rule fits gets the default verdict. Repeated rows are judged one by one, an empty table
stays empty.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cadenza.llm.common import shared_folder, without_column

VERDICTS = ("allow", "block")
_HEAD = struct.Struct("<QQQQ")  # rules, distinct lengths of paths, distinct numbers of labels, bytes of strings


def pack(rules: list[tuple[str, str, str]]) -> bytes:
    """The file of (host, path, verdict) rules: digests, ends of strings, host lengths, verdicts, path lengths, numbers of labels, strings."""
    by_key: dict[bytes, tuple[int, str]] = {}
    for host, path, verdict in rules:
        by_key.setdefault(host.encode() + path.encode(), (len(host.encode()), verdict))
    keys = sorted(by_key, key=lambda k: (xxhash.xxh64_intdigest(k), k))
    lengths = sorted({len(k) - by_key[k][0] for k in keys})
    labels = sorted({k[: by_key[k][0]].count(b".") + 1 for k in keys})
    parts = [
        _HEAD.pack(len(keys), len(lengths), len(labels), sum(map(len, keys))),
        np.array([xxhash.xxh64_intdigest(k) for k in keys], "<u8").tobytes(),
        np.cumsum([len(k) for k in keys]).astype("<u8").tobytes(),
        np.array([by_key[k][0] for k in keys], "<u4").tobytes(),
        np.array([VERDICTS.index(by_key[k][1]) for k in keys], "u1").tobytes(),
        np.array(lengths, "<u4").tobytes(),
        np.array(labels, "<u4").tobytes(),
        b"".join(keys),
    ]
    return b"".join(parts)


class RuleFile:
    """A packed file, mapped into memory."""

    def __init__(self, data: np.ndarray):
        n, k, m, size = _HEAD.unpack(data[: _HEAD.size].tobytes())
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, np.dtype(kind), count, at)
            at += got.nbytes
            return got

        self.digests, self.ends = take("<u8", n), take("<u8", n)
        self.hosts, self.verdicts = take("<u4", n), take("u1", n)
        self.lengths, self.labels, self.strings = take("<u4", k), take("<u4", m), take("u1", size)

    def string(self, i: int) -> bytes:
        return self.strings[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])].tobytes()

    def suffixes(self, host: bytes) -> list[bytes]:
        """The ends of a host that have as many labels as some rule's."""
        if not host or not len(self.labels):
            return []
        parts = host.rsplit(b".", int(self.labels[-1]))  # what stands before the last ones is left in one piece
        known = len(parts) if len(parts) <= self.labels[-1] else int(self.labels[-1])
        return [b".".join(parts[len(parts) - n :]) for n in self.labels.tolist() if n <= known]

    def match(self, urls: list[tuple[bytes, bytes]]) -> list[int]:
        """The number of the rule that wins for each (host, path), or -1."""
        owner, probes, hosts = [], [], []
        for i, (host, path) in enumerate(urls):
            for suffix in self.suffixes(host):
                for length in self.lengths.tolist():
                    if length <= len(path):
                        owner.append(i)
                        probes.append(suffix + path[:length])
                        hosts.append(len(suffix))
        best = [(-1, -1, -1)] * len(urls)
        if probes and len(self.digests):
            digests = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
            at = np.searchsorted(self.digests, digests)
            for p in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == digests).tolist():
                i = int(at[p])
                while i < len(self.digests) and self.digests[i] == digests[p]:
                    if self.hosts[i] == hosts[p] and self.string(i) == probes[p]:
                        best[owner[p]] = max(best[owner[p]], (len(probes[p]), hosts[p], i))
                    i += 1
        return [b[2] for b in best]


def split_url(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    at = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = rest[:at].encode().lower().decode()
    path = rest[at:].partition("#")[0].partition("?")[0]
    return host, path


def publish(spark: SparkSession, rules: list[tuple[str, str, str]]) -> str:
    """Write the rules to the shared folder and have Spark hand the file to the executors; gives its name."""
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(pack(rules))
    out.close()
    spark.sparkContext.addFile(path.toUri().toString())
    return name


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow", out: str = "url_rule") -> DataFrame:
    """``pages`` with the struct ``out``: host, path, the rule that wins (host + path, or null) and the verdict."""
    name = publish(pages.sparkSession, rules)
    pages = without_column(pages, out, url_col)
    fields = T.StructType.fromDDL("host string, path string, rule string, verdict string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = RuleFile(np.memmap(os.path.join(SparkFiles.getRootDirectory(), name), np.uint8, "r"))
        for batch in batches:
            urls = [split_url(u) for u in batch.column(batch.schema.get_field_index(url_col)).to_pylist()]
            won = file.match([(h.encode(), p.encode()) for h, p in urls])
            rows = [
                {"host": h, "path": p, "rule": file.string(i).decode() if i >= 0 else None, "verdict": VERDICTS[file.verdicts[i]] if i >= 0 else default}
                for (h, p), i in zip(urls, won)
            ]
            kind = pa.struct([(f.name, pa.string()) for f in fields])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, out])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(out, fields)]))
