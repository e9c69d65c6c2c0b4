"""Benchmark decontamination: a prefix-filtered join of item windows with texts.

A window is ``size`` consecutive words of an item, or the whole of a shorter
one. Its set holds its shingles of ``shingle`` words. All shingles of a window
must lie in a text that contains it, so with shingles in order of rarity a
prefix of one, the rarest, is enough to find every candidate. Rarity is counted
over all texts. A text's occurrence of a window's rarest shingle fixes where
the window would start (position bound) and end (length bound); equal words in
between verify it exactly.

The benchmark goes to the tasks in blocks of about ``block_words`` words, each of
them against all texts, so the broadcast is bounded for a benchmark of any size, at
one pass over the texts for each block. Items are cut into pieces of ``PIECE`` words
that overlap, so that each window lies in one, and pieces are dealt by a hash of
themselves: neither a huge item nor an id with most of the rows makes a block larger.
Words are compared as words, not as hashes.

Null texts have no words, items without an id or a text no windows; empty tables
give no hits. Repeated item rows or ids count once; of windows equally rare within
an item the first is looked up. A text's row keeps its other columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cadenza.llm.common import Scratch, alnum_words, raw_texts, slices, without_column
from cadenza.llm.repetition import covered

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)), T.StructField("items", T.ArrayType(T.StringType()))])
#: Words of distinct items in a block; three word ids must fit into 63 bits.
BLOCK_WORDS = 1_000_000
#: Words of a piece of an item.
PIECE = 10_000


class Block:
    """Windows of some items, by word ids."""

    def __init__(self, items: list[tuple[str, bytes]], size: int, shingle: int):
        self.shingle = shingle
        self.number: dict[bytes, int] = {}
        self.items: list[str] = []
        windows: dict[tuple[int, ...], set[int]] = {}
        for item, raw in sorted({x for x in items if x[1]}):
            ids = [self.number.setdefault(w, len(self.number)) for w in alnum_words(raw)]
            if ids:
                if not self.items or self.items[-1] != item:
                    self.items.append(item)
                for at in range(max(1, len(ids) - size + 1)):
                    windows.setdefault(tuple(ids[at : at + size]), set()).add(len(self.items) - 1)
        self.windows = list(windows)
        self.owners = [sorted(x) for x in windows.values()]
        self.base = len(self.number) + 1
        if self.base**shingle >= 1 << 63:
            raise ValueError(f"{shingle} of {len(self.number)} words don't fit into one number")

    def codes(self, ids: np.ndarray, k: int) -> np.ndarray:
        """One number for the k words from each position on; below 0 if one is in no item."""
        if len(ids) < k:
            return np.zeros(0, np.int64)
        out = ids[: len(ids) - k + 1].copy()
        bad = out < 0
        for j in range(1, k):
            part = ids[j : len(ids) - k + 1 + j]
            bad |= part < 0
            out = out * self.base + part
        out[bad] = -1
        return out

    def _lengths(self) -> list[int]:
        return sorted({min(self.shingle, len(w)) for w in self.windows})

    def shingles(self) -> dict[int, np.ndarray]:
        """The distinct shingles of all windows, for each length."""
        return {k: np.unique(np.concatenate([self.codes(np.array(w), k) for w in self.windows if min(self.shingle, len(w)) == k])) for k in self._lengths()}

    def index(self, counts: dict[tuple[int, int], int]) -> None:
        """Keep for each window its rarest shingle: {length: (codes, first entry of each, offsets, windows)}."""
        self.prefix = {}
        for k in self._lengths():
            entries = []
            for i, w in enumerate(self.windows):
                if min(self.shingle, len(w)) == k:
                    codes = self.codes(np.array(w), k).tolist()
                    offset = min(range(len(codes)), key=lambda o: (counts.get((k, codes[o]), 0), codes[o], o))
                    entries.append((codes[offset], offset, i))
            code, offset, window = np.array(sorted(entries), np.int64).T
            codes, first = np.unique(code, return_index=True)
            self.prefix[k] = codes, np.r_[first, len(code)], offset, window
        sizes = [len(w) for w in self.windows]
        self.size = np.array(sizes, np.int64)
        self.words = np.full((len(sizes), max(sizes, default=1)), -1, np.int64)
        for i, w in enumerate(self.windows):
            self.words[i, : len(w)] = w

    def ids(self, raws: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of all texts of a slice, -2 between texts and -1 for words of no item; the words of each."""
        get, out, counts = self.number.get, [], []
        for raw in raws:
            words = alnum_words(raw or b"")
            counts.append(len(words))
            out.extend(map(get, words, repeat(-1)))
            out.append(-2)
        return np.array(out, np.int64), np.array(counts, np.int64)

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The starts and the numbers of all windows that occur."""
        starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (codes, first, offset, window) in self.prefix.items():
            at = np.flatnonzero((code := self.codes(ids, k)) >= 0)
            entry = np.minimum(np.searchsorted(codes, code[at]), len(codes) - 1)
            hit = codes[entry] == code[at]
            at, entry = at[hit], entry[hit]
            n = first[entry + 1] - first[entry]
            which = np.repeat(first[entry], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start, w = np.repeat(at, n) - offset[which], window[which]
            fits = (start >= 0) & (start + self.size[w] <= len(ids))
            start, w = start[fits], w[fits]
            for j in range(self.words.shape[1]):  # a text's end differs from every word
                same = (j >= self.size[w]) | (ids[np.minimum(start + j, len(ids) - 1)] == self.words[w, j])
                start, w = start[same], w[same]
            starts.append(start)
            found.append(w)
        return np.concatenate(starts), np.concatenate(found)


def _count(blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, wanted = blocks.value
        total: Counter[tuple[int, int]] = Counter()
        for batch in slices(batches):
            ids, _ = block.ids(raw_texts(batch))
            for k, codes in wanted.items():
                got = block.codes(ids, k)
                got = got[got >= 0]
                got = got[codes[np.minimum(np.searchsorted(codes, got), len(codes) - 1)] == got]
                total.update({(k, c): n for c, n in zip(*(x.tolist() for x in np.unique(got, return_counts=True)))})
        columns = zip(*((k, c, n) for (k, c), n in total.items())) if total else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in columns], names=["k", "code", "n"])

    return run


def _mark(block, text_col: str, out: str):
    kind = to_arrow_type(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        for batch in slices(batches, text_col):
            raws = raw_texts(batch, text_col)
            ids, counts = own.ids(raws)
            starts, windows = own.find(ids)
            first = np.cumsum(counts + 1) - counts - 1
            text = np.searchsorted(first, starts, side="right") - 1
            hit = covered(starts, own.size[windows], len(ids))
            edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
            begin, end = edges[::2], edges[1::2]  # texts are apart by one, so no span has two
            where = np.searchsorted(first, begin, side="right") - 1
            before = batch.column(batch.schema.get_field_index(out)).to_pylist() if out in batch.schema.names else [None] * len(raws)
            rows = [{"n_words": n, "spans": list(x["spans"]) if x else [], "items": set(x["items"]) if x else set()} for n, x in zip(counts.tolist(), before)]
            for t, a, b in zip(where.tolist(), (begin - first[where]).tolist(), (end - first[where]).tolist()):
                rows[t]["spans"].append({"start": a, "end": b})
            for t, w in set(zip(text.tolist(), windows.tolist())):
                rows[t]["items"].update(own.items[i] for i in own.owners[w])
            for row in rows:
                row["items"] = sorted(row["items"], key=lambda s: s.encode())
                row["spans"] = _united(row["spans"])
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != out]
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(rows, kind)], names=[*(n for n, _ in rest), out])

    return run


def _united(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for x in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if out and x["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], x["end"])}
        else:
            out.append(dict(x))
    return out


def _pieces(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            for item, raw in zip(batch.column("item").to_pylist(), raw_texts(batch)):
                words = alnum_words(raw)
                for at in range(0, max(1, len(words) - size + 1), PIECE - size + 1):
                    part = words[at : at + PIECE]
                    if part:
                        out.append((item, b" ".join(part), len(part)))
            kinds = pa.string(), pa.binary(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=["item", "piece", "n"])

    return run


def find_items(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    size: int = 10, shingle: int = 3, block_words: int = BLOCK_WORDS, out: str = "leaks",
) -> DataFrame:
    """``docs`` with the struct ``out``: n_words, the spans of hit words (end exclusive) and the items found."""
    spark = docs.sparkSession
    if shingle > 3 or block_words > 2_000_000:
        raise ValueError("three words of a block must fit into one number")
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").alias("text")).where("item is not null and text is not null")
    pieces = items.mapInArrow(_pieces(size), "item string, piece binary, n long").distinct()
    pieces = Scratch(spark, "decontaminate").write(pieces, "pieces")
    words = pieces.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, -(-words // block_words))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(n_blocks)))
    docs = without_column(docs, out, text_col)
    found = docs
    for b in range(n_blocks):
        block = Block([(r["item"], bytes(r["piece"])) for r in dealt.where(F.col("block") == b).collect()], size, shingle)
        wanted = block.shingles()
        counts: dict[tuple[int, int], int] = {}
        if wanted:
            shared = spark.sparkContext.broadcast((block, wanted))
            total = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_count(shared), "k long, code long, n long")
            counts = {(r["k"], r["code"]): r["n"] for r in total.groupBy("k", "code").agg(F.sum("n").alias("n")).collect()}
        block.index(counts)
        schema = T.StructType([*docs.schema.fields, T.StructField(out, FOUND)])
        found = found.mapInArrow(_mark(spark.sparkContext.broadcast(block), text_col, out), schema)
    return found
