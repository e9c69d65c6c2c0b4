"""Near-duplicates by SimHash fingerprints, found by deletion-variant signatures.

1. A text's fingerprint has a bit set where over half of its hashed 4-word shingles,
   repeats included, have it. From here on each distinct fingerprint is one row.
2. A fingerprint is cut into ``SEGMENTS`` segments. Of two that differ in 4 bits at
   most, one segment differs in one bit at most, so both have an equal variant of
   that segment with one bit left out. All 64 one-wildcard variants are indexed,
   and fingerprints of an equal variant are compared by exclusive or.
3. A pair is accepted only at its first common variant (the lowest segment that
   differs in at most one bit; there the bit that differs, or the lowest one), so a
   link is found once. Of the links of a bucket only a spanning forest goes on.
4. Buckets are ``LIMIT`` rows at most: before the variants are dealt, segment values
   that over ``LIMIT / 2`` fingerprints have are counted. The buckets next to them are
   divided by pieces of all other bits, cut into one more piece than bits may
   differ, of which one is therefore equal; what is still too large is compared
   block against block, each pair of blocks in a cell of its own.
5. Components come from alternating large-star and small-star steps over distinct
   fingerprints and go back to all rows; copies of a hot fingerprint are dealt over
   several copies of its row.

Nothing is dropped or capped: every bucket, however large, is compared whole. Texts
without words and null texts have the fingerprint zero and are linked like any
others. Fewer than four words make one shingle. Repeated rows and repeated or null
ids are rows of their own; a component's id is its smallest id that isn't null. An
empty table stays empty. Only the two named columns are read, so no other can
clash. A long text is hashed in pieces, its words and their places are held at once.
There are no ties: a bit that exactly half of the shingles have is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch, raw_texts, slices, space_words
from cadenza.llm.near_dup import _bounded, _Join, _runs

SHINGLE, SEED = 4, 42
#: Differing bits of a link, at most.
BITS = 4
SEGMENTS = BITS // 2 + 1  # one of them differs in one bit at most
#: Lowest bit and width of each segment.
CUTS = tuple((64 * s // SEGMENTS, 64 * (s + 1) // SEGMENTS - 64 * s // SEGMENTS) for s in range(SEGMENTS))
#: Rows of a bucket that is compared at once, at most; rows of a block of a larger one, about.
LIMIT, BLOCK = 4096, 2048
#: Shingles whose bits are counted at a time.
PIECE = 1 << 16
_WIDEST = max(width for _, width in CUTS)


def fingerprint(raw: bytes) -> int:
    """The fingerprint of a text as an unsigned number."""
    words = space_words(raw.lower())
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n, digest = max(1, len(words) - SHINGLE + 1), xxhash.xxh64_intdigest
    places = zip(starts[:n].tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist())
    count, left = np.zeros(64, np.int64), n
    while left:
        size = min(PIECE, left)
        h = np.fromiter((digest(line[s:e], SEED) for s, e in islice(places, size)), np.uint64, size)
        count += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, np.int64)
        left -= size
    return int.from_bytes(np.packbits(2 * count > n, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = np.fromiter((fingerprint(raw or b"") for raw in raw_texts(batch)), np.uint64, batch.num_rows)
        rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != "text"]
        yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(found.view(np.int64))], names=[*(n for n, _ in rest), "fp"])


def _segment(s: int) -> Column:
    low, width = CUTS[s]
    return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))


def _key(number: int, value: Column) -> Column:
    return value.bitwiseOR(F.lit(number << _WIDEST))


def _variants() -> Column:
    """The key of each one-wildcard variant: the place of the bit left out, and its segment with that bit cleared."""
    keys = []
    for s, (low, width) in enumerate(CUTS):
        keys += [_key(low + j, _segment(s).bitwiseAND(F.lit(~(1 << j)))) for j in range(width)]
    return F.array(*keys)


def _others(fp: np.ndarray, s: int) -> np.ndarray:
    """All bits but those of segment ``s``, put together."""
    low, width = CUTS[s]
    above = fp >> np.uint64(low + width) if low + width < 64 else np.zeros_like(fp)
    return above << np.uint64(low) | fp & np.uint64((1 << low) - 1)


def _pieces(width: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each piece of the bits outside a segment: one more than bits that may differ."""
    rest = 64 - width
    edges = [rest * p // (BITS + 1) for p in range(BITS + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _linked(x: np.ndarray, y: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Whether fingerprints link and have their first common key here: the wildcard at ``place``, and ``piece`` if it isn't -1."""
    differ = x ^ y
    found = np.bitwise_count(differ) <= BITS
    lower, first = np.zeros(differ.shape, bool), np.zeros(differ.shape, bool)
    for low, width in CUTS:
        own = differ >> np.uint64(low) & np.uint64((1 << width) - 1)
        here = (place >= low) & (place < low + width)
        bit = np.uint64(1) << (np.where(here, place - low, 0)).astype(np.uint64)
        first |= here & ~lower & np.where(own == 0, place == low, own == bit)
        lower |= np.bitwise_count(own) <= 1
    found &= first
    if found.any() and (piece >= 0).any():
        for s, (low, width) in enumerate(CUTS):
            rest, here, earlier = _others(differ, s), (place >= low) & (place < low + width), np.zeros(differ.shape, bool)
            for p, (at, size) in enumerate(_pieces(width)):
                equal = (rest >> np.uint64(at) & np.uint64((1 << size) - 1)) == 0
                found &= ~here | (piece != p) | (equal & ~earlier)
                earlier |= equal
    return found


def forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that links connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        while True:
            after = new[new]
            if (after == new).all():
                break
            new = after
        if (new == label).all():
            return label
        label = new


def _bucket_links(key: np.ndarray, fp: np.ndarray, place: np.ndarray, piece: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Forests of the links within whole buckets; rows of a key follow each other."""
    edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    size = np.diff(np.r_[edges, len(key)])
    small = np.repeat(size <= 64, size)
    at, xs, ys = np.flatnonzero(small & np.repeat(size > 1, size)), [], []
    k, f, p, q = key[at], fp[at], place[at], piece[at]
    for step in range(1, 64):
        i = np.flatnonzero(k[step:] == k[:-step]) if step < len(k) else np.zeros(0, int)
        if not len(i):
            break
        good = _linked(f[i], f[i + step], p[i], q[i])
        xs.append(i[good])
        ys.append(i[good] + step)
    if xs:
        label = forest(np.concatenate(xs), np.concatenate(ys), len(f))
        moved = np.flatnonzero(label != np.arange(len(f)))
        yield f[moved], f[label[moved]]
    for start, n in zip(edges[size > 64].tolist(), size[size > 64].tolist()):
        own = fp[start : start + n]
        yield from _block_links(own, own, place[start], piece[start])


def _block_links(left: np.ndarray, right: np.ndarray, place: int, piece: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A forest of the links between two blocks of a bucket, or within one if they are the same."""
    both = left if left is right else np.concatenate([left, right])
    label, shift = np.arange(len(both)), 0 if left is right else len(left)
    for at in range(0, len(left), 256):
        part = left[at : at + 256][:, None]
        x, y = np.nonzero(_linked(part, right[None], np.full((1, 1), place), np.full((1, 1), piece)))
        if len(x):
            old = np.flatnonzero(label != np.arange(len(label)))
            label = forest(np.r_[x + at, old], np.r_[y + shift, label[old]], len(both))
    moved = np.flatnonzero(label != np.arange(len(label)))
    yield both[moved], both[label[moved]]


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of whole buckets: rows of the last key of a batch wait for the next one."""
    names, held = ("key", "fp", "place", "piece"), None
    for batch in batches:
        new = [batch.column(c).to_numpy() for c in names]
        new = [np.concatenate(x) for x in zip(held, new)] if held is not None else new
        if not len(new[0]):
            continue
        last = np.searchsorted(new[0], new[0][-1])
        yield tuple(x[:last] for x in new)
        held = [x[last:] for x in new]
    if held is not None:
        yield tuple(held)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, fp, place, piece in _whole_runs(batches):
        for a, b in _bucket_links(key, fp.view(np.uint64), place, piece):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cell in _runs(batches, "key"):
        fp, right = cell.column("fp").to_numpy().view(np.uint64), cell.column("right").to_numpy()
        left = fp[~right]
        for a, b in _block_links(left, fp[right] if right.any() else left, cell.column("place")[0].as_py(), cell.column("piece")[0].as_py()):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.select("key", "fp", "place", "piece").repartition("key").sortWithinPartitions("key").mapInArrow(_compare, "a long, b long")


def links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp``, enough of them to connect each component."""
    keyed = prints.select("fp", F.explode(_variants()).alias("key"))
    place = F.shiftright("key", _WIDEST).cast("int").alias("place")
    values = prints.select(F.explode(F.array(*(_key(s, _segment(s)) for s in range(SEGMENTS)))).alias("value"))
    heavy = scratch.write(values.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > LIMIT // 2).select("value"), "heavy")
    whole = F.lit(-1).alias("piece")
    if heavy.isEmpty():
        return _dealt(keyed.select("key", "fp", place, whole))

    near = []  # the variants of heavy values
    for s, (low, width) in enumerate(CUTS):
        own = F.col("value").bitwiseAND(F.lit((1 << _WIDEST) - 1))
        near.append(F.when(F.shiftright("value", _WIDEST) == s, F.array(*(_key(low + j, own.bitwiseAND(F.lit(~(1 << j)))) for j in range(width)))))
    hot = _bounded(scratch.write(heavy.select(F.explode(F.coalesce(*near)).alias("key")).distinct(), "hot"))
    keyed = scratch.write(keyed.join(hot.withColumn("hot", F.lit(True)), "key", "left"), "variants")
    found = [_dealt(keyed.where("hot is null").select("key", "fp", place, whole))]

    cut = []
    for s, (low, width) in enumerate(CUTS):
        above = F.shiftleft(F.shiftrightunsigned("fp", low + width), low) if low + width < 64 else F.lit(0).cast("long")
        rest = above.bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << low) - 1)))
        values = [F.shiftrightunsigned(rest, at).bitwiseAND(F.lit((1 << size) - 1)) for at, size in _pieces(width)]
        cut.append(F.when((F.col("place") >= low) & (F.col("place") < low + width), F.array(*values)))
    pieces = keyed.where("hot").select("key", "fp", place).select("key", "fp", "place", F.posexplode(F.coalesce(*cut)).alias("piece", "value"))
    pieces = scratch.write(pieces.select(F.xxhash64("key", "piece", "value").alias("key"), "fp", "place", "piece"), "pieces")
    large = scratch.write(pieces.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > LIMIT), "large")
    sizes = _bounded(large.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    pieces = pieces.join(sizes, "key", "left")
    found.append(_dealt(pieces.where("blocks is null")))

    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("own")
    cells = pieces.where("blocks is not null").select("key", "fp", "place", "piece", own, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cell = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key")
    blocks = cells.select(cell, "fp", "place", "piece", (F.col("own") > F.col("other")).alias("right")).repartition("key").sortWithinPartitions("key")
    found.append(blocks.mapInArrow(_compare_blocks, "a long, b long"))
    return found[0].union(found[1]).union(found[2])


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: doc_id, fingerprint (a signed long), component_id (the smallest id reachable by links)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    join = _Join(scratch, None)
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = scratch.write(plain.mapInArrow(_fingerprints, "row long, doc_id long, fp long"), "rows")
    prints = scratch.write(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "prints")
    edges = scratch.write(links(prints.select("fp"), scratch), "links")
    groups = join.components(edges, "groups").select(F.col("row").alias("fp"), "root")
    rooted = scratch.write(prints.join(groups, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = scratch.write(join.dealt(rooted.select("fp", "root"), smallest, "root", "fp"), "components")
    found = join.dealt(rows, known.select("fp", "component_id"), "fp", "row", prints.select("fp", "n"))
    return found.select("doc_id", F.col("fp").alias("fingerprint"), "component_id")
