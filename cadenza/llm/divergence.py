"""How sources of a language differ in the terms they use, by integer dictionaries.

1. Every task counts the terms of its texts by language and source, with the number of
   documents that hold them; a shuffle sums these rows, so a hot source is summed where it is read.
2. A language keeps the terms of ``min_docs`` documents or more.
3. Kept terms and counts are sorted together by range of (language, term), so a task
   has a range of the dictionary and whatever sources have of it. It cuts the range
   into chunks of about ``CHUNK`` kept terms: a sorted array in which ``searchsorted`` gives
   each count its id, and ``bincount`` a dense vector for each source. A chunk is named
   by its first term, so (chunk, id) is in UTF-8 order, like the terms.
4. With the sums of all chunks known, each chunk turns counts into smoothed shares in
   integers, compares the vectors of all pairs of sources, and takes the terms in which
   a source exceeds its language most; ties go to the lower id. Of many sources, blocks of
   ``SOURCES`` meet in pairs of blocks, so a task holds two blocks of one chunk.
5. Distances are summed over chunks, and each group's best terms of all chunks are ranked.

A term is a run of letters and of characters beyond ASCII, A-Z lower-cased. Shares are
1 + floor(``SCALE`` (count + SMOOTH) / (all + SMOOTH V)), exact as long as all occurrences of a
language are below 9 * 10**15. Null texts, languages and sources count as empty strings;
groups without terms take part, and without kept terms all distances are 0. Repeated rows
are documents of their own; an empty table gives no rows. Equal values are ranked by the
item in UTF-8 order. Only the three named columns are read, so no other can clash. The words of one long
text are held at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadenza.llm.common import Scratch, raw_texts, slices

MIN_DOCS, TOP = 30, 50
SCALE_STEP, SCALE_STEPS, SMOOTH = 1000, 3, 5
SCALE = SCALE_STEP**SCALE_STEPS
#: Kept terms of a chunk, and counts that close one early; sources of a block.
CHUNK, MOST_COUNTS, SOURCES = 4096, 4_000_000, 256
#: Bytes of terms that a counting task holds before it hands them on; the bit from which on it counts documents.
HELD_BYTES, DOCS = 56 << 20, 42
_TERM = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    r"""Terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` of a text, A-Z lower-cased."""
    return raw.lower().translate(_TERM).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), and a row without a term for each group."""
    held: dict[tuple, dict[bytes, int]] = {}  # by group; a term's documents are counted above bit DOCS, its occurrences below
    new = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in held.items():
            names, both = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
            for at in range(0, len(names) + 1, 1 << 16):
                part, values = [t.decode() for t in names[at : at + (1 << 16)]], both[at : at + (1 << 16)]
                own = [] if at else [None]
                columns = [pa.array(own + part, pa.string()), pa.array(np.r_[[0] * len(own), values & ((1 << DOCS) - 1)].astype(np.int64)), pa.array(np.r_[[0] * len(own), values >> DOCS].astype(np.int64))]
                group = [pa.array([x] * len(columns[0]), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*group, *columns], names=["lang", "source", "term", "n", "docs"])

    for batch in slices(batches):
        for lang, source, raw in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), raw_texts(batch)):
            counts = held.setdefault((lang, source), {})
            before, get = len(counts), counts.get
            for term, n in Counter(terms(raw or b"")).items():
                counts[term] = get(term, 0) + n + (1 << DOCS)
            new += 160 * (len(counts) - before) + (len(raw or b"") if len(counts) > before and len(raw) > 1 << 16 else 0)
        if new > HELD_BYTES:
            yield from out()
            held.clear()
            new = 0
    yield from out()


def _chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Dense vectors of whole chunks. Rows are sorted by language and term; a kept term's own row, without a source, comes first."""
    lang, words, total = None, [], []  # of the open chunk: its kept terms, ascending, and their counts in the language
    sources: dict[str, int] = {}
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def vectors(k: int):
        """Of the first ``k`` terms; the rest stays open."""
        nonlocal words, total, parts, sources
        source, ids, n = (np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in range(3))
        low, names = ids < k, list(sources)
        rows = [(None, np.array(total[:k], np.int64))]
        order = np.argsort(source[low], kind="stable")
        who, where, much = source[low][order], ids[low][order], n[low][order]
        for s, a, b in zip(*np.unique(who, return_index=True), np.r_[np.unique(who, return_index=True)[1][1:], len(who)]):
            exact = [np.bincount(where[a:b], part, k).astype(np.int64) for part in (much[a:b] & 0xFFFFFFFF, much[a:b] >> 32)]
            rows.append((names[s], exact[0] + (exact[1] << 32)))
        made = pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(rows), pa.string()), pa.array([words[0].decode()] * len(rows), pa.string()), pa.array([s for s, _ in rows], pa.string()),
             pa.array([v for _, v in rows], pa.list_(pa.int64())), pa.array([[w.decode() for w in words[:k]]] + [None] * (len(rows) - 1), pa.list_(pa.string()))],
            names=["lang", "chunk", "source", "counts", "terms"],
        )
        words, total = words[k:], total[k:]
        parts = [(source[~low], ids[~low] - k, n[~low])] if words else []
        if not words:
            sources = {}
        return made

    for batch in batches:
        langs = batch.column("lang")
        edges = [0]
        if batch.num_rows:
            values = langs.dictionary_encode().indices.to_numpy()
            edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if langs[a].as_py() != lang:
                if words:
                    yield vectors(len(words))
                lang, words, total, parts, sources = langs[a].as_py(), [], [], [], {}
            part = batch.slice(a, b - a)
            own = pc.is_null(part.column("source"))
            kept, rest = part.filter(own), part.filter(pc.invert(own))
            words += raw_texts(kept, "term")
            total += kept.column("n").to_pylist()
            if not words or not rest.num_rows:
                continue
            dictionary, wanted = np.array(words, object), np.array(raw_texts(rest, "term"), object)
            ids = np.minimum(np.searchsorted(dictionary, wanted), len(words) - 1)
            known = (dictionary[ids] == wanted).astype(bool)
            names = rest.column("source").to_pylist()
            source = np.fromiter((sources.setdefault(names[k], len(sources)) for k in np.flatnonzero(known)), np.int64, int(known.sum()))
            parts.append((source, ids[known].astype(np.int64), rest.column("n").to_numpy()[known]))
            if len(words) > 1 and (len(words) > most or sum(len(p[0]) for p in parts) > MOST_COUNTS):
                yield vectors(len(words) - 1)  # the last term may go on
    if words:
        yield vectors(len(words))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE (counts + SMOOTH) / total), by long division in steps that fit 64 bits."""
    whole, left = np.divmod(counts + SMOOTH, total)
    for _ in range(SCALE_STEPS):
        digit, left = np.divmod(left * SCALE_STEP, total)
        whole = whole * SCALE_STEP + digit
    return whole + 1


def _compared(cell: pa.Table) -> pa.Table:
    """Distances of the sources of a chunk or of a pair of their blocks, and in a block of its own the terms that exceed the language."""
    rows = cell.to_pylist()
    out: list[tuple] = []
    whole = next((r for r in rows if r["source"] is None), None)
    groups = [r for r in rows if r["source"] is not None]
    k = max((len(r["counts"]) for r in rows if r["counts"] is not None), default=0)
    lang = rows[0]["lang"]
    counts = np.zeros((len(groups), k), np.int64)
    for at, r in enumerate(groups):
        if r["counts"] is not None:
            counts[at] = r["counts"]
    p = np.stack([shares(c, r["total"]) for c, r in zip(counts, groups)]) if k and groups else counts
    right = np.array([r["right"] for r in groups], bool)
    across = bool(right.any()) or rows[0]["x"] != rows[0]["y"]
    for i, r in enumerate(groups):
        others = np.flatnonzero(right) if across else np.arange(i + 1, len(groups))
        if across and right[i]:
            continue
        far = np.abs(p[others] - p[i]).sum(1)
        out += [(lang, r["source"], "pair", groups[j]["source"], int(v)) for j, v in zip(others, far)]
    if whole is not None and k:
        q = shares(np.array(whole["counts"], np.int64), whole["total"])
        for i, r in enumerate(groups):
            more = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            best = more[np.lexsort((more, (q - p[i])[more]))][:TOP]
            out += [(lang, r["source"], "term", whole["terms"][t], int(p[i, t] - q[t])) for t in best]
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
    columns = zip(*out) if out else [[]] * 5
    return pa.Table.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=["lang", "source", "part", "item", "value"])


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, chunk: int = CHUNK) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of each source to the others of its language, and its ``TOP`` terms beyond the language's shares."""
    scratch = Scratch(docs.sparkSession, "divergence")
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    read = docs.select(*named, F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = read.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counted = scratch.write(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counted")
    in_terms = counted.where("term is not null")
    kept = in_terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= min_docs)
    kept = scratch.write(kept.select("lang", "term", "n"), "kept")

    entries = kept.select("lang", "term", F.lit(None).cast("string").alias("source"), "n").unionByName(in_terms.select("lang", "term", "source", "n"))
    entries = scratch.write(entries, "entries")
    ranges = entries.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term", F.col("source").asc_nulls_first())
    vectors = scratch.write(ranges.mapInArrow(lambda batches: _chunks(batches, chunk), "lang string, chunk string, source string, counts array<long>, terms array<string>"), "vectors")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("all"))
    sums = vectors.where("source is not null").select("lang", "source", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).alias("n")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = counted.where("term is null").select("lang", "source")
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("blocks"))
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang")
    total = (F.coalesce("n", F.lit(0)) + SMOOTH * F.col("v")).alias("total")
    groups = scratch.write(groups.select("lang", "source", total, "v", "all", "blocks", F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("block")), "groups")

    of_lang = groups.groupBy("lang").agg(F.first("blocks").alias("blocks"), F.first("v").alias("v"), F.first("all").alias("all"))
    no_terms = of_lang.where("v is null").select("lang", F.lit("").alias("chunk"))  # their distances are 0
    chunks = vectors.where("source is null").select("lang", "chunk").unionByName(no_terms)
    grid = chunks.join(groups.select("lang", "source", "total", "blocks", "block"), "lang")
    grid = grid.join(vectors.where("source is not null").select("lang", "chunk", "source", "counts"), ["lang", "chunk", "source"], "left")
    grid = grid.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("terms", F.lit(None).cast("array<string>"))
    whole = vectors.where("source is null").join(of_lang.where("v is not null"), "lang")
    whole = whole.select("lang", "chunk", "source", (F.col("all") + SMOOTH * F.col("v")).alias("total"), "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "counts", "terms").withColumn("other", F.col("block"))
    cells = grid.unionByName(whole)
    cells = cells.select("lang", "chunk", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "source", "total", "counts", "terms", (F.col("block") > F.col("other")).alias("right"))
    made = cells.groupBy("lang", "chunk", "x", "y").applyInArrow(_compared, "lang string, source string, part string, item string, value long")
    made = scratch.write(made, "made")

    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("e")
    pairs = made.where("part = 'pair'").select("lang", both, "value").groupBy("lang", "e").agg(F.sum("value").alias("value")).select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    beyond = made.where("part = 'term'").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    return ranked.unionByName(beyond).select("lang", "source", "part", "item", "value", "rank")
