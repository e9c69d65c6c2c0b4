"""Near-duplicates by chosen-path set similarity join over word shingles.

1. Every text becomes a set of 5-word shingles and a signature of minwise
   tokens. Texts of equal words form a class (128-bit digest); from here on one
   representative stands for each class.
2. ``TREES`` trees branch the representatives: a node sends each one to
   ``BRANCHES`` children, chosen by its minwise tokens at two places. The trees'
   first places differ; below, each node takes places by a hash of its own path,
   so that siblings that hold the same pair part or keep it independently. Where
   k of the ``PLACES`` tokens of a pair are equal, a tree of any depth loses it
   with probability q = (1 - p + p q)**2, p = k / PLACES; :func:`loss` sums q**TREES
   over all k. At similarity 0.75 that is below 3 in 10**6 pairs, at 0.8 below 4 in
   10**8, and less where nodes are small, as those don't branch on.
3. A text's popularity is the size of its nodes on the first level, so the text
   that others were copied from is popular. Each node's most popular member is
   its head; members are compared with the heads they meet in several nodes.
4. The texts of similarity 0.5 or more to a head are its circle. By the triangle
   inequality for Jaccard distance, whatever links to a member that links to the
   head lies in there too. Members that aren't linked to the head are compared
   with the whole circle exhaustively, block against block.
5. Nodes whose members all lie in one linked group or in one circle are done.
   Others of ``LEAF`` members at most are compared exhaustively, larger ones
   branch on. After ``LEVELS`` levels the rest is compared block by block, so no
   node is capped. Signatures sort out pairs far below the threshold: at 0.75,
   fewer than 30 equal ones of the first 64 tokens, or fewer than
   70 of all 128, have a probability below 1e-6 together.
6. All links are confirmed on the full sets of both texts; components come from
   alternating large-star and small-star steps.

All steps shuffle ids, signatures or the texts of candidates; no group meets in
one task: where over ``HOT`` rows have one key, a join deals them over several
copies of the other side's row (``_Join.dealt``). Tables of each step are written
to the shared folder.

Set sizes and candidates come from 64-bit hashes of shingles, links from the
shingles themselves. An empty table stays empty. Null texts and texts without words have no shingles and no links. Fewer than
five words count as one shingle. Row numbers stand for rows, so repeated rows
and repeated or null ids are linked like any others; a component's id is the
smallest id in it that isn't null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch, raw_texts, slices, space_words

SHINGLE = 5
PERCENT = 75
#: Minwise tokens that are compared first, and those of a whole signature.
TOKENS, SIGNATURE = 64, 128
TREES, BRANCHES, LEVELS, LEAF = 8, 2, 8, 4096
PLACES = SIGNATURE  # places that nodes may take
#: Equal tokens of a candidate, at least: of the first ``TOKENS``, and of the whole signature.
ALIKE, ALL_ALIKE = 30, 70
#: Rows of one key that a task of a join gets, about.
HOT = 4096
#: Shared nodes of the first level from which a member is compared with a head.
MET = 4
#: Members that aren't linked to their head, and members, in a block of a circle.
OPEN_BLOCK, CIRCLE_BLOCK = 128, 512
#: Steps until components must be stable; each about halves the depth of what is left.
STEPS = 100
#: Row numbers that are broadcast, at most; beyond it, Spark joins by a shuffle.
BROADCAST_ROWS = 1_000_000

_RANDOM = np.random.default_rng(20240607)
_MULTIPLY = _RANDOM.integers(0, 1 << 63, SIGNATURE, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 1 << 63, SIGNATURE, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
PREPARED = "row long, doc_id long, n long, digest binary, tokens array<int>"


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def loss(similarity: float) -> float:
    """The probability that no tree keeps a pair of this similarity together, however deep they are."""
    total = 0.0
    for k in range(PLACES + 1):
        p, q = k / PLACES, 0.0
        for _ in range(10_000):  # the least fixed point
            q = (1 - p + p * q) ** BRANCHES
        total += math.comb(PLACES, k) * similarity**k * (1 - similarity) ** (PLACES - k) * q**TREES
    return total


def shingle_set(raw: bytes) -> set[bytes]:
    """The full set of a text: its shingles as bytes, a space between words."""
    words = space_words(raw.lower())
    if not words:
        return set()
    return {b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _hashed(words: list[list[bytes]], known: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashed shingles of all texts that have some, with repeats; the numbers of these texts and where each starts."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(known.__getitem__, (x for w in words for x in w)), np.uint64, int(sizes.sum()))
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    first = np.cumsum(sizes) - sizes
    some = np.flatnonzero(n > 0)
    starts = np.cumsum(n[some]) - n[some]
    at = np.repeat(first[some] - starts, n[some]) + np.arange(int(n.sum()))
    h = flat[at] if len(at) else flat[:0]
    long = np.repeat(sizes[some] >= SHINGLE, n[some])
    for j in range(1, SHINGLE):  # a short text takes the words it has
        inside = long | (j < np.repeat(sizes[some], n[some]))
        h = np.where(inside, h * _BASE + flat[np.minimum(at + j, len(flat) - 1)], h * _BASE) if len(at) else h
    return _mix(h), some, np.r_[starts, len(h)]


def _signatures(words: list[list[bytes]], known: _Hashes) -> tuple[list[int], list[list[int] | None]]:
    """Set size and signature of each text; no signature without words."""
    h, some, starts = _hashed(words, known)
    count, tokens = [0] * len(words), [None] * len(words)
    if len(some):
        signature = np.empty((SIGNATURE, len(some)), np.uint32)
        for k in range(SIGNATURE):
            signature[k] = np.minimum.reduceat((h * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32), starts[:-1])
        signature = signature.T.copy().view(np.int32).tolist()
        for t, a, b, s in zip(some.tolist(), starts.tolist(), starts[1:].tolist(), signature):
            count[t], tokens[t] = len(np.unique(h[a:b])), s
    return count, tokens


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Hashes()
    for batch in slices(batches):
        words = [space_words((raw or b"").lower()) for raw in raw_texts(batch)]
        n, tokens = _signatures(words, known)
        digests = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words]
        new = [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(tokens, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "n", "digest", "tokens"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the intersection and of the union of the full sets; pairs of the same ``a`` follow each other."""
    last, left = None, set()
    for batch in batches:
        both, all_ = [], []
        for x, ta, tb in zip(batch.column("a").to_pylist(), raw_texts(batch, "text_a"), raw_texts(batch, "text_b")):
            if x != last:
                last, left = x, shingle_set(ta)
            right = shingle_set(tb)
            both.append(len(left & right))
            all_.append(len(left) + len(right) - both[-1])
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(all_, pa.int64())], names=["a", "b", "both", "all"])


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each value of ``key``, which follow each other."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        value = table.column(key).to_numpy()
        edges = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, int)
        for s, e in zip(edges, edges[1:]):
            yield table.slice(int(s), int(e - s))
        rest = table.slice(int(edges[-1])) if len(edges) else table
    if rest is not None and rest.num_rows:
        yield rest


def _circle_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the open members of a block and its members; of each open one, one link to each other group."""
    known = _Hashes()
    for block in _runs(batches, "cell"):
        row, group, open_ = (block.column(c).to_numpy() for c in ("row", "label", "open"))
        words = [space_words(raw.lower()) for raw in block.column("text").cast(pa.binary()).to_pylist()]
        h, some, starts = _hashed(words, known)
        _, token = np.unique(h, return_inverse=True)
        owner = np.repeat(some, np.diff(starts))
        key = np.unique(owner.astype(np.int64) << 32 | token)
        owner, token = key >> 32, key & 0xFFFFFFFF
        size = np.bincount(owner, minlength=len(row))
        u, m = np.flatnonzero(open_), np.flatnonzero(~open_)
        shared = np.zeros((len(u), len(m)), np.float32)
        place = np.full(len(row), -1)
        place[u], place[m] = np.arange(len(u)), np.arange(len(m))
        by_u, by_m = open_[owner], ~open_[owner]
        used = np.intersect1d(token[by_u], token[by_m])
        for at in range(0, len(used), 4096):  # tokens of both sides, some at a time
            part = used[at : at + 4096]
            sides = []
            for side, count in ((by_u, len(u)), (by_m, len(m))):
                where = np.minimum(np.searchsorted(part, token), len(part) - 1)
                hit = side & (part[where] == token)
                x = np.zeros((count, len(part)), np.float32)
                x[place[owner[hit]], where[hit]] = 1
                sides.append(x)
            shared += sides[0] @ sides[1].T
        linked = (100 * shared >= PERCENT * (size[u][:, None] + size[m][None] - shared)) & (group[u][:, None] != group[m][None])
        x, y = np.nonzero(linked)
        _, one = np.unique(np.stack([x, group[m][y]], 1), axis=0, return_index=True)
        a, b = row[u[x[one]]], row[m[y[one]]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _leaf_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates within each node, of different groups and circles.

    Of several leaves of the first level that hold a pair, the one of the lowest place gives it.
    """
    for node in _runs(batches, "node"):
        row, group, circle, n, leaves = (node.column(c).to_numpy() for c in ("row", "label", "circle", "n", "leaves"))
        place = node.column("place")[0].as_py()
        tokens = np.array(node.column("tokens").to_pylist(), np.int32)
        m = len(row)
        alike, before = np.zeros((m, m), np.uint8), np.zeros((m, m), bool)
        for k in range(TOKENS):
            same = tokens[:, k][:, None] == tokens[:, k][None]
            alike += same
            if k < place:
                before |= same & ((leaves >> k & 1) > 0)[None]
        found = np.triu((alike >= ALIKE) & ~before & (group[:, None] != group[None]) & (circle[:, None] != circle[None]), 1)
        i, j = np.nonzero(found)
        fits = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
        i, j = i[fits], j[fits]
        equal = alike[i, j]
        for k in range(TOKENS, SIGNATURE):
            equal += tokens[i, k] == tokens[j, k]
        i, j = i[equal >= ALL_ALIKE], j[equal >= ALL_ALIKE]
        a, b = np.minimum(row[i], row[j]), np.maximum(row[i], row[j])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _bounded(df: DataFrame) -> DataFrame:
    """A written table of row numbers, marked for broadcast where its size allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class _Join:
    def __init__(self, scratch: Scratch, prepared: DataFrame):
        self.scratch, self.prepared, self.joins = scratch, prepared, 0

    def dealt(self, left: DataFrame, right: DataFrame, key: str, by: str, counts: DataFrame | None = None, how: str = "inner") -> DataFrame:
        """``left`` joined with the row that ``right`` has for each key. Rows of ``left`` of a key that has over ``HOT`` of them
        are dealt by ``by`` over that many copies of the row; ``counts`` (key, n) are those of ``left``, if known. The join shuffles at every size."""
        counts = counts if counts is not None else left.groupBy(key).agg(F.count("*").alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) <= HOT:
            return left.join(right.hint("merge"), key, how)
        self.joins += 1
        hot = _bounded(self.scratch.write(counts.where(f"n > {HOT}").select(key, F.ceil(F.col("n") / HOT).cast("int").alias("__c")), f"hot-{self.joins}"))
        copies = F.coalesce("__c", F.lit(1))
        left = left.join(hot, key, "left").withColumn("__s", F.pmod(F.xxhash64(by, F.lit(3)), copies).cast("int")).drop("__c")
        right = right.join(hot, key, "left").withColumn("__s", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__c")
        return left.join(right.hint("merge"), [key, "__s"], how).drop("__s")

    def texts(self, rows: DataFrame, name: str) -> DataFrame:
        """The texts of some rows."""
        wanted = self.scratch.write(rows.distinct(), name)
        return self.prepared.select("row", "text").join(_bounded(wanted), "row", "left_semi")

    def among(self, reps: DataFrame, members: DataFrame, name: str) -> DataFrame:
        """The representatives that ``members`` has, so that a join moves the tokens of no others."""
        return reps.join(_bounded(self.scratch.write(members.select("row").distinct(), name)), "row", "left_semi")

    def compared(self, pairs: DataFrame, name: str) -> DataFrame:
        """a, b, and the sizes of intersection and union of their full sets."""
        pairs = self.scratch.write(pairs, f"{name}-pairs")
        texts = self.texts(pairs.select(F.explode(F.array("a", "b")).alias("row")), f"{name}-rows")
        with_b = self.dealt(pairs, texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b", "a")
        both = self.dealt(with_b, texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a", "b", pairs.groupBy("a").agg(F.count("*").alias("n")))
        return self.scratch.write(both.select("a", "b", "text_a", "text_b").mapInArrow(_compare, "a long, b long, both long, all long"), name)

    def circle_links(self, circles: DataFrame) -> DataFrame:
        """(circle, row, label, head_label) to links between open members and others, not yet confirmed."""
        open_ = F.col("label") != F.col("head_label")
        sizes = circles.groupBy("circle").agg(F.count("*").alias("s"), F.count_if(open_).alias("u")).where("u > 0 and s > 2")
        rows = self.scratch.write(self.dealt(circles, sizes, "circle", "row", sizes.select("circle", F.col("s").alias("n"))).withColumn("open", open_), "circles")
        across = F.ceil(F.col("u") / OPEN_BLOCK).cast("int")
        down = F.ceil(F.col("s") / CIRCLE_BLOCK).cast("int")
        x, y = F.pmod(F.xxhash64("row"), across).cast("int"), F.pmod(F.xxhash64("row", F.lit(1)), down).cast("int")
        members = rows.select("circle", "row", "label", F.lit(False).alias("open"), F.explode(F.sequence(F.lit(0), across - 1)).alias("x"), y.alias("y"))
        opened = rows.where("open").select("circle", "row", "label", F.lit(True).alias("open"), x.alias("x"), F.explode(F.sequence(F.lit(0), down - 1)).alias("y"))
        cells = members.unionByName(opened).select(F.xxhash64("circle", "x", "y").alias("cell"), "row", "label", "open")
        texts = self.texts(rows.select("row"), "circle-rows")
        dealt = cells.join(texts, "row").repartition("cell").sortWithinPartitions("cell")
        return dealt.select("cell", "row", "label", "open", "text").mapInArrow(_circle_pairs, "a long, b long").distinct()

    def components(self, links: DataFrame, name: str) -> DataFrame:
        """(row, root) of every linked row; the root is the smallest row of its component."""
        edges = self.scratch.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}-0")
        seen = None
        for step in range(1, STEPS + 1):
            ends = edges.union(edges.select("v", "u"))
            degree = ends.groupBy("u").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
            mark = degree.agg(F.sum("n"), F.sum("h"), F.max("n")).first()
            if mark == seen:
                break
            seen = mark
            around = edges.union(edges.select("v", "u"))
            least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            hot = (mark[2] or 0) > HOT
            large = (self.dealt(around, least, "u", "v") if hot else around.join(least, "u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            large = self.scratch.write(large, f"{name}-large-{step}") if hot else large
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = (self.dealt(large, least, "u", "v") if hot else large.join(least, "u")).select(F.explode(F.array(F.struct(F.col("u").alias("x"), "m"), F.struct(F.col("v").alias("x"), "m"))).alias("e"))
            edges = self.scratch.write(small.select(F.col("e.x").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), f"{name}-{step}")
            self.scratch.drop(f"{name}-{step - 1}")
        else:
            raise RuntimeError(f"components are not stable after {STEPS} steps")
        rows = edges.select(F.col("u").alias("row"), F.col("v").alias("root"))
        return rows.union(rows.select(F.col("root").alias("row"), "root").distinct())

    def children(self, members: DataFrame, level: int) -> DataFrame:
        """Members with their minwise tokens, sent to the children of their nodes; of the roots, to those by the tree's own places."""
        if level == 0:
            chosen = [F.col("tree") * BRANCHES + b for b in range(BRANCHES)]
        else:
            first = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(PLACES))
            chosen = [F.pmod(first + b * (1 + F.pmod(F.xxhash64("node", F.lit(-level)), F.lit(PLACES // BRANCHES - 1))), F.lit(PLACES)) for b in range(BRANCHES)]
        place = members.withColumn("place", F.explode(F.array(*(c.cast("int") for c in chosen))))
        node = F.xxhash64("node", "tree", "place", F.element_at("tokens", F.col("place") + 1))
        return place.select(node.alias("node"), "tree", "place", *(c for c in members.columns if c not in ("node", "tree", "tokens")))

    def run(self) -> DataFrame:
        """Of each row: its number, doc_id, n, component_id, and whether it is the first one of its component."""
        scratch = self.scratch
        smallest = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")).alias("smallest")
        dups = self.prepared.where("digest is not null").groupBy("digest").agg(F.min("row").alias("rep"), smallest, F.count("*").alias("n_rows")).where("n_rows > 1")
        dups = scratch.write(dups, "classes")
        own = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")
        plain = self.prepared.select("row", "doc_id", "n", "digest")
        sizes = dups.select("digest", F.col("n_rows").alias("n"))
        joined = self.dealt(plain.where("digest is not null"), dups.drop("n_rows"), "digest", "row", sizes, "left")
        joined = joined.unionByName(plain.where("digest is null"), allowMissingColumns=True)
        rep = F.coalesce("rep", "row")
        rows = scratch.write(
            joined.select("row", "doc_id", "n", rep.alias("rep"), F.coalesce("smallest", own).alias("smallest")), "rows"
        )
        copies = _bounded(scratch.write(rows.where("row <> rep").select("row"), "copies"))
        reps = self.prepared.where("n > 0").select("row", "n", "tokens").join(copies, "row", "left_anti")

        roots = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
        first = self.children(reps.select(F.lit(0).cast("long").alias("node"), roots, "row", "n", "tokens"), 0)
        several = scratch.write(first.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), "several")
        members = several.select("node", F.col("size").alias("n"))
        nodes = scratch.write(self.dealt(first, several, "node", "row", members), "nodes")
        fame = nodes.groupBy("row").agg(F.sum("size").alias("fame"))
        famous = nodes.join(fame, "row").select("node", F.struct("fame", (-F.col("row")).alias("minus"), "n").alias("f"))
        heads = famous.groupBy("node").agg(F.max("f").alias("f")).select("node", (-F.col("f.minus")).alias("head"), F.col("f.n").alias("head_n"))
        heads = scratch.write(heads, "heads")
        half = "100 * least(n, head_n) >= 50 * greatest(n, head_n)"  # else the similarity is below 0.5
        met = self.dealt(nodes, heads, "node", "row", members).where(f"row <> head and {half}").groupBy(F.col("head").alias("a"), F.col("row").alias("b")).agg(F.count("*").alias("k"))
        stars = self.compared(met.where(f"k >= {MET}").select("a", "b"), "stars")
        links = scratch.write(stars.where(f"100 * both >= {PERCENT} * all").select("a", "b"), "star-links")
        groups = scratch.write(self.components(links, "groups"), "groups")

        label = F.coalesce("root", "row").alias("label")
        near = stars.where("100 * both >= 50 * all").groupBy(F.col("b").alias("row")).agg(F.max(F.struct((F.col("both") / F.col("all")).alias("j"), (-F.col("a")).alias("minus"))).alias("m"))
        near = near.select("row", (-F.col("m.minus")).alias("circle"))
        circles = near.join(near.select(F.col("circle").alias("row")).distinct().withColumn("is_head", F.lit(True)), "row", "full")
        circles = scratch.write(circles.select("row", F.when(F.col("is_head"), F.col("row")).otherwise(F.col("circle")).alias("circle")), "circle-of")
        all_near = stars.where("100 * both >= 50 * all").select(F.col("a").alias("circle"), F.col("b").alias("row"))
        all_near = all_near.union(all_near.select("circle", F.col("circle").alias("row")).distinct())
        of_head = groups.select(F.col("row").alias("circle"), F.col("root").alias("head_root"))
        wide = self.dealt(all_near.join(groups, "row", "left"), of_head, "circle", "row", all_near.groupBy("circle").agg(F.count("*").alias("n")), "left").select("circle", "row", label, F.coalesce("head_root", "circle").alias("head_label"))
        inner = self.compared(self.circle_links(wide), "circle-links")
        links = scratch.write(links.union(inner.where(f"100 * both >= {PERCENT} * all").select("a", "b")), "early-links")
        groups = scratch.write(self.components(links, "more-groups"), "more-groups")

        circle = F.coalesce("circle", "row").alias("circle")
        labelled = nodes.join(groups, "row", "left").join(circles, "row", "left").select("node", "tree", "place", "row", "n", label, circle)
        leaves, level = [], 0
        while True:
            ends = [f(c).alias(f"{g}_{c}") for c in ("label", "circle") for f, g in ((F.min, "low"), (F.max, "high"))]
            state = labelled.groupBy("node").agg(F.count("*").alias("size"), *ends).where("low_label < high_label and low_circle < high_circle")
            state = scratch.write(state.select("node", "size"), f"state-{level}")
            open_ = scratch.write(self.dealt(labelled, state, "node", "row", state.select("node", F.col("size").alias("n"))), f"open-{level}")
            leaves.append(open_.where(f"size <= {LEAF}").select("node", "row", "label", "circle", F.col("place") if level == 0 else F.lit(-1).alias("place")))
            large = open_.where(f"size > {LEAF}")
            level += 1
            if large.isEmpty():
                break
            if level == LEVELS:  # block against block
                blocks = F.ceil(4 * F.col("size") / LEAF).cast("int")
                own_block = F.pmod(F.xxhash64("row"), blocks).cast("int")
                cells = large.select("node", "row", "label", "circle", own_block.alias("p"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("q"))
                leaves.append(cells.select(F.xxhash64("node", F.least("p", "q"), F.greatest("p", "q")).alias("node"), "row", "label", "circle", F.lit(-1).alias("place")))
                break
            tokens = self.among(reps.select("row", "tokens"), large, f"large-{level}")
            labelled = self.children(large.drop("size", "place").join(tokens, "row"), level)
        of_first = leaves[0].groupBy("row").agg(F.bit_or(F.expr("shiftleft(1, place)")).alias("leaves"))
        leaf = leaves[0]
        for more in leaves[1:]:
            leaf = leaf.union(more)
        leaf = leaf.join(of_first, "row", "left").withColumn("leaves", F.coalesce("leaves", F.lit(0)))
        dealt = leaf.join(self.among(reps, leaf, "leaf-rows"), "row").select("node", "row", "label", "circle", "place", "leaves", "n", "tokens").repartition("node").sortWithinPartitions("node")
        pairs = dealt.mapInArrow(_leaf_pairs, "a long, b long").distinct()
        more = self.compared(pairs, "leaves").where(f"100 * both >= {PERCENT} * all").select("a", "b")
        all_links = groups.where("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b")).union(more)
        found = self.components(all_links, "components") if not more.isEmpty() else groups

        of_rep = rows.where("row = rep").select("row", "smallest")
        least = found.join(of_rep, "row").groupBy("root").agg(F.min("smallest").alias("least"))
        by_rep = scratch.write(self.dealt(found, least, "root", "row").select(F.col("row").alias("rep"), "least"), "by-rep")
        final = self.dealt(rows, by_rep, "rep", "row", dups.select("rep", F.col("n_rows").alias("n")), "left").withColumn("least", F.coalesce("least", "smallest"))
        return final.select("row", "doc_id", F.col("n").alias("n_shingles"), F.col("least.doc_id").alias("component_id"), (F.col("least.row") == F.col("row")).alias("first"))


def _prepared(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch, whole: bool) -> DataFrame:
    own = [F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")]
    if whole:
        own.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("rest"))
    plain = docs.select(*own)
    schema = type(plain.schema)([*plain.schema.fields, *type(plain.schema).fromDDL("n long, digest binary, tokens array<int>").fields])
    return scratch.write(plain.mapInArrow(_prepare, schema), "prepared")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: doc_id, n_shingles, component_id, kept (doc_id = component_id), first (the one row of its component that stays)."""
    scratch = Scratch(docs.sparkSession, "near-dup")
    found = _Join(scratch, _prepared(docs, id_col, text_col, scratch, False)).run()
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("first"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "first")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id, of its repeated rows the first."""
    scratch = Scratch(docs.sparkSession, "near-dup")
    prepared = _prepared(docs, id_col, text_col, scratch, True)
    gone = scratch.write(_Join(scratch, prepared).run().where("not first").select("row"), "gone")
    kept = prepared.join(_bounded(gone), "row", "left_anti")
    return kept.select(*(F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))
