"""Spelling variants: words that differ by one letter, found in forward and reversed sorted dictionaries.

1. Every task counts the runs of letters of its texts; a shuffle sums them. Words of
   ``min_length`` letters and ``min_count`` occurrences or more are the vocabulary.
2. One inserted, deleted or replaced letter leaves the first or the last ``q`` letters
   of two words intact, where q is half the length of the shorter one. The forward
   dictionary holds the words sorted by their first q letters, the reversed one by
   their last q letters, read backwards, for each q that a word's length allows (one
   or two). Words of equal halves are a block: a range of a sorted dictionary.
3. A block of over ``LIMIT`` words is divided: of what its words have between the
   letters they share, again the first or the last half is intact. This goes on until
   blocks are small, or at most two letters are left between, which bounds a
   block by the alphabet. So no block is capped, and none goes to one task whole.
4. Within a block all pairs are verified: by common prefix and suffix. A pair
   counts in one block only, the forward one where it has that choice, so the number
   of near words is summed without gathering pairs, and each task hands on one row
   for each word that it has found something for.
5. A word's form is its near word of most occurrences (ties: the smallest in code point
   order), if it has ``factor`` times the word's or more. Roots follow forms to the
   last one, by pointer doubling: a chain halves in each step.

Letters are A-Z, a-z and U+00C0 to U+00FF, so a letter is one byte of Latin-1. Null texts and
texts without letters have no words. Repeated rows are counted row by row; a null id
counts as the empty text in :func:`vocabulary`. Words of any length are compared
whole. An empty table has no words. Only the named columns are read, so no other can clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch, raw_texts, slices, texts_of
from cadenza.llm.near_dup import _bounded

MIN_LENGTH, MIN_COUNT, FACTOR = 7, 2, 10
#: Words of a block, at most, unless no more than two letters are left to differ.
LIMIT = 256
#: Letters up to which words are compared side by side; longer ones one by one.
SHORT = 64
#: Bytes of words that a counting task holds before it hands them on.
HELD_BYTES = 32 << 20
#: Steps until roots must be stable; each one doubles the length of a chain that is followed.
STEPS = 40
#: Latin-1 letters stay, everything else becomes a space.
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def letter_runs(raw: bytes) -> list[bytes]:
    """The runs of letters of a text in UTF-8, A-Z lower-cased, in Latin-1."""
    return raw.lower().decode().encode("latin-1", "replace").translate(_LETTERS).split()


def _counted(min_length: int, slip: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in slices(batches):
            for doc, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
                if not raw:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(letter_runs(raw)).items():
                    if slip:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= min_length:
                        held[word] += n
            if sum(map(len, held)) + 100 * len(held) > HELD_BYTES:
                yield out()
                held.clear()
        yield out()

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int | None = None) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, and how often they occur.

    With ``slip`` the texts are read as if their writers had left out letters: of a run whose crc32 of ``<id>:<run>`` is a
    multiple of it, the letter at that number modulo the run's length is left out, wherever the row has that run.
    """
    words = texts_of(docs, id_col, text_col).mapInArrow(_counted(min_length, slip), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _ends_alike(words: list[bytes], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of the common prefix and of the common suffix of word pairs."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    least = np.minimum(size[i], size[j])
    width = int(size.max())
    if width <= SHORT:
        flat, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size)
        column = np.arange(width)
        inside = column < size[:, None]
        forward, backward = np.zeros((len(words), width + 1), np.uint8), np.zeros((len(words), width + 1), np.uint8)
        forward[:, :width][inside] = flat
        backward[:, :width][inside] = flat[(ends[:, None] - 1 - column)[inside]]
        prefix, suffix = np.empty(len(i), np.int64), np.empty(len(i), np.int64)
        for at in range(0, len(i), 1 << 16):
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            for side, found in ((forward, prefix), (backward, suffix)):
                differ = side[x] != side[y]
                differ[:, -1] = True
                found[at : at + len(x)] = differ.argmax(1)
        return np.minimum(prefix, least), np.minimum(suffix, least)
    ends = [(_common(words[x], words[y]), _common(words[x][::-1], words[y][::-1])) for x, y in zip(i, j)]
    return np.array([p for p, _ in ends], np.int64), np.array([s for _, s in ends], np.int64)


def _common(x: bytes, y: bytes) -> int:
    m = min(len(x), len(y))
    differ = np.frombuffer(x, np.uint8, m) != np.frombuffer(y, np.uint8, m)
    return int(differ.argmax()) if differ.any() else m


def _pairs(words: list[bytes], key: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near words that count here. Words of a key follow each other; ``path`` has the halves that each block shares."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    alive, xs, ys = np.arange(len(words)), [], []
    for step in range(1, len(words)):
        alive = alive[alive + step < len(words)]
        alive = alive[key[alive] == key[alive + step]]
        if not len(alive):
            break
        close = alive[np.abs(size[alive] - size[alive + step]) <= 1]
        xs.append(close)
        ys.append(close + step)
    if not xs:
        return np.zeros(0, int), np.zeros(0, int)
    i, j = np.concatenate(xs), np.concatenate(ys)
    if not len(i):
        return i, j
    prefix, suffix = _ends_alike(words, i, j)
    least = np.minimum(size[i], size[j])
    near = np.where(size[i] == size[j], prefix + suffix == least - 1, prefix + suffix >= least)
    first, last = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for step in path.T:  # whether the pair would take this way
        q, side = np.abs(step[i]), np.sign(step[i])
        forward = prefix >= first + q
        near &= ((least - first - last) // 2 == q) & ((side == 0) | (forward == (side > 0)))
        first, last = first + q * (side > 0), last + q * (side < 0)
    return i[near], j[near]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word with a near one among some whole blocks: how many, and the one of most occurrences."""
    held: pa.Table | None = None

    def work(rows: pa.Table) -> pa.RecordBatch:
        words = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
        n, key = rows.column("n").to_pylist(), rows.column("key").to_numpy()
        path = np.array(rows.column("path").to_pylist(), np.int64)
        long = np.fromiter((len(w) > SHORT for w in words), bool, len(words))
        with_long = np.isin(key, key[long]) if long.any() else long
        best: dict[bytes, list] = {}
        for part in (np.flatnonzero(~with_long), np.flatnonzero(with_long)):
            if len(part) < 2:
                continue
            own = [words[k] for k in part]
            for x, y in zip(*(part[p].tolist() for p in _pairs(own, key[part], path[part]))):
                for a, b in ((x, y), (y, x)):
                    found = (-n[b], words[b])
                    old = best.setdefault(words[a], [0, found])
                    old[0] += 1
                    if found < old[1]:
                        old[1] = found
        columns = [[w.decode("latin-1") for w in best], [x[0] for x in best.values()], [-x[1][0] for x in best.values()], [x[1][1].decode("latin-1") for x in best.values()]]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "near_n", "near"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
        key = rows.column("key").to_numpy()
        last = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1]) if len(key) else 0
        if last:
            yield work(rows.slice(0, last))
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield work(held)


def _halves(rows: DataFrame) -> DataFrame:
    """Every word in the blocks of the halves that one edit may leave intact: of what lies between the ``first`` and the ``last`` letters it shares already."""
    between = F.length("word") - F.col("first") - F.col("last")
    sizes = F.array_distinct(F.array(F.floor(between / 2), F.floor((F.greatest(between, F.lit(1)) - 1) / 2)))
    steps = F.flatten(F.transform(sizes, lambda q: F.when(q == 0, F.array(q)).otherwise(F.array(q, -q))))
    rows = rows.withColumn("step", F.explode(steps.cast("array<int>")))
    q = F.abs("step")
    forward = F.substring(F.col("word"), F.col("first") + 1, q)
    backward = F.reverse(F.substring(F.col("word"), F.length("word") - F.col("last") - q + 1, q))
    part = F.when(F.col("step") > 0, forward).when(F.col("step") < 0, backward).otherwise("")
    first, last = F.col("first") + F.greatest("step", F.lit(0)), F.col("last") - F.least("step", F.lit(0))
    path = F.concat("path", F.array("step")).alias("path")
    return rows.select(F.xxhash64("key", "step", part).alias("key"), path, part.alias("part"), "word", "n", first.cast("int").alias("first"), last.cast("int").alias("last"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) of each word that has near ones in (word, n): their number, and the one of most occurrences."""
    scratch = Scratch(words.sparkSession, "spelling")
    none = F.array().cast("array<int>").alias("path")
    rows = words.select(F.lit(0).cast("long").alias("key"), none, "word", "n", F.lit(0).alias("first"), F.lit(0).alias("last"))
    found, level = None, 0
    while True:
        level += 1
        rows = scratch.write(_halves(rows), f"halves-{level}")
        large = rows.where("element_at(path, -1) <> 0").groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > LIMIT).select("key")
        large = scratch.write(large, f"large-{level}")
        some = not large.isEmpty()
        small = rows.join(_bounded(large), "key", "left_anti") if some else rows
        sorted_ = small.repartitionByRange("path", "part", "key").sortWithinPartitions("path", "part", "key", "word")
        near = sorted_.select("key", "path", "word", "n").mapInArrow(_verified, "word string, n_near long, near_n long, near string")
        found = near if found is None else found.unionByName(near)
        if not some:
            break
        rows = rows.join(_bounded(large), "key", "left_semi").drop("part")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of (word, form) along the forms to the last one."""
    scratch = Scratch(forms.sparkSession, "roots")
    chain = scratch.write(forms.select("word", F.col("form").alias("root")), "0")
    for step in range(1, STEPS + 1):
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = scratch.write(chain.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("moved")), str(step))
        if chain.where("moved").isEmpty():
            return chain.select("word", "root")
        chain = chain.select("word", "root")
    raise RuntimeError(f"forms lead on after {STEPS} steps")


def spelling_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of (word, n): its near words' number, the near word it is a variant of, and the end of that chain."""
    scratch = Scratch(words.sparkSession, "variants")
    words = scratch.write(words, "words")
    near = scratch.write(near_words(words), "near")
    is_form = F.col("near_n") >= factor * F.col("n")
    found = words.join(near, "word", "left")
    found = scratch.write(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
