"""Token counts from distinct pre-tokens, without the ids of any text.

1. Every task counts its pre-tokens; a shuffle sums them over all texts, so
   each distinct pre-token is cut into pieces once in the whole job.
2. The most frequent ones, ``max_broadcast`` and ``max_bytes`` at most, go to every
   task, so none that many texts have is left to the join. A text
   sums its frequencies of these at once and hands on the rest.
3. The rest, the rare end of the vocabulary, joins the table of pieces by a
   shuffle on a hash of the pre-token and is summed for each text.

The table of rows is written to the shared folder, so that both ways see the
same row numbers. Null counts as the empty text. Repeated rows and ids are
counted row by row, and an empty table stays empty. Vocabulary growth lengthens the third part only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import bpe
from cadenza.llm.common import Scratch, raw_texts, slices

#: Distinct pre-tokens that a counting task holds before it hands them on.
HELD = 300_000


def _distinct(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held = bpe.load(path), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["piece", "n"])

        for batch in slices(batches):
            for raw in raw_texts(batch):
                if raw:
                    held.update(cutter.pieces(raw.decode())[1])
            if len(held) >= HELD:
                yield out()
                held.clear()
        yield out()

    return run


def _sizes(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(path)
        for batch in slices(batches, "piece"):
            sizes = coder.sizes(batch.column("piece").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "size"])

    return run


def _frequent(sizes: DataFrame, most: int, most_bytes: int) -> dict[str, int]:
    """The sizes of the most frequent pre-tokens, long ones too: whole powers of two of frequency, as many as fit both bounds."""
    power = F.floor(F.log2("n")).alias("power")
    by_power = {r["power"]: (r["k"], r["b"]) for r in sizes.groupBy(power).agg(F.count("*").alias("k"), F.sum(F.octet_length("piece")).alias("b")).collect()}
    total = held = 0
    least = None
    for power in sorted(by_power, reverse=True):
        total, held = total + by_power[power][0], held + by_power[power][1]
        if total > most or held > most_bytes:
            break
        least = power
    if least is None:
        return {}
    return {r["piece"]: r["size"] for r in sizes.where(F.col("n") >= 2**least).select("piece", "size").collect()}


def token_counts(docs: DataFrame, path: str, text_col: str = "text", out: str = "n_tokens", max_broadcast: int = 200_000, max_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` without its text, but with its UTF-8 size ``n_bytes`` and the column ``out``, for every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    text = docs.select(F.col(f"`{text_col}`").alias("text"))
    counted = text.mapInArrow(_distinct(path), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    sizes = scratch.write(counted.mapInArrow(_sizes(path), "piece string, n long, size long"), "sizes")
    known = spark.sparkContext.broadcast(_frequent(sizes, max_broadcast, max_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, get = bpe.load(path), known.value.get
        for batch in slices(batches):
            n_bytes, hot, pieces, times = [], [], [], []
            for raw in raw_texts(batch):
                special, cut = cutter.pieces((raw or b"").decode())
                count = Counter(cut)
                size = list(map(get, count))
                rare = [p for p, s in zip(count, size) if s is None]
                n_bytes.append(len(raw or b""))
                hot.append(len(special) + sum(n * s for n, s in zip(count.values(), size) if s is not None))
                pieces.append(rare)
                times.append([count[p] for p in rare])
            columns = [pa.array(x, k) for x, k in ((n_bytes, pa.int64()), (hot, pa.int64()), (pieces, pa.list_(pa.string())), (times, pa.list_(pa.int64())))]
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != "text"]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + columns, names=[n for n, _ in rest] + ["n_bytes", "hot", "pieces", "times"])

    taken = [c for c in docs.columns if c != text_col and c.lower() not in ("n_bytes", out.lower())]  # those are replaced
    names = {c: f"c{k}" for k, c in enumerate(taken)}  # own names, so that none clashes
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    kinds = [f for f in plain.schema.fields if f.name != "text"]
    schema = type(plain.schema)([*kinds, *type(plain.schema).fromDDL("n_bytes long, hot long, pieces array<string>, times array<long>").fields])
    rows = scratch.write(plain.mapInArrow(run, schema), "rows")
    rare = rows.where(F.size("pieces") > 0).select("row", F.explode(F.arrays_zip("pieces", "times")).alias("x")).select("row", F.col("x.pieces").alias("piece"), F.col("x.times").alias("times"))
    summed = rare.join(sizes.select("piece", "size"), "piece").groupBy("row").agg(F.sum(F.col("times") * F.col("size")).alias("cold"))
    total = (F.col("hot") + F.coalesce("cold", F.lit(0))).alias(out)
    return rows.join(summed, "row", "left").select(*(F.col(n).alias(c) for c, n in names.items()), "n_bytes", total)
