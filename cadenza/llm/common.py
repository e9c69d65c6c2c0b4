"""Helpers that the text operators share: Arrow batches and words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cadenza.sources.scratch import Scratch, shared_folder  # noqa: F401

#: A batch is worked on in slices of about this many text bytes.
SLICE_BYTES = 2 << 20


def _blanks(keep) -> bytes:
    return bytes(b if keep(b) else 0x20 for b in range(256))


#: Bytes outside 0-9, a-z and the non-ASCII range become spaces, A-Z become a-z.
ALNUM = _blanks(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def space_words(raw: bytes) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of UTF-8 text; bytes.split() has just these separators."""
    return raw.split()


def alnum_words(raw: bytes) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z lower-cased."""
    return raw.lower().translate(ALNUM).split()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold about ``most`` bytes, or one row."""
    for batch in batches:
        ends = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(ends):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names, so that no other column can clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def without_column(df: DataFrame, name: str, needed: str) -> DataFrame:
    """``df`` without the column that a result is to replace, if it has one; names don't differ by case alone."""
    if name.lower() == needed.lower():
        raise ValueError(f"the result can't replace the column {needed!r} it is made from")
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()))


def fresh(name: str, taken) -> str:
    """``name``, with underscores in front until no existing column has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def drawn(rows: DataFrame, kind: str, by: list[str], most: int, longest: int | None = None) -> DataFrame:
    """A bounded sample of ``rows``, written to the shared folder: of each value of ``kind`` about ``most`` distinct rows.

    Rows are drawn by a 64-bit hash of the columns ``by``, those of the lowest hashes, so it is the same rows at every
    run, and equal rows are drawn once; their number is estimated by approx_count_distinct. With ``longest``, rows
    whose ``text`` has more characters aren't drawn. Rows come out with their hash in ``draw``; see :func:`taken`.
    """
    spark = rows.sparkSession
    if longest is not None:
        rows = rows.where(F.length("text") <= longest)
    rows = rows.withColumn("draw", F.xxhash64(*by))
    sizes = rows.groupBy(kind).agg(F.approx_count_distinct("draw", 0.02).alias("n")).collect()
    lowest, span = -(1 << 63), 1 << 64
    limits = [(r[kind], lowest + min(span - 1, int(span * (1.2 * most + 20) / max(1, r["n"])))) for r in sizes if r[kind] is not None]
    limits = spark.createDataFrame(limits, f"`{kind}` {dict(rows.dtypes)[kind]}, below long")
    low = rows.join(F.broadcast(limits), kind).where("draw <= below").drop("below")  # one row for each value of kind
    return Scratch(spark, "drawn").write(low.dropDuplicates([kind, "draw"]), "rows")


#: Characters of a sample of texts on the driver, at most.
SAMPLE_CHARS = 24 << 20


def taken(sample: DataFrame, kind: str, value, most: int, most_chars: int = SAMPLE_CHARS) -> list:
    """The ``most`` rows of lowest hash of one kind, on the driver; fewer where their texts together are over ``most_chars`` characters."""
    lowest = sample.where(F.col(kind) == F.lit(value)).orderBy("draw").limit(most)
    if "text" not in sample.columns:
        return lowest.collect()
    total, last = 0, None
    for r in lowest.select("draw", F.coalesce(F.length("text"), F.lit(0)).alias("n")).collect():
        total += r["n"]
        if total > most_chars:
            break
        last = r["draw"]
    return lowest.where(F.col("draw") <= last).collect() if last is not None else []


def crc32_mod(col, n: int):
    """crc32 of the value's text, modulo n; null counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(col.cast("string"), F.lit("")), "UTF-8")), F.lit(n))


def annotate(docs: DataFrame, text_col: str, fields: str, start, out: str) -> DataFrame:
    """``docs`` with a struct column ``out`` of the DDL ``fields``, in one pass without a shuffle.

    ``start()`` is called once in each task and gives ``work(raws) -> {field: values}``, which sees the
    UTF-8 bytes (None for null) of some rows. Other columns pass through, whatever their names; a column
    named ``out`` is replaced.
    """
    docs = without_column(docs, out, text_col)
    kind = T.StructType.fromDDL(fields)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in slices(batches, text_col):
            got = work(raw_texts(batch, text_col))
            found = pa.StructArray.from_arrays([pa.array(got[f.name], f.type) for f in arrow], fields=list(arrow))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, kind)]))
