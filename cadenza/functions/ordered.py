"""Order-dependent columns without one task for each key.

A plain window over a key puts all its rows into one task. Here the rows of a
key are cut into buckets by an expression that grows with the order; windows
run over (key, bucket), and a table with one row for each bucket carries ranks,
sums and neighbours across their borders. A bucket without rows does no harm.

The table of buckets is written at once, so the input is read once for it and
once for the result, however many calls follow each other; columns that need the
same order are still best made in one call of :func:`extended`.

There can be almost as many buckets as rows, and their file is some forty times
smaller than its rows in memory, so the table is never broadcast: it is dealt as
the windows deal the rows, by one column of keys and bucket, and meets them there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadenza.sources.scratch import Scratch

_B, _AT = "__bucket", "__at"


def extended(
    df: DataFrame, keys: list[str], order: list[str], bucket: Column, rank: str | None = None, sums: dict[str, tuple[Column, bool]] | None = None,
    ahead: dict[str, str] | None = None, behind: dict[str, str] | None = None,
) -> DataFrame:
    """Add columns by the order of the rows of each key; null keys are a key of their own.

    ``rank`` numbers the rows from 1. ``sums`` has running sums by name: the value, and whether a row's own counts;
    for them the order must be without ties. ``ahead`` and ``behind`` name columns of the next row and the one
    before, which are null at the ends.
    """
    sums, ahead, behind = sums or {}, ahead or {}, behind or {}
    df = df.withColumn(_B, bucket)
    at = F.struct(*order)
    near = {"ahead": ahead, "behind": behind}
    packed = {side: F.struct(*(F.col(c).alias(n) for c, n in columns.items())) for side, columns in near.items() if columns}
    totals = [F.count("*").alias("__n"), *(F.sum(v).alias(f"__s_{n}") for n, (v, _) in sums.items())]
    edges = [(F.min_by if side == "ahead" else F.max_by)(x, at).alias(f"__e_{side}") for side, x in packed.items()]
    small = df.groupBy(*keys, _B).agg(*totals, *edges)
    across = Window.partitionBy(*keys).orderBy(_B)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    small = small.select(
        F.struct(*keys, _B).alias("__k"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n"),
        *(F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__s_{n}") for n in sums),
        *((F.lead if side == "ahead" else F.lag)(f"__e_{side}").over(across).alias(f"__e_{side}") for side in packed),
    )
    small = Scratch(df.sparkSession, "ordered").write(small, "buckets")
    inside = Window.partitionBy(_AT).orderBy(*order)
    own = [F.row_number().over(inside).cast("long").alias("__rank")] if rank else []
    for n, (value, inclusive) in sums.items():
        own.append(F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)), F.lit(0)).alias(f"__o_{n}"))
    own += [(F.lead if side == "ahead" else F.lag)(x).over(inside).alias(f"__o_{side}") for side, x in packed.items()]
    rows = df.withColumn(_AT, F.struct(*keys, _B)).select("*", *own)  # a struct is equal where the nulls in it are
    out = rows.join(small.hint("merge"), F.col(_AT) == F.col("__k"), "left")
    made = [(F.col("__rank") + F.col("__n")).alias(rank)] if rank else []
    made += [(F.col(f"__o_{n}") + F.col(f"__s_{n}")).alias(n) for n in sums]
    for side in packed:
        made += [F.coalesce(F.col(f"__o_{side}"), F.col(f"__e_{side}"))[n].alias(n) for n in near[side].values()]
    return out.select(*(c for c in df.columns if c != _B), *made)


def ranked(df: DataFrame, keys: list[str], order: list[str], bucket: Column, name: str) -> DataFrame:
    """Number the rows of each key from 1 in their order."""
    return extended(df, keys, order, bucket, rank=name)


def running_sum(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: Column, name: str, inclusive: bool = True) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to each row, itself included or not."""
    return extended(df, keys, order, bucket, sums={name: (value, inclusive)})


def neighbour(df: DataFrame, keys: list[str], order: list[str], bucket: Column, columns: dict[str, str], step: int = 1) -> DataFrame:
    """Columns of the next row of the key (``step`` 1) or the one before (-1), under new names."""
    return extended(df, keys, order, bucket, ahead=columns if step > 0 else None, behind=None if step > 0 else columns)
