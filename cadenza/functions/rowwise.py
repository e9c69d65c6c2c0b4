"""Python functions of a row over DataFrames, in memory that doesn't grow with the rows of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that are Python objects at once; strings, numbers and lists stay in Arrow's buffers until then.
ROWS = 16


def mapped(df: DataFrame, work: Callable[..., tuple], schema: str) -> DataFrame:
    """``work(*values)`` of each row, a tuple as the DDL ``schema`` has it; nothing is shuffled."""
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                got = [work(*values) for values in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns))]
                yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*got), arrow)], schema=arrow)

    return df.mapInArrow(run, kind)
