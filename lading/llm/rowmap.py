"""Adding per-text results to rows, one Arrow batch at a time.

The row travels as one struct column, so the operator's own column names
cannot clash with columns of the input, whatever those are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lading.llm.textcols import release, slices

ROW = "row"


def map_texts(docs: DataFrame, text_col: str, fields: Sequence[StructField],
              measure: Callable, arrow_types: Sequence[pa.DataType]) -> DataFrame:
    """``docs`` as a struct column ``row`` plus one column per field.

    ``measure(bytes, offsets)`` gets a bounded run of rows (null texts are
    empty) and returns one array per field.
    """
    at = docs.columns.index(text_col)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.column(0)
        parts: list[list] = [[] for _ in fields]
        for _, _, buf, off in slices(rows.field(at)):
            for part, values in zip(parts, measure(buf, off)):
                part.append(pa.array(values))
        new = [pa.concat_arrays([p.cast(t) for p in part]) if part else pa.array([], t)
               for part, t in zip(parts, arrow_types)]
        return pa.RecordBatch.from_arrays([rows, *new], [ROW, *(f.name for f in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield one(batch)
            del batch                       # gone before the next one is read
        release()

    schema = StructType([StructField(ROW, StructType(docs.schema.fields), False), *fields])
    packed = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return packed.select(F.struct(*[packed[f"`{c}`"] for c in docs.columns]).alias(ROW)).mapInArrow(run, schema)
