"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): two columns only, so that no other column can clash; null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, mod ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str, rows: int | None = None) -> DataFrame:
    """Run ``fn`` on each Arrow batch, or on each ``rows`` rows of it; it returns columns by name, cast to ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = rows or max(1, batch.num_rows)
            for start in range(0, batch.num_rows, step):
                yield record_batch(fn(batch.slice(start, step)), arrow)
        pa.default_memory_pool().release_unused()  # the worker process lives on beside later stages

    return df.mapInArrow(run, schema)


def record_batch(columns: dict[str, object], arrow: pa.Schema) -> pa.RecordBatch:
    made = []
    for field in arrow:
        values = columns[field.name]
        made.append(values if isinstance(values, pa.Array) and values.type == field.type else pa.array(values, type=field.type))
    return pa.RecordBatch.from_arrays(made, schema=arrow)


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)
