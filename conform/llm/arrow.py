"""Functions over documents that run on Arrow batches inside Spark's tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}
#: Bytes of text that a block of rows may hold, if it holds more than one row.
BLOCK_BYTES = 1 << 20


def blocks(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each piece fit ``BLOCK_BYTES``, or it is one row."""
    for batch in batches:
        sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)]
        start = held = 0
        for at, size in enumerate(sizes):
            if at > start and held + size > BLOCK_BYTES:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow schema of columns given as ``name kind, name kind``."""
    pairs = (column.split() for column in schema.split(","))
    return pa.schema([(name, KINDS[kind]) for name, kind in pairs])


def map_blocks(df: DataFrame, column: str, function: Callable, schema: str) -> DataFrame:
    """``function`` from a block of rows to rows, as lists by column in the schema's order."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, column):
            found = function(block)
            arrays = [pa.array(x, type=f.type) for x, f in zip(found, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def texts(block: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in block.column(column).to_pylist()]
