"""What the operators share: blocks of texts, broadcasts of a checked size, digests."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task works on at a time.
BLOCK_BYTES = 4 << 20
#: The largest thing that is broadcast.
BROADCAST_BYTES = 64 << 20
#: Rows without an id count as one document that comes after all others.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def broadcast_bytes(spark: SparkSession, content: bytes, what: str):
    """Broadcast a file's content, whose size does not grow with the corpus; raise if it is large."""
    if len(content) > BROADCAST_BYTES:
        raise ValueError(f"{what} has {len(content)} bytes; the most is {BROADCAST_BYTES}")
    return spark.sparkContext.broadcast(content)


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches again in slices of about BLOCK_BYTES of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > BLOCK_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def map_batches(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """``mapInArrow`` whose workers can import this package from where the driver has it."""
    home, environment = str(Path(__file__).parents[2]), df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return df.mapInArrow(run, schema)


def map_texts(
    docs: DataFrame,
    columns: list[str],
    work: Callable[[pa.RecordBatch], dict],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply ``work`` to blocks of texts. It returns a dict of columns in the order of ``schema``."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [_array(v, f.type) for v, f in zip(work(block).values(), arrow)], schema=arrow
            )

    return map_batches(docs.select(*columns), run, fields)


def arrow_schema(fields: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)
