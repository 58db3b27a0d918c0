"""Reading and staging tables, and walking through Arrow batches in bounded pieces."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.scratch import scratch_path

#: Text bytes that a Python task works on at once. An Arrow batch may hold more.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors.

    `options` are the writer's.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves `remainder`; false for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in slices of some `most` bytes of text, one row at least.

    A null text takes no bytes. Offsets are read from the string array, nothing is copied.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        width = 8 if pa.types.is_large_string(texts.type) else 4
        offsets = memoryview(texts.buffers()[1]).cast("q" if width == 8 else "i")
        base = texts.offset
        start = 0
        for row in range(1, batch.num_rows + 1):
            end = row == batch.num_rows
            if end or offsets[base + row + 1] - offsets[base + start] > most:
                yield batch.slice(start, row - start)
                start = row


def byte_texts(texts: pa.Array) -> list[bytes]:
    """Each text as UTF-8 bytes; null is empty."""
    return texts.cast(pa.binary()).fill_null(b"").to_pylist()


def giving_back(function: Callable) -> Callable:
    """A function over Arrow batches that returns freed memory to the system when its task ends.

    Python workers live on and take tasks of later stages, with all that their allocators hold.
    """

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
            if trim:
                trim(0)

    return run
