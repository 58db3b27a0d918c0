"""Length-delimited binary files of token sequences with a separate offset index.

A data file is a run of frames: the payload's length (8 bytes), the masked CRC-32 of those 8 bytes
(4), the payload, the masked CRC-32 of the payload (4); all little-endian. Masking turns the
checksum and adds a constant, so that data which holds such checksums is not checked by itself. A
payload is the sequence's id (8 bytes signed, after 8 bytes that are 1 if it has one), the count of
ids before it in its file (8) and the ids at 2 bytes each, or 4 if the vocabulary needs them.

The index file of a data file holds each frame's offset and number of ids (8 bytes each) with one
masked CRC-32 at its end: a reader that shuffles seeks to any frame.

Files are written by tasks under names of their own attempt, through Arrow's file systems. The
table of those that count, the manifest, is written by Spark's committer: an attempt that was lost
or ran twice leaves a file that nothing names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.tables import giving_back, text_slices
from orderlake.llm.tokens import with_end, word_encoder
from orderlake.scratch import scratch_path

MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
META = struct.Struct("<qqQ")
TAIL = struct.Struct("<I")

MANIFEST = "shard long, file string, width int, docs long, tokens long"
RECORD = "shard long, position long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, TAIL.pack(masked(zlib.crc32(length))), payload, TAIL.pack(masked(zlib.crc32(payload))))
    )


def unframe(data: memoryview, offset: int) -> tuple[memoryview, int]:
    """The payload at `offset` and where the next frame begins; an error if a checksum differs."""
    if len(data) < offset + HEAD.size:
        raise ValueError(f"frame at {offset} is cut short")
    length, check = HEAD.unpack_from(data, offset)
    if masked(zlib.crc32(data[offset : offset + 8])) != check:
        raise ValueError(f"length at {offset} does not match its checksum")
    start, end = offset + HEAD.size, offset + HEAD.size + length
    if len(data) < end + TAIL.size:
        raise ValueError(f"frame at {offset} is cut short")
    payload = data[start:end]
    if masked(zlib.crc32(payload)) != TAIL.unpack_from(data, end)[0]:
        raise ValueError(f"payload at {offset} does not match its checksum")
    return payload, end + TAIL.size


def payload_of(doc_id: int | None, before: int, ids: np.ndarray, width: int) -> bytes:
    return META.pack(doc_id is not None, doc_id or 0, before) + ids.astype(f"<u{width}").tobytes()


def parse_payload(payload: memoryview, width: int) -> tuple[int | None, int, np.ndarray]:
    known, doc_id, before = META.unpack_from(payload)
    return doc_id if known else None, before, np.frombuffer(payload[META.size :], f"<u{width}")


def index_bytes(rows: list[tuple[int, int]]) -> bytes:
    body = np.array(rows, "<u8").reshape(-1, 2).tobytes()
    return body + TAIL.pack(masked(zlib.crc32(body)))


def parse_index(data: bytes) -> np.ndarray:
    body = data[: -TAIL.size]
    if masked(zlib.crc32(body)) != TAIL.unpack(data[-TAIL.size :])[0]:
        raise ValueError("index does not match its checksum")
    return np.frombuffer(body, "<u8").reshape(-1, 2)


def read_record(location: str, file: str, k: int, width: int) -> tuple[int | None, int, np.ndarray]:
    """The k-th record of a file by its index alone, as a shuffled reader does."""
    store, folder = fs.FileSystem.from_uri(location)
    with store.open_input_file(f"{folder}/{file}.index") as source:
        offset = int(parse_index(source.read())[k, 0])
    with store.open_input_file(f"{folder}/{file}.records") as source:
        source.seek(offset)
        length, _ = HEAD.unpack(source.read(HEAD.size))
        source.seek(offset)
        data = memoryview(source.read(HEAD.size + length + TAIL.size))
    return parse_payload(unframe(data, 0)[0], width)


def write_records(
    docs: DataFrame,
    location: str,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 2,
    shards: int | None = None,
) -> DataFrame:
    """Encode documents, write them to `location` in ascending id order, return the manifest.

    Shards are ranges of ids, so one file follows another; rows of one id lie together, in any
    order among themselves, and null ids come first. Each row has its end id, so a null or empty
    text makes a record of one id. `location` is a URI that all machines reach. An empty table
    makes an empty manifest. `width` 2 refuses ids over 65535.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    location = uri(location)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(location)
        shard = TaskContext.get().partitionId()
        name = f"{shard:05d}-{uuid4().hex}"
        data, index, tokens, offset = None, [], 0, 0
        for part in text_slices(batches, "text"):
            if data is None:
                store.create_dir(folder, recursive=True)
                data = store.open_output_stream(f"{folder}/{name}.records")
            ids, begins = with_end(*word_encoder(tokenizer_path).encode(part.column(1)), end_id)
            if len(ids) and int(ids.max()) >> (8 * width):
                raise ValueError(f"an id needs more than {width} bytes")
            ids = ids.astype(f"<u{width}")
            frames = []
            for k, doc_id in enumerate(part.column(0).to_pylist()):
                own = ids[begins[k] : begins[k + 1]]
                framed = frame(payload_of(doc_id, tokens, own, width))
                index.append((offset, len(own)))
                frames.append(framed)
                offset += len(framed)
                tokens += len(own)
            data.write(b"".join(frames))
        if data is not None:
            data.close()
            with store.open_output_stream(f"{folder}/{name}.index") as out:
                out.write(index_bytes(index))
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int64()),
                    "file": [name],
                    "width": pa.array([width], pa.int32()),
                    "docs": pa.array([len(index)], pa.int64()),
                    "tokens": pa.array([tokens], pa.int64()),
                }
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first()
    )
    manifest = f"{location}/manifest"
    ordered.mapInArrow(giving_back(write), MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_records(spark: SparkSession, location: str, most: int = 1 << 22) -> DataFrame:
    """The records of all files that the manifest names, every checksum verified.

    Gives shard, position in it, doc_id, local_start (ids before it in its file), n_tokens and the
    CRC-32 of its ids as unsigned 32-bit integers. A task reads a file in runs of frames of some
    `most` bytes.
    """
    location = uri(location)
    manifest = spark.read.schema(MANIFEST).parquet(f"{location}/manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(location)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{folder}/{row['file']}.index") as source:
                    index = parse_index(source.read())
                if len(index) != row["docs"] or int(index[:, 1].sum()) != row["tokens"]:
                    raise ValueError(f"{row['file']}: index and manifest differ")
                with store.open_input_file(f"{folder}/{row['file']}.records") as source:
                    yield from _runs(source, index, row, most)

    # A number is given, as the few manifest rows would else be joined into one task that reads all files.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(tasks, "shard").mapInArrow(giving_back(read), RECORD)


def _runs(source, index: np.ndarray, row: dict, most: int) -> Iterator[pa.RecordBatch]:
    bounds = index[:, 0].astype(np.int64)
    ends = np.append(bounds[1:], source.size())
    first = 0
    while first < len(bounds):
        last = max(first + 1, int(np.searchsorted(ends, bounds[first] + most, side="right")))
        data = memoryview(source.read(int(ends[last - 1] - bounds[first])))
        out, offset = [], 0
        for k in range(first, last):
            if offset != bounds[k] - bounds[first]:
                raise ValueError(f"{row['file']}: frame {k} is not where its index says")
            payload, offset = unframe(data, offset)
            doc_id, before, ids = parse_payload(payload, row["width"])
            if len(ids) != index[k, 1]:
                raise ValueError(f"{row['file']}: frame {k} has another length than its index says")
            crc = zlib.crc32(ids.astype("<u4"))
            out.append((row["shard"], k, doc_id, before, len(ids), crc))
        first = last
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
            names=[c.split()[0] for c in RECORD.split(", ")],
        )


def records_with_starts(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add `start`, the ids of all records before in the order of shards.

    The running sum goes over the manifest, one row per file.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return records.join(bases, "shard").withColumn("start", F.col("base") + F.col("local_start"))


def uri(location: str) -> str:
    """A location as Arrow and Spark both read it."""
    return location if "://" in location or location.startswith("file:") else f"file://{location}"


def new_location(spark: SparkSession) -> str:
    return uri(scratch_path(spark, "token-records"))
