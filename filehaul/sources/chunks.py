"""File content as rows of bounded size.

A file bigger than the segment size is cut into segments that several tasks
read at the same time; a segment is read as chunks. No row ever holds a file,
and a task holds a few chunks at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from filehaul.functions import crypto, framing, paths
from filehaul.operators import packing
from filehaul.options import DEFAULT_CHUNK_BYTES, DEFAULT_SEGMENT_BYTES
from filehaul.storage import open_filesystem

# seg_* hold the plain bytes, CRC-32 and SHA-256 of the segment, on its last chunk only.
CHUNK_SCHEMA = StructType(
    [
        StructField("chunk_no", LongType()),
        StructField("is_last", BooleanType()),
        StructField("data", BinaryType()),
        StructField("seg_bytes", LongType()),
        StructField("seg_crc32", LongType()),
        StructField("seg_sha256", StringType()),
        StructField("error", StringType()),
        StructField("data_key", BinaryType()),
        StructField("run_key", BinaryType()),
    ]
)

_BATCH_BYTES = 16 << 20
_BATCH_ROWS = 1024


def to_segments(files: DataFrame, segment_bytes: int = DEFAULT_SEGMENT_BYTES) -> DataFrame:
    """One row per segment, with ``seg_no``, ``n_segments``, ``offset`` and ``length``.

    The last segment has no length: it ends where the file ends when it is read.
    """
    count = F.greatest(F.ceil(F.col("fileSize") / segment_bytes), F.lit(1).cast("long"))
    return (
        files.withColumn("n_segments", count)
        .withColumn("seg_no", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
        .withColumn("offset", F.col("seg_no") * segment_bytes)
        .withColumn(
            "length", F.when(F.col("seg_no") < count - 1, F.lit(segment_bytes).cast("long"))
        )
    )


def segment_size(segment_bytes: int = DEFAULT_SEGMENT_BYTES) -> Column:
    """Listed bytes of a segment, to balance tasks by."""
    return F.coalesce("length", F.greatest(F.col("fileSize") - F.col("offset"), F.lit(0)))


def with_source_uri(files: DataFrame) -> DataFrame:
    """Add ``sourceURI`` from host URI and full path when the listing did not keep it."""
    if "sourceURI" in files.columns:
        return files
    return files.withColumn("sourceURI", paths.source_uri("hostURI", "fullPath"))


def read_files(
    files: DataFrame,
    chunk_bytes: int = DEFAULT_CHUNK_BYTES,
    segment_bytes: int = DEFAULT_SEGMENT_BYTES,
) -> DataFrame:
    """Whole content of listed files as rows ``(file columns, seg_no, chunk_no, is_last, data)``."""
    chunks = read_segments(to_segments(with_source_uri(files), segment_bytes), chunk_bytes)
    return chunks.select(*files.columns, "seg_no", "n_segments", "chunk_no", "is_last", "data")


def read_segments(segments: DataFrame, chunk_bytes: int = DEFAULT_CHUNK_BYTES) -> DataFrame:
    schema = StructType(segments.schema.fields + CHUNK_SCHEMA.fields)
    return segments.mapInArrow(partial(segment_chunks, chunk_bytes=chunk_bytes), schema)


def read_contents(files: DataFrame) -> DataFrame:
    """Listed files with their whole ``content`` in one row, for files that fit into memory, read in balanced tasks."""
    names, schema = files.columns, StructType([*files.schema.fields, StructField("content", BinaryType())])
    placed = packing.balanced_tasks(with_source_uri(files)).drop("split_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            start, held, size = 0, [], 0
            for place, uri in enumerate(batch.column("sourceURI").to_pylist(), 1):
                filesystem, path = open_filesystem(uri, opened)
                with filesystem.open_input_file(path) as source:
                    held.append(source.read())
                size += len(held[-1])
                if place == batch.num_rows or len(held) == _BATCH_ROWS or size >= _BATCH_BYTES:
                    rows = batch.slice(start, len(held)).select(names)
                    yield rows.append_column("content", pa.array(held, pa.binary()))
                    start, held, size = place, [], 0

    return placed.mapInArrow(read, schema)


def segment_chunks(
    batches: Iterator[pa.RecordBatch],
    chunk_bytes: int,
    compress: bool = False,
    run_key: bytes | None = None,
    record_errors: bool = False,
) -> Iterator[pa.RecordBatch]:
    """Read the segments a task got. With a run key, every segment gets a new data key."""

    def rows(item: dict, opened: dict) -> Iterator[tuple]:
        data_key = crypto.new_key() if run_key else None
        digest, crc, total = hashlib.sha256(), 0, 0
        ends_file = item["seg_no"] == item["n_segments"] - 1
        filesystem, path = open_filesystem(item["sourceURI"], opened)
        with filesystem.open_input_file(path) as source:
            source.seek(item["offset"])
            pieces = _pieces(source.read, chunk_bytes, item["length"])
            for number, (data, is_last) in enumerate(with_last(pieces)):
                digest.update(data)
                crc, total = zlib.crc32(data, crc), total + len(data)
                if compress:
                    data = framing.deflate(data, is_last and ends_file)
                summary = (total, crc, digest.hexdigest()) if is_last else (None, None, None)
                yield number, is_last, data, *summary, None, data_key, run_key

    return expand_rows(batches, rows, record_errors)


def expand_rows(
    batches: Iterator[pa.RecordBatch],
    rows: Callable[[dict, dict], Iterator[tuple]],
    record_errors: bool,
) -> Iterator[pa.RecordBatch]:
    """Put the chunk rows of every input row behind its own columns, in batches of bounded size.

    ``rows`` makes the chunk rows of one input row. An I/O error ends its rows
    with one that holds the message, or the task when errors are not recorded.
    """
    opened: dict = {}
    for batch in batches:
        places: list[int] = []
        made: list[tuple] = []
        held = 0
        for place, item in enumerate(batch.to_pylist()):
            for row in _guarded(rows, item, opened, record_errors):
                places.append(place)
                made.append(row)
                held += len(row[2])
                if held >= _BATCH_BYTES or len(made) >= _BATCH_ROWS:
                    yield _chunk_batch(batch, places, made)
                    places, made, held = [], [], 0
        if made:
            yield _chunk_batch(batch, places, made)


def _guarded(rows, item: dict, opened: dict, record_errors: bool) -> Iterator[tuple]:
    number = 0
    try:
        for row in rows(item, opened):
            yield row
            number += 1
    except (OSError, ValueError, zlib.error) as error:
        if not record_errors:
            raise
        message = f"{type(error).__name__}: {error}"
        yield number, True, b"", None, None, None, message, None, None


def _chunk_batch(batch: pa.RecordBatch, places: list[int], made: list[tuple]) -> pa.RecordBatch:
    kept = batch.take(pa.array(places, pa.int64()))
    names = kept.schema.names + CHUNK_SCHEMA.names
    return pa.RecordBatch.from_arrays(kept.columns + arrow_columns(made, CHUNK_SCHEMA), names=names)


def arrow_columns(rows: list[tuple], schema: StructType) -> list[pa.Array]:
    """Arrow columns of rows that hold the simple types of a schema."""
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    return [
        pa.array(values, kinds[field.dataType.simpleString()])
        for values, field in zip(zip(*rows), schema)
    ]


def _pieces(read: Callable[[int], bytes], size: int, length: int | None) -> Iterator[bytes]:
    """Pieces of at most ``size`` bytes, up to ``length`` bytes or the end."""
    left = length
    while data := read(size if left is None else min(size, left)):
        yield data
        if left is not None:
            left -= len(data)


def with_last(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
    """Every piece with a flag on the last one; one empty piece when there is none."""
    held = next(pieces, b"")
    for piece in pieces:
        yield held, False
        held = piece
    yield held, True


def stored_chunks(
    batches: Iterator[pa.RecordBatch],
    chunk_bytes: int,
    run_keys: dict[str, bytes],
    record_errors: bool = False,
) -> Iterator[pa.RecordBatch]:
    """Read segments of written objects; encrypted ones come out as sealed frames with their keys."""

    def rows(item: dict, opened: dict) -> Iterator[tuple]:
        filesystem, path = open_filesystem(item["sourceURI"], opened)
        data_key = run_key = None
        with filesystem.open_input_file(path) as source:
            source.seek(item["offset"])
            if item["encrypted"]:
                header = framing.read_block_head(source.read)
                data_key = bytes.fromhex(header["data_key"])
                run_key = run_keys.get(header["run_key"])
                if run_key is None:
                    raise ValueError("no private key for this object")
                pieces = framing.read_frames(source.read)
            else:
                pieces = _pieces(source.read, chunk_bytes, item["length"])
                if item["compressed"]:
                    pieces = framing.inflate_pieces(pieces, chunk_bytes)
            for number, (data, is_last) in enumerate(with_last(pieces)):
                yield number, is_last, data, None, None, None, None, data_key, run_key

    return expand_rows(batches, rows, record_errors)
