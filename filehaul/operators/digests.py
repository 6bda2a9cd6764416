"""Checksums of files as trees over blocks of a fixed size.

SHA-256 of a whole file can only be computed from its start to its end. A tree
over blocks is computed by many tasks, compares at any size, and tells where a
file is damaged. The tree does not depend on how a file was cut for reading.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.operators import packing
from filehaul.options import DEFAULT_BLOCK_BYTES, DEFAULT_SEGMENT_BYTES, DEFAULT_TASK_BYTES, check_bytes
from filehaul.sources import chunks
from filehaul.storage import delete_stored, open_filesystem, store_once

# Digests below a node of the tree.
FAN = 1024
# First byte of what is hashed for a block, and for a node, so that no file's block passes for a node.
_LEAF, _NODE = b"\x00", "01"
_READ_BYTES = 4 << 20
FILE_COLUMNS = ["fileName", "fullPath", "relativePath"]


def block_digests(
    files: DataFrame,
    block_bytes: int | str | None = None,
    segment_bytes: int | str | None = None,
    task_bytes: int = DEFAULT_TASK_BYTES,
) -> DataFrame:
    """``fileName, fullPath, relativePath, block_no, bytes, digest`` for every block of the listed files, stored once.

    A file is read by several tasks, in segments of whole blocks. An empty file
    has one empty block. Files are read to their end, also if they have grown
    since they were listed.
    """
    block = check_bytes("block_bytes", block_bytes, DEFAULT_BLOCK_BYTES)
    segment = -(-check_bytes("segment_bytes", segment_bytes, DEFAULT_SEGMENT_BYTES) // block) * block
    segments = chunks.to_segments(chunks.with_source_uri(files), segment).withColumn("_size", chunks.segment_size(segment))
    placed = packing.balanced_tasks(segments, "_size", task_bytes=task_bytes).select(
        *FILE_COLUMNS, "sourceURI", "offset", "length"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            for item in batch.to_pylist():
                for numbers, sizes, digests in _blocks(item, block, opened):
                    many = len(numbers)
                    arrays = [pa.array([item[name]] * many, pa.string()) for name in FILE_COLUMNS]
                    arrays += [pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*FILE_COLUMNS, "block_no", "bytes", "digest"])

    schema = ", ".join(f"{name} string" for name in FILE_COLUMNS) + ", block_no long, bytes long, digest string"
    return store_once(placed.mapInArrow(read, schema), "blocks")[0]


def _blocks(item: dict, block: int, opened: dict) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Numbers, sizes and digests of the blocks of a segment, some thousand at a time."""
    filesystem, path = open_filesystem(item["sourceURI"], opened)
    number, left = item["offset"] // block, item["length"]
    numbers: list[int] = []
    sizes: list[int] = []
    digests: list[str] = []
    with filesystem.open_input_file(path) as source:
        source.seek(item["offset"])
        while left is None or left > 0:
            digest, size = hashlib.sha256(_LEAF), 0
            while size < block and (data := source.read(min(_READ_BYTES, block - size))):
                digest.update(data)
                size += len(data)
            if not size and number:
                break
            numbers.append(number)
            sizes.append(size)
            digests.append(digest.hexdigest())
            number, left = number + 1, None if left is None else left - size
            if size < block:
                break
            if len(numbers) == 4096:
                yield numbers, sizes, digests
                numbers, sizes, digests = [], [], []
    if numbers:
        yield numbers, sizes, digests


def tree_digests(blocks: DataFrame, fan: int = FAN) -> DataFrame:
    """``fileName, fullPath, relativePath, bytes, blocks, tree_sha256`` for every file, from its stored blocks.

    A node is the digest of up to ``fan`` digests below it, in order; a single
    one goes up as it is. A task sees ``fan`` digests of a node at a time.
    """
    last = blocks.agg(F.max("block_no")).first()[0]
    level = blocks.select(*FILE_COLUMNS, "block_no", "bytes", F.lit(1).cast("long").alias("blocks"), "digest")
    children = F.sort_array(F.collect_list(F.struct("block_no", "digest")))
    while last:
        up = level.groupBy(*FILE_COLUMNS, F.expr(f"block_no div {fan}").alias("node")).agg(
            children.alias("children"), F.sum("bytes").alias("bytes"), F.sum("blocks").alias("blocks")
        )
        below = F.array_join(F.transform("children", lambda child: child["digest"]), "")
        digest = F.when(F.size("children") == 1, F.col("children")[0]["digest"]).otherwise(
            F.sha2(F.unhex(F.concat(F.lit(_NODE), below)), 256)
        )
        level = up.select(*FILE_COLUMNS, F.col("node").alias("block_no"), "bytes", "blocks", digest.alias("digest"))
        last //= fan
    return level.select(*FILE_COLUMNS, "bytes", "blocks", F.col("digest").alias("tree_sha256"))


def file_digests(files: DataFrame, block_bytes: int | str | None = None, segment_bytes: int | str | None = None) -> DataFrame:
    """Tree digests of listed files, computed once."""
    blocks = block_digests(files, block_bytes, segment_bytes)
    result, _ = store_once(tree_digests(blocks), "tree-digests")
    delete_stored(blocks)
    return result


def compare_blocks(expected: DataFrame, found: DataFrame, block_bytes: int | str | None = None) -> DataFrame:
    """Blocks that differ: ``relativePath, block_no, offset, bytes, status, reason``, from blocks of the same size.

    ``reason`` is 'differs', 'missing' (only expected) or 'added' (only found).
    Files are paired by their path below the root.
    """
    block = check_bytes("block_bytes", block_bytes, DEFAULT_BLOCK_BYTES)
    side = lambda rows, name: rows.select("relativePath", "block_no", F.struct("bytes", "digest").alias(name))
    both = side(expected, "wanted").join(side(found, "got"), ["relativePath", "block_no"], "full")
    reason = F.when(F.col("got").isNull(), "missing").when(F.col("wanted").isNull(), "added").when(F.col("wanted.digest") != F.col("got.digest"), "differs")
    return both.withColumn("reason", reason).where("reason is not null").select(
        "relativePath", "block_no", (F.col("block_no") * block).alias("offset"),
        F.coalesce("wanted.bytes", "got.bytes").alias("bytes"), F.lit("failed").alias("status"), "reason",
    )
