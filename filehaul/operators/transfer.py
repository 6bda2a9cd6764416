"""Writing of chunk rows to target objects.

A task opens one object at a time. An object gets its name only when it is
complete: on local and HDFS targets it is written to the run's own folder,
under a name no other attempt uses, and moved. Segments of bigger files become
parts in that folder, joined by a second job.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from filehaul.functions import crypto, framing
from filehaul.operators import packing
from filehaul.sources.chunks import CHUNK_SCHEMA, arrow_columns
from filehaul.storage import ATOMIC_STORES, open_filesystem

RESULT_SCHEMA = StructType(
    [
        StructField("bytes", LongType()),
        StructField("crc32", LongType()),
        StructField("sha256", StringType()),
        StructField("target_offset", LongType()),
        StructField("target_bytes", LongType()),
        StructField("part", StringType()),
        StructField("status", StringType()),
        StructField("error", StringType()),
    ]
)
_COPY_BYTES = 4 << 20
# Object stores copy at most this much under a new name in one request.
_ONE_COPY_BYTES = 5 << 30
# Of written objects, by layout. An encrypted payload is no OpenPGP message, so it does not claim to be one.
CONTENT_TYPES = {
    "block": "application/vnd.filehaul.encrypted", "zip": "application/zip", "plain": "application/octet-stream",
}


def encrypt_chunks(chunks: DataFrame) -> DataFrame:
    """Seal every chunk with its data key, and the data key with the run key."""
    seg_aad = crypto.key_aad(F.col("relativePath"), F.col("seg_no"), F.col("n_segments"))
    return (
        chunks.withColumn(
            "data",
            crypto.encrypt(
                F.col("data"),
                F.col("data_key"),
                crypto.chunk_aad(seg_aad, F.col("chunk_no"), F.col("is_last")),
            ),
        )
        .withColumn(
            "data_key",
            F.when(
                F.col("chunk_no") == 0,
                crypto.encrypt(F.col("data_key"), F.col("run_key"), seg_aad),
            ),
        )
        .withColumn("run_key", F.lit(None).cast("binary"))
    )


def decrypt_chunks(chunks: DataFrame) -> DataFrame:
    """Inverse of :func:`encrypt_chunks`; ``data`` is NULL where a check fails."""
    seg_aad = crypto.key_aad(F.col("relativePath"), F.col("seg_no"), F.col("n_segments"))
    opened = crypto.try_decrypt(
        F.col("data"),
        crypto.try_decrypt(F.col("data_key"), F.col("run_key"), seg_aad),
        crypto.chunk_aad(seg_aad, F.col("chunk_no"), F.col("is_last")),
    )
    sealed = F.col("encrypted") & F.col("error").isNull()
    return (
        chunks.withColumn("data", F.when(sealed, opened).otherwise(F.col("data")))
        .withColumn("data_key", F.lit(None).cast("binary"))
        .withColumn("run_key", F.lit(None).cast("binary"))
    )


def result_schema(chunk_schema: StructType) -> StructType:
    """Schema of the writer's rows: the columns in front of the chunk columns, then the result."""
    kept = chunk_schema.fields[: len(chunk_schema.fields) - len(CHUNK_SCHEMA.fields)]
    return StructType(kept + RESULT_SCHEMA.fields)


def run_folder(run_id: str) -> str:
    """Folder below the target for parts and unfinished objects of a run."""
    return f"_run-{run_id}"


class _Target:
    """An object under construction; ``unfinished`` is its URI until it is complete.

    Closing a stream may publish what it holds, complete or not, so the final name is
    never opened: a write that fails leaves an older object of that name as it was.
    """

    def __init__(self, uri: str, unfinished: str, opened: dict, made_dirs: set, content_type: str | None = None):
        self.filesystem, self.path = open_filesystem(uri, opened)
        self.open_path = open_filesystem(unfinished, opened)[1]
        # Names in object stores need no folders.
        if self.filesystem.type_name not in ATOMIC_STORES:
            for folder in {posixpath.dirname(self.path), posixpath.dirname(self.open_path)}:
                if folder not in made_dirs:
                    self.filesystem.create_dir(folder, recursive=True)
                    made_dirs.add(folder)
        self.metadata = {"Content-Type": content_type} if content_type else None
        self.stream = self.filesystem.open_output_stream(self.open_path, metadata=self.metadata)
        self.size = 0

    def write(self, data) -> None:
        self.stream.write(data)
        self.size += len(data)

    def publish(self) -> None:
        self.stream.close()
        if self.filesystem.type_name in ATOMIC_STORES and self.size > _ONE_COPY_BYTES:
            self._copy_in_parts()
            return
        try:
            self.filesystem.move(self.open_path, self.path)
        except OSError:
            # Some filesystems do not rename over an existing file.
            if not self.filesystem.get_file_info(self.path).is_file:
                raise
            self._replace()

    def _replace(self) -> None:
        """Put the older object aside, and back if the new one cannot take its name."""
        aside = f"{self.open_path}.old"
        self.filesystem.move(self.path, aside)
        try:
            self.filesystem.move(self.open_path, self.path)
        except OSError:
            self.filesystem.move(aside, self.path)
            raise
        self.filesystem.delete_file(aside)

    def _copy_in_parts(self) -> None:
        with (
            self.filesystem.open_input_file(self.open_path) as source,
            self.filesystem.open_output_stream(self.path, metadata=self.metadata) as target,
        ):
            while data := source.read_buffer(_COPY_BYTES):
                target.write(data)
        self.filesystem.delete_file(self.open_path)

    def discard(self) -> None:
        try:
            self.stream.close()
            self.filesystem.delete_file(self.open_path)
        except OSError:
            pass


def write_chunks(
    batches: Iterator[pa.RecordBatch],
    target: str,
    run_id: str,
    layout: str = "plain",
    header: dict | None = None,
    check: bool = False,
    dry_run: bool = False,
    record_errors: bool = False,
) -> Iterator[pa.RecordBatch]:
    """Write the segments in a task's chunk rows; one result row per segment.

    ``layout`` is 'plain', 'zip' or 'block'. With ``check`` the data is
    inflated where needed, hashed and compared to ``expected_sha256``, and only
    a segment that passes is published. ``dry_run`` checks without writing.
    """
    # A folder per task attempt: names are unique, and tasks do not wait for each other's folder.
    scratch = f"{run_folder(run_id)}/{uuid.uuid4().hex}"
    job = _Job(target, scratch, layout, header, check, dry_run, record_errors, {}, set())
    segment: _Segment | None = None
    for batch in batches:
        places, results = [], []
        columns = {name: batch.column(name) for name in batch.schema.names}
        for place in range(batch.num_rows):
            number = columns["chunk_no"][place].as_py()
            is_last = columns["is_last"][place].as_py()
            if number == 0:
                kept = batch.schema.names[: -len(CHUNK_SCHEMA.fields)]
                item = {name: columns[name][place].as_py() for name in kept}
                segment = _Segment(item, job)
                segment.start(columns["data_key"][place].as_py())
            error = columns["error"][place].as_py()
            segment.add(columns["data"][place].as_buffer(), error)
            if is_last:
                places.append(place)
                results.append(
                    segment.finish(
                        columns["seg_bytes"][place].as_py(),
                        columns["seg_crc32"][place].as_py(),
                        columns["seg_sha256"][place].as_py(),
                    )
                )
        if places:
            done = batch.take(pa.array(places, pa.int64())).columns[: -len(CHUNK_SCHEMA.fields)]
            done += arrow_columns(results, RESULT_SCHEMA)
            names = batch.schema.names[: -len(CHUNK_SCHEMA.fields)] + RESULT_SCHEMA.names
            yield pa.RecordBatch.from_arrays(done, names=names)


@dataclass
class _Job:
    """What all segments of a task have in common."""

    target: str
    scratch: str
    layout: str
    header: dict | None
    check: bool
    dry_run: bool
    record_errors: bool
    opened: dict
    made_dirs: set
    started: int = 0


class _Segment:
    """One segment on its way to the target."""

    def __init__(self, item: dict, job: _Job):
        self.item, self.job = item, job
        self.whole = item["n_segments"] == 1
        self.scratch = f"{job.scratch}/{job.started}"
        job.started += 1
        self.part = None if self.whole else self.scratch
        self.output: _Target | None = None
        self.digest, self.plain_bytes = hashlib.sha256(), 0
        self.offset = 0
        self.data_bytes: int | None = None
        self.failure: str | None = None
        self.damaged = False

    def _attempt(self, step, *values) -> None:
        """Run a step; an I/O error gives up the segment, or the task when errors are not recorded."""
        if self.failure is not None:
            return
        try:
            step(*values)
        except (OSError, ValueError, zlib.error) as error:
            self._give_up(f"{type(error).__name__}: {error}")
            if not self.job.record_errors:
                raise

    def _give_up(self, message: str) -> None:
        self.failure = message
        if self.output is not None:
            self.output.discard()
            self.output = None

    def start(self, data_key: bytes | None) -> None:
        self._attempt(self._start, data_key)

    def _start(self, data_key: bytes | None) -> None:
        if self.job.dry_run:
            return
        name = self.item["targetName"] if self.whole else self.part
        self.output = _Target(
            f"{self.job.target}/{name}",
            f"{self.job.target}/{self.scratch}",
            self.job.opened,
            self.job.made_dirs,
            # Parts are read by the join only.
            CONTENT_TYPES.get(self.job.layout) if self.whole else None,
        )
        item = self.item
        if self.job.layout == "zip" and self.whole:
            self.output.write(
                framing.zip_head(
                    item["fileName"],
                    item["modificationTime"],
                    framing.needs_zip64(item["fileSize"]),
                )
            )
            self.offset = self.output.size
        elif self.job.layout == "block" and data_key is not None:
            self.output.write(
                framing.block_head(
                    {
                        **self.job.header,
                        "fileName": item["fileName"],
                        "relativePath": item["relativePath"],
                        "modificationTime": item["modificationTime"].isoformat(),
                        "seg_no": item["seg_no"],
                        "n_segments": item["n_segments"],
                        "data_key": data_key.hex(),
                    }
                )
            )

    def add(self, data: pa.Buffer | None, error: str | None) -> None:
        if error is not None:
            self._give_up(error)
        elif data is None:
            self.damaged = True
            self._give_up("the data does not pass its integrity check")
        else:
            self._attempt(self._add, data)

    def _add(self, data: pa.Buffer) -> None:
        if self.job.check:
            if self.item["encrypted"] and self.item["compressed"]:
                data = framing.inflate(data)
            self.digest.update(data)
            self.plain_bytes += len(data)
        if self.job.dry_run:
            return
        if self.job.layout == "block":
            self.output.write(framing.frame(data))
        self.output.write(data)

    def finish(self, seg_bytes: int | None, seg_crc: int | None, seg_sha: str | None) -> tuple:
        if self.job.check:
            seg_bytes, seg_sha = self.plain_bytes, self.digest.hexdigest()
        status = "ok"
        if self.job.check and self.failure is None:
            expected = self.item["expected_sha256"]
            status = "absent" if expected is None else "passed"
            if expected not in (None, seg_sha):
                self.damaged = True
                self._give_up("the checksum differs")
        self._attempt(self._finish, seg_bytes, seg_crc)
        if self.failure is not None:
            status = "failed" if self.damaged else "error"
            return (None, None, None, None, None, None, status, self.failure)
        return (seg_bytes, seg_crc, seg_sha, self.offset, self.data_bytes, self.part, status, None)

    def _finish(self, seg_bytes: int, seg_crc: int) -> None:
        if self.job.dry_run:
            return
        item, output = self.item, self.output
        if self.job.layout == "block":
            output.write(framing.BLOCK_END)
        self.data_bytes = output.size - self.offset
        if self.job.layout == "zip" and self.whole:
            output.write(
                framing.zip_tail(
                    item["fileName"],
                    item["modificationTime"],
                    framing.needs_zip64(item["fileSize"]),
                    seg_crc,
                    self.data_bytes,
                    seg_bytes,
                )
            )
        output.publish()
        self.output = None


def write_contents(
    table: DataFrame, target: str, run_id: str, name: str, content: str
) -> DataFrame:
    """Write every row's content to an object of its own; one result row per object.

    ``name`` holds object names below ``target``. Lazy: every evaluation
    writes. Remove ``run_folder(run_id)`` below the target when it is done.
    """
    data = F.col(content).cast("binary")
    rows = table.select(
        F.col(name).alias("targetName"),
        F.lit(0).cast("long").alias("seg_no"),
        F.lit(1).cast("long").alias("n_segments"),
        F.lit(0).cast("long").alias("chunk_no"),
        F.lit(True).alias("is_last"),
        data.alias("data"),
        F.octet_length(data).cast("long").alias("seg_bytes"),
        F.crc32(data).alias("seg_crc32"),
        F.sha2(data, 256).alias("seg_sha256"),
        *(F.lit(None).cast(kind).alias(field) for field, kind in
          (("error", "string"), ("data_key", "binary"), ("run_key", "binary"))),
    )
    write = partial(write_chunks, target=target, run_id=run_id)
    return rows.mapInArrow(write, result_schema(rows.schema))


def join_parts(
    results: DataFrame, target: str, run_id: str, layout: str, record_errors: bool
) -> DataFrame:
    """Join the parts of bigger files into their objects; result rows per segment again.

    Reading, compression and encryption were spread over tasks before; what is
    left is a byte copy per object, as an append-only store takes one writer.
    A file with a failed segment is not joined.
    """
    keys = ["targetName", "fullPath"]
    # A list per file of a few dozen bytes per segment: 1000 entries for a file of 1 TiB.
    segment = F.struct("seg_no", "part", "target_bytes", "bytes", "crc32", "status")
    files = results.groupBy(*keys).agg(
        F.sort_array(F.collect_list(segment)).alias("segments"),
        F.first("n_segments").alias("n_segments"),
        F.first("fileName").alias("fileName"),
        F.first("fileSize").alias("fileSize"),
        F.first("modificationTime").alias("modificationTime"),
    )
    # Files by bytes and number: left alone, Spark would merge these few bytes of metadata into one task.
    first = F.col("seg_no") == 0
    count, total = results.agg(
        F.count_if(first), F.coalesce(F.sum(F.when(first, F.col("fileSize"))), F.lit(0))
    ).first()
    tasks = packing.job_tasks(results.sparkSession, count, count, total)
    packed = packing.pack_files(
        files, max_split_size=4 * -(-count // tasks), ties=("fullPath", "targetName"), n_files=count, splits=tasks
    )
    placed = packing.one_task_per_split(packed, tasks).drop("split_id")
    joined = placed.mapInArrow(
        partial(_join, target=target, run_id=run_id, layout=layout, record_errors=record_errors),
        "targetName string, fullPath string, seg_no long, _offset long, _error string",
    )
    error = F.coalesce("error", "_error")
    return (
        results.join(joined, [*keys, "seg_no"], "left")
        .withColumn("target_offset", F.when(error.isNull(), F.col("_offset")))
        .withColumn("status", F.when(F.col("error").isNull() & error.isNotNull(), "error")
                    .otherwise(F.col("status")))
        .withColumn("error", error)
        .drop("_offset", "_error")
        .select(*results.columns)
    )


def _join(
    batches: Iterator[pa.RecordBatch], target: str, run_id: str, layout: str, record_errors: bool
) -> Iterator[pa.RecordBatch]:
    opened: dict = {}
    made_dirs: set = set()
    scratch = f"{run_folder(run_id)}/{uuid.uuid4().hex}"
    for batch in batches:
        for item in batch.to_pylist():
            segments = item["segments"]
            offsets: list[int | None] = [None] * len(segments)
            failure = None
            if any(segment["part"] is None for segment in segments):
                failure = "another segment of the file failed"
            else:
                try:
                    offsets = _join_file(
                        item, segments, target, scratch, layout, opened, made_dirs
                    )
                except (OSError, ValueError) as error:
                    if not record_errors:
                        raise
                    failure = f"{type(error).__name__}: {error}"
            count = len(segments)
            yield pa.RecordBatch.from_pydict(
                {
                    "targetName": [item["targetName"]] * count,
                    "fullPath": [item["fullPath"]] * count,
                    "seg_no": [segment["seg_no"] for segment in segments],
                    "_offset": pa.array(offsets, pa.int64()),
                    "_error": pa.array([failure] * count, pa.string()),
                }
            )


def _join_file(item, segments, target, scratch, layout, opened, made_dirs) -> list[int]:
    unfinished = f"{target}/{scratch}/joined"
    output = _Target(f"{target}/{item['targetName']}", unfinished, opened, made_dirs, CONTENT_TYPES.get(layout))
    zipped = layout == "zip"
    entry = (item["fileName"], item["modificationTime"], framing.needs_zip64(item["fileSize"]))
    try:
        if zipped:
            output.write(framing.zip_head(*entry))
        offsets, crc, packed, plain = [], 0, 0, 0
        for segment in segments:
            offsets.append(output.size)
            filesystem, path = open_filesystem(f"{target}/{segment['part']}", opened)
            with filesystem.open_input_file(path) as source:
                while data := source.read_buffer(_COPY_BYTES):
                    output.write(data)
            if zipped:
                crc = framing.joined_crc(crc, segment["crc32"], segment["bytes"])
            packed += segment["target_bytes"]
            plain += segment["bytes"]
        if zipped:
            output.write(framing.zip_tail(*entry, crc, packed, plain))
        output.publish()
    except BaseException:
        output.discard()
        raise
    return offsets


def delete_run_folder(target: str, run_id: str) -> None:
    """Remove joined parts and what lost attempts left behind."""
    filesystem, path = open_filesystem(f"{target}/{run_folder(run_id)}")
    if filesystem.get_file_info(path).type == pafs.FileType.Directory:
        filesystem.delete_dir(path)
