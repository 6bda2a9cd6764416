"""One-pass ingest: accepted and rejected lines of a micro-batch from one evaluation, committed by its number.

A micro-batch is one write job into a folder of its own, in which good rows and
bad lines are two partitions. A commit with the batch's sizes and times follows
it; readers see committed batches only. A batch that is repeated after a lost
driver overwrites its folder and its commit, so nothing stands twice. The
commits are also the job's progress table.
"""

from __future__ import annotations

import json
import posixpath
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from filehaul.sources.records import CORRUPT, DEFAULT_BATCH_SECONDS, decode_csv
from filehaul.storage import ATOMIC_STORES, open_filesystem, qualified

PROGRESS_SCHEMA = "batch long, input_rows long, accepted long, rejected long, started timestamp, ended timestamp"
_COMMITS = "commits"
# A commit of this many batches before it is put together with them, so that a reader opens few files.
COMPACT_EVERY = 100


class BatchStore:
    """Folder of an ingest: ``data/batch=N/kind=...`` and the commits."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.schema = spark, schema
        self.path = qualified(spark, path).rstrip("/")
        clash = {name.lower() for name in schema.names} & {"line", "kind", "batch", CORRUPT}
        if clash:
            raise ValueError(f"columns {sorted(clash)} are the store's own")

    def write(self, records: DataFrame, batch: int, **csv_options: str) -> None:
        """Decode the lines ``value`` of a micro-batch, write both kinds in one job, and commit."""
        started = datetime.now(timezone.utc)
        decoded = decode_csv(records, self.schema, **csv_options).withColumnRenamed(CORRUPT, "line")
        bad = F.col("line").isNotNull()
        # A bad line's fields are not kept: what could be read of it is not trusted.
        columns = [F.when(~bad, F.col(f"`{name}`")).alias(name) for name in self.schema.names]
        seen = Observation()
        rows = decoded.select(*columns, "line", F.when(bad, "rejected").otherwise("accepted").alias("kind")).observe(
            seen, F.count("*").alias("input_rows"), F.count_if(F.col("kind") == "accepted").alias("accepted"),
            F.count_if(F.col("kind") == "rejected").alias("rejected"),
        )
        rows.write.mode("overwrite").partitionBy("kind").parquet(f"{self.path}/data/batch={batch}")
        ended = datetime.now(timezone.utc)
        self._commit(batch, {"batch": batch, **seen.get, "started": started.isoformat(), "ended": ended.isoformat()})

    def _commit(self, batch: int, row: dict) -> None:
        filesystem, folder = open_filesystem(f"{self.path}/{_COMMITS}")
        filesystem.create_dir(folder, recursive=True)
        if batch and batch % COMPACT_EVERY == 0:
            # All before it in one file, named by the last of them; the single ones go when it stands.
            rows = [each for each in self._rows() if each["batch"] < batch]
            _put(filesystem, f"{folder}/{batch - 1:019d}.all", rows)
            for item in filesystem.get_file_info(pafs.FileSelector(folder)):
                name = posixpath.basename(item.path)
                if name.split(".")[0] < f"{batch - 1:019d}" or name == f"{batch - 1:019d}.one":
                    filesystem.delete_file(item.path)
        _put(filesystem, f"{folder}/{batch:019d}.one", [row])

    def _rows(self) -> list[dict]:
        filesystem, folder = open_filesystem(f"{self.path}/{_COMMITS}")
        found: dict[int, dict] = {}
        for item in sorted(filesystem.get_file_info(pafs.FileSelector(folder, allow_not_found=True)), key=lambda item: item.path):
            if item.path.endswith((".one", ".all")):
                with filesystem.open_input_stream(item.path) as source:
                    found.update({row["batch"]: row for row in json.loads(source.read())})
        return [found[batch] for batch in sorted(found)]

    def progress(self) -> DataFrame:
        """A row per committed batch: sizes and times."""
        rows = [(*(row[name] for name in ("batch", "input_rows", "accepted", "rejected")), *(datetime.fromisoformat(row[name]) for name in ("started", "ended"))) for row in self._rows()]
        return self.spark.createDataFrame(rows, PROGRESS_SCHEMA)

    def _read(self, kind: str, schema: str | StructType) -> DataFrame:
        batches = [row["batch"] for row in self._rows() if row[kind]]
        folders = [f"{self.path}/data/batch={batch}/kind={kind}" for batch in batches]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def accepted(self) -> DataFrame:
        return self._read("accepted", self.schema)

    def rejected(self) -> DataFrame:
        return self._read("rejected", "line string")


def _put(filesystem: pafs.FileSystem, path: str, rows: list[dict]) -> None:
    """Write a commit; it gets its name when it is complete."""
    atomic = filesystem.type_name in ATOMIC_STORES
    unfinished = path if atomic else f"{posixpath.dirname(path)}/_{posixpath.basename(path)}"
    with filesystem.open_output_stream(unfinished) as target:
        target.write(pa.py_buffer(json.dumps(rows).encode()))
    if not atomic:
        filesystem.move(unfinished, path)


def ingest_batches(
    records: DataFrame,
    schema: StructType,
    checkpoint: str,
    path: str,
    batch_seconds: int = DEFAULT_BATCH_SECONDS,
    available_now: bool = False,
    **csv_options: str,
) -> tuple[StreamingQuery, BatchStore]:
    """Start the ingest of the CSV lines in column ``value`` of a stream; gives the query and the store it fills."""
    if not checkpoint:
        raise ValueError("a streaming job needs a checkpoint folder")
    store = BatchStore(records.sparkSession, path, schema)

    def write(rows: DataFrame, batch: int) -> None:
        store.write(rows, batch, **csv_options)

    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{batch_seconds} seconds")
    return writer.start(), store

