"""Streaming ingest of CSV records into tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from filehaul.sources.records import (
    DEFAULT_BATCH_SECONDS,
    bad_records,
    check_schema,
    decode_csv,
    good_records,
)
from filehaul.storage import exists, qualified


@dataclass
class Ingest:
    """Running queries of an ingest job: accepted rows and, when asked for, rejected lines."""

    accepted: StreamingQuery
    rejected: StreamingQuery | None = None

    @property
    def queries(self) -> list[StreamingQuery]:
        return [query for query in (self.accepted, self.rejected) if query is not None]

    def wait(self) -> "Ingest":
        for query in self.queries:
            query.awaitTermination()
        return self

    def stop(self, timeout_seconds: float = 60.0) -> None:
        """Stop between micro-batches, or after the timeout; a cut batch is repeated at restart."""
        deadline = time.monotonic() + timeout_seconds
        for query in self.queries:
            while query.isActive and query.status["isTriggerActive"]:
                if time.monotonic() > deadline:
                    break
                time.sleep(0.1)
            query.stop()

    def metrics(self) -> dict:
        """Rows and times of the last micro-batch of accepted rows."""
        progress = self.accepted.lastProgress
        if progress is None:
            return {}
        return {
            "batch": progress["batchId"],
            "input_rows": progress["numInputRows"],
            "rows_per_second": progress["processedRowsPerSecond"],
            "milliseconds": dict(progress["durationMs"]),
        }


def ingest_stream(
    records: DataFrame,
    schema: StructType,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    sink: Callable[[DataFrame, int], None] | None = None,
    reject_path: str | None = None,
    batch_seconds: int = DEFAULT_BATCH_SECONDS,
    available_now: bool = False,
    **csv_options: str,
) -> Ingest:
    """Append CSV lines in column ``value`` of a stream to a Parquet ``path``, a ``table`` or a ``sink``.

    Without ``reject_path`` a bad line stops the query; with it, bad lines go
    there through a query of their own, which reads the source a second time.
    ``sink`` gets every micro-batch and its number, which a store outside Spark
    must use to ignore repeats. The checkpoint folder makes a restart go on
    where the last run ended.
    """
    spark = records.sparkSession
    if not checkpoint:
        raise ValueError("a streaming job needs a checkpoint folder")
    if sum(target is not None for target in (path, table, sink)) != 1:
        raise ValueError("give one of path, table and sink")
    existing = _existing(spark, path, table)
    if existing is not None:
        check_schema(existing, schema)
    decoded = decode_csv(records, schema, fail_fast=reject_path is None, **csv_options)
    rows = check_schema(good_records(decoded), schema)

    def start(stream: DataFrame, name: str, output) -> StreamingQuery:
        writer = stream.writeStream.option("checkpointLocation", f"{checkpoint}/{name}")
        if available_now:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=f"{batch_seconds} seconds")
        return output(writer)

    if path is not None:
        accepted = start(rows, "accepted", lambda writer: writer.format("parquet").start(path))
    elif table is not None:
        accepted = start(rows, "accepted", lambda writer: writer.format("parquet").toTable(table))
    else:
        accepted = start(rows, "accepted", lambda writer: writer.foreachBatch(sink).start())
    rejected = None
    if reject_path is not None:
        rejected = start(
            bad_records(decoded),
            "rejected",
            lambda writer: writer.format("parquet").start(reject_path),
        )
    return Ingest(accepted, rejected)


def _existing(spark: SparkSession, path: str | None, table: str | None) -> DataFrame | None:
    if table is not None:
        return spark.table(table) if spark.catalog.tableExists(table) else None
    if path is None or not exists(qualified(spark, path)):
        return None
    return spark.read.parquet(path)


def check_query(rows: DataFrame, limit: int = 1000) -> DataFrame:
    """A look at a target table."""
    return rows.limit(limit)
