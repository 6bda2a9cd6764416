"""A data source whose partitions are the byte-balanced splits of a file list.

``plan_splits`` lists and packs on the cluster and writes the split plan to a
folder: the records of each task's splits, and an index with what the records
of a task have in common. The source ``filehaul`` reads such a folder. Every
task of the plan is one partition of the table. Filters on path, size, time and
split are pushed into it: a partition whose index rules them out is not made,
and the others read only the columns and rows asked for from Parquet.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from filehaul.operators import packing
from filehaul.options import DEFAULT_MAX_TASKS, check_bytes, check_max_split_size
from filehaul.sources.listing import RECORD_COLUMNS, list_files
from filehaul.storage import new_shared_dir, open_filesystem, qualified

FORMAT = "filehaul"
SPLIT_SCHEMA = (
    "split_id long, fileName string, fullPath string, relativePath string, hostURI string, "
    "fileSize long, modificationTime timestamp, sourceURI string"
)
_COLUMNS = [name.split()[0] for name in SPLIT_SCHEMA.split(", ")]
# Columns whose filters are pushed down; the index holds their range in each task.
PUSHED = ("split_id", "fullPath", "fileSize", "modificationTime")
_COMPARED = {
    EqualTo: lambda column, value: column == value,
    GreaterThan: lambda column, value: column > value,
    GreaterThanOrEqual: lambda column, value: column >= value,
    LessThan: lambda column, value: column < value,
    LessThanOrEqual: lambda column, value: column <= value,
}


def plan_splits(
    files: DataFrame,
    path: str | None = None,
    max_split_size: int | None = None,
    max_tasks: int | str | None = None,
    **packing_options,
) -> str:
    """Pack a listing table into splits and write the plan to a new folder; gives its path.

    A task gets one split, or several when there are more than ``max_tasks``.
    """
    spark = files.sparkSession
    path = qualified(spark, path) if path else new_shared_dir(spark, "splits")
    # Nothing is read here but the records, so bytes ask for no tasks.
    n_files = files.count()
    splits = packing.n_splits(n_files, check_max_split_size(max_split_size))
    tasks = packing.job_tasks(spark, splits, n_files, 0, check_bytes("max_tasks", max_tasks, DEFAULT_MAX_TASKS))
    if "sourceURI" not in files.columns:
        files = files.withColumn("sourceURI", F.lit(None).cast("string"))
    records = files.select(*RECORD_COLUMNS, "fileSize", "modificationTime", "sourceURI")
    packed = packing.pack_files(records, max_split_size, n_files=n_files, **packing_options)
    placed = packing.one_task_per_split(packed, splits, tasks).withColumn("task", F.col("split_id") % tasks)
    # Times are stored as microseconds, whatever the session's format of times in Parquet is.
    placed = placed.withColumn("modificationTime", F.unix_micros("modificationTime"))
    placed.select(*_COLUMNS, "task").sortWithinPartitions("task", "split_id", "fullPath").write.partitionBy("task").parquet(f"{path}/records")
    stored = spark.read.schema(SPLIT_SCHEMA.replace("timestamp", "long") + ", task long").parquet(f"{path}/records")
    ranges = [F.struct(F.min(name).alias("low"), F.max(name).alias("high")).alias(name) for name in PUSHED]
    # One row per task, of which there are max_tasks at most.
    stored.groupBy("task").agg(*ranges).coalesce(1).write.parquet(f"{path}/index")
    return path


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """The planned records; a partition for each task of the plan."""
    register(spark)
    return spark.read.format(FORMAT).load(path)


def read_file_splits(
    spark: SparkSession, source_paths: str, scheme: str = "file", recursive: bool = True, max_split_size: int | None = None
) -> DataFrame:
    """List the roots, plan the splits and read them."""
    return read_splits(spark, plan_splits(list_files(spark, source_paths, scheme, recursive), max_split_size=max_split_size))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it push filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FileSplitSource)


class FileSplitSource(DataSource):
    """``spark.read.format("filehaul").load(folder)`` for a folder of :func:`plan_splits`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SPLIT_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        if not self.options.get("path"):
            raise ValueError("the folder of a split plan is needed")
        return FileSplitReader(self.options["path"])


class TaskPartition(InputPartition):
    def __init__(self, task: int):
        super().__init__(task)
        self.task = task


class FileSplitReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        # (column, kind of filter, value), all of which hold.
        self.filters: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for filter_ in filters:
            column = filter_.attribute[0] if len(getattr(filter_, "attribute", ())) == 1 else None
            kind = type(filter_)
            known = kind in _COMPARED or kind in (In, IsNotNull) or kind is StringStartsWith and column == "fullPath"
            if column in PUSHED and known:
                self.filters.append((column, kind, getattr(filter_, "value", None)))
            else:
                yield filter_

    def partitions(self) -> list[InputPartition]:
        filesystem, path = open_filesystem(f"{self.path}/index")
        index = pads.dataset(path, filesystem=filesystem, format="parquet").to_table().to_pylist()
        return [TaskPartition(row["task"]) for row in sorted(index, key=lambda row: row["task"]) if self._possible(row)]

    def _possible(self, row: dict) -> bool:
        """Whether the ranges of a task leave room for a row that passes all filters."""
        for column, kind, value in self.filters:
            low, high = row[column]["low"], row[column]["high"]
            if low is None:
                return False
            if kind is In:
                fits = any(low <= _stored(one) <= high for one in value if one is not None)
            elif kind is EqualTo:
                fits = low <= _stored(value) <= high
            elif kind in (GreaterThan, GreaterThanOrEqual):
                fits = _COMPARED[kind](high, _stored(value))
            elif kind in (LessThan, LessThanOrEqual):
                fits = _COMPARED[kind](low, _stored(value))
            elif kind is StringStartsWith:
                fits = low[: len(value)] <= value <= high[: len(value)]
            else:
                fits = True
            if not fits:
                return False
        return True

    def _condition(self) -> pc.Expression | None:
        condition = None
        for column, kind, value in self.filters:
            field = pc.field(column)
            if kind is In:
                one = field.isin([_stored(each) for each in value if each is not None])
            elif kind is StringStartsWith:
                one = pc.starts_with(field, value)
            elif kind is IsNotNull:
                one = field.is_valid()
            else:
                one = _COMPARED[kind](field, _stored(value))
            condition = one if condition is None else condition & one
        return condition

    def read(self, partition: TaskPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark gives when there are no partitions
            return
        filesystem, path = open_filesystem(f"{self.path}/records/task={partition.task}")
        found = filesystem.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        names = [item.path for item in found if item.is_file and not posixpath.basename(item.path).startswith(("_", "."))]
        if names:
            records = pads.dataset(sorted(names), filesystem=filesystem, format="parquet")
            for batch in records.to_batches(columns=_COLUMNS, filter=self._condition()):
                if batch.num_rows:
                    place = batch.schema.get_field_index("modificationTime")
                    time = batch.column(place).cast(pa.timestamp("us", tz="UTC"))
                    yield batch.set_column(place, pa.field("modificationTime", time.type), time)


def _stored(value):
    """A value of a filter as the plan stores it."""
    if not isinstance(value, datetime):
        return value
    value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return (value - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
