"""Byte-balanced packing of files into splits."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from filehaul.operators.ordering import with_rank
from filehaul.options import (
    DEFAULT_GROUP_FILES,
    DEFAULT_MAX_TASKS,
    DEFAULT_TASK_BYTES,
    DEFAULT_TASK_FILES,
    check_max_split_size,
)

_TIE_COLUMNS = ("fullPath", "relativePath", "seg_no")
# Tasks for each core that a job has at least, where there are so many splits.
_WAVES = 4
# Ranks whose choices are one row where all files are packed as one group.
_BLOCK_RANKS = 4096


def n_splits(n_files: int, max_split_size: int | None = None) -> int:
    """Splits needed for a number of files; none for no files."""
    return -(-n_files // check_max_split_size(max_split_size))


def job_splits(
    n_files: int, total_bytes: int, max_split_size: int | None = None, task_bytes: int = DEFAULT_TASK_BYTES
) -> int:
    """Splits of a job: as many as the file cap asks for, and more when the files are big."""
    by_bytes = min(n_files, -(-total_bytes // task_bytes))
    return max(n_splits(n_files, max_split_size), by_bytes)


def job_tasks(
    spark: SparkSession,
    splits: int,
    n_files: int,
    total_bytes: int,
    max_tasks: int = DEFAULT_MAX_TASKS,
    task_bytes: int = DEFAULT_TASK_BYTES,
) -> int:
    """Tasks of a job: some for every core, and more as files and bytes ask for.

    A task costs a start, a result file and a commit, which is more than a split
    of small files is worth. With fewer tasks than splits a task takes several.
    """
    wanted = max(
        _WAVES * spark.sparkContext.defaultParallelism, -(-n_files // DEFAULT_TASK_FILES), -(-total_bytes // task_bytes)
    )
    return max(1, min(splits, max_tasks, wanted))


def split_count(files: DataFrame, max_split_size: int | None = None) -> DataFrame:
    """One row with ``files`` and ``splits``."""
    size = check_max_split_size(max_split_size)
    return files.agg(F.count("*").alias("files")).withColumn(
        "splits", F.ceil(F.col("files") / F.lit(size))
    )


def pack_files(
    files: DataFrame,
    max_split_size: int | None = None,
    size: str = "fileSize",
    ties: tuple[str, ...] | None = None,
    group_files: int | None = DEFAULT_GROUP_FILES,
    n_files: int | None = None,
    splits: int | None = None,
) -> DataFrame:
    """Add ``split_id``: at most ``max_split_size`` files per split, bytes spread evenly.

    One rule for every size: splits form groups of at most ``group_files`` files,
    packed in parallel; few files are one group. While no split is full, the
    heaviest is at most the mean of its group and one file.
    Ranks by size are dealt to the groups in turn, forward and back, so every
    group holds the same mix of sizes. Within a group the biggest file comes
    first and goes to the split with the fewest bytes that has room. A split
    that may hold ``group_files`` files or more is a group of its own, in which
    nothing is left to choose. The number of splits is always exact.
    Give ``n_files`` when it is known, to save the count, and ``splits`` for
    more splits than the cap asks for.

    With ``group_files`` None all files are one group however many they are.
    The choices then follow one another by the rule, so one task makes them, but
    it sees numbers of files by size only; see :func:`_in_one_order`.

    ``ties`` orders files of equal size. It must leave no two different rows
    equal, or a repeated task could deal them differently.
    """
    cap = check_max_split_size(max_split_size)
    if ties is None:
        ties = tuple(name for name in _TIE_COLUMNS if name in files.columns)
    n_files = files.count() if n_files is None else n_files
    total = max(n_splits(n_files, cap), splits or 0)
    if group_files is None:
        return _in_one_order(files, size, ties, cap, total)
    groups = max(1, -(-total // max(1, group_files // cap)))
    if groups == 1:
        # All ranks are dealt to the only group.
        keyed = files.withColumn("_group", F.lit(0))
    else:
        turn, place = F.floor(F.col("rank") / total), F.col("rank") % total
        dealt = F.when(turn % 2 == 0, place).otherwise(total - 1 - place)
        keyed = (
            with_rank(files, F.desc(size), *ties)
            .withColumn("_group", (dealt % groups).cast("int"))
            .drop("rank")
        )
    if groups == total:
        return keyed.withColumn("split_id", F.col("_group").cast("long")).drop("_group")
    output = keyed.drop("_group").schema.add("split_id", LongType())

    def pack_group(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table = table.sort_by([(size, "descending"), *((tie, "ascending") for tie in ties)])
        # Bytes, number inside the group; the number breaks ties.
        open_splits = [(0, number) for number in range(-(-(total - group) // groups))]
        filled = [0] * len(open_splits)
        chosen = []
        for file_bytes in table.column(size).to_pylist():
            used, number = heapq.heappop(open_splits)
            chosen.append(group + number * groups)
            filled[number] += 1
            if filled[number] < cap:
                heapq.heappush(open_splits, (used + file_bytes, number))
        table = table.drop_columns("_group").append_column("split_id", pa.array(chosen, pa.int64()))
        # Spark takes back only UTC, whatever the session's time zone is.
        return table.cast(pa.schema([_in_utc(column) for column in table.schema]))

    return keyed.groupBy("_group").applyInArrow(pack_group, output)


def _in_one_order(files: DataFrame, size: str, ties: tuple[str, ...], cap: int, total: int) -> DataFrame:
    """Greedy packing of all files as one group.

    A choice depends on the sizes before it alone. One task goes through the
    sizes with their numbers of files, biggest first, and holds a heap of the open
    splits; it gives the choices in blocks by rank, to which the ranked files are
    joined. No file's record is in it.
    """
    sizes = files.groupBy(F.col(size).alias("_size")).agg(F.count("*").alias("_files"))
    # An exchange into one partition, without a sort of the whole table: the rows are sizes, not files.
    ordered = sizes.repartition(1).sortWithinPartitions(F.desc("_size"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_splits = [(0, number) for number in range(total)]
        filled = [0] * total
        block, chosen = 0, []

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([chosen], pa.list_(pa.int64()))], names=["_block", "_chosen"]
            )

        for batch in batches:
            for file_bytes, many in zip(batch.column("_size").to_pylist(), batch.column("_files").to_pylist()):
                for _ in range(many):
                    used, number = heapq.heappop(open_splits)
                    chosen.append(number)
                    filled[number] += 1
                    if filled[number] < cap:
                        # A file without a size adds nothing.
                        heapq.heappush(open_splits, (used + (file_bytes or 0), number))
                    if len(chosen) == _BLOCK_RANKS:
                        yield ended()
                        block, chosen = block + 1, []
        if chosen:
            yield ended()

    choices = ordered.mapInArrow(choose, "_block long, _chosen array<long>")
    ranked = with_rank(files, F.desc(size), *ties).withColumn("_block", F.expr(f"rank div {_BLOCK_RANKS}"))
    place = (F.col("rank") % _BLOCK_RANKS).cast("int")
    return ranked.join(choices, "_block").withColumn("split_id", F.get("_chosen", place)).drop("_block", "_chosen", "rank")


def _in_utc(column: pa.Field) -> pa.Field:
    if pa.types.is_timestamp(column.type) and column.type.tz is not None:
        return column.with_type(pa.timestamp("us", tz="UTC"))
    return column


def split_totals(packed: DataFrame, size: str = "fileSize") -> DataFrame:
    """Files and bytes per split."""
    return packed.groupBy("split_id").agg(
        F.count("*").alias("files"), F.sum(size).alias("total_bytes")
    )


def one_task_per_split(packed: DataFrame, splits: int, max_tasks: int = DEFAULT_MAX_TASKS) -> DataFrame:
    """Place every split in a partition of its own; only the file records move."""
    tasks = max(1, min(splits, max_tasks))
    return packed.repartitionById(tasks, (F.col("split_id") % tasks).cast(IntegerType()))


def balanced_tasks(
    files: DataFrame, size: str = "fileSize", max_split_size: int | None = None, task_bytes: int = DEFAULT_TASK_BYTES
) -> DataFrame:
    """Pack a table of files or segments and place its splits, as many to a task as :func:`job_tasks` says."""
    count, total = files.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    splits = job_splits(count, total, max_split_size, task_bytes)
    packed = pack_files(files, max_split_size, size, n_files=count, splits=splits)
    return one_task_per_split(packed, splits, job_tasks(files.sparkSession, splits, count, total, task_bytes=task_bytes))


def split_records(packed: DataFrame, split_id: int | Column) -> DataFrame:
    """The records of one split."""
    return packed.where(F.col("split_id") == split_id)
