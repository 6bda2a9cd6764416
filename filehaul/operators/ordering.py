"""Sort orders, and ranks over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filehaul.storage import new_shared_dir

# Rows per preview of a job.
PREVIEW_ROWS = 100

# monotonically_increasing_id() holds the row number of a partition in its low bits.
_ROW_BITS = 33


def by_size(files: DataFrame) -> DataFrame:
    """Biggest file first; equal sizes by path, so that the order is defined."""
    return files.orderBy(F.desc("fileSize"), "fullPath")


def by_path(files: DataFrame) -> DataFrame:
    return files.orderBy("fullPath")


def by_bytes(splits: DataFrame) -> DataFrame:
    """Splits with the fewest bytes first."""
    return splits.orderBy("total_bytes", "split_id")


def preview(rows: DataFrame) -> DataFrame:
    return rows.limit(PREVIEW_ROWS)


def with_rank(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Add ``rank``, counted from 0 over the whole table in the given order.

    A window without a partition would put the table into one task. Instead
    the rows are range-partitioned, sorted and written to the shared folder
    once with their place inside the partition; the places before a partition
    come from the partition sizes, one small row per partition.
    """
    spark = rows.sparkSession
    path = new_shared_dir(spark, "ranked")
    rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = (
        spark.read.parquet(path)
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .withColumn("_place", F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1))
    )
    sizes = {row["_part"]: row["count"] for row in placed.groupBy("_part").count().collect()}
    before, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    # One row per partition of the sort: bounded by the shuffle partitions.
    starts = spark.createDataFrame(offsets, "_part long, _before long")
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("rank", F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before")
    )
