from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from filehaul.operators import packing
from filehaul.sources import listing, splits


@pytest.fixture
def files(spark):
    rows = [(f"/data/{number % 7}/{number:04d}", number * 10) for number in range(500)]
    entries = spark.createDataFrame(rows, "path string, fileSize long").select(
        F.lit("/data").alias("root"), F.concat(F.lit("hdfs://host:1"), "path").alias("uri"), "fileSize",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("fileSize")).alias("modificationTime"),
    )
    return listing.describe_files(entries)


def partitions(table):
    return [sorted(row["fullPath"] for row in part) for part in table.rdd.glom().collect()]


def test_partitions_are_the_splits(spark, files):
    path = splits.plan_splits(files, max_split_size=40)
    table = splits.read_splits(spark, path)
    packed = packing.pack_files(files.drop("isDir"), 40)
    expected = {}
    for row in packed.collect():
        expected.setdefault(row["split_id"], []).append(row["fullPath"])
    assert table.rdd.getNumPartitions() == 13
    assert sorted(partitions(table)) == sorted(map(sorted, expected.values()))
    columns = ["split_id", "fullPath", "fileSize", "modificationTime", "hostURI", "sourceURI"]
    assert sorted(map(tuple, table.select(*columns).collect())) == sorted(map(tuple, packed.select(*columns).collect()))
    loaded = spark.read.format("filehaul").load(path)
    assert loaded.columns == table.columns and loaded.count() == 500


def test_more_splits_than_tasks(spark, files):
    table = splits.read_splits(spark, splits.plan_splits(files, max_split_size=10, max_tasks=8))
    assert table.rdd.getNumPartitions() == 8
    assert table.select("split_id").distinct().count() == 50 and table.count() == 500


@pytest.mark.parametrize(
    "condition",
    [
        "fileSize >= 4900", "fileSize > 4900 and fileSize < 4950", "fullPath = '/data/3/0010'", "fullPath like '/data/3/%'", "split_id in (1, 4)",
        "modificationTime < timestamp'2023-11-14 22:20:00'", "fileSize = -1", "fileName like '%7'", "fileSize <= 30 or fullPath = '/data/2/0009'", "fileSize is null",
    ],
)
def test_filters(spark, files, condition):
    table = splits.read_splits(spark, splits.plan_splits(files, max_split_size=40))
    found = {row["fullPath"] for row in table.where(condition).collect()}
    packed = packing.pack_files(files.drop("isDir"), 40)
    assert found == {row["fullPath"] for row in packed.where(condition).collect()}


def test_filters_reach_the_source(spark, files):
    """Splits that cannot match are not read, and Spark has nothing left to filter."""
    table = splits.read_splits(spark, splits.plan_splits(files, max_split_size=40))
    one = table.where("split_id = 3")
    assert one.rdd.getNumPartitions() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.replace("filterPushdown", "") or "split_id" not in plan.split("Filter (")[-1]
    reader = splits.FileSplitReader("/none")
    left = list(reader.pushFilters([splits.GreaterThan(("fileSize",), 5), splits.EqualTo(("fileName",), "a"), splits.StringStartsWith(("hostURI",), "h")]))
    assert [f.attribute for f in left] == [("fileName",), ("hostURI",)]


def test_real_tree_and_odd_plans(spark, make_tree, files):
    root = make_tree({f"{n}/x y.txt": b"a" * n for n in range(9)})
    table = splits.read_file_splits(spark, root + "/", max_split_size=4)
    assert table.rdd.getNumPartitions() == 3
    assert table.agg(F.sum("fileSize")).first()[0] == 36
    newest = table.agg(F.max("modificationTime")).first()[0]
    assert table.where(F.col("modificationTime") == F.lit(newest)).count() >= 1
    empty = splits.read_splits(spark, splits.plan_splits(files.limit(0)))
    assert empty.count() == 0 and empty.where("fileSize > 3").count() == 0
    nulls = files.limit(3).withColumn("modificationTime", F.lit(None).cast("timestamp"))
    table = splits.read_splits(spark, splits.plan_splits(nulls))
    assert table.count() == 3 and table.where(F.col("modificationTime") > F.lit(datetime(2000, 1, 1, tzinfo=timezone.utc))).count() == 0
    with pytest.raises(Exception, match="split plan"):
        spark.read.format("filehaul").load().count()


def test_small_splits_share_tasks(spark, files):
    table = splits.read_splits(spark, splits.plan_splits(files, max_split_size=5))
    assert table.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    placed = table.select("split_id", F.spark_partition_id().alias("part")).distinct()
    assert placed.count() == placed.select("split_id").distinct().count() == 100 and table.count() == 500
