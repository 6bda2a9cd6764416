from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from filehaul.storage import exists, new_shared_dir, open_filesystem, store_once


def test_cluster_needs_a_shared_folder():
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://node:7077"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_shared_dir(session, "plan")


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = new_shared_dir(spark, "plan"), new_shared_dir(spark, "plan")
    assert first != second and "://" in first or first.startswith("file:/")
    assert configured is None or configured.split(":")[-1] in first


def test_store_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows, measures = store_once(
        spark.range(10).mapInArrow(count, "id long"), "test", {"top": F.max("id")}
    )
    assert measures == {"top": 9}
    assert rows.count() == rows.count() == 10
    assert calls.value == 10
    empty, measures = store_once(spark.range(0), "test", {"rows": F.count("*")})
    assert empty.count() == 0 and measures == {"rows": 0}


@pytest.mark.parametrize("uri, path", [
    ("/a/b", "/a/b"), ("file:/a/b", "/a/b"), ("file:////a//b c", "/a/b c"), ("file:///x", "/x"),
])
def test_local_uris(uri, path):
    filesystem, found = open_filesystem(uri)
    assert filesystem.type_name == "local" and found == path


def test_exists(tmp_path):
    assert exists(f"file:{tmp_path}") and not exists(f"{tmp_path}/nothing")
