from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from filehaul.functions import paths
from filehaul.options import ExportOptions, check_bytes, check_max_split_size, check_scheme
from filehaul.sources.listing import describe_files, emit_records


def value(spark, column, **columns):
    row = spark.sql("SELECT 1 AS one").select(
        *(F.lit(content).alias(name) for name, content in columns.items())
    )
    return row.select(column.alias("value")).first()["value"]


@pytest.mark.parametrize(
    "uri, root, name, path, relative, host",
    [
        ("hdfs://store-7/in/2020/may/r.csv", "/in/2020/may",
         "r.csv", "/in/2020/may/r.csv", "may/r.csv", "hdfs://store-7/"),
        ("hdfs://store-7/in/2020/may/r.csv", "/in/2020/",
         "r.csv", "/in/2020/may/r.csv", "may/r.csv", "hdfs://store-7/"),
        ("hdfs://store-7/", "/", "", "/", "", "hdfs://store-7/"),
        ("hdfs://store-7/top", "/", "top", "/top", "top", "hdfs://store-7/"),
        ("http://pages.test/docs/en/start.html", "/docs/en",
         "start.html", "/docs/en/start.html", "en/start.html", "http://pages.test/"),
        ("file:/a b/c d.txt", "/a b/", "c d.txt", "/a b/c d.txt", "c d.txt", "file:/"),
        ("hdfs://user@node:8020/x//y/", "/x", "y", "/x/y", "x/y", "hdfs://node/"),
        ("s3a://under_score/x", "/", "x", "/x", "x", "s3a:/"),
        ("/no/scheme", "/no/", "scheme", "/no/scheme", "scheme", "/"),
    ],
)
def test_path_columns(spark, uri, root, name, path, relative, host):
    entries = spark.createDataFrame(
        [(root, uri, 1, datetime(2024, 1, 1))],
        "root string, uri string, fileSize long, modificationTime timestamp",
    )
    row = emit_records(describe_files(entries)).first()
    assert tuple(row) == (name, path, relative, host)


def test_wrong_root_is_an_error(spark):
    with pytest.raises(PySparkException, match="not a prefix"):
        value(spark, paths.relative_path("path", "/other"), path="/a/b")


def test_extra_columns(spark):
    entries = spark.createDataFrame(
        [("/", "file:/a", 1, datetime(2024, 1, 1))],
        "root string, uri string, fileSize long, modificationTime timestamp",
    )
    files = describe_files(entries, {"region": F.lit("x")})
    assert emit_records(files, ["region"]).columns[-1] == "region"
    assert files.first()["region"] == "x"


@pytest.mark.parametrize(
    "compress, encrypt, name, kind",
    [
        (False, False, "out/d/a.csv", "application/octet-stream"),
        (True, False, "out/d/a.csv.zip", "application/zip"),
        (False, True, "out/d/a.csv.pgp", "application/pgp-encrypted"),
        (True, True, "out/d/a.csv.zip.pgp", "application/pgp-encrypted"),
    ],
)
def test_target_names(spark, compress, encrypt, name, kind):
    assert value(spark, paths.target_name("out/", "rel", compress, encrypt), rel="d/a.csv") == name
    assert value(spark, paths.content_type(compress, encrypt)) == kind


def test_source_uri(spark):
    assert value(spark, paths.source_uri("h", "p"), h="hdfs://n/", p="/a/b") == "hdfs://n///a/b"


@pytest.mark.parametrize(
    "path, bucket, name",
    [
        ("gs://bucket/name", "bucket", "name"),
        ("/bucket/name", "bucket", "name"),
        ("bucket/name", "bucket", "name"),
        ("bucket", "bucket", ""),
        ("gs://b-1_x.y/a/b/", "b-1_x.y", "a/b/"),
        ("bucket//x", "bucket", "/x"),
    ],
)
def test_bucket_and_name(spark, path, bucket, name):
    assert value(spark, paths.bucket("p"), p=path) == bucket
    assert value(spark, paths.object_name("p"), p=path) == name


def test_split_target(spark):
    assert paths.split_target(spark, "gs://bucket/a/b") == ("bucket", "a/b")


@pytest.mark.parametrize("path", ["", "/", "//x", "buck et/x", "b*"])
def test_bad_buckets(spark, path):
    with pytest.raises(PySparkException, match="bucket|empty"):
        value(spark, paths.bucket("p"), p=path)


@pytest.mark.parametrize(
    "name, suffix, compat, prefix",
    [
        ("out", None, False, "out/"),
        ("out", None, True, "out"),
        ("", None, False, ""),
        ("out", "yyyy-MM-dd-HH-mm", False, "out/2015-01-01-20-42/"),
        ("out/", "yyyy", True, "out/2015/"),
        ("", "yyyy", True, "/2015/"),
        ("", "yyyy", False, "2015/"),
    ],
)
def test_destination_prefix(spark, name, suffix, compat, prefix):
    column = paths.destination_prefix(name, datetime(2015, 1, 1, 20, 42), suffix, compat)
    assert value(spark, column) == prefix


def test_option_checks(spark):
    assert check_max_split_size(None) == 128
    assert check_bytes("chunk_bytes", "4096", 1) == 4096
    assert check_bytes("chunk_bytes", "", 1024) == 1024
    for wrong in (0, -1, "7", 1.5, True):
        with pytest.raises(ValueError):
            check_max_split_size(wrong)
    for wrong in ("1e3", "-5", 0, 2.5, "0"):
        with pytest.raises(ValueError):
            check_bytes("chunk_bytes", wrong, 1)
    with pytest.raises(ValueError):
        check_scheme("ftp")
    assert check_scheme("hdfs") == "hdfs"


@pytest.mark.parametrize(
    "options",
    [
        {"encryption": "PGP"},
        {"compression": "RAR"},
        {"encryption": "ROT13"},
        {"suffix": "no pattern {"},
        {"chunk_bytes": "many"},
        {"max_split_size": 0},
        {"on_error": "ignore"},
    ],
)
def test_bad_export_options(spark, options):
    with pytest.raises(ValueError):
        ExportOptions(**options).checked(spark)


def test_empty_options_are_off(spark):
    options = ExportOptions(compression="", encryption=None).checked(spark)
    assert not options.compress and not options.encrypt


def test_random_paths(spark):
    """Any text that can be a path, against the rules written in plain Python."""
    import random
    import re

    source = random.Random(7)
    letters = "ab.-_ %?#:@+é日\n'\"\\$"
    rows = []
    for _ in range(500):
        parts = ["".join(source.choice(letters) for _ in range(source.randint(1, 6)))
                 for _ in range(source.randint(1, 5))]
        path = "/" + "/".join(parts)
        depth = source.randint(0, len(parts) - 1)
        root = "/" + "/".join(parts[:depth]) + source.choice(["", "/"] if depth else [""])
        messy = path.replace("/", "/" * source.randint(1, 3)) + "/" * source.randint(0, 1)
        rows.append((path, root, source.choice(["file://", "hdfs://node:8020", "hdfs://u@10.0.0.1"]) + messy))
    table = spark.createDataFrame(rows, "path string, root string, uri string")
    found = table.select(
        "path", "root", "uri",
        paths.full_path("uri").alias("full"),
        paths.file_name("path").alias("name"),
        paths.relative_path("path", F.col("root")).alias("relative"),
        paths.host_uri("uri").alias("host"),
    ).collect()
    for row in found:
        assert row["full"] == row["path"]
        assert row["name"] == row["path"].rpartition("/")[2]
        assert row["relative"] == row["path"][row["root"].rfind("/") + 1 :]
        host = re.match(r"hdfs://(?:[^@/]*@)?([^:/]*)", row["uri"])
        assert row["host"] == (f"hdfs://{host.group(1)}/" if host else "file:/")
