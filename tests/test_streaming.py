import pytest

from filehaul.sources.records import (
    CUSTOMER_SCHEMA,
    check_schema,
    decode_csv,
    kafka_options,
    kafka_records,
    text_records,
)
from filehaul.streaming.ingest import check_query, ingest_stream

GOOD = "'c-77','g-4-z',10,true,'9.50 EUR','http://pic.test/7',3,'Ada','Berg','Mill and Sons'"
WRONG_TYPE = GOOD.replace("10", "ten")
TOO_FEW = "'id','guid',3"
ROW = ("c-77", "g-4-z", 10, True, "9.50 EUR", "http://pic.test/7", 3, "Ada", "Berg", "Mill and Sons")


def lines(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def test_decode(spark):
    decoded = decode_csv(lines(spark, GOOD), CUSTOMER_SCHEMA, quote="'").first()
    assert tuple(decoded)[:-1] == ROW and decoded["_corrupt_record"] is None
    kept = decode_csv(lines(spark, GOOD), CUSTOMER_SCHEMA).first()
    assert kept["_id"] == "'c-77'" and kept["balance"] == "'9.50 EUR'"


def test_bad_lines(spark):
    bad = [WRONG_TYPE, TOO_FEW, "", None]
    rows = decode_csv(lines(spark, *bad), CUSTOMER_SCHEMA, quote="'").collect()
    assert [row["_corrupt_record"] for row in rows] == [WRONG_TYPE, TOO_FEW, "", ""]
    for line in bad:
        with pytest.raises(Exception, match="MALFORMED|empty record"):
            decode_csv(lines(spark, line), CUSTOMER_SCHEMA, fail_fast=True, quote="'").collect()


def start(spark, folder, **options):
    source = text_records(spark, f"{folder}/in", max_files_per_trigger=1)
    targets = {"path": f"{folder}/table"} | options
    if "table" in options or "sink" in options:
        targets.pop("path")
    return ingest_stream(
        source, CUSTOMER_SCHEMA, f"{folder}/checkpoint", available_now=True, quote="'", **targets
    )


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text(f"{GOOD}\n")
    return tmp_path


def test_restart_goes_on(spark, folder):
    job = start(spark, folder).wait()
    assert job.metrics()["input_rows"] == 1
    table = str(folder / "table")
    assert tuple(spark.read.parquet(table).first()) == ROW
    start(spark, folder).wait()
    assert spark.read.parquet(table).count() == 1
    (folder / "in" / "2.csv").write_text(f"{GOOD}\n{GOOD}\n")
    start(spark, folder).wait()
    assert spark.read.parquet(table).count() == 3
    assert check_query(spark.read.parquet(table), 2).count() == 2


def test_rejects(spark, folder):
    (folder / "in" / "2.csv").write_text(f"{WRONG_TYPE}\n{GOOD}\n{TOO_FEW}\n")
    start(spark, folder, reject_path=str(folder / "rejects")).wait()
    assert spark.read.parquet(str(folder / "table")).count() == 2
    rejected = spark.read.parquet(str(folder / "rejects")).collect()
    assert sorted(row["value"] for row in rejected) == sorted([WRONG_TYPE, TOO_FEW])


def test_bad_line_stops_the_strict_job(spark, folder):
    (folder / "in" / "2.csv").write_text(f"{TOO_FEW}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        start(spark, folder).wait()


def test_one_file_per_batch_and_sink(spark, folder):
    (folder / "in" / "2.csv").write_text(f"{GOOD}\n")
    seen = {}
    start(spark, folder, sink=lambda rows, number: seen.__setitem__(number, rows.count())).wait()
    assert seen == {0: 1, 1: 1}


def test_table_target(spark, folder):
    spark.sql("DROP TABLE IF EXISTS customer_stream")
    start(spark, folder, table="customer_stream").wait()
    assert tuple(spark.table("customer_stream").first()) == ROW
    spark.sql("DROP TABLE customer_stream")


def test_schema_is_enforced(spark, folder):
    spark.range(1).write.parquet(str(folder / "table"))
    with pytest.raises(ValueError, match="schema"):
        start(spark, folder)
    with pytest.raises(ValueError):
        check_schema(spark.range(1), CUSTOMER_SCHEMA)


def test_options(spark, folder):
    with pytest.raises(ValueError, match="checkpoint"):
        ingest_stream(text_records(spark, str(folder / "in")), CUSTOMER_SCHEMA, "", path="x")
    with pytest.raises(ValueError, match="one of"):
        ingest_stream(text_records(spark, str(folder / "in")), CUSTOMER_SCHEMA, "c")
    assert kafka_options("host:9092", "topic", 1000, 3) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "topic",
        "maxOffsetsPerTrigger": "30000"}
    with pytest.raises(ValueError):
        kafka_options("host:9092", "topic", 1000)
    with pytest.raises(Exception, match="kafka"):
        kafka_records(spark, "host:9092", "topic")


def test_stop_between_batches(spark, folder):
    job = ingest_stream(
        text_records(spark, str(folder / "in")), CUSTOMER_SCHEMA, str(folder / "checkpoint"),
        path=str(folder / "table"), batch_seconds=1, quote="'",
    )
    job.accepted.processAllAvailable()
    job.stop()
    assert not job.accepted.isActive
    assert spark.read.parquet(str(folder / "table")).count() == 1
