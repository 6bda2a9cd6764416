import os
import shutil

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from filehaul.sources.records import CUSTOMER_SCHEMA, text_records
from filehaul.streaming import batches

GOOD = "'c-{}','g-4-z',10,true,'9.50 EUR','http://pic.test/7',3,'Ada','Berg','Mill and Sons'"
BAD = ["'id','guid',3", GOOD.format(1).replace("10", "ten"), ""]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for number in range(6):
        (tmp_path / "in" / f"{number}.csv").write_text("\n".join([GOOD.format(number), GOOD.format(number + 100), BAD[number % 3]]) + "\n")
    return tmp_path


def run(spark, folder, limit=2):
    source = text_records(spark, f"{folder}/in", max_files_per_trigger=limit)
    query, store = batches.ingest_batches(source, CUSTOMER_SCHEMA, f"{folder}/checkpoint", f"{folder}/store", available_now=True, quote="'")
    query.awaitTermination()
    return store


def state(store):
    return (
        sorted(row["_id"] for row in store.accepted().collect()), sorted(row["line"] for row in store.rejected().collect()),
        [(row["batch"], row["input_rows"], row["accepted"], row["rejected"]) for row in store.progress().orderBy("batch").collect()],
    )


def test_one_pass_and_restart(spark, folder):
    store = run(spark, folder)
    ids, lines, progress = state(store)
    assert ids == sorted([f"c-{n}" for n in range(6)] + [f"c-{n + 100}" for n in range(6)])
    assert lines == sorted(BAD * 2)
    assert progress == [(0, 6, 4, 2), (1, 6, 4, 2), (2, 6, 4, 2)]
    (folder / "in" / "9.csv").write_text(f"{GOOD.format(9)}\n")
    again = state(run(spark, folder))
    assert again[2] == [*progress, (3, 1, 1, 0)] and len(again[0]) == 13
    times = store.progress().orderBy("batch").collect()
    assert all(a["started"] <= a["ended"] <= b["started"] for a, b in zip(times, times[1:]))


def test_the_limit_holds_only_with_it(spark, folder):
    assert [row[1] for row in state(run(spark, folder, limit=None))[2]] == [18]


def test_a_repeated_batch_changes_nothing(spark, folder):
    """As after a driver that was lost behind the write and before Spark's own commit of the batch."""
    store = run(spark, folder)
    before = state(store)
    os.remove(f"{folder}/checkpoint/commits/2")
    crc = f"{folder}/checkpoint/commits/.2.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert state(run(spark, folder)) == before


def test_an_unfinished_batch_is_not_seen(spark, folder):
    store = run(spark, folder)
    whole = state(store)
    shutil.copytree(f"{folder}/store/data/batch=1", f"{folder}/store/data/batch=7")
    assert state(store) == whole


def test_commits_are_put_together(spark, folder, monkeypatch):
    monkeypatch.setattr(batches, "COMPACT_EVERY", 2)
    store = run(spark, folder, limit=1)
    assert [row[0] for row in state(store)[2]] == list(range(6))
    assert len([name for name in os.listdir(f"{folder}/store/commits") if not name.startswith(".")]) == 3
    assert len(state(store)[0]) == 12


def test_options(spark, folder):
    with pytest.raises(ValueError, match="own"):
        batches.BatchStore(spark, str(folder), StructType([StructField("Line", StringType())]))
    store = batches.BatchStore(spark, f"{folder}/none", CUSTOMER_SCHEMA)
    assert store.accepted().count() == store.rejected().count() == store.progress().count() == 0
    with pytest.raises(ValueError, match="checkpoint"):
        batches.ingest_batches(text_records(spark, f"{folder}/in"), CUSTOMER_SCHEMA, "", f"{folder}/store")
