import pytest

from filehaul.llm.token_rollup import TokenRollup

SCHEMA = "doc_id long, source string, lang string, tokenizer string, tokens long"


@pytest.fixture
def rollup(spark, tmp_path):
    return TokenRollup(spark, f"file:{tmp_path}/rollup")


def state(rollup):
    return sorted(tuple(row) for row in rollup.totals().fillna("-").collect())


def test_signed_changes(spark, rollup):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as sign", "2 as batch", "'x' as new")
    first = make([(1, "a", "en", "t1", 10), (2, "a", "en", "t1", 5), (3, None, "de", "t1", 0), (1, "a", "en", "t2", 4)])
    assert rollup.apply(1, first)
    assert state(rollup) == [("-", "de", "t1", 1, 0), ("a", "en", "t1", 2, 15), ("a", "en", "t2", 1, 4)]
    # A revised count with another source, a deletion, one of what is not there, and one row twice.
    second = make([(1, "b", "en", "t1", 7), (1, "b", "en", "t1", 7), (2, None, None, "t1", None), (9, "a", "en", "t1", None)])
    assert rollup.apply(2, second)
    expected = [("-", "de", "t1", 1, 0), ("a", "en", "t2", 1, 4), ("b", "en", "t1", 1, 7)]
    assert state(rollup) == expected
    # Again, and in the wrong order.
    assert not rollup.apply(2, second) and not rollup.apply(1, first)
    assert state(rollup) == expected
    with pytest.raises(ValueError, match="other content"):
        rollup.apply(1, second)
    with pytest.raises(ValueError, match="too late"):
        rollup.apply(0, second)
    # A document comes back; null ids and tokenizers are rejected; nothing changes with an empty batch.
    assert rollup.apply(3, make([(2, "a", "en", "t1", 1), (None, "a", "en", "t1", 8), (4, "a", "en", None, 8)]))
    assert rollup.apply(4, make([]))
    assert state(rollup) == [*expected[:1], ("a", "en", "t1", 1, 1), *expected[1:]]
    assert {row["batch"]: row["n_rejected"] for row in rollup.commits().collect()} == {1: 0, 2: 0, 3: 2, 4: 0}


def test_a_batch_that_was_not_committed_does_not_count(spark, rollup):
    first = spark.createDataFrame([(1, "a", "en", "t", 3)], SCHEMA)
    rollup.apply(1, first)
    # As a job leaves it that died before its commit.
    for name in ("ledger", "totals"):
        spark.read.parquet(f"{rollup.root}/{name}/batch=1").write.parquet(f"{rollup.root}/{name}/batch=2")
    assert state(rollup) == [("a", "en", "t", 1, 3)]
    rollup.apply(2, spark.createDataFrame([(1, "a", "en", "t", 5)], SCHEMA))
    assert state(rollup) == [("a", "en", "t", 1, 5)]


def test_empty(rollup):
    assert rollup.totals().count() == 0
