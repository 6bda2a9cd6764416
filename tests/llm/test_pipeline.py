import ctypes
import os
import uuid
from numbers import Number
from pathlib import Path

import duckdb
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import __spark_entry__ as registry
import corpus_pipeline
from filehaul import storage
from filehaul.llm import byte_bpe, decontaminate, quality
from filehaul.llm import queries as llm
from filehaul.llm.common import slices
from filehaul.llm.graph import connected_components

from .conftest import DATA
from .test_near_copies import plain as near_copies
from .test_substrings import plain as repeats_of


def test_stages_against_plain_versions(spark, documents):
    """Every stage against what the plain versions make of the same input."""
    docs = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, DATA)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == documents.columns
        docs, _ = corpus_pipeline.store_once(result, "test")
        kept[name] = docs.toPandas().set_index("doc_id")
    first, second, third, fourth, last = kept.values()
    model = quality.fit_line_model(documents, spark.read.parquet(f"{DATA}/labels.parquet"))
    judged = quality.judge_quality(documents, model).toPandas().set_index("doc_id")
    assert sorted(first.index) == sorted(judged.index[judged.kept])
    texts = first.sort_index().text
    assert sorted(second.index) == [texts.index[root] for root in near_copies(list(texts))]
    removed = dict(zip(second.index, repeats_of([t.encode() for t in second.text], corpus_pipeline.REPEAT_BYTES)))
    for number, (_, gone, _, _) in removed.items():
        left = len(third.text.get(number, "").encode())
        # Characters cut in two stay whole, and texts that are white space go.
        assert left == 0 or gone - 6 <= len(second.text[number].encode()) - left <= gone
    items = [row["text"] for row in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(fourth.index) <= set(third.index)
    for number in fourth.index:
        assert not any(item in fourth.text[number] for item in items if len(decontaminate.words_of(item.encode())) >= 8)
    ranks = byte_bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert sorted(last.index) == sorted(fourth.index)
    for number, row in last.iterrows():
        assert row.decoded == fourth.text[number]
        assert row.n_tokens == len(reference.encode_ordinary(fourth.text[number]))


def test_odd_documents(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "ok " * 30, None, "s", 90), (2, "ok " * 30, None, "s", 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, DATA).count() <= 4


def test_near_copies_by_similarity(spark, documents):
    """The second stage against the similarity of all pairs of its input."""
    rows = documents.toPandas().sort_values("doc_id")
    kept = corpus_pipeline.drop_near_duplicates(spark, documents, DATA).toPandas()
    assert sorted(kept.doc_id) == [rows.doc_id.iloc[root] for root in near_copies([text or "" for text in rows.text])]


def test_passages_of_51_to_60_words_go(spark, prose):
    """A passage of just over 50 words that two documents share goes from both."""
    rows, passages = [], {}
    for many in range(51, 61):
        own = [f"shared{many}{word}"[-5:] for word in prose(many, many).split()]
        passages[many] = " ".join(word.ljust(4, "x") for word in own)
        for side in (0, 1):
            rows.append((many * 2 + side, f"{prose(60, 1000 + many * 2 + side)} {passages[many]} {prose(60, 2000 + many * 2 + side)}", "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {row["doc_id"]: row["text"] for row in corpus_pipeline.cut_repeats(spark, docs, DATA).collect()}
    assert len(left) == len(rows)
    for many, passage in passages.items():
        assert 200 <= len(passage) < 400
        assert not any(passage[10:60] in left[many * 2 + side] for side in (0, 1))


def test_clashing_columns(spark, documents):
    """No stage loses or needs a column of its input by name."""
    own = {name: 7 for name in ("leak_id", "leak_digest", "leak", "digest_", "chosen", "chosen_id", "chosen_digest", "kept", "row", "key")}
    docs = documents.limit(40)
    for name, value in own.items():
        docs = docs.selectExpr("*", f"{value} as {name}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, DATA)
        assert left.columns == docs.columns
        assert left.where(" and ".join(f"{name} = 7" for name in own)).count() == left.count()


def test_one_python_worker_a_task(spark, documents):
    """No task of the last stage holds two workers, each with the vocabulary."""
    coded = corpus_pipeline.encode(spark, documents.limit(5), DATA)
    assert coded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert coded.where("decoded is not null").count() == 5


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="glibc only")
def test_tasks_give_memory_back():
    """At the end of a task's texts, what it has freed is the system's again, also between blocks still in use."""

    def held():
        return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    blocks = [bytes(3000) for _ in range(50_000)]
    kept = blocks[::100]
    del blocks
    before = held()
    batch = pa.RecordBatch.from_arrays([pa.array([b"a", b"bc"], pa.binary())], names=["body"])
    assert [texts for _, texts in slices(iter([batch]))] == [[b"a", b"bc"]]
    assert held() < before - 50_000_000 and len(kept) == 500


def test_all_queries_are_registered():
    names = registry.queries().keys()
    assert {f"op{n}_" for n in range(1, 14)} <= {name.split("_")[0] + "_" for name in names}
    assert "pipeline" in names


@pytest.mark.parametrize("name", llm.oracle_sql())
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in "documents pages benchmark labels conversations".split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found, expected = llm.queries()[name](spark, DATA).toPandas(), connection.execute(llm.oracle_sql()[name]).df()
    columns = sorted(found.columns)

    def as_rows(frame):
        # Whole numbers with nulls come as floats from one side.
        value = lambda v: None if pd.isna(v) else float(v) if isinstance(v, Number) else v
        return sorted(str(tuple(map(value, row))) for row in frame[columns].itertuples(index=False, name=None))

    assert columns == sorted(expected.columns) and as_rows(found) == as_rows(expected)


def test_stages_leave_no_tables_that_nothing_reads(spark, documents, tmp_path, monkeypatch):
    """Of the tables that the stages write on their way only those stay that their results read."""
    monkeypatch.setattr(storage, "new_shared_dir", lambda _, purpose: f"file://{tmp_path}/{purpose}-{uuid.uuid4().hex}")
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.cut_repeats, corpus_pipeline.drop_leaks):
        assert stage(spark, documents, DATA).count()
    assert {path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir()} == {"chosen", "repeats", "leaks", "leaking"}


def test_a_round_of_components_is_few_shuffles(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(64)], "u long, v long")
    spark.sparkContext.setJobGroup("components", "")
    assert connected_components(links).select("root").distinct().count() == 1
    tracker = spark.sparkContext.statusTracker()
    stages = {stage for job in tracker.getJobIdsForGroup("components") for stage in tracker.getJobInfo(job).stageIds}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # 85; 239 with a join and a union for each end.
    assert sum(tracker.getStageInfo(stage).numTasks for stage in stages if tracker.getStageInfo(stage)) < 150
