"""From raw documents to token ids, in stages that each read what the one before kept.

Every stage is a function of ``(spark, docs, sf_dir)``; its result is written as
Parquet and read again as the next one's ``docs``. All stages but the last
return the columns of ``documents``. The rows of a text are found again by its
id and the XXH64 of its text, so repeated and null ids do no harm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filehaul.llm import byte_bpe, decontaminate, near_copies, quality, substrings
from filehaul.llm.common import fresh_name, small_batches
from filehaul.storage import store_once

RANKS = "byte_bpe_multi_50k.tiktoken"
SHINGLE_WORDS = 5
# Bits of 64 that may differ in a link of fingerprints; bands of MinHash values find what is further apart.
RADIUS = 3
MIN_SIMILARITY = 0.8
# Passages of over 50 words reach it: of runs of 51 words in the texts of scale 0.1, 99.5% have 200 bytes, under a tenth 400.
REPEAT_BYTES = 200


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and are content by the line labels."""
    model = quality.fit_line_model(docs, _table(spark, sf_dir, "labels"))
    with small_batches(spark):
        return store_once(quality.keep_good(docs, model), "good")[0]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return near_copies.keep_first(docs, words=SHINGLE_WORDS, radius=RADIUS, least=MIN_SIMILARITY)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that repeat; those of which nothing is left go."""
    left = substrings.cut_texts(docs, length=REPEAT_BYTES)
    return left.where(F.trim("text") != "").withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    leaks = decontaminate.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    name = fresh_name(docs.columns, "leak")
    found = leaks.select(F.struct(F.col("doc_id").alias("id"), "digest").alias(name)).distinct()
    found, _ = store_once(found, "leaking")
    digest = F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    same = F.col("doc_id").eqNullSafe(F.col(f"{name}.id")) & (digest == F.col(f"{name}.digest"))
    return docs.join(found, same, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: token ids, and whether decoding gives the text back."""
    vocabulary = byte_bpe.load_vocabulary(spark, public_tokenizers.path(RANKS))
    # Written between, so that a task holds one Python worker with the vocabulary and not two.
    with small_batches(spark):
        ids, _ = store_once(byte_bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), "token-ids")
    coded = byte_bpe.decode(ids, vocabulary)
    return coded.select("doc_id", "n_tokens", "ids", F.decode("body", "utf-8").alias("decoded"))


STAGES = [
    ("quality rules", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE encoding and decoding", encode),
]

# Viterbi labels, trees of fingerprints, suffix orders and merges are not for SQL; see tests/llm for the plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, beginning with the table documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = store_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
