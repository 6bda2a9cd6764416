"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from filehaul.llm import byte_bpe, chat, collocations, decontaminate, katz, licenses, oracles, page_text, quality, simhash, substrings, token_rollup, url_filter, whitening
from filehaul.llm.oracles import LONG_WORDS, MARKS, WORDS
from filehaul.storage import new_shared_dir, store_once

URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]
RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), URL_RULES)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.drop("digest")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; then a second tokenizer, revised counts of toxic and deletion of bad documents; a batch comes again."""
    count = lambda pattern: F.regexp_count(F.coalesce("text", F.lit("")), F.lit(pattern)).cast("long")
    counted = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", count(WORDS).alias("words"), count(LONG_WORDS).alias("long_words"), count(MARKS).alias("marks")
    )
    counted, _ = store_once(counted, "counted")
    marked = counted.join(_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    row = lambda rows, tokenizer, tokens: rows.select(
        "doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), tokens.cast("long").alias("tokens")
    )
    first = row(counted, "words-1", F.col("words"))
    bad, toxic = F.coalesce(F.col("quality") == 0, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False))
    second = (
        row(marked.where(~bad), "marks-1", F.col("marks"))
        .unionByName(row(marked.where(bad), "words-1", F.lit(None)))
        .unionByName(row(marked.where(toxic & ~bad), "words-1", F.col("long_words")))
    )
    rollup = token_rollup.TokenRollup(spark, new_shared_dir(spark, "token-counts"))
    rollup.apply(1, first)
    rollup.apply(2, second)
    rollup.apply(1, first)
    rollup.apply(2, second)
    return rollup.totals()


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, radius=2)
    return marked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    windows = chat.format_windows(turns)
    read = chat.read_windows(windows).select("conv_id", "window", "turns", "loss_text", "chars")
    # The digests are over whole conversations, so each is put together in one row here, and only here.
    whole = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss_text"))).alias("windows"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns_of = F.flatten(F.col("windows.turns"))
    lines = F.transform(turns_of, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.col("windows.loss_text"), "")
    return whole.select(
        "conv_id",
        F.size(turns_of).cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op7_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return katz.score_texts(_table(spark, sf_dir, "documents"), held_out)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.load_vocabulary(spark, public_tokenizers.path(RANKS))
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("body", 256).alias("decoded_sha256")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality.fit_line_model(documents, _table(spark, sf_dir, "labels"))
    return quality.judge_quality(documents, model)


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.drop_repeats(_table(spark, sf_dir, "documents"), length=400)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(_table(spark, sf_dir, "documents"), least=100, longest=5, best=2000)


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(_table(spark, sf_dir, "pages"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=4)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [op1_url_filter, op2_decontamination, op3_token_counts, op4_license_scan, op5_simhash, op6_chat_windows, op7_katz_backoff, op8_byte_bpe, op9_quality_rules, op10_repeated_substrings, op11_phrase_mining, op12_page_text, op13_embedding_whitening]
    return {query.__name__: query for query in registered} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {"op3_token_counts": oracles.TOKEN_COUNTS, "op4_license_scan": oracles.license_scan(), "op11_phrase_mining": oracles.phrase_mining()} | pipeline
