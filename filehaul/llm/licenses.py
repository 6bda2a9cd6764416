"""License scans by diagonal voting.

All word k-grams of the texts are joined to the k-grams of the templates. A
match at word ``pos`` of a text and ``tpos`` of a template votes for the
diagonal ``pos - tpos``. Neighbouring diagonals of a template are merged to a
span, which allows for added and lost words, and a span is verified by the
share of the template's k-grams found in it and by its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filehaul.llm.common import lower_ascii
from filehaul.llm.license_texts import NOTICES, PHRASES
from filehaul.storage import store_once

WORD_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
GRAM = 3
# Templates are sent to every task, so their words are limited.
MAX_TEMPLATE_WORDS = 200_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def _grams(words: Column) -> Column:
    """Word k-grams in their order, as strings; none for fewer words."""
    grams = F.transform(
        F.sequence(F.lit(1), F.size(words) - (GRAM - 1)),
        lambda i: F.concat_ws(" ", *(F.try_element_at(words, i + step) for step in range(GRAM))),
    )
    return F.when(F.size(words) >= GRAM, grams)


def template_grams(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """``template, label, exact, n_grams, tpos, gram, key`` of all templates; ``exact`` marks phrases."""
    rows = [(f"phrase {text}", label, True, text) for text, label in phrases.items()]
    rows += [(f"notice {label}", label, False, text) for label, text in notices.items()]
    if sum(len(row[3].split()) for row in rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have over {MAX_TEMPLATE_WORDS} words")
    texts = spark.createDataFrame(rows, "template string, label string, exact boolean, text string")
    worded = texts.select("template", "label", "exact", _words(F.col("text")).alias("words"))
    return worded.select(
        "template", "label", "exact",
        (F.size("words") - (GRAM - 1)).alias("n_grams"),
        F.posexplode(_grams(F.col("words"))).alias("tpos", "gram"),
    ).withColumn("key", F.xxhash64("gram"))


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    id_column: str = "doc_id",
    text_column: str = "text",
    gap: int = 8,
    min_cover: float = 0.8,
    max_stretch: float = 1.5,
) -> DataFrame:
    """Places of phrases and verified spans of notices in whole texts.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans``, one row per row; spans are ``(label, first, last,
    cover)`` in words. A null or empty text has no words, no labels (empty
    strings) and score 0. Rows with equal id and text get equal results; a null
    id is a value like any other. Other columns are left out. Phrases have at
    least three words.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    source = source.withColumn("digest", F.xxhash64("text"))
    worded = source.select("doc_id", "digest", _words(F.col("text")).alias("words"))
    grams = worded.select("doc_id", "digest", F.posexplode(_grams(F.col("words"))).alias("pos", "gram"))
    grams = grams.withColumn("key", F.xxhash64("gram"))
    templates = template_grams(docs.sparkSession, phrases, notices)
    # Equal hashes are verified by the words themselves. Rows that stand twice vote once.
    votes = (
        grams.join(F.broadcast(templates), ["key", "gram"])
        .select(
            "doc_id", "digest", "template", "label", "exact", "n_grams", "tpos", "pos",
            (F.col("pos") - F.col("tpos")).alias("diagonal"),
        )
        .distinct()
    )
    # Few rows, used twice: the texts are cut into k-grams once.
    votes, _ = store_once(votes, "votes")
    places = (
        votes.where("exact")
        .groupBy("doc_id", "digest", "template", "label", "n_grams", "diagonal")
        .count()
        .where("count = n_grams")
        .groupBy("doc_id", "digest")
        .agg(
            F.count("*").alias("n_base"),
            F.min("diagonal").cast("long").alias("first_word"),
            F.max("diagonal").cast("long").alias("last_word"),
            F.collect_set("label").alias("base_set"),
        )
    )
    by_diagonal = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal", "pos")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > gap
    merged = (
        votes.where("not exact")
        .withColumn("starts", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("span", F.sum("starts").over(by_diagonal))
    )
    # Merging may chain places far apart. What counts is the best stretch of a span that is not much longer than the template:
    # of those that begin at a vote, the one with the most of its k-grams, and of equals the first. Steps of half a place
    # less than one over the stretch make the window's bound the same for all templates.
    reach = F.floor(F.lit(max_stretch) * (F.col("n_grams") + (GRAM - 1))) - GRAM
    stretch = Window.partitionBy("doc_id", "digest", "template", "span").orderBy(F.col("pos") / (F.greatest(reach, F.lit(0)) + 0.5)).rangeBetween(0, 1)
    best = F.struct(F.size(F.collect_set("tpos").over(stretch)).alias("found"), (-F.col("pos")).alias("before"), F.max("pos").over(stretch).alias("end"))
    spans = (
        merged.withColumn("best", best)
        .groupBy("doc_id", "digest", "template", "label", "n_grams", "span")
        .agg(F.max("best").alias("best"))
        .select(
            "doc_id", "digest", "label", (F.col("best.found") / F.col("n_grams")).alias("cover"),
            (-F.col("best.before")).cast("long").alias("first"), (F.col("best.end") + GRAM).cast("long").alias("last"),
        )
    )
    seen = spans.groupBy("doc_id", "digest").agg(
        F.max("cover").alias("cover"),
        F.sort_array(
            F.collect_list(F.when(F.col("cover") >= min_cover, F.struct("label", "first", "last", "cover")))
        ).alias("spans"),
    )
    seen = seen.toDF("seen_id", "seen_digest", "cover", "spans")
    found = places.join(seen, _same(F.col("seen_id"), F.col("seen_digest")), "full").select(
        F.coalesce("doc_id", "seen_id").alias("found_id"),
        F.coalesce("digest", "seen_digest").alias("found_digest"),
        "n_base", "first_word", "last_word", "base_set", "cover", "spans",
    )
    counted = source.select("doc_id", "digest", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    base = F.coalesce("base_set", none)
    spans_or_none = F.coalesce("spans", F.array().cast("array<struct<label:string,first:bigint,last:bigint,cover:double>>"))
    own = F.transform(spans_or_none, lambda span: span["label"])
    return counted.join(found, _same(F.col("found_id"), F.col("found_digest")), "left").select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word",
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
        spans_or_none.alias("spans"),
    )


def _same(doc_id: Column, digest: Column) -> Column:
    return F.col("doc_id").eqNullSafe(doc_id) & (F.col("digest") == digest)
