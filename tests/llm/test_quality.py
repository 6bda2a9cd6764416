import re
from collections import Counter
from itertools import product

import numpy as np
import pytest

from filehaul.llm import quality
from filehaul.llm.queries import op9_quality_rules

from .conftest import DATA


def plain(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    lines = text.split("\n")
    seen, repeated = set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line) and line in seen:
            repeated += 1
        seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) for j in range(8) if windows[tuple(words[i : i + 8])] > 1}
    return (
        len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_query_counts(spark, documents):
    found = {row["doc_id"]: row for row in op9_quality_rules(spark, DATA).collect()}
    for row in documents.collect():
        got = found[row["doc_id"]]
        assert tuple(got[name] for name in COUNTS) == plain(row["text"])
        assert not (got["base_failed"] and got["kept"])


@pytest.mark.parametrize("text", ["a b c d e f g h " * 4, "a\na\n\n\na", "é# | é# |", "x " * 9, "\x0b \x0ca\x1cb\x85c"])
def test_counts(spark, text):
    model = quality.LineModel(np.zeros(len(quality.FEATURES)), np.zeros((2, 2)))
    row = quality.judge_quality(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert tuple(row[name] for name in COUNTS) == plain(text)


def test_viterbi_is_the_best_of_all_sequences():
    source = np.random.default_rng(2)
    for _ in range(50):
        model = quality.LineModel(np.zeros(1), source.normal(size=(2, 2)))
        scores = source.normal(size=source.integers(1, 8)).tolist()

        def value(labels):
            moves = sum(model.moves[int(a), int(b)] for a, b in zip(labels, labels[1:]))
            return moves + sum(s for s, label in zip(scores, labels) if label)

        best = max(product([False, True], repeat=len(scores)), key=value)
        assert value(model.label(scores)) == pytest.approx(value(best))


def test_held_out_labels(spark):
    """Fitted on one half of the labels: nearly all good documents of the other half stay, and most bad ones go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_line_model(docs, labels.where("doc_id % 2 = 0"))
    judged = quality.judge_quality(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    good, bad = judged[(judged.quality == 1) & ~judged.base_failed], judged[judged.quality == 0]
    assert good.kept.mean() > 0.97
    assert bad.kept.mean() < 0.2


LARGE = "/root/testdata/sf0.01"
# Of the kinds that the labelled documents show; a line that only repeats words ("click click here here") is found by chance.
JUNK = ["home | login | basket | help | terms", "*** SALE!! *** NOW!! $$$", "BUY!! THIS!! NOW!! HERE!! TODAY!!", "#tag ### %%% &&& more", "A | B | C | D"]


def test_labels_differ_within_texts(spark):
    """Bad documents hold content lines, and boilerplate planted in good ones is marked there, and little else."""
    docs, labels = (spark.read.parquet(f"{LARGE}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit_line_model(docs, labels.where("doc_id % 2 = 0"))
    held = docs.join(labels.where("doc_id % 2 = 1"), "doc_id")
    bad = quality.judge_quality(held.where("quality = 0"), model).where("n_lines > 1").toPandas()
    assert ((bad.content_lines > 0) & (bad.content_lines < bad.n_lines)).mean() > 0.25
    source = np.random.default_rng(3)
    told, true = [], []
    for row in held.where("quality = 1").orderBy("doc_id").collect():
        lines = [(line, True) for line in row["text"].split("\n")]
        for _ in range(max(1, len(lines) // 4)):
            lines.insert(source.integers(len(lines) + 1), (JUNK[source.integers(len(JUNK))], False))
        features, _, _ = quality.line_features(["\n".join(line for line, _ in lines).encode()])
        told += model.label(model.scores(features).tolist())
        true += [content for _, content in lines]
    told, true = np.array(told), np.array(true)
    assert (~told & ~true).sum() / (~true).sum() > 0.9
    assert (~told & ~true).sum() / (~told).sum() > 0.9


def plain_features(text):
    lines, seen = [], set()
    for line in text.split("\n"):
        parts = re.findall("[^\x20\x09-\x0d]+", line)
        octets = "".join(parts).encode()
        words, chars = max(len(parts), 1), max(sum(map(len, parts)), 1)
        count = lambda known: sum(byte in known for byte in octets)  # noqa: B023, E731
        echo = sum(a == b for a, b in zip(parts, parts[1:]))
        lines.append([
            1, min(len(parts) / 30, 1), len(parts) <= 3, min(chars / words / 15, 1), min(4 * count(b"#*$%&|<>") / words, 1),
            min(2 * count(b"0123456789") / chars, 1), min(2 * count(bytes(range(65, 91))) / chars, 1),
            min(count(b"!?;:=_/\\@^~+{}[]()\"'") / words, 1), min(2 * echo / words, 1), line in seen and len(parts) > 0,
        ])
        seen.add(line)
    return np.array(lines, float), [len(re.findall("[^\x20\x09-\x0d]+", line)) for line in text.split("\n")]


def test_verdict_against_plain_version(spark, documents):
    """``kept`` and the share of every row of the query, from the fitted weights, with a table of best values for the chain."""
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit_line_model(documents, labels)
    found = {row["doc_id"]: row for row in op9_quality_rules(spark, DATA).collect()}
    assert len(found) == documents.count()
    for row in documents.collect():
        features, words = plain_features(row["text"] or "")
        scores = features @ model.weights
        value, last = np.zeros((len(scores), 2)), np.zeros((len(scores), 2), int)
        value[0, 1] = scores[0]
        for place in range(1, len(scores)):
            for state in (0, 1):
                reach = value[place - 1] + model.moves[:, state]
                last[place, state] = reach[1] >= reach[0] if state else reach[1] > reach[0]
                value[place, state] = reach.max() + scores[place] * state
        state, content = int(value[-1, 1] >= value[-1, 0]), 0
        for place in range(len(scores) - 1, -1, -1):
            content += words[place] * state
            state = last[place, state]
        share = content / sum(words) if sum(words) else 0
        got = found[row["doc_id"]]
        assert got["content_share"] == pytest.approx(share)
        assert got["kept"] == (not plain(row["text"] or "")[-1] and share >= 0.5)


def test_fit_is_bounded(spark, documents):
    """A few chains are enough for a model, and no text comes to the driver."""
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit_line_model(documents, labels, max_documents=40, max_chains=30)
    assert np.isfinite(model.weights).all() and model.weights[quality.FEATURES.index("symbols")] < 0


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, None)], "doc_id long, quality int")
    model = quality.fit_line_model(odd, labels)
    rows = quality.judge_quality(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(row["content_share"] == 0 for row in rows if row["n_words"] == 0)
    assert quality.judge_quality(empty, quality.fit_line_model(empty, labels.limit(0))).count() == 0
    assert quality.keep_good(odd, model, min_words=1, max_repeated_percent=100).columns == odd.columns
