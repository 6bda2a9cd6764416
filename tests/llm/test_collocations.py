import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from filehaul.llm import collocations


def plain(rows, least, longest=5, best=2000):
    """All rows ``(lang, rank, phrase, a, l, r, n, score)`` from plain counts."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, count in counts.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in found.items():
            inside |= {q for n in range(2, len(p)) for i in range(len(p) - n + 1) if count[q := p[i : i + n]] <= a}
        scored = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000 * a * total[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def mined(table, **options):
    return sorted(map(tuple, collocations.mine_phrases(table, **options).collect()))


@pytest.mark.parametrize("shard", [200, 1 << 20])
def test_against_plain_counts(spark, monkeypatch, shard):
    """Many shards and ranges, copies, several languages, marks and white space of all kinds."""
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard)
    monkeypatch.setattr(collocations, "RANGE_WORDS", 300)
    rng = random.Random(3)
    words = ["a", "The", "of", "é", "zu", "x1", "İst", "ẞ", "new", "york", "times"]
    rows = []
    for i in range(300):
        parts = [rng.choice(words) + rng.choice([" "] * 12 + ["  ", "\t", ", ", ".", "\n", "\x0b", "!?", "\r\n"]) for _ in range(rng.randrange(60))]
        rows.append((rng.choice(["en", "de", None, ""]), "".join(parts)))
    rows += [("en", "once upon a time there was a king")] * 9 + [("fr", None), (None, "")]
    table = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for least, longest, best in ((8, 5, 2000), (3, 3, 20), (9, 2, 5)):
        expected = plain(rows, least, longest, best)
        assert len(expected) > 10
        assert mined(table, least=least, longest=longest, best=best) == expected


def test_query_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in table.select("lang", "text").collect()]
    assert mined(table) == plain(rows, 100)


def test_long_numbers_stay_exact(spark):
    """Products beyond 64 bits, through the tables of the transducer."""
    big = 3_000_000_000_000
    one = spark.createDataFrame([(0, "en", "a", big), (1, "en", "b", big - 1)], "state long, lang string, word string, n long")
    two = spark.createDataFrame([(7, 0, 1, big - 2)], "state long, prefix long, suffix long, n long")
    totals = spark.createDataFrame([("en", 9 * big + 5)], "lang string, total long")
    docs = spark.createDataFrame([("en", "")], "lang string, text string")
    original = collocations._transducer
    try:
        collocations._transducer = lambda *args: ([one, two], totals)
        row = collocations.mine_phrases(docs).first()
    finally:
        collocations._transducer = original
    assert row["score"] == 1000 * (big - 2) * (9 * big + 5) // (big * (big - 1))


def test_odd_rows(spark, odd, empty):
    for table in (odd.withColumn("lang", F.lit(None).cast("string")), odd.withColumn("lang", F.lit("en")).withColumn("shard", F.lit(1))):
        rows = [(r["lang"], r["text"]) for r in table.select("lang", "text").collect()]
        assert mined(table, least=2) == plain(rows, 2)
        assert mined(table) == plain(rows, 100)
    assert mined(empty.withColumn("lang", F.lit("en"))) == []
