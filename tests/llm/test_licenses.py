import re

from filehaul.llm import licenses
from filehaul.llm.license_texts import NOTICES, PHRASES
from filehaul.llm.queries import op4_license_scan

from .conftest import DATA

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(text.encode().lower())
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.encode().split()
    ]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places})))


BASE = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def test_query_base(spark, documents):
    found = {row["doc_id"]: row for row in op4_license_scan(spark, DATA).collect()}
    for row in documents.collect():
        assert tuple(found[row["doc_id"]][name] for name in BASE) == plain(row["text"])


def test_phrases_and_notices(spark, prose):
    cut = NOTICES["isc"].replace("software", "very own software").replace("fee", "")
    texts = [
        "CC-BY-NC cc by nc, under THE mit license", prose(50) + NOTICES["mit"] + prose(20), prose(30) + cut,
        NOTICES["mit"][:120], "Ünder the MIT license", "cc by", NOTICES["bsd"] + " " + NOTICES["bsd"],
    ]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = {row["doc_id"]: row for row in rows.collect()}
    for number, text in enumerate(texts):
        assert tuple(rows[number][name] for name in BASE) == plain(text)
    assert rows[0]["labels"] == "cc-by-nc,mit" and rows[0]["score"] == 1.0
    assert rows[1]["labels"] == "mit" and rows[1]["spans"][0]["first"] == 50
    assert rows[2]["labels"] == "isc"
    assert rows[3]["labels"] == "" and 0 < rows[3]["score"] < 0.8
    assert len(rows[6]["spans"]) == 2


def test_best_stretch_of_a_long_span(spark, prose):
    """Beginnings of a notice that are repeated before it chain into one span; the notice in it is found all the same."""
    chained = "x is licensed under the mit license. y is licensed under the apache license. z is licensed under the gnu general public license, version 3"
    words = NOTICES["mit"].split()
    texts = [chained, " ".join([*words[:8]] * 30 + words), prose(40) + " " + " ".join([*words[:8]] * 3)]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = {row["doc_id"]: row for row in rows.collect()}
    assert "gpl-3" in rows[0]["labels"] and "mit" in rows[0]["labels"]
    assert "mit" in rows[1]["labels"].split(",")
    span = next(span for span in rows[1]["spans"] if span["label"] == "mit")
    # The last k-gram stands once more inside the notice, so that the first stretch that holds all ends one word before it.
    assert span["cover"] == 1.0 and span["last"] == 8 * 30 + len(WORD.findall(NOTICES["mit"].encode().lower())) - 1
    assert rows[2]["labels"] == ""


def test_odd_rows(odd, empty):
    rows = licenses.scan_licenses(odd).collect()
    assert len(rows) == odd.count()
    assert {row["n_words"] for row in rows if row["doc_id"] in (2, 3, 4)} == {0}
    assert licenses.scan_licenses(empty).count() == 0


def test_rows_that_stand_twice(spark):
    twice = spark.createDataFrame([(1, "under the mit license")] * 2 + [(None, "under the mit license")], "doc_id long, text string")
    assert [row["n_base"] for row in licenses.scan_licenses(twice).collect()] == [1, 1, 1]
