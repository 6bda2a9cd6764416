import hashlib
import random
import sys

import numpy as np
import pytest

from filehaul.llm import substrings
from filehaul.llm.deep_shallow import order_suffixes
from filehaul.llm.queries import op10_repeated_substrings

from .conftest import DATA


def plain(texts, length):
    places = {}
    for number, text in enumerate(texts):
        for start in range(len(text) - length + 1):
            places.setdefault(text[start : start + length], []).append((number, start))
    gone = [bytearray(len(text)) for text in texts]
    for found in places.values():
        if len(found) > 1:
            for number, start in found:
                gone[number][start : start + length] = b"\1" * length
    out = []
    for text, marks in zip(texts, gone):
        kept = bytes(byte for byte, mark in zip(text, marks) if not mark)
        runs = sum(bool(mark) and not before for mark, before in zip(marks, b"\0" + marks))
        out.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_query(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    expected = dict(zip([row["doc_id"] for row in rows], plain([row["text"].encode() for row in rows], 400)))
    found = {row["doc_id"]: tuple(row)[1:] for row in op10_repeated_substrings(spark, DATA).collect()}
    assert found == expected


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, prose, seed):
    source = random.Random(seed)
    passages = [prose(source.randint(100, 200), n, ["ab", "é", "cde", "f", "gg" * 4]) for n in range(4)]
    texts = ["", "a" * 399, "a" * 400, "a" * 401, "ab" * 300, "x" * 1500]
    for number in range(40):
        text = prose(source.randint(0, 100), number)
        for _ in range(source.randint(0, 3)):
            passage = source.choice(passages)
            start = source.randint(0, 80)
            text += passage[start : start + source.randint(380, 700)] + prose(source.randint(0, 60), number + 99)
        texts.append(text)
    texts += [text[:500] + "!" + text[501:] for text in texts[-20:]] + texts[6:8]
    rows = [(number if number != 9 else None, text) for number, text in enumerate(texts)] + [(8, texts[8])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [
        (row["doc_id"] if row["doc_id"] is not None else -1, row["n_bytes"], row["n_removed"], row["n_spans"], hashlib.sha256(row["kept"]).hexdigest())
        for row in substrings.drop_repeats(frame).collect()
    ]
    expected = [(i if i is not None else -1, *own) for (i, _), own in zip(rows, plain([t.encode() for _, t in rows], 400))]
    assert sorted(found) == sorted(expected)


def test_a_text_longer_than_a_piece(spark):
    letters = np.random.default_rng(3).integers(97, 123, 9_000_000, dtype=np.uint8).tobytes().decode()
    text = letters + letters[4_194_000:4_194_900]
    row = substrings.drop_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(span) for span in row["spans"]] == [(4_194_000, 4_194_900), (9_000_000, 9_000_900)]


def test_order_of_suffixes():
    source = random.Random(5)
    for _ in range(60):
        length = source.choice([3, 8, 20, 50])
        base = bytes(source.choice(b"abc"[: source.randint(1, 3)]) for _ in range(source.randint(length, 200)))
        data = base + base[:50] + base
        starts = np.array(sorted(source.sample(range(len(data) - length + 1), 30)) if len(data) - length > 30 else [0])
        groups = np.array([source.randint(0, 2) for _ in starts])
        order, same = order_suffixes(data, starts, groups, length)
        keys = [(groups[i], data[starts[i] : starts[i] + length]) for i in order]
        assert keys == sorted(keys)
        assert same.tolist() == [i > 0 and keys[i] == keys[i - 1] for i in range(len(keys))]


def test_odd_rows(odd, empty):
    rows = substrings.drop_repeats(odd).collect()
    assert len(rows) == odd.count()
    # A text of one word repeats itself.
    assert {row["n_removed"] for row in rows if row["doc_id"] == 5} == {250_000}
    assert substrings.drop_repeats(empty).count() == 0
    cut = substrings.cut_texts(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()


def test_whole_characters(spark):
    shared = "é" * 300
    frame = spark.createDataFrame([(1, "aé" + shared), (2, "b" + shared + "x")], "doc_id long, text string")
    assert sorted(row["text"] for row in substrings.cut_texts(frame).collect()) == ["a", "bx"]


def test_a_piece_needs_little_memory():
    """Working memory of a task's anchors; a worker holds it next to Spark's heap."""
    import tracemalloc

    data = np.random.default_rng(2).integers(97, 123, substrings.PIECE, dtype=np.uint8)
    powers = substrings._Powers(len(data) + 401)
    tracemalloc.start()
    found = substrings.find_anchors(data, np.array([0]), np.array([len(data)]), 400, powers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) and peak < 150 << 20


def test_large_parts_fall_around_pivots():
    source = np.random.default_rng(8)
    for letters, length in ((2, 12), (3, 50), (250, 40)):
        base = source.integers(0, letters, 900, dtype=np.uint8)
        data = np.concatenate([base, base[100:400], base]).tobytes()
        starts = np.arange(len(data) - length + 1)
        groups = source.integers(0, 3, len(starts))
        order, same = order_suffixes(data, starts, groups, length)
        keys = [(groups[i], data[starts[i] : starts[i] + length]) for i in order]
        assert sorted(order.tolist()) == starts.tolist() and keys == sorted(keys)
        assert same.tolist() == [i > 0 and keys[i] == keys[i - 1] for i in range(len(keys))]


def test_small_groups_are_sorted_together():
    """Calls do not grow with the number of groups."""
    data = np.random.default_rng(9).integers(0, 256, 60_000, dtype=np.uint8).tobytes()
    starts, calls = np.arange(0, 59_000, 10), []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        order_suffixes(data, starts, starts // 100, 50)
    finally:
        sys.setprofile(None)
    assert len(calls) < 590
