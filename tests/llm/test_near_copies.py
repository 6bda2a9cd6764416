import random

import numpy as np
import pytest

from filehaul.llm import near_copies


def shingle_set(text):
    parts = text.lower().split()
    return {tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))} if parts else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def near(text, low, rng):
    """The text with words changed one by one, as long as the similarity stays at least ``low``."""
    words, last = text.split(), text
    while True:
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        if jaccard(text, " ".join(words)) < low:
            return last
        last = " ".join(words)


def plain(texts, least=0.8):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= least:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted({find(i) for i in range(len(texts))})


@pytest.fixture(scope="module")
def planted():
    """Per level 60 texts of 100 to 300 words, and a copy of each a little above the level."""
    rng, out = random.Random(5), []
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    for level in (0.8, 0.85, 0.9, 0.95):
        for _ in range(60):
            text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(100, 300)))
            out.append((level, text, near(text, level, rng)))
    return out


def test_recall_of_planted_copies(spark, planted):
    rows = [(2 * i + side, pair[1 + side]) for i, pair in enumerate(planted) for side in (0, 1)]
    kept = {r.doc_id for r in near_copies.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {2 * i for i in range(len(planted))} <= kept
    for level in (0.8, 0.85, 0.9, 0.95):
        at = [i for i, pair in enumerate(planted) if pair[0] == level]
        assert sum(2 * i + 1 not in kept for i in at) >= 0.98 * len(at), level


def test_against_all_pairs(spark, prose):
    """Chains, large groups and texts just below the similarity, against the comparison of all pairs."""
    rng, texts = random.Random(9), []
    for seed in range(6):
        base = prose(rng.randint(30, 200), seed)
        texts += [base, base.upper(), *(near(base, low, rng) for low in (0.6, 0.7, 0.75, 0.8, 0.85, 0.9) for _ in range(4))]
        texts += [near(texts[-1], 0.8, rng), near(texts[-2], 0.8, rng)]
    texts += ["", " \n", "one two", "one  TWO", "one three", "word " * 50, "word " * 60]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_first(rows).collect()) == plain(texts)


def test_odd_rows(spark, odd, empty):
    kept = near_copies.keep_first(odd)
    assert kept.columns == odd.columns
    # Repeats, and texts without words, are one row each.
    assert sorted(r.text or "" for r in kept.collect()) == sorted(["", "one two three four", "other", "word " * 50_000, "x y z"])
    assert near_copies.keep_first(empty).count() == 0
    clashing = odd.selectExpr("*", "1 as chosen", "2 as chosen_id", "3 as chosen_digest", "4 as Chosen_")
    assert near_copies.keep_first(clashing).columns == clashing.columns


def test_sketches_against_sets():
    """Whole sets are told apart exactly; of cut ones none that are alike is lost."""
    rng = np.random.default_rng(3)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    pairs = []
    for size in (1, 5, 40, 500, 511, 512, 513, 3000):
        for share in (0.0, 0.5, 0.75, 0.8, 0.85, 0.95, 1.0):
            one = draw(size)
            pairs.append((one, np.unique(np.concatenate([one[rng.random(len(one)) < share], draw(max(1, int(size * (1 - share))))]))))
    sketches = near_copies.Lowest([b[: near_copies.LOWEST] for _, b in pairs])
    for row, (a, b) in enumerate(pairs):
        common = len(np.intersect1d(a, b))
        alike = common >= 0.8 * (len(a) + len(b) - common)
        told = bool(sketches.may_be_alike(a[: near_copies.LOWEST], np.array([row]), 0.8)[0])
        assert told if alike else not (told and max(len(a), len(b)) < near_copies.LOWEST), (len(a), len(b), common)


def test_blocks_of_a_band(spark, monkeypatch):
    """One band with many texts of which none is a copy of a hub's, in blocks of a few; every link between them is found."""
    monkeypatch.setattr(near_copies, "BLOCK", 3)
    monkeypatch.setattr(near_copies, "PAIRS", 4)
    rng = random.Random(31)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for group in range(12):
        words = list(base)
        for _ in range(7):
            words[rng.randrange(len(words))] = f"g{group}x{rng.randrange(10**6)}"
        texts += [" ".join(words), near(" ".join(words), 0.85, rng)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_first(rows).collect()) == plain(texts)
