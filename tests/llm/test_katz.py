import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from filehaul.llm import katz
from filehaul.llm.queries import op7_katz_backoff

from .conftest import DATA


def tokens(text):
    return (text or "").encode().lower().split() + [b" end"]


class Plain:
    """The model from the definitions, one dictionary at a time."""

    def __init__(self, texts):
        self.one, self.two, self.context = Counter(), Counter(), Counter()
        for text in texts:
            words = tokens(text)
            before = [b" start", *words[:-1]]
            self.one.update(words)
            self.two.update(zip(before, words))
            self.context.update(before)
        self.n, self.v = sum(self.one.values()), len(self.one)
        numbers = [[list(c.values()).count(r) for r in range(1, 7)] for c in (self.one, self.two)]
        self.d1, self.d2 = map(katz.discounts, numbers)
        kept = sum(self.cut(c, self.d1) for c in self.one.values())
        self.mass = min(kept / self.n, self.n / (self.n + 1)) if self.n else 0.0
        self.scale = self.mass * self.n / kept if self.n else 0.0
        seen = defaultdict(list)
        for (h, w), c in self.two.items():
            seen[h].append((w, c))
        self.weights = {}
        for h, own in seen.items():
            kept, total = sum(self.cut(c, self.d2) for _, c in own), self.context[h]
            mass = min(kept / total, total / (total + 1))
            self.weights[h] = mass * total / kept, (1 - mass) / (1 - sum(self.word(w) for w, _ in own))

    @staticmethod
    def cut(count, factors):
        return count * (factors[count] if count <= katz.RELIABLE else 1)

    def word(self, w):
        return self.scale * self.cut(self.one[w], self.d1) / self.n if self.one[w] else 1 - self.mass

    def pair(self, h, w):
        if h not in self.weights:
            return self.word(w)
        scale, alpha = self.weights[h]
        count = self.two.get((h, w), 0)
        return scale * self.cut(count, self.d2) / self.context[h] if count else alpha * self.word(w)

    def row(self, text):
        words = tokens(text)
        base = sum(math.log10((self.one[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in words)
        score = sum(math.log10(self.pair(h, w)) for h, w in zip([b" start", *words[:-1]], words))
        return len(words), sum(self.one[w] > 0 for w in words), self.n, base, score


def check(rows, docs, held):
    model = Plain([text for number, text in docs if not held(number)])
    found = {row["doc_id"]: row for row in rows}
    for number, text in docs:
        got, expected = found[number], model.row(text)
        assert got["held_out"] == held(number)
        assert (got["n_tokens"], got["n_known"], got["train_tokens"]) == expected[:3]
        assert (got["base_score"], got["score"]) == pytest.approx(expected[3:], abs=1e-6)
    return model


def test_query(spark, documents):
    docs = [tuple(row) for row in documents.select("doc_id", "text").collect()]
    rows = op7_katz_backoff(spark, DATA).collect()
    model = check(rows, docs, lambda number: zlib.crc32(str(number).encode()) % 5 == 1)
    for h in list(model.weights)[:50]:
        assert sum(model.pair(h, w) for w in model.one) + model.pair(h, b"not there") == pytest.approx(1)
    held = [row for row in rows if row["held_out"]]
    assert sum(row["score"] for row in held) > sum(row["base_score"] for row in held)


def test_frequent_contexts_are_dealt_to_all_buckets(spark, documents):
    docs = [tuple(row) for row in documents.select("doc_id", "text").collect()]
    rows = katz.score_texts(documents, F.col("doc_id") % 4 == 1, bucket_tokens=4000).collect()
    check(rows, docs, lambda number: number % 4 == 1)


def test_discounts_without_a_regular_shape():
    for numbers in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 9, 1, 9, 1, 9], [100, 40, 20, 12, 8, 6]):
        factors = katz.discounts(numbers)
        assert np.all((factors > 0) & (factors <= 1))


def test_odd_rows(odd, empty):
    rows = katz.score_texts(odd, F.lit(None).cast("boolean")).collect()
    assert len(rows) == odd.count()
    assert all(row["score"] < 0 and not row["held_out"] for row in rows)
    assert {row["n_tokens"] for row in rows if row["doc_id"] in (2, 3, 4)} == {1}
    assert katz.score_texts(empty, F.lit(True)).count() == 0
    # Nothing to learn from.
    assert {row["score"] for row in katz.score_texts(odd, F.lit(True)).collect()} == {0.0}


def test_pack_is_small():
    rng = np.random.default_rng(1)
    values = np.sort(rng.zipf(1.3, 200_000) % 50_000).astype(np.uint64), (rng.zipf(1.5, 200_000) % 3000).astype(np.uint64)
    packed = katz.pack(*values)
    assert all((a == b).all() for a, b in zip(values, katz.unpack(packed)))
    planes = [np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T).tobytes() for v in values]
    assert len(packed) < len(katz.zstandard.ZstdCompressor(level=3).compress(b"".join(planes)))


def test_counts_of_words_cost_nearly_nothing():
    """Pairs are packed with the counts of both words in little more than without them."""
    rng = np.random.default_rng(3)
    counts = np.sort((1e7 / np.arange(1, 60_001)).astype(np.uint64) + rng.integers(0, 2, 60_000).astype(np.uint64))[::-1]
    h, w = (np.minimum(rng.zipf(1.2, 400_000), 60_000) - 1 for _ in range(2))
    order = np.lexsort((w, h))
    h, w = h[order], w[order]
    number = (np.arange(60_000) % 7 << 40 | np.arange(60_000) // 7).astype(np.uint64)
    order = np.lexsort((number[w], number[h]))
    h, w = h[order], w[order]
    packed = katz.pack_pairs(number[h], number[w], counts[h], counts[w])
    for found, expected in zip(katz.unpack_pairs(packed), (number[h], number[w], counts[h], counts[w]), strict=True):
        assert (found == expected).all()
    assert len(packed) < 1.1 * len(katz.pack(number[h], number[w]))
    # As it was before.
    assert len(packed) < 0.8 * len(katz.pack(number[h], number[w], counts[h], counts[w]))


def test_packed_pairs_at_the_edges():
    top = np.array([2**64 - 1], np.uint64)
    for h, w, ch, cw in (([], [], [], []), ([0], [0], [5], [0]), ([3, 3, 9], [1, 2, 1], [0, 0, 8], [7, 6, 7])):
        rows = [np.array(values, np.uint64) for values in (h, w, ch, cw)]
        assert all((a == b).all() for a, b in zip(katz.unpack_pairs(katz.pack_pairs(*rows)), rows, strict=True))
    rows = [np.concatenate([[np.uint64(1)], top]), np.array([4, 4], np.uint64), np.array([2, 2**40], np.uint64), np.array([6, 6], np.uint64)]
    assert all((a == b).all() for a, b in zip(katz.unpack_pairs(katz.pack_pairs(*rows)), rows, strict=True))


def test_sums_are_added_up_before_they_are_sent(spark, documents, monkeypatch):
    """A task sends one row for a chunk, not one for each of its buckets, and the scores are the same if it sends them early."""
    sent = []
    totals = katz._totals
    monkeypatch.setattr(katz, "_totals", lambda sums: sent.append(sums.where("bucket >= 0").selectExpr("spark_partition_id() as task", "chunk").collect()) or totals(sums))
    held = lambda number: number % 4 == 1
    docs = [tuple(row) for row in documents.select("doc_id", "text").collect()]
    check(katz.score_texts(documents, F.col("doc_id") % 4 == 1, bucket_tokens=4000).collect(), docs, held)
    assert len(set(sent[0])) == len(sent[0])
    monkeypatch.setattr(katz, "HELD_SUMS", 10)
    check(katz.score_texts(documents, F.col("doc_id") % 4 == 1, bucket_tokens=4000).collect(), docs, held)
