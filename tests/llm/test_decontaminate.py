import random
import tracemalloc

import numpy as np
import pytest

from filehaul.llm import decontaminate
from filehaul.llm.queries import op2_decontamination

from .conftest import DATA


def test_query_finds_all_exact_items(spark, documents):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").collect()
    expected = {
        (doc["doc_id"], item["item_id"])
        for doc in documents.collect()
        for item in items
        if item["text"] in doc["text"] and len(decontaminate.words_of(item["text"].encode())) >= 8
    }
    found = op2_decontamination(spark, DATA).collect()
    assert expected and expected <= {(row["doc_id"], row["item_id"]) for row in found}
    assert all(row["share"] >= 0.6 for row in found)


def test_paraphrases(spark, prose):
    """Items with a tenth of their words changed or added are found; texts without an item are not."""
    source = random.Random(4)
    words = [prose(1, n) + str(n % 7) for n in range(800)]
    items = [" ".join(source.choice(words) for _ in range(source.randint(15, 60))) for _ in range(40)]
    rows = []
    for number in range(400):
        text = [source.choice(words) for _ in range(source.randint(50, 300))]
        if number < 40:
            own = items[number].split()
            for _ in range(len(own) // 10):
                own[source.randrange(len(own))] = "changed"
            own.insert(len(own) // 2, "added")
            place = source.randint(0, len(text))
            text[place:place] = own
        rows.append((number, " ".join(text).upper()))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(row["doc_id"], row["item_id"]) for row in decontaminate.find_leaks(frame, benchmark).collect()}
    assert len(found & {(n, n) for n in range(40)}) >= 36
    assert {doc for doc, _ in found} <= set(range(40))


def test_answer_lowers_the_share(spark):
    item = "what is the tallest tower in the old town built before the war. the long grey clock tower"
    text = "tower in the old town built before that. the long grey clock tower stands"
    frame = spark.createDataFrame([(1, text), (2, text.replace("grey", "red"))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = decontaminate.find_leaks(frame, benchmark, min_cosine=-1, min_nearness=-1e9).collect()
    assert [(row["doc_id"], row["answer"]) for row in rows] == [(1, True)]


def test_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (None, "word " * 12), (3, "one two")], "item_id long, text string")
    found = decontaminate.find_leaks(odd, benchmark, min_cosine=-1, min_nearness=-1e9).collect()
    assert {(row["doc_id"], row["item_id"]) for row in found} == {(5, None)}
    assert decontaminate.find_leaks(odd, benchmark.limit(0)).count() == 0
    assert decontaminate.find_leaks(empty, benchmark).count() == 0


def brute(text, item):
    """Whether the whole text holds the item by the rule, from the longest common subsequence."""
    inside, own = decontaminate.words_of(text.encode()), decontaminate.words_of(item.encode())
    row = [0] * (len(own) + 1)
    for word in inside:
        last, row = row, [0]
        for place, other in enumerate(own):
            row.append(last[place] + 1 if word == other else max(last[place + 1], row[-1]))
    share = row[-1] / len(own)
    answer = [part for part in map(decontaminate.words_of, item.encode().replace(b"\n", b".").split(b".")) if part][-1]
    held = any(inside[i : i + len(answer)] == answer for i in range(len(inside)))
    return share >= 0.8 or share >= 0.6 and held


def test_planted_shares_against_brute_force(spark, prose):
    """A leak in a third of the texts, items of common words, and items of which the answer and a share stay."""
    source = random.Random(8)
    words = [prose(1, n) + str(n % 7) for n in range(900)]
    common = [f"common{n}" for n in range(12)]
    pick = lambda many, known: [source.choice(known) for _ in range(many)]
    items = [" ".join(pick(30, words)) + ". " + " ".join(pick(5, words)) for _ in range(60)]
    items[1] = " ".join(pick(16, common)) + ". " + " ".join(pick(3, common))
    rows = []
    for number in range(450):
        text = [source.choice(common) if source.random() < 0.3 else source.choice(words) for _ in range(source.randint(30, 60))]
        own = items[0 if number % 3 == 0 else number % 60].split()
        share = (1.0, 0.9, 0.8, 0.7)[number // 3 % 4]
        if number % 3 < 2:
            # The answer stays: only words before it change.
            for place in source.sample(range(len(own) - 5), int((1 - share) * len(own))):
                own[place] = f"changed{number}x{place}"
            text[10:10] = own
        rows.append((number, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(row["doc_id"], row["item_id"]) for row in decontaminate.find_leaks(frame, benchmark).collect()}
    expected = {(doc, item) for doc, text in rows for item, own in enumerate(items) if brute(text, own)}
    assert sum(item == 0 for _, item in expected) >= 150 and any(item == 1 for _, item in expected)
    # Texts of up to 95 words can hold an item spread wider than a passage, so the plain version may know more of the common one.
    assert {pair for pair in expected if pair[1] != 1} <= found <= expected
    planted = {(doc, 1) for doc in range(450) if doc % 3 == 1 and doc % 60 == 1}
    assert planted <= found


def test_hashes_tell_words_apart():
    texts = ["The cat, the CAT. é É dog", "", "  x", "...", "the Dog" * 50]
    hashes, sizes = decontaminate.hash_words([text.encode() for text in texts])
    words = [decontaminate.words_of(text.encode()) for text in texts]
    flat = [word for each in words for word in each]
    assert sizes.tolist() == [len(each) for each in words]
    assert all((a == b) == (v == w) for a, v in zip(hashes, flat) for b, w in zip(hashes, flat))
    assert decontaminate.hash_words([])[1].tolist() == []


def brute_windows(text, item):
    """Whether some passage of 48 words with 24 on each side, which begins at a multiple of 24, holds the item by the rule."""
    words = text.split()
    return any(brute(" ".join(words[max(low - 24, 0) : low + 72]), item) for low in range(0, len(words), 24))


@pytest.fixture(scope="module")
def planted(spark):
    """Texts of scale 0.01 with items of the benchmark planted at each share; the space of those texts; the items."""
    source = random.Random(12)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    items = [row["text"] for row in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()]
    plain = [row["text"] or "" for row in docs.orderBy("doc_id").collect()]
    other = " ".join(plain).split()
    rows = []
    for share in (1.0, 0.9, 0.8, 0.7):
        for item in [*range(len(items))] * 5:
            own = items[item].split()
            for place in source.sample(range(len(own)), int((1 - share) * len(own) + 1e-9)):
                own[place] = source.choice(other)
            around = [source.choice(plain).split()[:150] for _ in range(2)]
            rows.append((len(rows), share, item, " ".join(around[0] + own + around[1])))
    frame = spark.createDataFrame(rows, "doc_id long, planted double, item long, text string")
    return frame, docs, items, rows


def test_recall_at_each_share(spark, planted):
    """Of the pairs that hold the rule by brute force over all windows, at least nine in ten are found at each share."""
    frame, docs, items, rows = planted
    corpus = frame.select("doc_id", "text").unionByName(docs.selectExpr("-1 - doc_id as doc_id", "text"))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(row["doc_id"], row["item_id"]) for row in decontaminate.find_leaks(corpus, benchmark).collect()}
    for share in (1.0, 0.9, 0.8, 0.7):
        expected = {(doc, item) for doc, planted_at, item, text in rows if planted_at == share and brute_windows(text, items[item])}
        assert len(expected) > (10 if share < 0.8 else 100)
        print(share, len(expected), len(expected & found))
        assert len(expected & found) / len(expected) >= 0.9


def test_the_latent_space_decides(spark, planted):
    """Few pairs are candidates, and neither a mask in place of the space nor another threshold gives the same."""
    frame, docs, items, rows = planted
    hashed = decontaminate._hashed(decontaminate.bodies(docs).selectExpr("doc_id", "xxhash64(body) as digest", "body"))
    space = decontaminate.fit_space(hashed)
    texts = [decontaminate.hash_words([text.encode()])[0].astype("<u4").tobytes() for _, _, _, text in rows[::4]]

    def share_of_pairs(space, **least):
        known = decontaminate._Items([(n, item.encode()) for n, item in enumerate(items)], space, 8, 0.6)
        known.latent[:] = True
        blocks = decontaminate._Blocks(texts, space)
        return sum(len(part[0]) for part in decontaminate._candidates(blocks, known, **least)) / (len(blocks.starts) * len(items))

    mask = np.repeat(space.any(axis=1)[:, None], space.shape[1], axis=1).astype(np.float32)
    usual = share_of_pairs(space, min_cosine=0.2, min_nearness=0.3)
    assert usual < 0.25 < share_of_pairs(mask, min_cosine=0.2, min_nearness=0.3)
    assert share_of_pairs(space, min_cosine=0.99, min_nearness=0.3) < usual / 20


def test_the_driver_holds_little_of_the_space(spark, documents, planted):
    """Arrays of the driver while the space is fitted and texts are searched: a copy or two of 12.6 MB, not many."""
    _, docs, items, _ = planted
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    decontaminate.find_leaks(documents, benchmark).collect()
    tracemalloc.start()
    decontaminate.find_leaks(docs, benchmark)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20


def test_space_is_that_of_the_plain_decomposition(spark, documents):
    """Inner products of features are those of a dense computation over all passages at once."""
    hashed = decontaminate._hashed(decontaminate.bodies(documents).selectExpr("doc_id", "xxhash64(body) as digest", "body"))
    rank, size = 24, decontaminate.STEP * decontaminate.PASSAGE
    space = decontaminate.fit_space(hashed, rank=rank).astype(np.float64)
    words = [np.frombuffer(row["words"], "<u4") & (decontaminate.FEATURES - 1) for row in hashed.collect()]
    passages = [part[low : low + size] for part in words for low in range(0, len(part), size)]
    df = np.bincount(np.concatenate([np.unique(passage) for passage in passages]), minlength=decontaminate.FEATURES)
    idf = np.where((df > 0) & (df <= max(0.05 * len(passages), 1)), np.log((1 + len(passages)) / (1 + df)) + 1, 0.0)
    omega = np.random.default_rng(decontaminate.SEED).standard_normal((decontaminate.FEATURES, rank))
    z = np.zeros((decontaminate.FEATURES, rank))
    for passage in passages:
        latent = (idf[passage, None] * omega[passage]).sum(axis=0) / max((idf[passage] ** 2).sum(), 1e-9)
        np.add.at(z, passage, latent)
    z *= idf[:, None]
    shift = 1e-6 * np.trace(omega.T @ z) / rank
    shifted = z + shift * omega
    inner = omega.T @ shifted
    lower = np.linalg.cholesky((inner + inner.T) / 2 + shift * np.eye(rank))
    basis, values, _ = np.linalg.svd(np.linalg.solve(lower, shifted.T).T, full_matrices=False)
    plain = idf[:, None] * basis / np.maximum(values, 1e-3 * values.max())
    on = np.flatnonzero(idf)[::7]
    expected = plain[on] @ plain[on].T
    assert np.allclose(space[on] @ space[on].T, expected, rtol=0, atol=2e-3 * np.abs(expected).max())
