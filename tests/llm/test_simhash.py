import numpy as np
import pandas as pd
import pytest
import xxhash

from filehaul.llm import simhash
from filehaul.llm.graph import connected_components
from filehaul.llm.queries import op5_simhash

from .conftest import DATA


def fingerprint(text, size=3):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    array = np.array(values, np.uint64)
    for i in range(len(array)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_query(spark, documents):
    rows = sorted(documents.select("doc_id", "text").collect())
    prints = [fingerprint(row["text"]) for row in rows]
    roots = components(prints, 2)
    expected = [(r["doc_id"], f"{p:016x}", rows[root]["doc_id"]) for r, p, root in zip(rows, prints, roots)]
    assert sorted(map(tuple, op5_simhash(spark, DATA).collect())) == expected


@pytest.mark.parametrize("count, flips, radius", [(300, 3, 2), (5000, 4, 2), (200, 5, 3)])
def test_dense_groups(spark, count, flips, radius):
    """Many fingerprints near few centres, so that shards hold several trees."""
    source = np.random.default_rng(count)
    values = source.integers(0, 2**63, 4, dtype=np.uint64)[source.integers(0, 4, count)]
    for _ in range(flips):
        values ^= np.uint64(1) << source.integers(0, 64, count).astype(np.uint64)
    values = np.unique(values)
    table = spark.createDataFrame(pd.DataFrame({"fp": values.view(np.int64)}))
    found = connected_components(simhash.link_fingerprints(table, radius)).toPandas()
    groups = {frozenset(nodes) for nodes in found.groupby("root").node.apply(list)}
    signed = values.view(np.int64).tolist()
    expected: dict = {}
    for place, root in enumerate(components(values.tolist(), radius)):
        expected.setdefault(root, []).append(signed[place])
    assert groups == {frozenset(nodes) for nodes in expected.values() if len(nodes) > 1}


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(7, 7), (None, 3)], "u long, v long")
    assert {row["root"] for row in connected_components(links).collect()} == {0}


def test_odd_rows(odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {(row["doc_id"], row["fp"]): row["component_id"] for row in found}
    assert by_id[2, 0] == by_id[3, 0] == by_id[4, 0] == by_id[None, 0] == 2
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    # Equal rows, rows without words, and others alone.
    assert kept.count() == 5
