"""SimHash near-duplicates, linked through BK-trees over shards of the fingerprints.

The 64 bits are cut into radius + 2 blocks. Two fingerprints within the radius
agree in two blocks at least, so each pair of blocks with its values names a
shard, and every link lies within some shard. A shard is cut into trees of a
bounded number of fingerprints. Every tree is sent to all blocks of queries of
its shard, by a shuffle and not through the driver, and a query follows only
the edges whose distance is within the radius of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.llm.common import bodies, slices
from filehaul.llm.graph import connected_components
from filehaul.storage import store_once

BITS = 64
SEED = 42
# Fingerprints in a tree, and queries that pass a tree together.
TREE = 4096
QUERIES = 256


def fingerprints(
    docs: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, fp``: the SimHash of the word shingles of each whole text, as a signed long.

    Shingles count as often as they stand in the text. A text with fewer words
    is one shingle; one without words, or a null, has the fingerprint zero.
    Rows stay as they are: repeated ids and null ids keep their rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            out = np.zeros(len(texts), dtype=np.uint64)
            for place, text in enumerate(texts):
                hashes = shingles(text, words)
                if len(hashes):
                    out[place] = hashes[0] if len(hashes) == 1 else _majority(hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"]
            )

    source = bodies(docs, id_column, text_column)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, fp long")


def shingles(text: bytes, words: int) -> np.ndarray:
    """Hashes of the word shingles of a text, in order and as often as they stand in it."""
    digest = xxhash.xxh64_intdigest
    parts = text.lower().split()
    if len(parts) <= words:
        return np.array([digest(b" ".join(parts), SEED)] if parts else [], dtype=np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-words] + 1]).tolist()
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    return np.array(hashes, dtype=np.uint64)


def _majority(hashes: np.ndarray) -> np.uint64:
    """Bits set in over half of the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones = np.ones(len(part), dtype=np.float32) @ np.unpackbits(part, axis=1).astype(np.float32)
        counts += ones.astype(np.int64)
    return np.packbits(2 * counts > len(hashes)).view(">u8")[0]


class BKTree:
    """Fingerprints; the children of a node stand by their distance to it."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.children = np.full((len(keys), BITS + 1), -1, dtype=np.int32)
        # All keys sink at once, a level in each step; of those that meet at a free place the first takes it.
        rest, node = np.arange(1, len(keys)), np.zeros(max(0, len(keys) - 1), dtype=np.int64)
        while len(rest):
            apart = np.bitwise_count(keys[rest] ^ keys[node]).astype(np.int64)
            free = self.children[node, apart] < 0
            place = node[free] * (BITS + 1) + apart[free]
            _, first = np.unique(place, return_index=True)
            self.children.ravel()[place[first]] = rest[free][first]
            node = self.children[node, apart].astype(np.int64)
            on = node != rest
            rest, node = rest[on], node[on]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of keys at most ``radius`` apart."""
        ask, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ask):
            apart = np.bitwise_count(queries[ask] ^ self.keys[node]).astype(np.int64)
            near = apart <= radius
            found.append((ask[near], node[near]))
            asks, nodes = [], []
            for edge in range(-radius, radius + 1):
                at = apart + edge
                good = (at >= 0) & (at <= BITS)
                child = self.children[node[good], at[good]]
                asks.append(ask[good][child >= 0])
                nodes.append(child[child >= 0].astype(np.int64))
            ask, node = np.concatenate(asks), np.concatenate(nodes)
        return tuple(np.concatenate(part) for part in zip(*found)) if found else (ask, node)


def _joined(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest linked place of each place, after more pairs."""
    while True:
        low = np.minimum(root[left], root[right])
        after = root.copy()
        for side in (left, right):
            np.minimum.at(after, root[side], low)
        while (after != (up := after[after])).any():
            after = up
        if (after == root).all():
            return root
        root = after


def _link(tree: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that tie the queries to the tree's keys, few for each: within the tree only its components matter."""
    bk = BKTree(tree)
    own = np.arange(len(tree))
    for start in range(0, len(tree), QUERIES):
        ask, node = bk.within(tree[start : start + QUERIES], radius)
        own = _joined(own, ask + start, node)
    us, vs = [tree], [tree[own]]
    for start in range(0, len(queries), QUERIES):
        ask, node = bk.within(queries[start : start + QUERIES], radius)
        tied = np.unique(np.stack([ask, own[node]]), axis=1)
        us.append(queries[start : start + QUERIES][tied[0]])
        vs.append(tree[tied[1]])
    u, v = np.concatenate(us), np.concatenate(vs)
    return u[u != v], v[u != v]


def link_fingerprints(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``u, v`` that connect all fingerprints at most ``radius`` bits apart, given rows of distinct ``fp``.

    Not every pair is listed: within a tree each fingerprint is tied to the
    smallest place of its component, which keeps all that is linked together.
    """
    cuts = [BITS * place // (radius + 2) for place in range(radius + 3)]
    blocks = [
        F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1))
        for i in range(radius + 2)
    ]
    shards = F.array(
        *(
            F.struct(
                F.lit(number).alias("pair"),
                F.shiftleft(blocks[j], cuts[i + 1] - cuts[i]).bitwiseOR(blocks[i]).alias("value"),
            )
            for number, (i, j) in enumerate(combinations(range(radius + 2), 2))
        )
    )
    keyed = distinct.select("fp", F.inline(shards))
    sizes = keyed.groupBy("pair", "value").count().where("count > 1")
    members = keyed.join(sizes, ["pair", "value"])
    trees = F.ceil(F.col("count") / TREE).cast("int")
    members = members.select(
        "pair", "value", "fp", trees.alias("trees"), F.pmod(F.xxhash64("fp"), trees).cast("int").alias("own")
    )
    # A tree of its own piece; queries are the pieces after it, so that two pieces meet once.
    sent = members.select(
        "pair", "value", "fp", "own", F.explode(F.sequence(F.lit(0), "own")).alias("tree")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(parts: list) -> Iterator[pa.RecordBatch]:
            fps = np.concatenate([p[0] for p in parts]).view(np.uint64)
            own = np.concatenate([p[1] for p in parts])
            # Equal rows cannot be told from each other and make no link.
            tree = np.unique(fps[own])
            u, v = _link(tree, np.unique(fps[~own]), radius)
            if len(u):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
                )

        now, parts = None, []
        for batch in batches:
            pair, value, fp, own, tree = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            change = np.flatnonzero((np.diff(pair) != 0) | (np.diff(value) != 0) | (np.diff(tree) != 0)) + 1
            for low, high in zip([0, *change.tolist()], [*change.tolist(), len(fp)]):
                if low == high:
                    continue
                key = (pair[low], value[low], tree[low])
                if key != now and parts:
                    yield from ended(parts)
                    parts = []
                now = key
                parts.append((fp[low:high].copy(), own[low:high] == tree[low:high]))
        if parts:
            yield from ended(parts)

    return (
        sent.repartition("pair", "value", "tree")
        .sortWithinPartitions("pair", "value", "tree")
        .mapInArrow(run, "u long, v long")
    )


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    radius: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, fp, component_id``: one row per row; the smallest id reachable over links, its own included.

    Rows with a null id link others and get the component's smallest id; null
    if it has none. An empty table gives an empty result.
    """
    marked, _ = store_once(fingerprints(docs, words, id_column, text_column), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(link_fingerprints(distinct.select("fp"), radius))
    # Few fingerprints have links at all; the others are their own root.
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(
    docs: DataFrame, words: int = 5, radius: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component, with all columns: that of the smallest id, and of rows with one id the least text.

    Rows with a null id stay only if their component has no other, one of them.
    Texts without words are one component.
    """
    digest = F.xxhash64(F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")))
    keyed = docs.select(
        F.struct(F.col(id_column).alias("id"), digest.alias("digest")).alias("key"), F.col(text_column).alias("text")
    )
    marked, _ = store_once(fingerprints(keyed, words, "key", "text"), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id.id").isNull().alias("none"), "doc_id")).alias("least"))
    roots = connected_components(link_fingerprints(distinct.select("fp"), radius))
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    chosen = of.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
    chosen = chosen.select(F.col("least.doc_id.id").alias("chosen_id"), F.col("least.doc_id.digest").alias("chosen_digest"))
    chosen, _ = store_once(chosen, "chosen")
    same = F.col(id_column).eqNullSafe(F.col("chosen_id")) & (digest == F.col("chosen_digest"))
    kept = docs.join(chosen, same, "left_semi")
    # Rows that stand twice are one.
    return kept.dropDuplicates([id_column, text_column])
