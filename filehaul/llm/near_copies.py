"""Near copies by the exact Jaccard similarity of their sets of word shingles.

Candidates come from SimHash links and from bands of MinHash values: two sets
of a similarity of 0.8 share one of 12 bands of 3 with a chance of 0.9998, more
alike ones with more. Candidates must be alike in size, which loses nothing, and
agree in as many MinHash values as sets of the similarity do but for a chance
below one in a million. No candidate counts before its sets have been compared.
Of the texts of a band and size first each meets one hub, twice, so a large group
of copies costs a pair or two a text. Then those meet that no link has joined
yet: a band is cut into blocks, two blocks at a time are compared in a task by
their sketches, and only pairs that these let pass are rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filehaul.llm.common import fresh_name, give_back, release, slices, small_batches
from filehaul.llm.graph import connected_components
from filehaul.llm.simhash import _majority, link_fingerprints, shingles
from filehaul.storage import delete_stored, store_once

BANDS = 12
ROWS = 3
HUB_ROUNDS = 2
# Texts of a band that are compared with as many others in one task, and pairs of them looked at together.
BLOCK = 512
PAIRS = 1 << 18
# Least hashes of a set in its sketch; a set of no more is there as a whole.
LOWEST = 512
# Deviations by which a sketch may fall short of the similarity.
DEVIATIONS = 5
# Shingles hashed together for the bands.
PIECE = 1 << 14
_FACTORS = np.random.default_rng(23).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(members: np.ndarray) -> np.ndarray:
    """MinHash values of a set of hashes."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for start in range(0, len(members), PIECE):
        np.minimum(least, (_FACTORS[:, None] * members[None, start : start + PIECE]).min(axis=1), out=least)
    return least


def bands_of(least: np.ndarray) -> list[int]:
    """Band values of MinHash values."""
    digests = [xxhash.xxh64_intdigest(part.tobytes(), band) for band, part in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(digests, np.uint64).view(np.int64).tolist()


def fewest_equal(least: float) -> int:
    """MinHash values in which sets of the similarity agree, less some deviations."""
    n = BANDS * ROWS
    return math.floor(n * least - DEVIATIONS * math.sqrt(n * least * (1 - least)))


class Lowest:
    """Sketches of many sets: their least hashes, sorted, and what they tell of the similarity to another set."""

    def __init__(self, parts: list[np.ndarray]) -> None:
        self.sizes = np.array([len(part) for part in parts])
        self.hashes = np.full((len(parts), LOWEST), (1 << 64) - 1, np.uint64)
        for row, part in zip(self.hashes, parts):
            row[: len(part)] = part
        self.known = np.unique(self.hashes)
        self.number = np.searchsorted(self.known, self.hashes)
        # Up to its end a sketch is complete.
        self.ends = np.where(self.sizes == LOWEST, self.hashes[:, -1], np.uint64((1 << 64) - 1))

    def may_be_alike(self, a: np.ndarray, rows: np.ndarray, least: float) -> np.ndarray:
        """Whether the sets of ``rows`` may have the similarity to that with the least hashes ``a``; exact for whole sets."""
        at = np.minimum(np.searchsorted(self.known, a), len(self.known) - 1)
        flags = np.zeros(len(self.known), bool)
        flags[at[self.known[at] == a]] = True
        flags[-1] &= self.known[-1] != np.uint64((1 << 64) - 1)
        common = flags[self.number[rows]].sum(axis=1)
        end = a[-1] if len(a) == LOWEST else np.uint64((1 << 64) - 1)
        both = np.minimum(self.ends[rows], end)
        theirs = np.minimum((self.hashes[rows] <= both[:, None]).sum(axis=1), self.sizes[rows])
        union = np.searchsorted(a, both, "right") + theirs - common
        whole = (len(a) < LOWEST) & (self.sizes[rows] < LOWEST)
        slack = np.where(whole, 0.0, DEVIATIONS * np.sqrt(least * (1 - least) / np.maximum(union, 1)))
        return common >= (least - slack) * union


def _sketches(keyed: DataFrame, words: int) -> DataFrame:
    """``key, fp, node, size, bands, marks`` for rows ``key, body``.

    ``node`` is the digest of the whole set, ``size`` its members, ``marks`` the
    upper halves of its MinHash values. A set without members has no bands.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            fps, nodes = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
            bands, sizes, marks = [], [], []
            for place, text in enumerate(texts):
                hashes = shingles(text, words)
                if len(hashes):
                    fps[place] = hashes[0] if len(hashes) == 1 else _majority(hashes)
                members = np.unique(hashes)
                nodes[place] = xxhash.xxh64_intdigest(members.tobytes())
                sizes.append(len(members))
                least = minima(members)
                bands.append(bands_of(least) if len(members) else [])
                marks.append((least >> np.uint64(32)).astype(np.uint32).tobytes())
            arrays = [batch.column("key"), pa.array(fps.view(np.int64)), pa.array(nodes.view(np.int64)), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["key", "fp", "node", "size", "bands", "marks"],
            )

    kind = keyed.schema["key"].dataType.simpleString()
    return keyed.mapInArrow(run, f"key {kind}, fp long, node long, size long, bands array<long>, marks binary")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``node, members`` for rows ``node, body``: the sorted hashes of the set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            members = [np.unique(shingles(text, words)).tobytes() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(members, pa.binary())], names=["node", "members"]
            )

    return rows.select("node", "body").mapInArrow(run, "node long, members binary")


def _fit(one: str, other: str, least: float) -> Column:
    """Whether sets of these sizes can reach the similarity."""
    return (F.col(one) >= F.col(other) * F.lit(least)) & (F.col(other) >= F.col(one) * F.lit(least))


def _agreeing(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs ``u, v`` that agree in enough MinHash values."""
    fewest = fewest_equal(least)
    marks = lambda end: nodes.select(F.col("node").alias(end), F.col("marks").alias(f"{end}_marks"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32) for name in ("u_marks", "v_marks"))
            mask = pa.array((u == v).reshape(batch.num_rows, BANDS * ROWS).sum(axis=1) >= fewest)
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(mask), batch.column("v").filter(mask)], names=["u", "v"])

    joined = pairs.join(marks("u"), "u").join(marks("v"), "v")
    return joined.select("u", "v", "u_marks", "v_marks").mapInArrow(run, "u long, v long")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``u, v`` whose sets have a Jaccard similarity of at least ``least``."""
    left = sets.select(F.col("node").alias("u"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("members").alias("right"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("left"), batch.column("right")):
                a, b = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(common >= least * (len(a) + len(b) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(mask), batch.column("v").filter(mask)], names=["u", "v"])
        give_back()

    joined = pairs.join(left, "u").join(right, "v")
    return joined.select("u", "v", "left", "right").mapInArrow(run, "u long, v long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _several(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows of those keys that have several roots."""
    ends = rows.groupBy(*keys).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rows.join(ends.where("low <> high").select(*keys), list(keys))


def _grade(least: float, shift: float) -> Column:
    """Number of a range of sizes; sets of the similarity are in one or in two that follow one another."""
    return F.floor(F.log("size") / F.lit(math.log(1.0001 / least)) + F.lit(shift))


def _pairs_with_hubs(rooted: DataFrame, turn: int, least: float) -> DataFrame:
    """Each node with the hub of its band and size; the ranges of sizes of the next turn begin elsewhere."""
    open_ = _several(rooted.withColumn("grade", _grade(least, turn / HUB_ROUNDS)), "band", "grade")
    hubs = open_.groupBy("band", "grade").agg(F.min_by(F.struct("node", "root", "size"), F.xxhash64("node", F.lit(turn))).alias("hub"))
    met = open_.join(hubs, ["band", "grade"]).where(F.expr("root <> hub.root") & _fit("size", "hub.size", least))
    return met.select(F.col("node").alias("u"), F.col("hub.node").alias("v"))


def _compare_blocks(group: pa.Table, least: float) -> pa.Table:
    """The pairs ``u, v`` of two blocks of a band, or within one, that may be alike and share no band before it."""
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    node, root, size, own = (group.column(name).to_numpy() for name in ("node", "root", "size", "own"))
    bands = np.array(group.column("bands").to_pylist(), np.int64)
    marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint32).reshape(len(node), -1)
    lowest = [np.frombuffer(part, np.uint64) for part in group.column("lowest").to_pylist()]
    sketches = Lowest(lowest)
    this = int(np.flatnonzero(bands[0] == group.column("band")[0].as_py())[0])
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    u, v, step = [], [], max(1, PAIRS // max(1, len(right)))
    for start in range(0, len(left), step):
        one = left[start : start + step]
        open_ = root[one, None] != root[None, right]
        open_ &= (size[one, None] >= least * size[None, right]) & (size[None, right] >= least * size[one, None])
        if low == high:
            open_ &= node[one, None] < node[None, right]
        for before in range(this):
            open_ &= bands[one, None, before] != bands[None, right, before]
        i, j = np.nonzero(open_)
        i, j = one[i], right[j]
        agree = (marks[i] == marks[j]).sum(axis=1) >= fewest_equal(least)
        i, j = i[agree], j[agree]
        for a in np.unique(i):
            others = j[i == a]
            others = others[sketches.may_be_alike(lowest[a], others, least)]
            u.append(np.full(len(others), node[a]))
            v.append(node[others])
    u, v = (np.concatenate([np.empty(0, np.int64), *parts]) for parts in (u, v))
    return pa.table({"u": u, "v": v})


def _pairs_of_bands(rooted: DataFrame, nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs of different roots that share a band and may be alike: every block of the band meets every other and itself."""
    open_ = _several(rooted.select("band", "node", "root"), "band")
    counts = open_.groupBy("band").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    dealt = open_.join(counts, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    sketches = nodes.select("node", "size", "bands", "marks").join(sets.select("node", F.expr(f"substring(members, 1, {8 * LOWEST})").alias("lowest")), "node")
    dealt = dealt.join(sketches, "node")
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "blocks")
    # The rows are few and the work on them is not: tasks by number, not by bytes.
    spark = rooted.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return met.repartition(tasks, "band", "low", "high").groupBy("band", "low", "high").applyInArrow(lambda group: _compare_blocks(group, least), "u long, v long")


def _roots(nodes: DataFrame, source: DataFrame, words: int, radius: int, least: float) -> DataFrame:
    """``node, root`` of all nodes that are linked to others."""
    spread = nodes.select("node", "size", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets, _ = store_once(spread.join(shared, "band"), "buckets")
    # SimHash: fingerprints within the radius, and sets of one fingerprint.
    by_fp, _ = store_once(nodes.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("hub")), "fingerprints")
    links = link_fingerprints(by_fp.select("fp"), radius)
    near = links.join(by_fp.select(F.col("fp").alias("u"), F.col("hub").alias("a")), "u")
    near = near.join(by_fp.select(F.col("fp").alias("v"), F.col("hub").alias("b")), "v").select("a", "b")
    near = near.unionByName(nodes.join(by_fp, "fp").select(F.struct("node", "size").alias("a"), F.col("hub").alias("b")))
    near = near.where(_fit("a.size", "b.size", least)).select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
    near, _ = store_once(_agreeing(_ordered(near), nodes, least), "near-fingerprints")

    ends = near.select(F.explode(F.array("u", "v")).alias("node")).unionByName(buckets.select("node")).distinct()
    wanted = nodes.join(ends, "node").select("node", F.col("least.key.id").alias("of"), F.col("least.key.digest").alias("of_digest"))
    same = F.col("key.id").eqNullSafe(F.col("of")) & (F.col("key.digest") == F.col("of_digest"))
    with small_batches(source.sparkSession):
        sets, _ = store_once(_sets(source.join(wanted, same).dropDuplicates(["node"]), words), "shingle-sets")

    proven = tested = roots = None
    stored = [buckets, by_fp, near, sets]
    for turn in range(HUB_ROUNDS + 1):
        if roots is None:
            rooted = buckets.withColumn("root", F.col("node"))
        else:
            rooted = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if turn < HUB_ROUNDS:
            pairs = _agreeing(_ordered(_pairs_with_hubs(rooted, turn, least)), nodes, least)
        else:
            pairs = _ordered(_pairs_of_bands(rooted, nodes, sets, least))
        pairs = pairs.unionByName(near).distinct() if tested is None else pairs.join(tested, ["u", "v"], "left_anti")
        pairs, seen = store_once(pairs, "pairs", {"pairs": F.count("*")})
        stored.append(pairs)
        if not seen["pairs"] and roots is not None:
            continue
        with small_batches(source.sparkSession):
            found, _ = store_once(_alike(pairs, sets, least), "alike")
        release(source.sparkSession)
        tested = pairs if tested is None else tested.unionByName(pairs)
        proven = found if proven is None else proven.unionByName(found)
        stored.append(found)
        before, roots = roots, connected_components(proven)
        if before is not None:
            delete_stored(before)
    delete_stored(*stored)
    return roots


def keep_first(
    docs: DataFrame,
    words: int = 5,
    radius: int = 3,
    least: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each component, with all columns: that of the smallest id, and of rows with one id the least text.

    Two texts are linked if the Jaccard similarity of their sets of shingles is
    at least ``least``. Rows with a null id stay only if their component has no
    other, one of them. Texts without words are one component.
    """
    body = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    digest = F.xxhash64(body)
    source = docs.select(F.struct(F.col(id_column).alias("id"), digest.alias("digest")).alias("key"), body.alias("body"))
    with small_batches(source.sparkSession):
        marked, _ = store_once(_sketches(source, words), "sketches")
    first = F.min(F.struct(F.col("key.id").isNull().alias("none"), "key")).alias("least")
    nodes = marked.groupBy("node").agg(first, F.min("fp").alias("fp"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    nodes, _ = store_once(nodes, "nodes")
    delete_stored(marked)
    roots = _roots(nodes, source, words, radius, least)
    of = nodes.join(roots, "node", "left")
    chosen = of.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    name = fresh_name(docs.columns, "chosen")
    chosen, _ = store_once(chosen.select(F.col("least.key").alias(name)), "chosen")
    delete_stored(nodes, roots)
    same = F.col(id_column).eqNullSafe(F.col(f"{name}.id")) & (digest == F.col(f"{name}.digest"))
    kept = docs.join(chosen, same, "left_semi")
    # Rows that stand twice are one.
    return kept.dropDuplicates([id_column, text_column])
