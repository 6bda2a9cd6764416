"""Benchmark decontamination by latent semantic retrieval.

Passages are blocks of words with TF-IDF weights over hashed words. A
randomised SVD over all passages gives the latent space: every task adds up its
part of ``Z = A'(A omega)``, and the singular vectors and values follow from Z and
``omega' Z`` (Nystroem). Z stays in slices of features with the tasks; only products as small as
the rank come to the driver. Candidates are the pairs of passage and item whose cosine and
nearness in this space reach a threshold. A pair of which so many words are missing that the
share cannot be reached is told by bit sets of words; the others are aligned word by word by
the longest common subsequence. An item whose answer stands in the window needs a smaller share.
Items of which less than half the words weigh anything, being common, cannot be told by their
place: for them every passage is a candidate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.llm.common import bodies, slices, small_batches
from filehaul.storage import delete_stored, store_once

FEATURES = 1 << 15
RANK = 96
SEED = 11
# Words in a block, and blocks in a passage; passages overlap by half.
STEP = 24
PASSAGE = 2
# Features in a slice of the sums, and items sent to the tasks at once.
SLICE = 1 << 12
ITEMS = 5000
# Words of 64 bits in a bit set of words.
BITS = 8
# Items of which fewer words weigh are compared with all passages.
LEAST_WEIGHING = 0.5
_BREAKS = bytes(c if bytes([c]).isalnum() or c >= 128 else 32 for c in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words; all ASCII but letters and digits stands between words."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_BREAKS).split()


# Powers of an odd number and of its inverse, as many as the longest batch so far has bytes.
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    if size > len(_POWERS[0]):
        size = 1 << (size - 1).bit_length()
        for place, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[place] = np.multiply.accumulate(steps)
    return _POWERS


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words of all texts, one after the other, and the number of words of each text."""
    lowered = [text if text.isascii() else text.decode("utf-8", "replace").lower().encode() for text in texts]
    data = np.frombuffer(b" ".join([b"", *(text.translate(_BREAKS) for text in lowered), b""]), np.uint8)
    if len(data) < 3:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    inside = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    # A word is its bytes as digits, counted from its start: differences of sums over the whole batch.
    power, inverse = _powers(len(data))
    sums = np.cumsum(data * power[: len(data)], dtype=np.uint64)
    value = (sums[ends - 1] - sums[starts - 1]) * inverse[starts]
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    limits = np.cumsum([len(text) + 1 for text in lowered])
    return (value >> np.uint64(32)).astype(np.uint32), np.diff(np.searchsorted(starts, limits, "right"), prepend=0)


def _hashed(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, words``: 32-bit hashes of the words of whole texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=1 << 20):
            hashes, sizes = hash_words(texts)
            ends = np.cumsum(sizes)
            out = [hashes[end - size : end].astype("<u4").tobytes() for size, end in zip(sizes, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(out, pa.binary())],
                names=["doc_id", "digest", "words"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, digest long, words binary")


def _flat(texts: list[bytes], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts, where blocks of ``step`` words start, and the number of blocks of each text."""
    sizes = np.array([len(text) // 4 for text in texts], dtype=np.int64)
    words = np.frombuffer(b"".join(texts), "<u4")
    blocks = -(-sizes // step)
    place = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return words, np.repeat(np.cumsum(sizes) - sizes, blocks) + place * step, blocks


def _sum_blocks(table: np.ndarray, features: np.ndarray, block_of: np.ndarray, blocks: int) -> np.ndarray:
    """Sums of the table's rows of the features in each block; blocks hold few, in order. The table's last row is zero."""
    start = np.searchsorted(block_of, np.arange(blocks))
    place = np.arange(len(features)) - start[block_of]
    padded = np.full((int(place.max(initial=-1)) + 1, blocks), len(table) - 1, np.int32)
    padded[place, block_of] = features
    out = np.zeros((blocks, table.shape[1]), table.dtype)
    for each in padded:
        out += table[each]
    return out


def _add_rows(total: np.ndarray, features: np.ndarray, values: np.ndarray, rows: np.ndarray) -> None:
    """Add ``values[rows]`` to the rows ``features`` of the total; first what stands first for each, then second and so on."""
    order = np.argsort(features, kind="stable")
    ranked = features[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
    sizes = np.diff(first, append=len(ranked))
    nth = np.arange(len(ranked)) - np.repeat(first, sizes)
    by_nth = order[np.argsort(nth.astype(np.uint16) if len(nth) < 1 << 16 or nth.max() < 1 << 16 else nth, kind="stable")]
    start = 0
    for size in np.bincount(nth).tolist():
        part = by_nth[start : start + size]
        total[features[part]] += values[rows[part]]
        start += size


def _sum_slices(rows: DataFrame, each) -> DataFrame:
    """``slice, values``: sums over all tasks, a row for each slice, whatever the corpus."""
    # Every task sends whole arrays, however little it has read: tasks by cores, not by bytes.
    parts = rows.coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(each, "slice int, values binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, values in zip(batch.column("slice").to_pylist(), batch.column("values")):
                add = np.frombuffer(values.as_buffer(), "<f4")
                if number in sums:
                    sums[number] += add
                else:
                    sums[number] = add.astype(np.float64)
        for number in list(sums):
            yield _slice(number, sums.pop(number))

    return parts.repartition("slice").mapInArrow(run, "slice int, values binary")


def _whole(parts: DataFrame, width: int, kind: str = "<f8") -> np.ndarray:
    """An array of FEATURES rows from its slices."""
    out = np.zeros((FEATURES, width), kind)
    for row in parts.collect():
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["values"], kind).reshape(SLICE, width)
    return out


def _test_vectors(rank: int) -> Iterator[np.ndarray]:
    """Slices of omega: every task draws it again, as its seed is all that need be sent."""
    source = np.random.default_rng(SEED)
    for _ in range(FEATURES // SLICE):
        yield source.standard_normal((SLICE, rank))


def _each_slice(sketch: DataFrame, idf: np.ndarray, rank: int, work) -> DataFrame:
    """``slice, values`` with the arrays that ``work`` makes of each slice of Z, omega and idf."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, values in zip(batch.column("slice").to_pylist(), batch.column("values")):
                weight = idf[number * SLICE : (number + 1) * SLICE, None]
                omega = next(islice(_test_vectors(rank), number, None))
                out = work(weight * np.frombuffer(values.as_buffer()).reshape(SLICE, rank), omega, weight)
                yield _slice(number, out)

    return sketch.mapInArrow(run, "slice int, values binary")


def _small(parts: DataFrame, *shape: int) -> list[np.ndarray]:
    """Arrays of all slices, in order."""
    rows = sorted(parts.collect(), key=lambda row: row["slice"])
    return [np.frombuffer(row["values"]).reshape(shape) for row in rows]


def _slice(number: int, values: np.ndarray) -> pa.RecordBatch:
    """A row ``slice, values`` on the array's own memory."""
    values = np.ascontiguousarray(values)
    offsets = pa.py_buffer(np.array([0, values.nbytes], np.int32))
    column = pa.Array.from_buffers(pa.binary(), 1, [None, offsets, pa.py_buffer(values)])
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), column], names=["slice", "values"])


def _emit(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    for number in range(FEATURES // SLICE):
        yield _slice(number, total[number * SLICE : (number + 1) * SLICE].astype("<f4", copy=False))


def fit_space(hashed: DataFrame, max_df: float = 0.05, rank: int = RANK) -> np.ndarray:
    """Weight times place in the latent space of every feature, over all passages.

    Words in more than ``max_df`` of the passages weigh nothing.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((FEATURES, 2))
        for _, texts in slices(batches, "words"):
            words, starts, _ = _flat(texts, STEP * PASSAGE)
            if not len(words):
                continue
            # Features of each passage in order, so that each counts once; beyond a passage's end stands no feature.
            passage = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(words)))
            padded = np.full((len(starts), STEP * PASSAGE), FEATURES, np.uint16)
            padded[passage, np.arange(len(words)) - starts[passage]] = words & (FEATURES - 1)
            padded.sort(axis=1)
            first = np.ones(padded.shape, bool)
            first[:, 1:] = padded[:, 1:] != padded[:, :-1]
            found[:, 0] += np.bincount(padded[first], minlength=FEATURES + 1)[:FEATURES]
            found[0, 1] += len(starts)
        yield from _emit(found)

    counts = _whole(_sum_slices(hashed.select("words"), count), 2)
    passages, df = counts[0, 1], counts[:, 0]
    if not passages:
        return np.zeros((FEATURES, rank), np.float32)
    idf = np.where((df > 0) & (df <= max(max_df * passages, 1)), np.log((1 + passages) / (1 + df)) + 1, 0.0)

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = np.zeros((FEATURES + 1, rank), np.float32)
        for number, omega in enumerate(_test_vectors(rank)):
            on = slice(number * SLICE, (number + 1) * SLICE)
            weighted[on] = idf[on, None] * omega
        total = np.zeros((FEATURES, rank), np.float32)
        for _, texts in slices(batches, "words", 1 << 20):
            words, starts, _ = _flat(texts, STEP * PASSAGE)
            if not len(words):
                continue
            passage = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(words)))
            feature = (words & (FEATURES - 1)).astype(np.uint16)
            on = np.flatnonzero(idf[feature])
            feature, passage = feature[on], passage[on]
            latent = _sum_blocks(weighted, feature, passage, len(starts))
            # Each passage weighs the same, whatever its words.
            norm = np.bincount(passage, weights=idf[feature] ** 2, minlength=len(starts))
            latent /= np.maximum(norm, 1e-9)[:, None].astype(np.float32)
            _add_rows(total, feature, latent, passage)
        yield from _emit(total)

    sums, _ = store_once(_sum_slices(hashed.select("words"), sketch), "sketch")
    # A'A is near Z (omega'Z)^-1 Z'; a small shift keeps the inner matrix positive when passages are few.
    products = _each_slice(sums, idf, rank, lambda z, omega, _: np.stack([omega.T @ z, omega.T @ omega]))
    inner, plain = np.sum(_small(products, 2, rank, rank), axis=0)
    shift = 1e-6 * max(np.trace(inner) / rank, 1e-9)
    inner = inner + shift * plain
    lower = np.linalg.cholesky((inner + inner.T) / 2 + shift * np.eye(rank))
    # Singular values and right vectors of a tall matrix are those of the triangles of its slices.
    triangles = _each_slice(
        sums, idf, rank, lambda z, omega, _: np.linalg.qr(np.linalg.solve(lower, (z + shift * omega).T).T, mode="r")
    )
    _, values, right = np.linalg.svd(np.linalg.qr(np.concatenate(_small(triangles, rank, rank)), mode="r"))
    # Places count in units of their singular value, so that no single trend, such as the language, rules the cosine.
    turn = np.linalg.solve(lower.T, right.T / (values * np.maximum(values, 1e-3 * values.max())))
    space = _each_slice(sums, idf, rank, lambda z, omega, weight: (weight * ((z + shift * omega) @ turn)).astype("<f4"))
    space = _whole(space, rank, "<f4")
    delete_stored(sums)
    return space


def _bit_sets(words: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Bit sets of the words of each row."""
    on = np.zeros((rows, BITS * 64), bool)
    on[row, (words >> np.uint32(15)) & np.uint32(BITS * 64 - 1)] = True
    return np.packbits(on, axis=1).view(np.uint64)


class _Items:
    """Items as word hashes, bit sets of words, their place in the latent space, and their answers."""

    def __init__(self, rows: list[tuple[object, bytes]], space: np.ndarray, min_words: int, least_share: float) -> None:
        self.ids, self.words, self.answers, self.steps = [], [], [], []
        vectors, sets, searched = [], [], []
        weighs = space.any(axis=1)
        for item_id, text in rows:
            words, _ = hash_words([text])
            if len(words) < min_words:
                continue
            # The answer is the last sentence or line.
            ends = [part for part in text.replace(b"\n", b".").split(b".") if words_of(part)]
            features = words & (FEATURES - 1)
            self.ids.append(item_id)
            self.words.append(words.tolist())
            self.answers.append(hash_words([ends[-1]])[0].tolist())
            vectors.append(space[features].sum(axis=0, dtype=np.float64))
            sets.append(_bit_sets(words, np.zeros(len(words), np.int64), 1)[0])
            searched.append(weighs[features].mean() >= LEAST_WEIGHING)
            # Blocks of the passages that it is looked for in: few lengths in all, however many items.
            steps = PASSAGE
            while steps * STEP * 4 < len(words) * 3:
                steps *= 2
            self.steps.append(steps)
        self.vectors = np.array(vectors).reshape(len(self.ids), space.shape[1])
        self.lengths = np.maximum(np.linalg.norm(self.vectors, axis=1), 1e-9)
        self.sets = np.array(sets, np.uint64).reshape(len(self.ids), BITS)
        # Whether the latent space decides on its candidates.
        self.latent = np.array(searched, bool)
        # Words that may be missing.
        self.spare = np.array([int((1 - least_share) * len(words) + 1e-9) for words in self.words], np.int64)
        self.masks = []
        for words in self.words:
            masks: dict[int, int] = {}
            for place, word in enumerate(words):
                masks[word] = masks.get(word, 0) | 1 << place
            self.masks.append(masks)

    def shared(self, item: int, window: list[int], least: float) -> int:
        """Length of the longest common subsequence, by bits; 0 if the window holds fewer than ``least`` of the words."""
        masks, size = self.masks[item], len(self.words[item])
        hits = [masks[word] for word in window if word in masks]
        if len(hits) < least:
            return 0
        every = (1 << size) - 1
        state = every
        for mask in hits:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & every
        return size - state.bit_count()

    def answered(self, item: int, window: list[int]) -> bool:
        answer = self.answers[item]
        span = len(answer)
        return any(window[i : i + span] == answer for i in range(len(window) - span + 1))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    min_cosine: float = 0.2,
    min_nearness: float = 0.3,
    min_share: float = 0.8,
    min_share_with_answer: float = 0.6,
    min_words: int = 8,
) -> DataFrame:
    """``doc_id, digest, item_id, share, nearness, answer, first_word, last_word`` of texts that hold an item.

    Candidates are passages at a cosine of ``min_cosine`` and a nearness of ``min_nearness`` to the item.
    ``nearness`` is the cosine times the passage's length in the latent space over the item's (which makes good for
    the passage's other words, so that a passage with the whole item is near 1). For an item of which less than half the
    words weigh, all passages are candidates. ``share`` is that of the item's words in order in a passage
    with its neighbours; a pair of text and item has the row of its best window. ``digest`` is the
    XXH64 of the text, which tells rows with one id apart; rows that stand twice
    have one row. A null or empty text holds nothing. Items with fewer than
    ``min_words`` words, or null, are not searched for; an empty benchmark finds
    nothing. Null ids are values like others. Other columns are left out.
    """
    source = bodies(docs, id_column, text_column).withColumn("digest", F.xxhash64("body"))
    with small_batches(docs.sparkSession):
        hashed, _ = store_once(_hashed(source), "word-hashes")
        space = fit_space(hashed)
    kind = source.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema[item_id_column].dataType.simpleString()
    schema = (
        f"doc_id {kind}, digest long, item_id {item_kind}, share double, nearness double, answer boolean, "
        "first_word long, last_word long"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    arrow_kind = pa.schema(_arrow(docs, id_column)).field(0).type, pa.schema(_arrow(benchmark, item_id_column)).field(0).type

    def search(block: list[tuple[object, bytes]]) -> DataFrame:
        items = _Items(block, space, min_words, min(min_share, min_share_with_answer))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches, "words", 1 << 20):
                rows = list(_search(texts, items, space, min_share, min_share_with_answer, min_cosine, min_nearness))
                if not rows:
                    continue
                row, item, *rest = zip(*rows)
                taken = pa.array(row)
                arrays = [batch.column("doc_id").take(taken), batch.column("digest").take(taken)]
                arrays.append(pa.array([items.ids[i] for i in item], arrow_kind[1]))
                kinds = [pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()]
                arrays += [pa.array(values, t) for values, t in zip(rest, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        return hashed.mapInArrow(run, schema)

    def stored(block: list[tuple[object, bytes]]) -> DataFrame:
        with small_batches(docs.sparkSession):
            return store_once(search(block), "leaks")[0]

    found = None
    block: list[tuple[object, bytes]] = []
    rows = bodies(benchmark, item_id_column, item_text_column).toLocalIterator()
    for row in rows:
        block.append((row["doc_id"], bytes(row["body"])))
        if len(block) == ITEMS:
            part = stored(block)
            found, block = part if found is None else found.unionByName(part), []
    if block or found is None:
        part = stored(block)
        found = part if found is None else found.unionByName(part)
    delete_stored(hashed)
    best = F.max(F.struct("share", "nearness", "answer", "first_word", "last_word")).alias("best")
    return found.groupBy("doc_id", "digest", "item_id").agg(best).select("doc_id", "digest", "item_id", "best.*")


def _arrow(rows: DataFrame, column: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [pa.field(column, to_arrow_type(rows.schema[column].dataType))]


class _Blocks:
    """Blocks of words of some texts: sums of places in the latent space up to each, and bit sets."""

    def __init__(self, texts: list[bytes], space: np.ndarray) -> None:
        self.words, self.starts, blocks = _flat(texts, STEP)
        count = len(self.starts)
        features = self.words & (FEATURES - 1)
        block_of = np.repeat(np.arange(count), np.diff(self.starts, append=len(self.words)))
        on = np.flatnonzero(space.any(axis=1)[features])
        self.total = np.zeros((count + 1, space.shape[1]))
        padded = np.concatenate([space, np.zeros((1, space.shape[1]), space.dtype)])
        np.cumsum(_sum_blocks(padded, features[on], block_of[on], count), axis=0, out=self.total[1:])
        self.sets = _bit_sets(self.words, block_of, count)
        self.text_of = np.repeat(np.arange(len(texts)), blocks)
        self.last = np.repeat(np.cumsum(blocks), blocks)
        self.first = self.last - np.repeat(blocks, blocks)
        sizes = np.array([len(text) // 4 for text in texts], dtype=np.int64)
        self.begins = np.cumsum(sizes) - sizes
        self.ends = np.cumsum(sizes)


def _candidates(
    blocks: _Blocks, items: _Items, min_cosine: float, min_nearness: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First and last block of windows, number of the item, nearness, and whether enough words may stand there."""
    place_in = np.arange(len(blocks.starts)) - blocks.first
    steps = np.array(items.steps)
    for length in np.unique(steps).tolist():
        # Passages start at every half; of those that the end of their text cuts, one is enough.
        half = length // 2
        cut = np.arange(len(blocks.starts)) + length - blocks.last
        places = np.flatnonzero((place_in % half == 0) & ((cut < half) | (place_in == 0) | (cut == half)))
        chosen = np.flatnonzero(steps == length)
        vectors = (items.vectors[chosen] / items.lengths[chosen, None] ** 2).astype(np.float32).T
        told = items.latent[chosen]
        size = max(64, (1 << 21) // len(chosen))
        for low in range(0, len(places), size):
            part = places[low : low + size]
            ends = np.minimum(part + length, blocks.last[part])
            passage = (blocks.total[ends] - blocks.total[part]).astype(np.float32)
            nearness = passage @ vectors
            # The cosine is the nearness times the item's length over the passage's.
            lengths = np.maximum(np.linalg.norm(passage, axis=1), 1e-9)
            least = np.maximum(min_nearness, min_cosine * lengths[:, None] / items.lengths[chosen].astype(np.float32))
            at, item = np.nonzero((nearness >= least) | ~told)
            # Each passage with half of one before and after it, as far as the text goes.
            from_ = np.maximum(part - half, blocks.first[part])
            to = np.minimum(part + length + half, blocks.last[part])
            sets = np.zeros((len(part), BITS), np.uint64)
            for step in range(2 * length):
                sets |= blocks.sets[np.minimum(from_ + step, to - 1)]
            # Each bit that the window lacks is a word that it lacks.
            lacks = np.zeros(len(at), np.int64)
            for each in range(BITS):
                lacks += np.bitwise_count(items.sets[chosen[item], each] & ~sets[at, each])
            yield from_[at], to[at], chosen[item], nearness[at, item], lacks <= items.spare[chosen[item]]


def _search(
    texts: list[bytes], items: _Items, space: np.ndarray, min_share: float, min_answered: float, min_cosine: float, min_nearness: float
) -> Iterator[tuple]:
    """Row, item, share, nearness, answer, first and last word of leaks in texts of word hashes."""
    blocks = _Blocks(texts, space)
    if not len(blocks.words) or not items.ids:
        return
    best: dict[tuple[int, int], tuple] = {}
    for from_, to, item, nearness, enough in _candidates(blocks, items, min_cosine, min_nearness):
        for each in np.flatnonzero(enough):
            which, row = int(item[each]), int(blocks.text_of[from_[each]])
            low = int(blocks.starts[from_[each]])
            high = min(int(blocks.starts[to[each] - 1]) + STEP, int(blocks.ends[row]))
            size = len(items.words[which])
            inside = blocks.words[low:high].tolist()
            share = items.shared(which, inside, min_answered * size) / size
            if share < min_answered:
                continue
            answer = items.answered(which, inside)
            if share < min_share and not answer:
                continue
            begin = int(blocks.begins[row])
            found = (share, float(nearness[each]), answer, low - begin, high - begin)
            if found > best.get((row, which), ()):
                best[row, which] = found
    for (row, which), found in sorted(best.items()):
        yield (row, which, *found)
