"""A bigram model with Katz backoff, fitted and evaluated in buckets.

Counts are discounted by Good-Turing; what a context loses goes to the words
not seen after it, in proportion to their unigram probability, with a weight
that makes every context's probabilities sum to one. Unigrams are discounted
likewise, and what they lose is the probability of an unknown word.

Texts are taken in chunks. A chunk sends its distinct words, then its distinct
pairs with the documents they stand in, to buckets by hash; a bucket adds up
the counts of all chunks, evaluates each pair once, and sends sums by document
back. Pairs of a context lie in one bucket, but those of a context with very
many occurrences are dealt to all buckets, and its sums are put together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from filehaul.llm.common import release, slices
from filehaul.storage import delete_stored, store_once

# Words that stand for a text's start, as a context, and its end, as a token; no word has a space.
START, END = (xxhash.xxh64_intdigest(name) for name in (b" start", b" end"))
CHUNK_BYTES = 14 << 20
# Tokens for which a bucket is made. A context with over a quarter of this many is dealt to all buckets.
BUCKET_TOKENS = 1_500_000
# Of zstandard: packed arrays are written to disk several times, so their size counts more than the time.
LEVEL = 5
# Sums of documents that a task holds before it sends them.
HELD_SUMS = 1 << 22
# Counts up to this are discounted.
RELIABLE = 5


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: all first bytes, all second bytes and so on, compressed."""
    parts = []
    for array in arrays:
        planes = np.ascontiguousarray(array.view(np.uint8).reshape(len(array), array.itemsize).T)
        head = np.array([len(array), np.dtype(array.dtype).num], "<i8").tobytes()
        parts += [head, planes]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(parts))


_KINDS = {np.dtype(name).num: np.dtype(name) for name in ("uint16", "uint32", "uint64", "int64", "float64")}


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(data):
        size, number = np.frombuffer(data, "<i8", 2, at).tolist()
        kind = _KINDS[number]
        planes = np.frombuffer(data, np.uint8, size * kind.itemsize, at + 16).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 16 + size * kind.itemsize
    return out


def falls(values: np.ndarray) -> np.ndarray:
    """The first value, then by how much each is less than the one before; modulo 2**64."""
    return np.concatenate([values[:1], values[:-1] - values[1:]])


def fallen(steps: np.ndarray) -> np.ndarray:
    """The values of :func:`falls`."""
    return np.concatenate([steps[:1], steps[:1] - np.cumsum(steps[1:], dtype=steps.dtype)])


def pack_pairs(h: np.ndarray, w: np.ndarray, ch: np.ndarray, cw: np.ndarray, *more: np.ndarray) -> bytes:
    """Pairs sorted by the numbers of context and word, packed with the counts of both and other arrays.

    Numbers of words rise as their counts fall, so each count is sent once, in the order of the
    numbers, as a step that is mostly none.
    """
    _, first = np.unique(w, return_index=True)
    new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
    return pack(np.diff(h, prepend=np.uint64(0)), w, falls(ch[new]), falls(cw[first]), *more)


def unpack_pairs(data: bytes) -> list[np.ndarray]:
    """The arrays of :func:`pack_pairs`."""
    steps, w, ch, cw, *more = unpack(data)
    h = np.cumsum(steps, dtype=np.uint64)
    group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]) - 1
    _, word = np.unique(w, return_inverse=True)
    return [h, w, fallen(ch)[group], fallen(cw)[word], *more]


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def discounts(with_count: list[int]) -> np.ndarray:
    """Factor for the counts 0 to RELIABLE, from the numbers of n-grams that occur 1 to RELIABLE + 1 times.

    Good-Turing after Katz; if that leaves no factor in (0, 1], each count loses
    ``n1 / (n1 + 2 n2)`` instead.
    """
    n = np.array([0, *with_count], dtype=np.float64)
    factors = np.ones(RELIABLE + 1)
    if n[1] == 0:
        return factors
    cut = (RELIABLE + 1) * n[RELIABLE + 1] / n[1]
    counts = np.arange(1, RELIABLE + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        factors[1:] = ((counts + 1) * n[2:] / (counts * n[1:-1]) - cut) / (1 - cut)
    if not np.all((factors > 0) & (factors <= 1)):
        factors[1:] = (counts - n[1] / (n[1] + 2 * n[2])) / counts if n[2] else 0.5 / counts + (counts - 1) / counts
    return factors


@dataclass
class Unigrams:
    """Probability of a token by its count."""

    tokens: int
    words: int
    factors: np.ndarray
    scale: float
    unknown: float

    @classmethod
    def of(cls, tokens: int, words: int, with_count: list[int]) -> Unigrams:
        factors = discounts(with_count)
        if not tokens:
            return cls(0, 0, factors, 0.0, 1.0)
        lost = sum((1 - factors[r]) * r * with_count[r - 1] for r in range(1, RELIABLE + 1))
        known = min((tokens - lost) / tokens, tokens / (tokens + 1))
        return cls(tokens, words, factors, known * tokens / (tokens - lost), 1 - known)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        seen = self.scale * discounted(counts, self.factors) / self.tokens
        return np.where(counts > 0, seen, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= RELIABLE, factors[np.minimum(counts, RELIABLE).astype(np.int64)], 1.0)


def _chunked(source: DataFrame) -> DataFrame:
    """``chunk, ids, held, sizes, words, stream`` for rows ``doc_id, held, body``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, number = TaskContext.get().partitionId(), 0
        ids: list = []
        held: list[bool] = []
        sizes: list[int] = []
        streams: list[np.ndarray] = []
        places, room = _Places(), CHUNK_BYTES

        def ended() -> pa.RecordBatch:
            keys = np.array([END if w is None else xxhash.xxh64_intdigest(w) for w in places], np.uint64)
            order = np.argsort(keys)
            stream = np.concatenate(streams)
            learn = np.repeat(~np.array(held), sizes)
            learned = np.bincount(stream[learn], minlength=len(keys)).astype(np.uint32)[order]
            # Words are sorted by hash, but the text numbers them by frequency, which packs better.
            often = np.argsort(-np.bincount(stream, minlength=len(keys)), kind="stable")
            number, place = np.empty(len(order), np.uint32), np.empty(len(order), np.uint32)
            number[often] = np.arange(len(often))
            place[order] = np.arange(len(order))
            packed = pack(place[often], number[stream])
            arrays = [
                pa.array([f"{name}-{number}"]), pa.array([ids], pa.list_(id_kind)), pa.array([held], pa.list_(pa.bool_())),
                pa.array([sizes], pa.list_(pa.int64())), pa.array([pack(keys[order], learned)], pa.binary()),
                pa.array([packed], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "ids", "held", "sizes", "words", "stream"])

        for batch, texts in slices(batches):
            for doc_id, hold, text in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), texts):
                if ids and len(text) > room:
                    yield ended()
                    number += 1
                    ids, held, sizes, streams, places, room = [], [], [], [], _Places(), CHUNK_BYTES
                stream = list(map(places.__getitem__, text.lower().split()))
                stream.append(places[None])
                ids.append(doc_id)
                held.append(hold)
                sizes.append(len(stream))
                streams.append(np.array(stream, np.int32))
                room -= len(text)
        if ids:
            yield ended()

    id_kind = to_arrow_type(source.schema["doc_id"].dataType)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"chunk string, ids array<{kind}>, held array<boolean>, sizes array<long>, words binary, stream binary"
    )


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _by_bucket(rows: DataFrame, work, schema: str) -> DataFrame:
    """Give all rows ``bucket, chunk, data`` of a bucket to ``work(bucket, chunks, datas)``, which yields batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunks, datas = None, [], []
        for batch in batches:
            for bucket, chunk, data in zip(*(batch.column(name).to_pylist() for name in ("bucket", "chunk", "data"))):
                if bucket != now and chunks:
                    yield from work(now, chunks, datas)
                    chunks, datas = [], []
                now = bucket
                chunks.append(chunk)
                datas.append(data)
        if chunks:
            yield from work(now, chunks, datas)

    return rows.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(run, schema)


def _unigram_answers(chunks: DataFrame, buckets: int) -> DataFrame:
    """The unigram table by bucket, and what each chunk's words have there.

    Rows with a chunk: ``bucket, chunk, data`` with the counts of the chunk's
    words, by place, and the places. Rows without: ``data`` with hashes and counts, ``with_count``,
    ``tokens`` and ``words``.
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words in zip(batch.column("chunk").to_pylist(), batch.column("words").to_pylist()):
                keys, learned = unpack(words)
                cuts = np.searchsorted(_bucket_of(keys, buckets), np.arange(buckets + 1))
                on = np.flatnonzero(np.diff(cuts))
                data = [pack(keys[cuts[b] : cuts[b + 1]], learned[cuts[b] : cuts[b + 1]]) for b in on]
                arrays = [pa.array(on, pa.int32()), pa.array([chunk] * len(on)), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "data"])

    def answer(bucket: int, names: list[str], datas: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(data) for data in datas]
        keys, place = np.unique(np.concatenate([part[0] for part in parts]), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([part[1] for part in parts])).astype(np.uint64)
        # Places go by frequency, so that those of most words are small numbers.
        often = np.argsort(counts, kind="stable")[::-1]
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        keys, counts, place = keys[often], counts[often], rank[place]
        ends = np.cumsum([len(part[0]) for part in parts])
        known = counts > 0
        with_count = np.bincount(np.minimum(counts, RELIABLE + 2).astype(np.int64), minlength=RELIABLE + 3)
        data = [pack(falls(counts[np.sort(at)]), at.astype(np.uint32)) for at in np.split(place, ends[:-1])]
        data.append(pack(keys[known], counts[known]))
        size = len(data)
        stats = [[None] * (size - 1) + [value] for value in (with_count[1 : RELIABLE + 2].tolist(), int(counts.sum()), int(known.sum()))]
        arrays = [
            pa.array([bucket] * size, pa.int32()), pa.array([*names, None], pa.string()), pa.array(data, pa.binary()),
            pa.array(stats[0], pa.list_(pa.int64())), pa.array(stats[1], pa.int64()), pa.array(stats[2], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "data", "with_count", "tokens", "words"])

    sent = chunks.select("chunk", "words").mapInArrow(send, "bucket int, chunk string, data binary")
    return _by_bucket(sent, answer, "bucket int, chunk string, data binary, with_count array<long>, tokens long, words long")


def _pairs(chunks: DataFrame, answers: DataFrame, buckets: int, unigrams: Unigrams, starts: int, often: int) -> DataFrame:
    """``bucket, chunk, data``: the distinct pairs of each chunk, and its base scores in buckets below zero."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = [unpack(answer["data"]) for answer in row["answers"]]
                # In the order of the places, as the counts are.
                counts = np.concatenate([fallen(part[0]) for part in parts])
                # A word's number: its bucket and its place there.
                word = np.concatenate([np.uint64(a["bucket"]) << np.uint64(40) | p[1] for a, p in zip(row["answers"], parts)])
                order = np.argsort(word)
                word, ranked = word[order], np.empty(len(order), np.uint32)
                ranked[order] = np.arange(len(order), dtype=np.uint32)
                place, stream = unpack(row["stream"])
                stream = ranked[place][stream]
                sizes = np.array(row["sizes"], np.int64)
                learn = np.repeat(~np.array(row["held"]), sizes)
                doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
                first = np.cumsum(sizes) - sizes
                base = np.add.reduceat(unigrams.base(counts.astype(np.float64))[stream], first)
                known = np.add.reduceat((counts > 0)[stream], first, dtype=np.int64)
                number = len(word)
                # In place: these arrays are the task's largest.
                pair = np.empty(len(stream), np.int64)
                pair[1:] = stream[:-1]
                pair[first] = number
                pair *= number + 1
                pair += stream
                del stream
                order = np.argsort(pair, kind="stable")
                ranked = pair[order]
                docs, learn = doc[order], learn[order]
                del pair, order, doc
                new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                size = np.diff(new, append=len(ranked))
                ranked = ranked[new]
                h, w = (ranked // (number + 1)).astype(np.int32), (ranked % (number + 1)).astype(np.int32)
                del ranked
                words = np.concatenate([word, [np.uint64(2**64 - 1)]])
                ch = np.concatenate([counts, [np.uint64(starts)]])[h]
                # Pairs are in the order of the words' numbers.
                seen = np.add.reduceat(learn, new, dtype=np.uint32)
                del learn
                # Contexts are dealt by themselves, frequent ones by the pair.
                mixed = words[h] * np.uint64(0x9E3779B97F4A7C15)
                dealt = ch > often
                mixed[dealt] ^= words[w[dealt]] * np.uint64(0xD6E8FEB86659FD93)
                mixed ^= mixed >> np.uint64(31)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                bucket = _bucket_of(mixed, buckets).astype(np.int32)
                del mixed, dealt
                by_bucket = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
                del bucket
                out = [-1 - xxhash.xxh32_intdigest(row["chunk"]) % buckets]
                data = [pack(known, base)]
                for number in range(buckets):
                    at = by_bucket[cuts[number] : cuts[number + 1]]
                    if not len(at):
                        continue
                    spread = np.repeat(new[at] - (np.cumsum(size[at]) - size[at]), size[at]) + np.arange(size[at].sum())
                    out.append(number)
                    unseen = size[at].astype(np.uint32) - seen[at]
                    data.append(pack_pairs(words[h[at]], words[w[at]], ch[at], counts[w[at]], seen[at], unseen, docs[spread]))
                arrays = [pa.array(out, pa.int32()), pa.array([row["chunk"]] * len(out)), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "data"])

    answered = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "data"))).alias("answers"))
    rows = chunks.select("chunk", "held", "sizes", "stream").join(answered, "chunk")
    return rows.mapInArrow(run, "bucket int, chunk string, data binary")


def _merge_pairs(sent: DataFrame, unigrams: Unigrams, often: int) -> DataFrame:
    """The bigram table: a row for each bucket with the counts of all chunks, and the places where they stand.

    ``with_count`` has the numbers of pairs by count; ``frequent`` what a bucket
    has of contexts that are dealt to all buckets. Buckets below zero pass.
    """

    def work(bucket: int, names: list[str], datas: list[bytes]) -> Iterator[pa.RecordBatch]:
        columns = ["bucket", "chunks", "data", "with_count", "frequent"]
        frequent_kind = pa.list_(pa.struct([("context", pa.int64()), ("with_count", pa.list_(pa.int64())), ("rest", pa.int64()), ("lower", pa.float64())]))
        kinds = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int64()), frequent_kind]
        if bucket < 0:
            row = [bucket, names, datas, None, None]
            yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, kinds)], names=columns)
            return
        parts = [unpack_pairs(data) for data in datas]
        h, w, ch, cw, seen = (np.concatenate([part[i] for part in parts]) for i in range(5))
        order = np.lexsort((w, h))
        new = np.concatenate([[True], (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)])
        place = np.empty(len(order), np.uint32)
        place[order] = np.cumsum(new) - 1
        first = order[new]
        counts = np.bincount(place, weights=seen).astype(np.int64)
        h, w, ch, cw = h[first], w[first], ch[first], cw[first]
        with_count = np.bincount(np.minimum(counts, RELIABLE + 2), minlength=RELIABLE + 3)[1 : RELIABLE + 2]
        frequent = []
        on = np.flatnonzero((ch > often) & (counts > 0))
        contexts, group = np.unique(h[on], return_inverse=True)
        lower = np.bincount(group, weights=unigrams.probability(cw[on]), minlength=len(contexts))
        for number, context in enumerate(contexts.view(np.int64).tolist()):
            own = counts[on[group == number]]
            small = np.bincount(own[own <= RELIABLE], minlength=RELIABLE + 1)[1:]
            frequent.append({"context": context, "with_count": small.tolist(), "rest": int(own[own > RELIABLE].sum()), "lower": float(lower[number])})
        ends = np.cumsum([len(part[0]) for part in parts])
        data = [pack_pairs(h, w, ch, cw, counts)]
        # A chunk's pairs are in the order of its words; here their places rise.
        for at, part in zip(np.split(place, ends[:-1]), parts):
            data.append(pack(*_rising(at, part[4] + part[5], part[6])))
        row = [bucket, names, data, with_count.tolist(), frequent]
        yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, kinds)], names=columns)

    return _by_bucket(
        sent,
        work,
        "bucket int, chunks array<string>, data array<binary>, with_count array<long>, "
        "frequent array<struct<context:long,with_count:array<long>,rest:long,lower:double>>",
    )


def _rising(at: np.ndarray, size: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in rising order, each less the one before, with the documents that belong to them."""
    order, size = np.argsort(at, kind="stable"), size.astype(np.int64)
    starts = np.cumsum(size) - size
    spread = np.repeat(starts[order] - (np.cumsum(size[order]) - size[order]), size[order]) + np.arange(size.sum())
    return np.diff(at[order], prepend=np.uint32(0)).astype(np.uint32), size[order].astype(np.uint32), docs[spread]


def pair_probabilities(
    h: np.ndarray, counts: np.ndarray, ch: np.ndarray, cw: np.ndarray, unigrams: Unigrams, factors: np.ndarray,
    frequent: dict[int, tuple[float, float]],
) -> np.ndarray:
    """Probability of each pair, seen or not, for pairs sorted by context that hold all seen pairs of their contexts.

    ``frequent`` has the discounted counts and the unigram probabilities of the
    seen words for contexts of which only a part is here.
    """
    new = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(new) - 1
    lower = unigrams.probability(cw)
    kept = discounted(counts, factors)
    sums, below = np.bincount(group, weights=kept), np.bincount(group, weights=np.where(counts > 0, lower, 0.0))
    if frequent:
        for number, context in enumerate(h[new].view(np.int64).tolist()):
            if context in frequent:
                sums[number], below[number] = frequent[context]
    total = ch[new].astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        mass = np.minimum(sums / total, total / (total + 1))
        scale = mass * total / sums
    # Words not known are never seen, so their share is left below the contexts, whatever the rounding.
    alpha = (1 - mass) / np.maximum(1 - below, unigrams.unknown)
    with np.errstate(invalid="ignore", divide="ignore"):
        seen = (scale[group] * kept) / total[group]
    probability = np.where(counts > 0, seen, alpha[group] * lower)
    return np.where(total[group] > 0, probability, lower)


def _evaluate(table: DataFrame, unigrams: Unigrams, factors: np.ndarray, frequent: dict) -> DataFrame:
    """``chunk, bucket, data``: sums of log10 probabilities by document of the chunk; base scores pass.

    A task adds up what its buckets have for a chunk, under the number of the last of them.
    """

    def rows(bucket: int, names: list[str], datas: list[bytes]) -> pa.RecordBatch:
        arrays = [pa.array(names, pa.string()), pa.array([bucket] * len(names), pa.int32()), pa.array(datas, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["chunk", "bucket", "data"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        size = last = 0
        for batch in batches:
            for place in range(batch.num_rows):
                bucket = batch.column("bucket")[place].as_py()
                names, datas = batch.column("chunks")[place].as_py(), batch.column("data")[place].as_py()
                if bucket < 0:
                    yield rows(bucket, names, datas)
                    continue
                h, _, ch, cw, counts = unpack_pairs(datas[0])
                logs = np.log10(pair_probabilities(h, counts, ch, cw, unigrams, factors, frequent))
                last = bucket
                for chunk, data in zip(names, datas[1:]):
                    at, times, docs = unpack(data)
                    at = np.cumsum(at, dtype=np.int64)
                    sums = np.bincount(docs, weights=np.repeat(logs[at], times))
                    before = held.get(chunk, sums[:0])
                    if len(before) > len(sums):
                        sums, before = before, sums
                    sums[: len(before)] += before
                    size += len(sums) - len(held.get(chunk, ()))
                    held[chunk] = sums
                    if size > HELD_SUMS:
                        yield rows(last, list(held), [pack(values) for values in held.values()])
                        held, size = {}, 0
        if held:
            yield rows(last, list(held), [pack(values) for values in held.values()])

    return table.select("bucket", "chunks", "data").mapInArrow(run, "chunk string, bucket int, data binary")


def _totals(sums: DataFrame) -> DataFrame:
    """``chunk, known, base, score``: arrays by document of each chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended() -> pa.RecordBatch:
            arrays = [pa.array([now]), pa.array([known.tolist()], pa.list_(pa.int64())), pa.array([base.tolist()], pa.list_(pa.float64())), pa.array([score.tolist()], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "known", "base", "score"])

        now, known, base, score = None, None, None, None
        for batch in batches:
            for chunk, bucket, data in zip(*(batch.column(name).to_pylist() for name in ("chunk", "bucket", "data"))):
                if chunk != now:
                    if now is not None:
                        yield ended()
                    # The row with the base scores comes first.
                    now, (known, base) = chunk, unpack(data)
                    score = np.zeros(len(base))
                    continue
                (part,) = unpack(data)
                score[: len(part)] += part
        if now is not None:
            yield ended()

    ordered = sums.repartition("chunk").sortWithinPartitions("chunk", "bucket")
    return ordered.mapInArrow(run, "chunk string, known array<long>, base array<double>, score array<double>")


def score_texts(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", bucket_tokens: int = BUCKET_TOKENS
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of whole texts.

    The model learns from the rows for which ``held_out`` is false; null counts
    as false. ``score`` is the log10 probability of the text's words and its end.
    ``base_score`` is that of unigrams with half a count added. One row per row;
    a null or empty text is its end alone. A null id stays null. Without
    anything to learn from, every token is the unknown word, with probability
    one. Other columns are left out.
    """
    held = F.coalesce(held_out, F.lit(False))
    source = docs.select(F.col(id_column).alias("doc_id"), held.alias("held"), F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("body"))
    learns = F.aggregate("held", F.lit(0).cast("long"), lambda n, h: n + F.when(h, 0).otherwise(1))
    tokens = F.aggregate("sizes", F.lit(0).cast("long"), lambda n, size: n + size)
    chunks, seen = store_once(_chunked(source), "chunks", {"starts": F.sum(learns), "tokens": F.sum(tokens)})
    buckets = max(8, -(-(seen["tokens"] or 0) // bucket_tokens))
    spark = docs.sparkSession
    stored, _ = store_once(_unigram_answers(chunks, buckets), "unigrams")
    release(spark)
    answers = stored
    of_all = answers.where("chunk is null").agg(
        F.sum("tokens").alias("tokens"), F.sum("words").alias("words"),
        *(F.sum(F.col("with_count")[r]).alias(f"n{r}") for r in range(RELIABLE + 1)),
    ).first()
    unigrams = Unigrams.of(of_all["tokens"] or 0, of_all["words"] or 0, [of_all[f"n{r}"] or 0 for r in range(RELIABLE + 1)])
    answers = answers.where("chunk is not null").select("chunk", "bucket", "data")
    often = bucket_tokens // 4
    sent = _pairs(chunks, answers, buckets, unigrams, seen["starts"] or 0, often)
    table, _ = store_once(_merge_pairs(sent, unigrams, often), "bigrams")
    delete_stored(stored)
    release(spark)
    numbers = table.agg(*(F.sum(F.col("with_count")[r]).alias(f"n{r}") for r in range(RELIABLE + 1))).first()
    factors = discounts([numbers[f"n{r}"] or 0 for r in range(RELIABLE + 1)])
    # Contexts with over a quarter of a bucket's tokens: at most four for each bucket.
    parts = table.select(F.inline("frequent")).groupBy("context").agg(
        F.sum("rest").alias("rest"), F.sum("lower").alias("lower"),
        *(F.sum(F.col("with_count")[r]).alias(f"n{r + 1}") for r in range(RELIABLE)),
    )
    frequent = {
        row["context"]: (row["rest"] + sum(factors[r] * r * row[f"n{r}"] for r in range(1, RELIABLE + 1)), row["lower"])
        for row in parts.collect()
    }
    totals = _totals(_evaluate(table, unigrams, factors, frequent))
    listed = F.arrays_zip("ids", "held", "sizes", "known", "base", "score")
    each = chunks.select("chunk", "ids", "held", "sizes").join(totals, "chunk").select(F.explode(listed).alias("row"))
    return each.select(
        F.col("row.ids").alias("doc_id"), F.col("row.held").alias("held_out"), F.col("row.sizes").alias("n_tokens"),
        F.col("row.known").alias("n_known"), F.lit(unigrams.tokens).cast("long").alias("train_tokens"),
        F.col("row.base").alias("base_score"), F.col("row.score").alias("score"),
    )
