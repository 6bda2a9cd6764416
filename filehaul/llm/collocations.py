"""Phrase collocations from counting transducers, built level by level and summed over shards.

A transducer here is an acyclic automaton over words: its states are phrases,
a transition adds a word, and a state's weight is how often its phrase stands
in the corpus. A shard (some MiB of text of one language) sorts its n-grams and
gives the transitions that it adds to the states it shares with all others.
These are united by ranges of a mixed order of the prefixes; those of one
frequent prefix lie in several ranges, as its count demands. A range sums the
weights of all shards, drops what is too rare for ever to become a candidate,
numbers the states that are left, and tells each shard those it uses. Then the
next level begins. A phrase is only counted if what is left of it without its
last, and without its first word, is frequent, which loses nothing: no part
of a phrase is rarer than the phrase. So levels shrink, and no shard
sends a phrase that cannot reach the threshold.

Every state knows the state without its last word and the one without its
first. Following those composes a phrase with the transducer for all its parts
at once: counts of all beginnings come along the first, of all ends along the
second.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filehaul.llm.common import release, slices
from filehaul.llm.katz import pack, unpack
from filehaul.storage import delete_stored, store_once

SHARD_BYTES = 8 << 20
# Words of the corpus for which a range is made.
RANGE_WORDS = 2_000_000
NO_LANGUAGE = "und"
# First cut of a language's ranking, before its best meet in one task.
SALTS = 64
MARK = b"."
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_MARKS = bytes.maketrans(_SEPARATORS, MARK * len(_SEPARATORS))
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def split_words(text: bytes) -> list[bytes]:
    """Words of a text, with a mark wherever a piece ends."""
    return text.lower().translate(_MARKS).replace(MARK, b" . ").split()


def _shards(source: DataFrame) -> DataFrame:
    """``shard, lang, size, words, stream`` for rows ``lang, body``.

    ``words`` are the words and their counts, the stream numbers them from 1, and 0 ends a piece.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        open_: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        held: dict[str, int] = {}

        def ended(langs: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lang in langs:
                numbers, streams = open_.pop(lang)
                del held[lang]
                stream = np.concatenate(streams)
                counts = np.bincount(stream, minlength=len(numbers))[1:]
                arrays = [
                    pa.array([first + made]), pa.array([lang]), pa.array([len(numbers) - 1]), pa.array([int(counts.sum())]),
                    pa.array([_pack_words(list(numbers)[1:], counts)], pa.binary()), pa.array([pack(stream)], pa.binary()),
                ]
                made += 1
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "lang", "size", "total", "words", "stream"])

        for batch, texts in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                numbers, streams = open_.setdefault(lang, (_Numbers({MARK: 0}), []))
                stream = np.array([*map(numbers.__getitem__, split_words(text)), 0], np.uint32)
                streams.append(stream)
                held[lang] = held.get(lang, 0) + len(text)
                if held[lang] >= SHARD_BYTES:
                    yield from ended([lang])
                elif sum(held.values()) >= 2 * SHARD_BYTES:
                    yield from ended(list(open_))
        yield from ended(list(open_))

    return source.mapInArrow(run, "shard long, lang string, size long, total long, words binary, stream binary")


def _pack_words(words: list[bytes], *numbers: np.ndarray) -> bytes:
    packed = pack(*(values.astype(np.uint32) for values in numbers))
    return len(packed).to_bytes(8, "little") + packed + zstandard.ZstdCompressor().compress(MARK.join(words))


def _unpack_words(data: bytes) -> tuple[list[bytes], list[np.ndarray]]:
    end = 8 + int.from_bytes(data[:8], "little")
    return zstandard.ZstdDecompressor().decompress(data[end:]).split(MARK), unpack(data[8:end])


def _sent_words(shards: DataFrame, ranges: int) -> DataFrame:
    """``range, shard, lang, data``: the words of a shard, sorted, with counts and numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, size, data in zip(*(batch.column(name).to_pylist() for name in ("shard", "lang", "size", "words"))):
                if not size:
                    continue
                words, (counts,) = _unpack_words(data)
                hashes = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint64, size)
                range_of = (hashes * np.uint64(ranges) >> np.uint64(32)).astype(np.int64).tolist()
                parts: dict[int, list[int]] = {}
                for place in sorted(range(size), key=words.__getitem__):
                    parts.setdefault(range_of[place], []).append(place)
                packed = [_pack_words([words[i] for i in part], counts[part], np.array(part)) for part in parts.values()]
                many = len(parts)
                arrays = [
                    pa.array(list(parts), pa.int32()), pa.array([shard] * many, pa.int64()), pa.array([lang] * many), pa.array(packed, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["range", "shard", "lang", "data"])

    return shards.select("shard", "lang", "size", "words").mapInArrow(run, "range int, shard long, lang string, data binary")


def _by_range(sent: DataFrame, names: list[str], work, schema: str) -> DataFrame:
    """Give all rows of a range, in the order of the shards, to ``work(range, *columns)``, which makes a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for number, *row in zip(*(batch.column(name).to_pylist() for name in ("range", *names))):
                if number != now and rows:
                    yield work(now, *zip(*rows))
                    rows = []
                now = number
                rows.append(row)
        if rows:
            yield work(now, *zip(*rows))

    return sent.repartition("range").sortWithinPartitions("range", "shard").mapInArrow(run, schema)


def _united_words(sent: DataFrame, least: int) -> DataFrame:
    """Sums of a range. Rows with a shard: numbers of its frequent words, and their states. Rows without: the first states."""

    def work(number: int, shards: tuple, langs: tuple, datas: tuple) -> pa.RecordBatch:
        sums: dict[str, dict[bytes, int]] = {}
        for lang, data in zip(langs, datas):
            words, (counts, _) = _unpack_words(data)
            of = sums.setdefault(lang, {})
            for word, count in zip(words, counts.tolist()):
                of[word] = of.get(word, 0) + count
        found = [(lang, word, n) for lang, of in sorted(sums.items()) for word, n in of.items() if n >= least]
        del sums
        states: dict[str, dict[bytes, int]] = {}
        for place, (lang, word, _) in enumerate(found):
            states.setdefault(lang, {})[word] = place + (number << 32)
        weights = np.array([n for _, _, n in found], np.uint64)
        told, replies = [], []
        for shard, lang, data in zip(shards, langs, datas):
            own = states.get(lang)
            if not own:
                continue
            words, (_, places) = _unpack_words(data)
            state = np.array([own.get(word, -1) for word in words], np.int64)
            hit = state >= 0
            if hit.any():
                told.append(shard)
                replies.append(pack(places[hit], state[hit].astype(np.uint64), weights[state[hit] - (number << 32)]))
        none = [None] * len(told)
        columns = zip(*found) if found else ((), (), ())
        lang_of, words, counts = columns
        arrays = [
            pa.array([*told, None], pa.int64()), pa.array([*replies, None], pa.binary()),
            pa.array([*none, np.arange(len(found)) + (number << 32)], pa.list_(pa.int64())), pa.array([*none, list(lang_of)], pa.list_(pa.string())),
            pa.array([*none, [word.decode() for word in words]], pa.list_(pa.string())), pa.array([*none, list(counts)], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "data", "state", "lang", "word", "n"])

    schema = "shard long, data binary, state array<long>, lang array<string>, word array<string>, n array<long>"
    return _by_range(sent, ["shard", "lang", "data"], work, schema)


def _replies(united: DataFrame) -> DataFrame:
    return united.where("shard is not null").groupBy("shard").agg(F.collect_list("data").alias("replies"))


def _numbered(shards: DataFrame, united: DataFrame) -> DataFrame:
    """``shard, data`` at level one.

    ``data`` packs for each place the number of the word and of the state that
    begin there, 0 for none, what the words' and the states' numbers are in the
    corpus, and how often the states stand there. At level one both are the
    same, and the places of states are left empty.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = [unpack(reply) for reply in row["replies"]]
                places, states, weights = (np.concatenate([part[i] for part in parts]) for i in range(3))
                order = np.argsort(states)
                known = np.zeros(row["size"] + 1, np.uint32)
                known[places[order].astype(np.int64) + 1] = np.arange(1, len(order) + 1)
                words = known[unpack(row["stream"])[0]]
                kept = words > 0
                kept[1:] |= words[:-1] > 0  # the end of a run stays as a mark
                words = words[kept]
                data = pack(words, words[:0], states[order], states[order], weights[order])
                yield pa.RecordBatch.from_pydict({"shard": [row["shard"]], "data": [data]})

    rows = shards.select("shard", "size", "stream").join(_replies(united), "shard")
    return rows.mapInArrow(run, "shard long, data binary")


def _unpacked(data: bytes) -> list[np.ndarray]:
    words, at, *rest = unpack(data)
    return [words, at if len(at) else words, *rest]


def _candidates(words: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
    """Places where a phrase of this many words begins whose two parts of one word less are states."""
    last = len(at) - level + 1
    return np.flatnonzero((at[:last] > 0) & (at[1 : last + 1] > 0)) if last > 0 else np.zeros(0, np.int64)


def _sent(held: DataFrame, level: int, ranges: int) -> DataFrame:
    """``range, shard, data``: the transitions of a shard, sorted: state, word, count, and the state without the first word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist()):
                words, at, states, own_words, weights = _unpacked(data)
                begin = _candidates(words, at, level)
                if not len(begin):
                    continue
                key = at[begin].astype(np.uint64) << np.uint64(32) | words[begin + level - 1]
                order = np.argsort(key)
                ranked = key[order]
                new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                counts = np.diff(new, append=len(ranked)).astype(np.uint32)
                suffix = states[at[begin[order[new]] + 1] - 1]
                key = ranked[new]
                state, word = states[(key >> np.uint64(32)).astype(np.int64) - 1], own_words[(key & np.uint64(2**32 - 1)).astype(np.int64) - 1]
                # What follows a state is in one range, or in several if it is frequent; there it packs well.
                pieces = np.uint64(1) + weights[(key >> np.uint64(32)).astype(np.int64) - 1] * np.uint64(8) // np.uint64(RANGE_WORDS)
                mixed = state * _MIX[0] + (word * _MIX[1] >> np.uint64(32)) % pieces * _MIX[1]
                mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1]
                range_of = ((mixed >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                by_range = np.argsort(range_of, kind="stable")
                cuts = np.searchsorted(range_of[by_range], np.arange(ranges + 1))
                on = np.flatnonzero(np.diff(cuts))
                parts = [by_range[cuts[r] : cuts[r + 1]] for r in on]
                packed = [pack(state[p], word[p], counts[p], suffix[p]) for p in parts]
                arrays = [pa.array(on, pa.int32()), pa.array([shard] * len(on), pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["range", "shard", "data"])

    return held.mapInArrow(run, "range int, shard long, data binary")


def _united(sent: DataFrame, least: int) -> DataFrame:
    """Sums of a range. Rows with a shard: the frequent transitions it has, with their states. Rows without: the new states."""
    table = ("state", "prefix", "suffix", "n")

    def work(number: int, shards: tuple, datas: tuple) -> pa.RecordBatch:
        parts = [unpack(data) for data in datas]
        sizes = [len(part[0]) for part in parts]
        state, word, counts, suffix = (np.concatenate([part[i] for part in parts]) for i in range(4))
        del parts
        order = np.lexsort((word, state))
        ranked_state, ranked_word = state[order], word[order]
        new = np.concatenate([[True], (ranked_state[1:] != ranked_state[:-1]) | (ranked_word[1:] != ranked_word[:-1])])
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        first = order[new]
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, of, counts.astype(np.int64))
        frequent = sums >= least
        numbers = np.where(frequent, np.cumsum(frequent) - 1 + (number << 32), -1)
        own = numbers[of]
        replies, told = [], []
        for shard, at in zip(shards, np.split(np.arange(len(of)), np.cumsum(sizes)[:-1])):
            hit = at[own[at] >= 0]
            if len(hit):
                told.append(shard)
                replies.append(pack(state[hit], word[hit], own[hit].astype(np.uint64), sums[of[hit]].astype(np.uint64)))
        keep = first[frequent]
        found = [numbers[frequent], state[keep].astype(np.int64), suffix[keep].astype(np.int64), sums[frequent]]
        arrays = [
            pa.array([*told, None], pa.int64()), pa.array([*replies, None], pa.binary()),
            *(pa.array([*[None] * len(told), values], pa.list_(pa.int64())) for values in found),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "data", *table])

    spec = ", ".join(f"{name} array<long>" for name in table)
    return _by_range(sent, ["shard", "data"], work, f"shard long, data binary, {spec}")


def _advanced(held: DataFrame, united: DataFrame, level: int) -> DataFrame:
    """``shard, data`` with the states of this level, without the places that no frequent phrase covers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, at, states, own_words, _ = _unpacked(row["data"])
                parts = [unpack(reply) for reply in row["replies"]]
                state, word, number, weights = (np.concatenate([part[i] for part in parts]) for i in range(4))
                known, word = np.searchsorted(states, state), np.searchsorted(own_words, word)
                key = (known + 1).astype(np.uint64) << np.uint64(32) | (word + 1).astype(np.uint64)
                order = np.argsort(key)
                key, number, weights = key[order], number[order], weights[order]
                begin = _candidates(words, at, level)
                asked = at[begin].astype(np.uint64) << np.uint64(32) | words[begin + level - 1]
                place = np.minimum(np.searchsorted(key, asked), len(key) - 1)
                hit = key[place] == asked
                begin, found = begin[hit], number[place[hit]]
                states, first = np.unique(number, return_index=True)
                at = np.zeros(len(words), np.uint32)
                at[begin] = np.searchsorted(states, found) + 1
                change = np.zeros(len(words) + 1, np.int64)
                change[begin] += 1
                change -= np.concatenate([np.zeros(level, np.int64), change[: len(change) - level]])
                covered = np.cumsum(change)[:-1] > 0
                data = pack(words[covered], at[covered], states, own_words, weights[first])
                yield pa.RecordBatch.from_pydict({"shard": [row["shard"]], "data": [data]})

    return held.join(_replies(united), "shard").mapInArrow(run, "shard long, data binary")


def _transducer(source: DataFrame, least: int, longest: int) -> tuple[list[DataFrame], DataFrame]:
    """The tables of all levels (the first ``state, lang, word, n``, others ``state, prefix, suffix, n``), and words by language."""
    spark = source.sparkSession
    shards, seen = store_once(_shards(source), "phrase-shards", {"words": F.coalesce(F.sum("total"), F.lit(0))})
    totals, _ = store_once(shards.groupBy("lang").agg(F.sum("total").alias("total")), "phrase-totals")
    ranges = max(1, -(-seen["words"] // RANGE_WORDS))
    united, _ = store_once(_united_words(_sent_words(shards, ranges), least), "phrase-sums")
    held, _ = store_once(_numbered(shards, united), "phrase-level")
    delete_stored(shards)
    release(spark)
    levels = [united.where("shard is null").select(F.inline(F.arrays_zip("state", "lang", "word", "n")))]
    for level in range(2, longest + 1):
        united, seen = store_once(_united(_sent(held, level, ranges), least), "phrase-sums", {"states": F.coalesce(F.sum(F.size("state")), F.lit(0))})
        rows = united.where("shard is null").select(F.inline(F.arrays_zip("state", "prefix", "suffix", "n")))
        levels.append(rows)
        former, last = held, level == longest or not seen["states"]
        if not last:
            held, _ = store_once(_advanced(held, united, level), "phrase-level")
        delete_stored(former)
        release(spark)
        if last:
            break
    return levels, totals


def _composed(levels: list[DataFrame]) -> Iterator[tuple[int, DataFrame]]:
    """For each level from the second: ``state, prefix, suffix, lang, phrase, a, before, after``.

    ``before`` has the counts of the phrase's beginnings of 1, 2, ... words, up
    to itself, and ``after`` those of its ends.
    """
    own = F.array("n")
    first, _ = store_once(levels[0].select("state", "lang", F.col("word").alias("first"), F.col("word").alias("phrase"), own.alias("before"), own.alias("after")), "phrases")
    for size, found in enumerate(levels[1:], start=2):
        left = first.select(F.col("state").alias("prefix"), "lang", "first", "before")
        right = first.select(F.col("state").alias("suffix"), "phrase", "after")
        made = found.join(left, "prefix").join(right, "suffix").select(
            "state", "prefix", "suffix", "lang", "first", F.concat_ws(" ", "first", "phrase").alias("phrase"), F.col("n").alias("a"),
            F.concat("before", F.array("n")).alias("before"), F.concat("after", F.array("n")).alias("after"),
        )
        first, _ = store_once(made, "phrases")
        yield size, first


def mine_phrases(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    best: int = 2000,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """The best-scoring phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends,
    and those into words at spaces and tabs. A candidate is a phrase of 2 to
    ``longest`` words within a piece that stands ``least`` times or more, ``a``
    times. It is cut in two where ``1000 * a * n / (l * r)``, rounded down, is
    least (ties: the shortest first part); ``n`` are the words of the language,
    ``l`` and ``r`` the occurrences of both parts. A candidate is dropped if it
    lies in a longer one that stands as often. Order: score falling, ``a``
    falling, phrase by bytes. A null language is ``und``, a null text empty;
    repeated rows count as often as they stand; other columns are not read. An
    empty table gives no rows.
    """
    source = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("body"),
    )
    levels, totals = _transducer(source, least, longest)
    phrases = dict(_composed(levels))
    number = lambda column: column.cast("decimal(19,0)")
    ranked = None
    for size, rows in phrases.items():
        if size + 1 in phrases:
            # A phrase in a longer one as frequent as it is lies in one of one word more that is.
            longer = phrases[size + 1]
            around = longer.select(F.col("prefix").alias("state"), "a").unionByName(longer.select(F.col("suffix").alias("state"), "a"))
            around = around.groupBy("state").agg(F.max("a").alias("longer"))
            rows = rows.join(around, "state", "left").where("longer is null or longer < a")
        rows = rows.join(totals, "lang")
        cuts = []
        for cut in range(1, size):
            l, r = F.element_at("before", cut), F.element_at("after", size - cut)  # noqa: E741
            above = (number(F.col("a")) * number(F.col("total"))).cast("decimal(35,0)") * F.lit(1000)
            score = F.call_function("div", above.cast("decimal(38,0)"), (number(l) * number(r)).cast("decimal(38,0)"))
            cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), l.alias("l"), r.alias("r")))
        rows = rows.withColumn("best", F.array_min(F.array(*cuts)))
        rows = rows.select("lang", "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), F.col("best.score").alias("score"))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    ahead = ranked.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= best)
    placed = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    return placed.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
