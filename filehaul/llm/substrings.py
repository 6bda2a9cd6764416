"""Exact repeated substrings: every byte covered by a string that starts anywhere else goes.

Only suffixes that may repeat are sorted. Every string of ``length`` bytes has
an anchor: the last smallest hash among its 32-byte grams, so equal strings
have it at the same offset. The strings around an anchor are dealt to blocks of
offsets; those of a block share its core. Cores that stand once are done, and
where all strings of a block stand elsewhere too, all its bytes go. What is
left is where repeats begin and end: there the suffixes of all texts with the
core are ordered by deep-shallow sorting, and equal neighbours are repeats.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.llm.common import bodies, give_back, slices
from filehaul.llm.deep_shallow import order_suffixes
from filehaul.storage import delete_stored, store_once

GRAM = 32
# Offsets in a block. Smaller blocks: more rows to count, but fewer suffixes to sort, by their square.
BLOCK = 74
# Bytes taken together; longer texts are cut into pieces that overlap by all but one byte of the length. A task holds some hundred times as much.
PIECE = 1 << 20
_PLACE_BITS = 23
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of the hash's base and of its inverse, and a random value for each byte."""

    def __init__(self, size: int) -> None:
        def powers(base: int) -> np.ndarray:
            out = np.full(size, base, np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
        self.values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(32))) * _MIX
    return hashes ^ (hashes >> np.uint64(29))


def find_anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, powers: _Powers) -> list[np.ndarray]:
    """Text, anchor, lowest and highest offset, hash of the core and hash of all bytes, for the blocks of all anchors.

    Texts lie in ``data`` from ``starts`` to ``ends``; places count from there.
    """
    wide = length - GRAM + 1
    blocks = -(-wide // BLOCK)
    block = -(-wide // blocks)
    nothing = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    if len(data) < length:
        return nothing
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(powers.values[data] * powers.up[: len(data)], out=sums[1:])

    def digest(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return _mix((sums[high] - sums[low]) * powers.down[low])

    grams = (sums[GRAM:] - sums[:-GRAM]) * powers.down[: len(data) - GRAM + 1]
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    least = (_mix(grams) & ~mask) | (mask - np.arange(len(grams), dtype=np.uint64))
    step = 1
    while 2 * step <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if wide > step:
        least = np.minimum(least[: len(least) - (wide - step)], least[wide - step :])
    anchor = (mask - (least & mask)).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), np.maximum(ends - starts - length + 1, 0))
    sizes = np.maximum(ends - starts - length + 1, 0)
    window = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[text]
    if not len(window):
        return nothing
    anchor = anchor[window]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(text) != 0)]))
    last = np.concatenate([first[1:], [len(window)]]) - 1
    anchor, text = anchor[first], text[first]
    low, high = anchor - window[last], anchor - window[first]
    parts = []
    for number in range(blocks):
        from_, to = number * block, min((number + 1) * block, wide) - 1
        some_low, some_high = np.maximum(low, from_), np.minimum(high, to)
        on = np.flatnonzero(some_low <= some_high)
        at, some_low, some_high = anchor[on], some_low[on], some_high[on]
        core = digest(at - from_, at - to + length) + np.uint64(number)
        whole = digest(at - some_high, at - some_low + length)
        whole = _mix(whole + (some_low * 1024 + some_high).astype(np.uint64) * _MIX)
        parts.append([text[on], at - starts[text[on]], some_low, some_high, _mix(core), whole])
    return [np.concatenate(column) for column in zip(*parts)]


def _anchor_table(source: DataFrame, length: int) -> DataFrame:
    """``doc_id, digest, at, low, high, core, whole``: see ``find_anchors``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(PIECE + length + 1)

        def out(batch: pa.RecordBatch, row: np.ndarray, base: int, found: list[np.ndarray]) -> pa.RecordBatch:
            keys = [batch.column(name).take(pa.array(row)) for name in ("doc_id", "digest")]
            at, low, high = found[1] + base, found[2].astype(np.int16), found[3].astype(np.int16)
            core, whole = found[4].view(np.int64), found[5].view(np.int64)
            arrays = [*keys, *(pa.array(values) for values in (at, low, high, core, whole))]
            return pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "digest", "at", "low", "high", "core", "whole"]
            )

        for batch, texts in slices(batches, limit=PIECE // 2):
            sizes = np.array([len(text) for text in texts], dtype=np.int64)
            if sizes.sum() <= PIECE:
                ends = np.cumsum(sizes)
                found = find_anchors(np.frombuffer(b"".join(texts), np.uint8), ends - sizes, ends, length, powers)
                yield out(batch, found[0], 0, found)
                continue
            for row, text in enumerate(texts):
                for base in range(0, max(len(text) - length + 1, 0), PIECE):
                    data = np.frombuffer(text, np.uint8, min(PIECE + length - 1, len(text) - base), base)
                    found = find_anchors(data, np.array([0]), np.array([len(data)]), length, powers)
                    yield out(batch, np.full(len(found[0]), row), base, found)

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, digest long, at long, low short, high short, core long, whole long"
    )


def _fetch(wanted: DataFrame, source: DataFrame, length: int) -> DataFrame:
    """``doc_id, digest, at, low, high, core, alone, part``: the bytes of wanted blocks."""
    listed = wanted.groupBy("doc_id", "digest").agg(
        F.collect_list(F.struct("at", "low", "high", "core", "alone")).alias("blocks")
    )
    listed = listed.select(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"), "blocks")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))
    # Rows that stand twice have the same bytes.
    found = source.join(listed, same).dropDuplicates(["doc_id", "digest"])
    block = F.explode("blocks").alias("block")
    part = F.substring(
        F.col("body"),
        (F.col("block.at") - F.col("block.high") + 1).cast("int"),
        (F.col("block.high") - F.col("block.low") + length).cast("int"),
    )
    return found.select("doc_id", "digest", "body", block).select("doc_id", "digest", "block.*", part.alias("part"))


def _repeats(parts: DataFrame, length: int) -> DataFrame:
    """``doc_id, digest, start, end``: repeats in blocks that stand alone, by ordering the suffixes of each core."""

    def ended(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        texts = table["part"].to_pylist()
        cores, alone = table["core"].to_numpy(), table["alone"].to_numpy()
        sizes = np.array([len(text) for text in texts], dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        row = np.repeat(np.arange(len(texts)), counts)
        shift = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        group = np.cumsum(np.concatenate([[0], cores[1:] != cores[:-1]]))
        order, same = order_suffixes(b"".join(texts), begins[row] + shift, group[row], length)
        repeated = np.zeros(len(row), bool)
        repeated[order] = same | np.concatenate([same[1:], [False]])
        repeated &= alone[row]
        # Runs of repeated suffixes, each covering its bytes.
        edge = np.flatnonzero(repeated)
        if not len(edge):
            return
        new = np.concatenate([[True], (np.diff(edge) != 1) | (np.diff(row[edge]) != 0)])
        first, last = edge[new], edge[np.concatenate([new[1:], [True]])]
        origin = (table["at"].to_numpy() - table["high"].to_numpy())[row[first]]
        keys = [table[name].combine_chunks().take(pa.array(row[first])) for name in ("doc_id", "digest")]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(origin + shift[first]), pa.array(origin + shift[last] + length)],
            names=["doc_id", "digest", "start", "end"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            cores = batch.column("core").to_numpy()
            cuts = (np.flatnonzero(cores[1:] != cores[:-1]) + 1).tolist()
            for low, high in zip([0, *cuts], [*cuts, len(cores)]):
                if low == high:
                    continue
                # Whole groups, as many as are worth a call.
                if held and size > 1 << 20 and held[-1].column("core")[-1].as_py() != cores[low]:
                    yield from ended(held)
                    held, size = [], 0
                held.append(batch.slice(low, high - low))
                size += held[-1].nbytes
        if held:
            yield from ended(held)
        held = []
        give_back()

    kind = parts.schema["doc_id"].dataType.simpleString()
    return (
        parts.repartition("core").sortWithinPartitions("core").mapInArrow(run, f"doc_id {kind}, digest long, start long, end long")
    )


def repeated_spans(source: DataFrame, length: int) -> DataFrame:
    """``doc_id, digest, start, end``: bytes of repeats, in runs that may overlap, for rows ``doc_id, digest, body``."""
    anchors, _ = store_once(_anchor_table(source, length), "anchors")
    cores = anchors.groupBy("core").agg(
        F.count("*").alias("n"), F.min("whole").alias("least"), F.max("whole").alias("most")
    )
    # Written out, so that both sides of the join are plain and Spark splits a core that very many texts share.
    cores, _ = store_once(cores.where("n > 1").select("core", (F.col("least") != F.col("most")).alias("mixed")), "cores")
    shared, _ = store_once(anchors.join(cores, "core"), "shared-anchors")
    span = [
        "doc_id", "digest", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end"),
    ]
    mixed = shared.where("mixed")
    kinds = mixed.groupBy("core", "whole").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "digest", "at", "low", "high")).alias("one")
    )
    kinds, _ = store_once(kinds, "kinds")
    everywhere = shared.where("not mixed").unionByName(
        mixed.join(kinds.where("n > 1").select("core", "whole"), ["core", "whole"])
        .select(*shared.columns)
    )
    wanted = kinds.select("core", "one.*", (F.col("n") == 1).alias("alone"))
    parts = _fetch(wanted, source, length)
    spans = everywhere.select(*span).unionByName(_repeats(parts, length))
    spans, _ = store_once(spans, "repeats")
    delete_stored(anchors, cores, shared, kinds)
    return spans


def drop_repeats(
    docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text", whole_characters: bool = False
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept``: what is left of whole texts, as bytes.

    A byte goes if it is covered by a string of ``length`` bytes that also
    starts anywhere else, in another row or in the same; all its places go.
    ``spans`` lists the removed runs ``(start, end)``. With
    ``whole_characters``, a character of which a byte would stay stays whole.
    One row per row: rows that stand twice repeat each other. A null or empty
    text has no bytes; a null id is a value like any other. Other columns are
    left out.
    """
    if length < GRAM or length - GRAM + 1 > 1024:
        raise ValueError(f"length must be from {GRAM} to {1023 + GRAM}")
    source = bodies(docs, id_column, text_column).withColumn("digest", F.xxhash64("body"))
    return _cut(source, "doc_id", repeated_spans(source, length), whole_characters)


def _cut(source: DataFrame, key: str, spans: DataFrame, whole_characters: bool) -> DataFrame:
    """Cut the spans of ``doc_id, digest`` out of rows ``doc_id, digest, body``, whose id is in the column ``key``."""
    listed = spans.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    listed = listed.select(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"), "runs")
    same = F.col(key).eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows = []
            for text, runs in zip(texts, batch.column("runs")):
                if not runs.is_valid:
                    rows.append((len(text), 0, 0, [], text))
                    continue
                values = runs.values
                merged = _merge(values.field(0).to_numpy(), values.field(1).to_numpy())
                if whole_characters:
                    merged = _to_characters(text, merged)
                kept, at = [], 0
                for start, end in merged:
                    kept.append(text[at:start])
                    at = end
                kept.append(text[at:])
                left = b"".join(kept)
                spans = [{"start": start, "end": end} for start, end in merged]
                rows.append((len(text), len(text) - len(left), len(merged), spans, left))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return (
        source.join(listed, same, "left")
        .select("doc_id", "body", "runs")
        .mapInArrow(
            run,
            f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary",
        )
    )


def cut_texts(docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with repeats cut out of the texts by whole characters; other columns stay."""
    source = bodies(docs, id_column, text_column).withColumn("digest", F.xxhash64("body"))
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns if name != text_column)).alias("doc_id")
    body = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    rows = docs.select(row, F.col(id_column).alias("id"), body.alias("body")).withColumn("digest", F.xxhash64("body"))
    left = _cut(rows, "id", repeated_spans(source, length), whole_characters=True)
    whole = left.select("doc_id.*", F.decode("kept", "utf-8").alias(text_column))
    return whole.select(*(F.col(f"`{name}`") for name in docs.columns))


def _merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union; runs that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return list(zip(starts[new].tolist(), ends[np.concatenate([new[1:], [True]])].tolist()))


def _to_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs without the bytes of characters that lie in them only in part."""
    out = []
    for start, end in runs:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out
