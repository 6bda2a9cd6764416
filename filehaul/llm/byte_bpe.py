"""Byte-level BPE: encoding by merges in padded matrices, and decoding.

A text is cut by the vocabulary's pattern. The distinct pieces of a batch that
are no token themselves stand in matrices by length, one row of token ids each.
In every round each row merges its leftmost pair of the lowest rank; a row
without a pair leaves its matrix.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filehaul.llm.common import bodies, slices

NONE = np.int32(2**31 - 1)
# Rows of a longer piece are merged at all places of a rank at once, where that gives the same ids.
WIDEST = 128


class Vocabulary:
    """Tokens by rank, and an open-addressed table from pairs of ranks to the rank of the merged token."""

    def __init__(self, tokens: dict[bytes, int]) -> None:
        self.ranks = tokens
        self.size = max(tokens.values(), default=-1) + 1
        self.tokens = [b""] * self.size
        for token, rank in tokens.items():
            self.tokens[rank] = token
        self.bytes = np.array([tokens[bytes([value])] for value in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                first, second = tokens.get(token[:cut]), tokens.get(token[cut:])
                if first is not None and second is not None:
                    left.append(first)
                    right.append(second)
                    merged.append(rank)
        left, right = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
        merged = np.array(merged, dtype=np.int32)
        self._fill(left * self.size + right, merged)
        # Whether no pair with this token comes before the token's own merge.
        lowest = np.full(self.size, NONE, dtype=np.int32)
        np.minimum.at(lowest, left, merged)
        np.minimum.at(lowest, right, merged)
        self.ordered = lowest > np.arange(self.size)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        rest, slot = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            free = self.keys[slot[rest]] < 0
            taken, first = np.unique(slot[rest[free]], return_index=True)
            placed = rest[free][first]
            self.keys[taken], self.values[taken] = keys[placed], values[placed]
            rest = np.setdiff1d(rest, placed, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged token for each pair, NONE without one; negative ids pair with nothing."""
        shape, keys = left.shape, (left.astype(np.int64) * self.size + right).ravel()
        out = np.full(keys.shape, NONE, dtype=np.int32)
        rest = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(keys[rest])
        while len(rest):
            found = self.keys[slot]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            rest, slot = rest[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for place, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[place] = np.array([rank], dtype=np.int32)
            elif len(piece) > WIDEST:
                out[place] = self._merge_long(piece)
            else:
                buckets.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(place)
        for width, places in buckets.items():
            for start in range(0, len(places), step := max(1, (1 << 20) // width)):
                part = places[start : start + step]
                for place, ids in zip(part, self._merge_rows([pieces[p] for p in part], width)):
                    out[place] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        padded = b"".join(piece.ljust(width, b"\0") for piece in pieces)
        ids = self.bytes[np.frombuffer(padded, dtype=np.uint8).reshape(-1, width)]
        lengths = np.array([len(piece) for piece in pieces])
        columns = np.arange(width)
        ids[columns >= lengths[:, None]] = -1
        out: list[np.ndarray] = [ids[:0, 0]] * len(pieces)
        rows = np.arange(len(pieces))
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(rows)), at]
            ended = lowest == NONE
            for place in np.flatnonzero(ended):
                out[rows[place]] = ids[place, : lengths[place]].copy()
            on = ~ended
            rows, ids, ranks, lengths = rows[on], ids[on], ranks[on], lengths[on] - 1
            if not len(rows):
                break
            width = int(lengths.max())
            at, lowest, every = at[on], lowest[on], np.arange(len(rows))
            ids[every, at] = lowest
            # Close the gap right of the merged pair.
            source = columns[:width] + (columns[:width] > at[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            ids[columns[:width] >= lengths[:, None]] = -1
            if width == 1:
                ranks = np.full((len(rows), 1), NONE, dtype=np.int32)
                continue
            source = columns[: width - 1] + (columns[: width - 1] > at[:, None])
            ranks = np.take_along_axis(ranks, np.minimum(source, ranks.shape[1] - 1), axis=1)
            ranks[columns[: width - 1] >= lengths[:, None] - 1] = NONE
            for left in (at - 1, at):
                good = np.flatnonzero((left >= 0) & (left < width - 1))
                ranks[good, left[good]] = self.pairs(ids[good, left[good]], ids[good, left[good] + 1])
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.bytes[np.frombuffer(piece, dtype=np.uint8)]
        ranks = self.pairs(ids[:-1], ids[1:])
        while len(ranks) and (lowest := ranks.min()) != NONE:
            at = np.flatnonzero(ranks == lowest)
            if self.ordered[lowest]:
                # Of places that overlap, every second one from the left.
                run = np.cumsum(np.diff(at, prepend=-2) != 1)
                first = np.searchsorted(run, run)
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            else:
                at = at[:1]
            ids[at] = lowest
            ids = np.delete(ids, at + 1)
            at = at - np.arange(len(at))
            ranks = np.delete(ranks, np.minimum(at + np.arange(len(at)), len(ranks) - 1))
            for left in (at - 1, at):
                good = left[(left >= 0) & (left < len(ids) - 1)]
                ranks[good] = self.pairs(ids[good], ids[good + 1])
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines with a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def load_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary for all tasks. Its size is that of the rank file, whatever the corpus."""
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path)))


def encode(
    docs: DataFrame, vocabulary: Broadcast, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Token ids of whole texts: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers).

    One row per row, repeated ones too. A null or empty text has no tokens. A
    null id stays null. Other columns are left out, whatever their names.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, split = vocabulary.value, regex.compile(pattern)
        for batch, texts in slices(batches):
            known: dict[str, int] = {}
            texts_pieces = []
            for text in texts:
                found = split.findall(text.decode("utf-8", "replace"))
                texts_pieces.append(
                    np.fromiter((known.setdefault(p, len(known)) for p in found), np.int64, len(found))
                )
            tokens = vocab.encode_pieces([piece.encode() for piece in known])
            sizes = np.array([len(ids) for ids in tokens], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            flat = np.concatenate(tokens).astype("<u4") if tokens else np.zeros(0, "<u4")
            counts, ids = [], []
            for pieces in texts_pieces:
                each = sizes[pieces]
                ends = np.cumsum(each)
                count = int(ends[-1]) if len(ends) else 0
                shift = np.repeat(starts[pieces] - (ends - each), each)
                counts.append(count)
                ids.append(flat[shift + np.arange(count)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    source = bodies(docs, id_column, text_column)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary: Broadcast, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Bytes of token ids: ``doc_id, n_tokens, ids, body``; null ids give empty bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary.value.tokens
        for batch, ids in slices(batches, "ids"):
            texts = [b"".join([tokens[i] for i in np.frombuffer(each, "<u4").tolist()]) for each in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names=["doc_id", "n_tokens", "ids", "body"]
            )

    ids = F.coalesce(F.col(ids_column), F.lit(b""))
    source = encoded.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        ids.alias("ids"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, body binary")
