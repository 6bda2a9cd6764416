"""Quality rules, and a linear-chain CRF that labels the lines of a text.

Every line is content or boilerplate. The weights of the line features and of
the transitions are fitted on a bounded sample of labelled documents. Labels of
lines are not given, so they are latent: a document's label only makes content
more or less likely at each of its lines. A first fit finds how likely each line
is content, by its features and its document; the chain is then fitted to these
chances, so that it learns both to stay and to move: good documents hold
boilerplate lines and bad ones content. Viterbi decoding finds the best labels of
each text, and the share of words in content lines decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.llm.common import bodies, slices

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
FEATURES = ("bias", "words", "short", "word_length", "symbols", "digits", "upper", "marks", "echo", "repeated")
# Lines in a training sequence; longer texts are cut into several.
CHAIN = 64
PENALTY = 1e-3
CONTENT_WEIGHT = 5.0
# Log odds that a line is content, in a bad and in a good document: 0.3 and 0.95.
ODDS = (np.log(0.3 / 0.7), np.log(0.95 / 0.05))
# The fit begins with lines that nearly take the label of their document.
FIRST_ODDS = 6.0

_CLASS = {
    name: np.isin(np.arange(256), np.frombuffer(members, np.uint8))
    for name, members in {
        "space": b" \t\n\x0b\x0c\r",
        "symbol": SYMBOLS,
        "digit": b"0123456789",
        "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "mark": b"!?;:=_/\\@^~+{}[]()\"'",
    }.items()
}
_CLASS["inner"] = (np.arange(256) & 0xC0) == 0x80  # continuation of a character


@dataclass
class LineModel:
    """Weights of a two-state chain; state 1 is content."""

    weights: np.ndarray
    moves: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Score of content over boilerplate for each line."""
        return features @ self.weights

    def label(self, scores: list[float]) -> list[bool]:
        """Viterbi: the best sequence; ties go to content."""
        (stay0, to1), (to0, stay1) = self.moves.tolist()
        bad, good = 0.0, 0.0
        back = []
        for place, score in enumerate(scores):
            if place:
                from_good0, from_good1 = good + to0 > bad + stay0, good + stay1 >= bad + to1
                bad, good = (
                    good + to0 if from_good0 else bad + stay0,
                    good + stay1 if from_good1 else bad + to1,
                )
                back.append((from_good0, from_good1))
            good += score
        state = good >= bad
        labels = [state]
        for pair in reversed(back):
            state = pair[state]
            labels.append(state)
        return labels[::-1]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Features of all lines, each from 0 to 1, the number of lines of each text, and counts by line."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return sums[ends] - sums[starts]

    space = _CLASS["space"][data]
    word_start = ~space
    word_start[1:] &= space[:-1]
    counts = {
        "words": count(word_start),
        "chars": count(~space & ~_CLASS["inner"][data]),
        "symbols": count(_CLASS["symbol"][data]),
    }
    lines_of = np.array([text.count(b"\n") + 1 for text in texts], dtype=np.int64)
    repeated, echo = np.zeros(len(ends), dtype=bool), np.zeros(len(ends))
    place = 0
    for text in texts:
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            repeated[place] = line in seen
            seen.add(line)
            parts = line.split()
            echo[place] = sum(map(eq, parts, parts[1:]))
            place += 1
    counts["repeated"] = repeated & (counts["words"] > 0)
    chars, words = np.maximum(counts["chars"], 1), np.maximum(counts["words"], 1)
    features = np.stack(
        [
            np.ones(len(ends)),
            np.minimum(counts["words"] / 30, 1),
            counts["words"] <= 3,
            np.minimum(counts["chars"] / words / 15, 1),
            np.minimum(4 * counts["symbols"] / words, 1),
            np.minimum(2 * count(_CLASS["digit"][data]) / chars, 1),
            np.minimum(2 * count(_CLASS["upper"][data]) / chars, 1),
            np.minimum(count(_CLASS["mark"][data]) / words, 1),
            np.minimum(2 * echo / words, 1),
            counts["repeated"],
        ],
        axis=1,
    ).astype(np.float64)
    return features, lines_of, counts


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for place in range(window):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + (hashes[place : place + n] ^ (keys >> np.uint64(31)))
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(n, bool)
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    same[1:] |= equal
    same[:-1] |= equal
    change = np.zeros(len(words) + 1, np.int64)
    starts = order[same]
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return int((np.cumsum(change) > 0).sum())


def fit_line_model(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    max_documents: int = 2000,
    max_chains: int = 8000,
    steps: int = 200,
) -> LineModel:
    """Fit the chain on at most ``max_documents`` labelled documents, taken by hash of the id.

    Half of them, if there are so many, are of the rarer label. Of their chains
    of at most 64 lines, ``max_chains`` at most come to the driver, taken by hash, as
    numbers and not as text. Repeated labels of a document count once (the
    lowest); null ids and labels are left out. Without both labels, or without
    text, the untrained weights are returned, which mark lines with symbols as
    boilerplate.
    """
    known = (
        labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    sample = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents // 2)
        sample = part if sample is None else sample.unionByName(part)
    # At most max_documents ids: a broadcast of bounded size.
    rows = (
        bodies(docs, id_column, text_column)
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.min("body").alias("body"))
        .select(F.xxhash64("doc_id").alias("doc"), "label", "body")
        .mapInArrow(_chains, "doc long, label int, chain long, features binary")
        .orderBy(F.xxhash64("doc", "chain"), "doc", "chain", "features")
        .limit(max_chains)
        .toPandas()
    )
    given = rows["label"].to_numpy()
    if len(set(given.tolist())) < 2:
        weights = np.zeros(len(FEATURES))
        weights[FEATURES.index("bias")], weights[FEATURES.index("symbols")] = 2.0, -6.0
        return LineModel(weights, np.zeros((2, 2)))
    return _fit([np.frombuffer(part, "<f4").reshape(-1, len(FEATURES)) for part in rows["features"]], given, steps)


def _chains(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of each text, cut into chains."""
    for batch, texts in slices(batches):
        features, lines_of, _ = line_features(texts)
        ends = np.cumsum(lines_of)
        row, chain, packed = [], [], []
        for number, (start, end) in enumerate(zip(ends - lines_of, ends)):
            for low in range(start, end, CHAIN):
                row.append(number)
                chain.append((low - start) // CHAIN)
                packed.append(features[low : min(low + CHAIN, end)].astype("<f4").tobytes())
        taken = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc").take(taken), batch.column("label").take(taken), pa.array(chain, pa.int64()), pa.array(packed, pa.binary())],
            names=["doc", "label", "chain", "features"],
        )


def _marginals(unary: np.ndarray, moves: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of content at each place of each chain, and expected number of moves in each chain, by forward and backward sums."""
    width = inside.shape[1]
    forward, backward = np.zeros_like(unary), np.zeros_like(unary)
    forward[:, 0] = unary[:, 0]
    for t in range(1, width):
        reach = forward[:, t - 1, :, None] + moves
        # Beyond a chain's end the sums stay as they are.
        forward[:, t] = np.where(inside[:, t, None], np.logaddexp(reach[:, 0], reach[:, 1]) + unary[:, t], forward[:, t - 1])
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    for t in range(width - 2, -1, -1):
        reach = moves + (unary[:, t + 1] + backward[:, t + 1])[:, None, :]
        backward[:, t] = np.where(inside[:, t + 1, None], np.logaddexp(reach[..., 0], reach[..., 1]), backward[:, t + 1])
    content = np.exp(forward + backward - total[:, None, None])[..., 1] * inside
    pair = forward[:, :-1, :, None] + moves + (unary + backward)[:, 1:, None, :] - total[:, None, None, None]
    return content, (np.exp(np.where(inside[:, 1:, None, None], pair, -np.inf))).sum(axis=1)


def _fit(parts: list[np.ndarray], given: np.ndarray, steps: int) -> LineModel:
    """Two fits by Adam: of single lines, whose labels are latent, to the documents' labels; then of the chain to what came out."""
    sizes = np.array([len(part) for part in parts])
    inside = np.arange(sizes.max()) < sizes[:, None]
    padded = np.zeros((*inside.shape, len(FEATURES)))
    padded[inside] = np.concatenate(parts)
    # In sum, content weighs more than boilerplate, so that doubtful lines stay; a chain weighs by its lines up to ten.
    weight = np.minimum(sizes, 10) / sizes
    for label in (0, 1):
        share = CONTENT_WEIGHT if label else 1.0
        weight[given == label] *= share / max((weight * sizes)[given == label].sum(), 1e-9)
    weights, moves = np.zeros(len(FEATURES)), np.zeros((2, 2))
    first = [np.zeros_like(weights), np.zeros_like(moves)]
    second = [np.zeros_like(weights), np.zeros_like(moves)]
    lines, targets = steps // 2, None
    for step in range(1, steps + 1):
        scores = padded @ weights
        unary = np.stack([np.zeros_like(scores), scores], axis=2)
        # Lines by themselves at first. From their documents' labels alone, of which all lines take the same,
        # a chain would only learn to stay.
        hard = max(0.0, 1 - 1.5 * step / lines)
        odds = np.array([hard * sign * FIRST_ODDS + (1 - hard) * soft for sign, soft in zip((-1, 1), ODDS)])
        if step <= lines:
            told = inside / (1 + np.exp(-scores - odds[given][:, None]))
            gap = told - inside / (1 + np.exp(-scores))
            grad_moves = np.zeros_like(moves)
        else:
            if targets is None:
                # What lines and documents tell of each line; the chain is fitted to it, its moves included.
                both = np.stack([inside - told, told], axis=2)
                targets = told, np.einsum("cti,ctj->cij", both[:, :-1], both[:, 1:])
            content, pairs = _marginals(unary, moves, inside)
            gap = targets[0] - content
            grad_moves = ((targets[1] - pairs) * weight[:, None, None]).sum(axis=0) - PENALTY * moves
        grad_weights = np.einsum("ct,ctf->f", gap * weight[:, None], padded) - PENALTY * weights
        for values, grad, m, v in ((weights, grad_weights, first[0], second[0]), (moves, grad_moves, first[1], second[1])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            values += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return LineModel(weights, moves)


def keep_good(docs: DataFrame, model: LineModel, text_column: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, with all their columns."""
    extra = {name: F.col(f"`{name}`") for name in docs.columns}
    row = docs.select(F.struct(*(column.alias(name) for name, column in extra.items())).alias("row"), F.col(text_column).alias("text"))
    judged = judge_quality(row, model, id_column="row", text_column="text", **rules)
    return judged.where("kept").select("doc_id.*")


def judge_quality(
    docs: DataFrame,
    model: LineModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = 20,
    max_repeated_percent: int = 30,
    min_content: float = 0.5,
) -> DataFrame:
    """Counts, base rules and verdict of whole texts.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, content_lines, content_share, base_failed, kept``,
    one row per row. A null or empty text has no words and fails the base
    rules; its content share is 0. Other columns are left out. ``content_share``
    is the share of words in content lines.
    """
    columns = {
        "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
        "n_repeat_words": pa.int64(), "n_lines": pa.int64(), "content_lines": pa.int64(), "content_share": pa.float64(),
    }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            features, lines_of, counts = line_features(texts)
            scores = model.scores(features).tolist()
            rows = []
            start = 0
            for text, size in zip(texts, lines_of.tolist()):
                end = start + size
                labels = np.array(model.label(scores[start:end]))
                words = counts["words"][start:end]
                total = int(words.sum())
                share = float(words[labels].sum() / total) if total else 0.0
                rows.append(
                    (
                        total,
                        int(counts["chars"][start:end].sum()),
                        int(counts["symbols"][start:end].sum()),
                        int(counts["repeated"][start:end].sum()),
                        repeated_words(text.split()),
                        size,
                        int(labels.sum()),
                        share,
                    )
                )
                start = end
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), columns.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *columns])

    source = bodies(docs, id_column, text_column)
    kind = source.schema["doc_id"].dataType.simpleString()
    spec = ", ".join(f"{name} {'double' if t == pa.float64() else 'long'}" for name, t in columns.items())
    judged = source.mapInArrow(run, f"doc_id {kind}, {spec}")
    repeated = 100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words")
    failed = (F.col("n_words") < min_words) | repeated
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("content_share") >= min_content)
    )
