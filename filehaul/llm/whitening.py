"""Whitening of embeddings by an eigendecomposition that grows by rank-one updates.

Every task keeps the mean and the spectrum of the scatter of the rows it has
read. A block of rows is centred and turned into at most as many rows as there
are dimensions, of the same scatter (the triangle of a QR); each of those is a
rank-one update, whose new eigenvalues are the roots of the secular equation.
Entries that the update does not reach, and all but one of equal eigenvalues,
are deflated. Spectra of tasks are combined in a tree by the same updates: one
for each eigenvector of the other, and one for the distance of the means. The
leading vectors are then refined by Rayleigh-Ritz steps over all rows, until
the residuals are at the limit of double precision.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.storage import delete_stored, store_once

SCALE = 256
# A spectrum is a square matrix of this many columns at most.
MAX_DIMENSIONS = 4096
# Spectra that one task combines.
FAN = 16
# Vectors refined beyond those asked for, so that the ones asked for stand apart from what is left out.
OVERSAMPLING = 8
MAX_REFINEMENTS = 6
RESIDUAL = 1e-13
# Eigenvalues below this share of the largest are taken for zero, and have no component.
RANK = 1e-12
_EPS = np.finfo(np.float64).eps


def _secular_roots(values: np.ndarray, squares: np.ndarray, rho: float) -> np.ndarray:
    """``values[i] - root[j]`` for all roots of ``1 + rho * sum(squares / (values - root)) = 0``, rho above zero.

    Root j lies between value j and the next, and is kept as its distance to
    the nearer of both, so that small differences stay exact. All roots are
    bracketed and halved together.
    """
    ends = np.append(values[1:], values[-1] + rho)
    middle = (values + ends) / 2
    at_middle = 1 + rho * (squares[:, None] / (values[:, None] - middle)).sum(axis=0)
    left = at_middle >= 0
    left[-1] = True  # no pole at the right of the last
    origin = np.where(left, values, ends)
    side = np.where(left, 1.0, -1.0)
    from_origin = values[:, None] - origin
    high = np.where(left, middle - values, ends - middle)
    high[-1] = rho
    low = high * 1e-40
    for _ in range(64):
        half = np.where(high > 4 * low, np.sqrt(low) * np.sqrt(high), (low + high) / 2)
        value = side * (1 + rho * (squares[:, None] / (from_origin - side * half)).sum(axis=0))
        farther = value < 0
        low, high = np.where(farther, half, low), np.where(farther, high, half)
    return from_origin - side * (low + high) / 2


@dataclass
class Spectrum:
    """Count, mean, and the scatter around the mean as ascending eigenvalues and orthonormal vectors (columns)."""

    count: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimensions: int) -> Spectrum:
        return cls(0, np.zeros(dimensions), np.zeros(dimensions), np.eye(dimensions))

    def update(self, vector: np.ndarray, weight: float = 1.0) -> None:
        """Add ``weight * vector vector^T`` to the scatter."""
        z = self.vectors.T @ vector
        norm = np.sqrt(z @ z)
        rho = weight * norm * norm
        if not rho > 0:
            return
        z = z / norm
        values, vectors = self.values, self.vectors
        limit = 8 * _EPS * max(values[-1], rho)
        reached = rho * np.abs(z) > limit
        kept: list[int] = []
        # Of nearly equal eigenvalues a rotation leaves one that the update reaches.
        for place in np.flatnonzero(reached).tolist():
            if kept:
                last = kept[-1]
                length = np.hypot(z[last], z[place])
                c, s = z[place] / length, z[last] / length
                if abs((values[place] - values[last]) * c * s) <= limit:
                    z[place], z[last] = length, 0.0
                    one, other = vectors[:, last].copy(), vectors[:, place].copy()
                    vectors[:, last], vectors[:, place] = c * one - s * other, s * one + c * other
                    low, high = values[last], values[place]
                    values[last], values[place] = low * c * c + high * s * s, low * s * s + high * c * c
                    kept.pop()
            kept.append(place)
        if not kept:
            return
        on = np.array(kept)
        poles = values[on]
        apart = _secular_roots(poles, z[on] ** 2, rho)
        # The update whose exact roots these are: its vectors are orthogonal however close the roots lie.
        size = len(on)
        between = poles[None, :] - poles[:, None]
        others = between[~np.eye(size, dtype=bool)].reshape(size, size - 1)
        squares = np.prod(-apart[:, :-1] / others, axis=1) * (-apart[:, -1] / rho)
        turn = np.copysign(np.sqrt(np.abs(squares)), z[on])[:, None] / apart
        turn /= np.sqrt((turn**2).sum(axis=0))
        vectors[:, on] = vectors[:, on] @ turn
        values[on] = poles - apart.diagonal()
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = np.maximum(values[order], 0.0), vectors[:, order]

    def _move(self, count: int, mean: np.ndarray) -> None:
        """Take in the mean of ``count`` rows whose own scatter has been added."""
        both = self.count + count
        if self.count and count:
            self.update(mean - self.mean, self.count * (count / both))
        self.mean = self.mean + (mean - self.mean) * (count / both)
        self.count = both

    def add_rows(self, rows: np.ndarray) -> None:
        mean = rows.mean(axis=0)
        for row in np.linalg.qr(rows - mean, mode="r"):
            self.update(row)
        self._move(len(rows), mean)

    def add(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(vector, value)
        self._move(other.count, other.mean)

    def pack(self) -> bytes:
        return np.concatenate([[float(self.count)], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpack(cls, data: bytes, dimensions: int) -> Spectrum:
        flat = np.frombuffer(data, np.float64)
        count, mean, values, vectors = np.split(flat, [1, 1 + dimensions, 1 + 2 * dimensions])
        return cls(int(count[0]), mean.copy(), values.copy(), vectors.reshape(dimensions, dimensions).copy())


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dimensions)


def _integers(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, x`` of the rows whose vector has only finite entries."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda entry: entry.isNotNull() & (F.abs(entry) < float("inf")))
    return rows.where(vector.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_column).alias("vec_id"), F.transform(vector, lambda entry: F.floor(entry.cast("double") * SCALE).cast("long")).alias("x")
    )


def _summed(fit: DataFrame, work, size: int) -> np.ndarray:
    """Sum over all tasks of the array that ``work`` makes of the batches of a task; ``size`` entries come to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(batch)
                total = part if total is None else total + part
        if total is not None:
            kind = pa.int64() if total.dtype == np.int64 else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(kind))], names=["part"])

    whole = work(None)
    parts = fit.mapInArrow(run, f"part array<{'long' if whole.dtype == np.int64 else 'double'}>")
    rows = parts.select(F.posexplode("part")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    for row in rows:
        whole[row["pos"]] = row["total"]
    assert len(whole) == size
    return whole


def spectrum(fit: DataFrame, dimensions: int) -> Spectrum:
    """Spectrum of all rows ``x`` of the table."""

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(dimensions)
        for batch in batches:
            if batch.num_rows:
                own.add_rows(_matrix(batch, dimensions).astype(np.float64))
        if own.count:
            yield pa.RecordBatch.from_pydict({"place": [TaskContext.get().partitionId()], "data": [own.pack()]})

    def combine(key: tuple, table: pa.Table) -> pa.Table:
        datas = [data for _, data in sorted(zip(table.column("place").to_pylist(), table.column("data").to_pylist()))]
        own = Spectrum.unpack(datas[0], dimensions)
        for data in datas[1:]:
            own.add(Spectrum.unpack(data, dimensions))
        return pa.table({"place": pa.array([key[0].as_py()], pa.int64()), "data": [own.pack()]})

    schema = "place long, data binary"
    spectra, seen = store_once(fit.mapInArrow(grow, schema), "spectra", {"last": F.max("place")})
    last = seen["last"]
    while last:
        former = spectra
        spectra, _ = store_once(former.groupBy(F.expr(f"place div {FAN}")).applyInArrow(combine, schema), "spectra")
        delete_stored(former)
        last //= FAN
    found = Spectrum.unpack(spectra.first()["data"], dimensions)
    delete_stored(spectra)
    return found


@dataclass
class Whitening:
    """A fitted transformation: ``components`` are columns, by falling eigenvalue."""

    count: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit_whitening(fit: DataFrame, dimensions: int, components: int = 4) -> Whitening:
    """Fit on the rows ``x`` (each counts once) of a stored table that has rows."""
    count = fit.count()
    zeros = lambda size, kind=np.float64: np.zeros(size, kind)
    sums = _summed(fit, lambda b: zeros(dimensions, np.int64) if b is None else _matrix(b, dimensions).sum(axis=0), dimensions)
    width = min(dimensions, components + OVERSAMPLING)
    basis = np.linalg.qr(spectrum(fit, dimensions).vectors[:, ::-1][:, :width])[0]

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (_matrix(batch, dimensions) * count - sums) / count

    for _ in range(MAX_REFINEMENTS):

        def product(batch: pa.RecordBatch | None, basis: np.ndarray = basis) -> np.ndarray:
            if batch is None:
                return zeros(dimensions * width + 1)
            x = centred(batch)
            return np.append((x.T @ (x @ basis)).ravel(), (x * x).sum())

        total = _summed(fit, product, dimensions * width + 1) / count
        image, trace = total[:-1].reshape(dimensions, width), float(total[-1])
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz = basis @ turn
        missed = image @ turn - ritz * values
        if np.abs(missed[:, :components]).max() <= RESIDUAL * max(values[0], 1e-300) * dimensions:
            break
        basis = np.linalg.qr(image @ turn)[0]
    on = np.flatnonzero(values[:components] > RANK * max(trace, 1e-300))
    chosen = ritz[:, on] * np.sign(ritz[np.abs(ritz[:, on]).argmax(axis=0), on])
    values = values[on].copy()
    whiten = chosen / np.sqrt(values)
    size = len(on)

    def moments(batch: pa.RecordBatch | None) -> np.ndarray:
        if batch is None:
            return zeros(size * size + size)
        z = centred(batch) @ whiten
        return np.append((z.T @ z).ravel(), z.sum(axis=0))

    error = 0.0
    if size:
        total = _summed(fit, moments, size * size + size) / count
        square, mean = total[: size * size].reshape(size, size), total[size * size :]
        error = float(np.abs(square - np.outer(mean, mean) - np.eye(size)).max())
    return Whitening(count, sums, chosen, values, trace, error)


def whiten(
    rows: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable row and component.

    Rows whose vector is null or holds a null or an infinite entry or NaN are
    left out, and so are those that have not as many entries as most rows
    (ties: the longer). Each distinct vector counts once in the fit. Repeated
    rows and null ids stay. Components of an eigenvalue of zero do not exist:
    equal vectors, a single row and an empty table give no rows.
    """
    spark = rows.sparkSession
    usable = _integers(rows, id_column, vector_column)
    kind = usable.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    most = usable.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dimensions = most["size"] if most else 0
    if dimensions > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {dimensions} entries, at most {MAX_DIMENSIONS} are allowed")
    if not dimensions:
        return spark.createDataFrame([], schema)
    usable = usable.where(F.size("x") == dimensions)
    fit, _ = store_once(usable.select("x").distinct(), "distinct-vectors")
    model = fit_whitening(fit, dimensions, components)
    delete_stored(fit)
    return apply_whitening(usable, model, schema)


def apply_whitening(usable: DataFrame, model: Whitening, schema: str) -> DataFrame:
    """The rows of ``usable`` (``vec_id, x``) in the coordinates of the model."""
    count, sums, dimensions, size = model.count, model.sums, len(model.sums), len(model.values)
    turn = model.components / np.sqrt(model.values)
    explained = model.values / model.trace if size else model.values

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not size:
                continue
            apart = _matrix(batch, dimensions) * count - sums
            if float(np.abs(apart).max()) ** 2 * dimensions >= 2.0**63:
                raise OverflowError("deviation does not fit into a long")
            many = batch.num_rows
            arrays = [
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(many), size))),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), many)),
                pa.array(np.full(many * size, count, np.int64)),
                pa.array(np.repeat((apart * apart).sum(axis=1), size)),
                pa.array(((apart / count) @ turn).ravel()),
                pa.array(np.tile(explained, many)),
                pa.array(np.full(many * size, model.identity_error)),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return usable.mapInArrow(run, schema)
