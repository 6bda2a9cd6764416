import numpy as np
import pytest

from filehaul.llm import whitening
from filehaul.llm.queries import op13_embedding_whitening

from .conftest import DATA


def plain(vectors, components=4):
    """Whitened coordinates by a dense eigendecomposition, for lists of finite numbers of one length."""
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for v in vectors], dtype=object)
    distinct = np.array(sorted({tuple(row) for row in x}), dtype=object)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = ((distinct * n - sums) / n).astype(float)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [int(sum((n * row - sums) ** 2)) for row in x]
    return n, deviation, ((x * n - sums) / n).astype(float) @ vectors / np.sqrt(values), values / np.trace(covariance)


def check(rows, ids, vectors, components=4):
    n, deviation, whitened, explained = plain(vectors, components)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(ids) * components == len(by)
    for component in range(components):
        got = [by[i, component + 1] for i in ids]
        assert all(r["n"] == n for r in got) and [r["deviation"] for r in got] == deviation
        values = np.array([r["whitened"] for r in got])
        sign = np.sign(values @ whitened[:, component])
        assert np.abs(values * sign - whitened[:, component]).max() < 1e-8
        assert got[0]["explained"] == pytest.approx(explained[component], rel=1e-10)
        assert got[0]["identity_error"] < 1e-10


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    rows = op13_embedding_whitening(spark, f"/root/testdata/{sf}").collect()
    check(rows, [r["vec_id"] for r in table], [r["embedding"] for r in table])
    assert DATA


@pytest.mark.parametrize("seed", range(6))
def test_updates_give_the_spectrum_of_the_scatter(seed):
    """Random, low-rank, repeated and nearly equal rows; in blocks, and combined from parts."""
    source = np.random.default_rng(seed)
    rows = source.normal(size=(200, 12)) * (10.0 ** source.integers(-4, 4, 12) if seed % 2 else 1.0)
    if seed >= 2:
        rows[:, 3:6] = rows[:, :3]
    if seed >= 4:
        rows = np.repeat(rows[:5], 40, axis=0) + (1e-9 * source.normal(size=(200, 12)) if seed == 5 else 0)
    rows = rows + 50
    parts = []
    for part in np.array_split(rows, 3):
        spectrum = whitening.Spectrum.empty(12)
        for block in np.array_split(part, 4):
            spectrum.add_rows(block)
        parts.append(spectrum)
    whole = parts[0]
    for part in parts[1:]:
        whole.add(whitening.Spectrum.unpack(part.pack(), 12))
    centred = rows - rows.mean(axis=0)
    scatter = centred.T @ centred
    assert whole.count == len(rows) and np.allclose(whole.mean, rows.mean(axis=0))
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(12)).max() < 1e-11
    made = whole.vectors * whole.values @ whole.vectors.T
    assert np.abs(made - scatter).max() < 1e-11 * max(np.abs(scatter).max(), 2500 * 200 * 1e-3)


def test_one_row_at_a_time_equals_blocks():
    rows = np.random.default_rng(1).normal(size=(60, 5))
    one, block = whitening.Spectrum.empty(5), whitening.Spectrum.empty(5)
    for row in rows:
        one.add_rows(row[None])
    block.add_rows(rows)
    assert np.allclose(one.values, block.values) and np.allclose(one.mean, block.mean)


def test_a_wrong_basis_is_not_repaired(spark, monkeypatch):
    """The updates decide the result: from some other vectors, one step of refinement gives other components."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    right = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in whitening.whiten(table).collect()}
    monkeypatch.setattr(whitening, "MAX_REFINEMENTS", 1)
    monkeypatch.setattr(whitening, "spectrum", lambda fit, d: whitening.Spectrum.empty(d))
    wrong = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in whitening.whiten(table).collect()}
    assert max(abs(right[k] - wrong[k]) for k in right) > 0.5


def test_odd_rows(spark):
    source = np.random.default_rng(4)
    good = [source.normal(size=5).tolist() for _ in range(30)]
    good += [good[0], good[1], [0.0, -0.0, 1e-9, -1e-9, 3.0]]
    rows = [(i, v, "taken") for i, v in enumerate(good)]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows += [(100 + i, v, "taken") for i, v in enumerate(bad)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string").withColumn("n", table_null())
    check(whitening.whiten(table, components=3).collect(), list(range(len(good))), good, components=3)
    floats = table.withColumn("embedding", table.embedding.cast("array<float>"))
    assert whitening.whiten(floats).count() == 4 * len(good)
    # Repeated rows and null ids stay rows; they add nothing to the fit.
    again = table.unionByName(table.withColumn("vec_id", table_null().cast("long")))
    assert whitening.whiten(again).count() == 8 * len(good)
    assert whitening.whiten(again).first()["n"] == len({tuple(np.floor(np.array(v) * 256)) for v in good})
    for few in (table.limit(0), table.where("vec_id = 3"), table.where("vec_id in (0, 30)"), table.where("vec_id >= 100 and vec_id < 102")):
        assert whitening.whiten(few).count() == 0
    # Two distinct vectors have one direction.
    assert whitening.whiten(table.where("vec_id in (2, 3)")).count() == 2


def table_null():
    from pyspark.sql import functions as F

    return F.lit(None).cast("string")
