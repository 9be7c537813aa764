"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwin.llm.queries import QUERIES
from metricwin.llm.whitening import Centre, leading_components, whiten

VECTORS = "vec_id long, embedding array<double>, label int"


def dense(entries, k, scale=1024, shift=100_000):
    """x, exact deviations, eigenvalues, whitened coordinates and trace, by the plain way."""
    x = np.floor(scale * np.array(entries, float)) + shift
    n, sums = len(x), x.sum(axis=0)
    away = n * x.astype(object) - sums.astype(object)
    centred = x - sums / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return [int(d) for d in (away * away).sum(axis=1)], values, centred @ vectors / np.sqrt(values), np.trace(v)


def check(rows, ids, entries, k=8):
    deviations, values, whitened, trace = dense(entries, k)
    assert len(rows) == len(ids) * len(values)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    table = np.array([[got[i, c + 1]["whitened"] for c in range(len(values))] for i in ids])
    sign = np.sign((table * whitened).sum(axis=0))
    assert np.abs(table * sign - whitened).max() < 1e-6
    for i, d in zip(ids, deviations, strict=True):
        assert got[i, 1]["deviation"] == d
        assert got[i, 1]["n"] == len(ids)
    for c, value in enumerate(values):
        assert got[ids[0], c + 1]["explained"] == pytest.approx(value / trace, rel=1e-9)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]}
    assert rows[0]["identity_error"] < 1e-9


def test_query_equals_dense(spark, data):
    rows = QUERIES["op11_chebyshev_whitening"](spark, data).collect()
    table = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    sound = [
        r for r in table if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)
    ]
    check(rows, [r.vec_id for r in sound], [r.embedding for r in sound])


@pytest.mark.parametrize("spectrum", ["flat", "outlier", "steep", "pairs"])
def test_filter_finds_the_leading_eigenvectors(spectrum):
    rng = np.random.default_rng(3)
    dim, k = 60, 8
    basis = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    values = {
        "flat": 1 + 0.1 * rng.random(dim),
        "outlier": np.concatenate([[1e6], 1 + 0.2 * rng.random(dim - 1)]),
        "steep": 10.0 ** -np.linspace(0, 12, dim),
        "pairs": np.repeat(np.linspace(1, 2, dim // 2), 2),
    }[spectrum]
    values = np.sort(values)[::-1]
    matrix = basis * values @ basis.T
    passes = []

    def apply(block):
        passes.append(block.shape[1])
        return matrix @ block

    found = leading_components(apply, dim, k)
    assert found.values == pytest.approx(values[:k], rel=1e-9, abs=1e-9 * values[0])
    assert found.residual < 1e-10
    assert len(passes) == found.passes < 300
    assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-12


def test_uncertified_is_an_error():
    rng = np.random.default_rng(4)
    noise = lambda block: rng.standard_normal(block.shape)
    with pytest.raises(ArithmeticError):
        leading_components(noise, 60, 8, most_passes=30)


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    sound = [(i, rng.standard_normal(10).tolist(), 1) for i in range(40)]
    rows = [
        *sound,
        (0, sound[0][1], 2),
        (None, sound[1][1], None),
        (100, None, 1),
        (101, [], 1),
        (102, [None, *[1.0] * 9], 1),
        (103, [math.nan, *[1.0] * 9], 1),
        (104, [math.inf, *[1.0] * 9], 1),
        (105, [1e300, *[1.0] * 9], 1),
        (106, [0.0] * 10, 1),
    ]
    table = spark.createDataFrame(rows, VECTORS).withColumns(
        {c: F.lit("own") for c in ("x", "key", "k", "n", "component", "y0")}
    )
    got = whiten(table, components=8).collect()
    kept = [(r[0], r[1]) for r in rows if r[0] is None or r[0] < 100 or r[0] == 106]
    assert len(got) == 8 * len(kept)
    assert {r["vec_id"] for r in got} == {k[0] for k in kept}
    deviations, _, whitened, _ = dense([k[1] for k in kept], 8)
    assert sorted(r["deviation"] for r in got if r["component"] == 3) == sorted(deviations)
    zero = [r["whitened"] for r in got if r["vec_id"] == 106]
    assert np.abs(zero) == pytest.approx(np.abs(whitened[-1]), abs=1e-8)


def test_lengths_are_fitted_apart(spark):
    rng = np.random.default_rng(6)
    short = [(i, rng.standard_normal(3).tolist(), 0) for i in range(20)]
    long = [(100 + i, rng.standard_normal(12).tolist(), 0) for i in range(30)]
    got = whiten(spark.createDataFrame(short + long, VECTORS)).collect()
    check([r for r in got if r["vec_id"] < 100], [r[0] for r in short], [r[1] for r in short])
    check([r for r in got if r["vec_id"] >= 100], [r[0] for r in long], [r[1] for r in long])


def test_few_and_equal_rows(spark):
    assert whiten(spark.createDataFrame([], VECTORS)).collect() == []
    equal = [(i, [1.0, 2.0, 3.0], 0) for i in range(4)]
    assert whiten(spark.createDataFrame(equal[:1], VECTORS)).collect() == []
    assert whiten(spark.createDataFrame(equal, VECTORS)).collect() == []
    line = [(0, [0.0, 0.0], 0), (1, [1.0, 1.0], 0), (2, [3.0, 3.0], 0)]
    got = whiten(spark.createDataFrame(line, VECTORS)).collect()
    assert {r["component"] for r in got} == {1}
    assert {round(r["explained"], 9) for r in got} == {1.0}


def test_deviation_past_a_long_is_null():
    centre = Centre(1 << 20, (0, 0), (0, 0))
    assert centre.deviations(np.array([[1 << 30, 0], [1, 2]])) == [None, 5 << 40]
