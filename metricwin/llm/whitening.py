"""Whitening by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed. A block of directions Q is multiplied by it in a pass over
the vectors, XᵀXQ with X centred: each task adds up its own rows' products and only one row per
dimension and task is shuffled. A Chebyshev polynomial of the covariance, grown by its three-term
recurrence at one pass a degree, damps the part of the spectrum that is not wanted; QR and a
Rayleigh-Ritz step turn the block into approximate eigenvectors with residuals. Converged ones are
locked and projected out, the rest is filtered again, until all residuals are certified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwin.llm.common import small_batches, table

#: Entries from here on, times the scale, are no longs.
LONGEST = float(1 << 62)

Apply = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Centre:
    """Sums of the fit list, kept exactly: each dimension's sum is ``whole * n + rest``."""

    n: int
    whole: tuple[int, ...]
    rest: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean, rounded once for an entry of usual size."""
        return (x - np.array(self.whole, np.int64)) - np.array(self.rest, np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """For each row the sum over dimensions of (n * x - sum)^2; null where no long holds it."""
        away = x - np.array(self.whole, np.int64)
        largest = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if x.shape[1] * largest * largest < 1 << 63:
            exact = away * self.n - np.array(self.rest, np.int64)
            return (exact * exact).sum(axis=1).tolist()
        exact = away.astype(object) * self.n - np.array(self.rest, object)
        return [s if s < 1 << 63 else None for s in (int(t) for t in (exact * exact).sum(axis=1))]


@dataclass(frozen=True)
class Components:
    """Eigenvectors as columns by falling eigenvalue, and how they were found."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int


def _sound(vector: Column) -> Column:
    """Not null, not empty, and every entry a number that times the scale is a long."""

    def usable(c: Column) -> Column:
        d = c.cast("double")
        return c.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))

    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, usable), F.lit(False))


def integer_vectors(vectors: DataFrame, key: str, column: str, scale: int, shift: int) -> DataFrame:
    """``key, x``: entries as floor(scale * entry) + shift, without rows that are not sound."""
    v = F.col(column)
    inside = F.forall(v, lambda c: F.abs(c.cast("double")) * scale < F.lit(LONGEST))
    rows = vectors.where(_sound(v)).where(inside)
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long") + shift)
    return rows.select(F.col(key).alias("key"), x.alias("x"))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def centre_of(rows: DataFrame, n: int, dim: int) -> Centre:
    """Exact sums per dimension: high and low halves are added apart, in longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            x = _matrix(batch, dim)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim)), pa.array(high), pa.array(low)], names=["k", "high", "low"]
        )

    parts = rows.select("x").mapInArrow(run, "k long, high long, low long")
    found = parts.groupBy("k").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    sums = [0] * dim
    for r in found:
        sums[r["k"]] = (r["high"] << 32) + r["low"]
    return Centre(n, tuple(s // n for s in sums), tuple(s % n for s in sums))


def _summed(rows: DataFrame, dim: int, centre: Centre, of: Callable, height: int, width: int):
    """The sum over all rows of ``of(centred rows)``, a matrix of ``height`` rows.

    Each task adds up its own and passes on ``height`` rows; those are added in a shuffle.
    """
    names = [f"y{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in batches:
            if batch.num_rows:
                total += of(centre.centred(_matrix(batch, dim)))
        columns = [pa.array(np.arange(height)), *[pa.array(total[:, j]) for j in range(width)]]
        yield pa.RecordBatch.from_arrays(columns, names=["k", *names])

    schema = "k long, " + ", ".join(f"{c} double" for c in names)
    parts = rows.select("x").mapInArrow(run, schema)
    out = np.zeros((height, width))
    for r in parts.groupBy("k").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[r["k"]] = [r[c] for c in names]
    return out


def covariance_times(rows: DataFrame, dim: int, centre: Centre) -> Apply:
    """The pass Q -> covariance * Q. A block of directions goes to the tasks, one comes back."""

    def apply(block: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            return x.T @ (x @ block)

        return _summed(rows, dim, centre, of, dim, block.shape[1]) / centre.n

    return apply


def trace_of(rows: DataFrame, dim: int, centre: Centre) -> float:
    """The sum of all variances."""

    def of(x: np.ndarray) -> np.ndarray:
        return (x * x).sum(axis=0)[:, None]

    return float(_summed(rows, dim, centre, of, dim, 1).sum()) / centre.n


def _lowest(diagonal: list[float], beside: list[float]) -> float:
    """A bound below the spectrum out of some Lanczos steps: least Ritz value less the last link."""
    t = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - beside[-1])


def leading_components(
    apply: Apply,
    dim: int,
    k: int,
    guard: int = 16,
    tolerance: float = 2e-13,
    accept: float = 1e-10,
    most_passes: int = 400,
    seed: int = 11,
) -> Components:
    """The ``k`` leading eigenvectors of the symmetric, non-negative matrix behind ``apply``.

    The block has ``guard`` more directions than asked for. The interval to damp reaches from a
    bound below the spectrum, found by Lanczos steps that ride along in the first passes, to the
    block's least Ritz value. A degree is chosen so that the residuals would be met but the largest
    direction not locked yet cannot outgrow the others by more than 1e7.

    Certified means that each residual ``|Av - ev|`` is at most ``tolerance`` times the largest
    eigenvalue, or that three rounds brought it no lower than where rounding keeps it, below
    ``accept`` times that; else an error is raised.
    """
    rng = np.random.default_rng(seed)
    k, width = min(k, dim), min(dim, k + guard)
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    # Lanczos vectors, and the entries of their tridiagonal matrix.
    path = [np.linalg.norm(s := rng.standard_normal(dim)) ** -1 * s]
    diagonal: list[float] = []
    beside: list[float] = []
    passes, low, best, stalled = 0, 0.0, np.inf, 0

    def times(block: np.ndarray, lanczos: bool) -> np.ndarray:
        nonlocal passes
        passes += 1
        if not lanczos or len(path) > min(12, dim - 1):
            return apply(block)
        out = apply(np.column_stack([block, path[-1]]))
        step = out[:, -1]
        diagonal.append(float(path[-1] @ step))
        basis = np.array(path)
        for _ in range(2):
            step = step - basis.T @ (basis @ step)
        beside.append(float(np.linalg.norm(step)))
        if beside[-1] > 0:
            path.append(step / beside[-1])
        return out[:, :-1]

    first = True
    while True:
        product = times(q, first)
        h = q.T @ product
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        x, ax = q @ turn, product @ turn
        scale = max(float(values[0]), np.finfo(float).tiny)
        misses = np.linalg.norm(ax - x * values, axis=0) / scale
        worst = float(misses[:k].max())
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if worst <= tolerance or width == dim or (stalled >= 3 and worst <= accept):
            return Components(values[:k], x[:, :k], worst, passes)
        if passes >= most_passes:
            raise ArithmeticError(f"not certified after {passes} passes: residual {worst:.1e}")
        locked = 0
        while locked < k - 1 and misses[locked] <= tolerance:
            locked += 1
        cut = float(values[-1])
        low = _lowest(diagonal, beside) if len(diagonal) > 3 else 0.0
        low = min(low, 0.99 * cut)
        middle, half = (cut + low) / 2, (cut - low) / 2

        def growth(value: float, middle: float = middle, half: float = half) -> float:
            t = max((value - middle) / half, 1.0 + 1e-9)
            return float(np.log(t + np.sqrt(t * t - 1)))

        if first:
            degree = 6
        else:
            need = np.log(max(worst / (0.1 * tolerance), 10.0)) / growth(float(values[k - 1]))
            degree = int(np.clip(min(need, np.log(1e7) / growth(float(values[locked]))), 2, 60))
        keep, block, ablock = x[:, :locked], x[:, locked:], ax[:, locked:]

        def apart(b: np.ndarray, keep: np.ndarray = keep) -> np.ndarray:
            return b - keep @ (keep.T @ b)

        top = max(float(values[locked]), cut + half * 1e-6)
        sigma1 = sigma = half / (top - middle)
        old, new = block, apart((ablock - middle * block) * (sigma / half))
        for _ in range(1, degree):
            after = 1.0 / (2.0 / sigma1 - sigma)
            grown = apart(times(new, first))
            old, new = new, 2 * after / half * (grown - middle * new) - sigma * after * old
            sigma = after
        new = apart(new)
        q = np.linalg.qr(np.column_stack([keep, new / np.linalg.norm(new, axis=0)]))[0]
        first = False


def _identity_error(rows: DataFrame, dim: int, centre: Centre, onto: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    k = onto.shape[1]

    def of(x: np.ndarray) -> np.ndarray:
        w = x @ onto
        return np.column_stack([w.T @ w, w.sum(axis=0)])

    sums = _summed(rows, dim, centre, of, k, k + 1) / centre.n
    return float(np.abs(sums[:, :k] - np.outer(sums[:, k], sums[:, k]) - np.eye(k)).max())


def whiten(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    components: int = 8,
    scale: int = 1024,
    shift: int = 100_000,
    guard: int = 16,
) -> DataFrame:
    """Whitened coordinates: ``key, component, n, deviation, whitened, explained, identity_error``.

    Entries c become whole numbers floor(scale * c) + shift; everything is fitted on all of them.
    One row for each row and component, numbered from 1 by falling eigenvalue. ``deviation`` is
    exact, and null where no long holds it. A component's sign makes its largest entry positive.

    Vectors that are null, empty, or hold null or non-finite entries, or entries that times the
    scale are no longs, are dropped. Vectors of each length are a fit list of their own, with their
    own n; few lengths are expected, as each is fitted in turn. Directions without variance (equal
    rows, fewer rows than components) are no components, so a single row or equal rows give none.
    Repeated rows and ids, null ids included, count and come back once each; other columns are
    ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[key].dataType.simpleString()
    rows = table(
        small_batches(integer_vectors(vectors, key, column, scale, shift)), "whole-numbers"
    )
    schema = (
        f"`{key}` {id_type}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    sizes = rows.groupBy(F.size("x").alias("dim")).count().orderBy("dim").collect()
    results = []
    for size in sizes:
        dim, n = int(size["dim"]), int(size["count"])
        own = rows.where(F.size("x") == dim)
        found = _whitened(own, dim, n, components, guard, schema, key)
        if found is not None:
            results.append(found)
    return reduce(DataFrame.union, results) if results else spark.createDataFrame([], schema)


def _whitened(
    rows: DataFrame, dim: int, n: int, components: int, guard: int, schema: str, key: str
) -> DataFrame | None:
    centre = centre_of(rows, n, dim)
    trace = trace_of(rows, dim, centre)
    if trace <= 0:
        return None
    found = leading_components(covariance_times(rows, dim, centre), dim, components, guard)
    real = found.values > found.values[0] * dim * np.finfo(float).eps * 8
    values, vectors = found.values[real], found.vectors[:, real]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    vectors = vectors * np.sign(largest)
    onto = vectors / np.sqrt(values)
    error = _identity_error(rows, dim, centre, onto)
    share = values / trace
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dim)
            m = len(x)
            at = pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column("key").take(at),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)),
                pa.array(centre.deviations(x), pa.int64()).take(at),
                pa.array((centre.centred(x) @ onto).ravel()),
                pa.array(np.tile(share, m)),
                pa.array(np.full(m * k, error)),
            ]
            names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)
