"""Whitening of embeddings by their leading principal components.

The covariance is summed by Spark over the distinct vectors; its eigenvectors come from a Householder
tridiagonal form, bisection on Sturm counts and inverse iteration on the driver (a matrix of the vectors'
dimension, whatever the number of rows); the projection goes back to the tasks.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.session import stage

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0**34
"""Components from this size on count as not finite: sums of the integers stay exact."""


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(diagonal, off_diagonal, q)`` with ``matrix = q @ T @ q.T``: Householder reflections of a symmetric matrix."""
    a = np.array(matrix, float)
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        column = a[k + 1 :, k]
        size = np.linalg.norm(column)
        if size == 0:
            continue
        size = np.copysign(size, column[0])
        v = column.copy()
        v[0] += size
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = 2 * (p - (v @ p) * v)
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -size
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each ``x`` (Sturm count)."""
    least = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0)))
    pivot = diagonal[0] - x
    found = (pivot < 0).astype(int)
    for a, b in zip(diagonal[1:], off**2):
        pivot = a - x - b / np.where(np.abs(pivot) < least, -least, pivot)
        found += pivot < 0
    return found


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection until the interval is down to rounding."""
    d = len(diagonal)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    size = max(np.abs(diagonal + reach).max(), np.abs(diagonal - reach).max())
    margin = 2 * d * np.finfo(float).eps * size + np.finfo(float).tiny
    low = np.full(count, (diagonal - reach).min() - margin)
    high = np.full(count, (diagonal + reach).max() + margin)
    place = d - 1 - np.arange(count)
    while True:
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        under = below(diagonal, off, middle) > place
        high, low = np.where(under, middle, high), np.where(under, low, middle)


def _factors(diagonal: np.ndarray, off: np.ndarray, value: float, least: float) -> tuple:
    """``T - value`` as multipliers, row swaps and an upper triangle of three bands (partial pivoting)."""
    d = len(diagonal)
    u, v, w = np.zeros(d), np.zeros(d), np.zeros(d)
    times, swapped = np.zeros(d), np.zeros(d, bool)
    a, b = diagonal[0] - value, off[0] if d > 1 else 0.0
    for i in range(1, d):
        below_, next_a, next_b = off[i - 1], diagonal[i] - value, off[i] if i < d - 1 else 0.0
        if abs(below_) > abs(a):
            swapped[i], times[i] = True, a / below_
            u[i - 1], v[i - 1], w[i - 1] = below_, next_a, next_b
            a, b = b - times[i] * next_a, -times[i] * next_b
        else:
            a = a if abs(a) > least else least
            times[i] = below_ / a
            u[i - 1], v[i - 1], w[i - 1] = a, b, 0.0
            a, b = next_a - times[i] * b, next_b
    u[d - 1] = a if abs(a) > least else least
    return u, v, w, times, swapped


def _solve(factors: tuple, x: np.ndarray, first: bool) -> np.ndarray:
    u, v, w, times, swapped = factors
    d, x = len(x), x.copy()
    # The first pass starts from the triangle alone: a start vector that no swap can cancel.
    for i in range(1, d) if not first else ():
        if swapped[i]:
            x[i - 1], x[i] = x[i], x[i - 1]
        x[i] -= times[i] * x[i - 1]
    for i in range(d - 1, -1, -1):
        rest = (v[i] * x[i + 1] if i + 1 < d else 0.0) + (w[i] * x[i + 2] if i + 2 < d else 0.0)
        x[i] = (x[i] - rest) / u[i]
    return x / np.linalg.norm(x)


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, turns: int = 4) -> np.ndarray:
    """Unit eigenvectors (columns) for falling eigenvalues by inverse iteration.

    Values closer than a thousandth of the matrix norm form a cluster; each vector is kept orthogonal to those
    found before it in its cluster, and equal values are moved apart by a few roundings.
    """
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0)) or 1.0
    step, rng = np.finfo(float).eps * norm, np.random.default_rng(1)
    found, cluster, last = np.zeros((d, len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            cluster = k
        at = min(value, last - 2 * step)
        last = at
        factors = _factors(diagonal, off, at, step)
        x = rng.uniform(0.5, 1.5, d)
        for turn in range(turns):
            x = _solve(factors, x, turn == 0)
            for _ in range(2):
                x -= found[:, cluster:k] @ (found[:, cluster:k].T @ x)
            size = np.linalg.norm(x)
            x = x / size if size > 1e-8 else rng.uniform(-1, 1, d)
        found[:, k] = x
    return found


def leading_components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)``: up to ``count`` leading eigenvalues above rounding, falling, and unit eigenvectors as columns."""
    diagonal, off, q = tridiagonal(covariance)
    values = leading_values(diagonal, off, min(count, len(covariance)))
    floor = 16 * len(covariance) * np.finfo(float).eps * max(values[0], 0.0)
    values = values[values > floor]
    return values, q @ vectors_of(diagonal, off, values)


def whole(vector: Column) -> Column:
    """Every component c as the long ``floor(64 * c) + 1000000``; null for a vector that is null, empty, or holds a
    null or non-finite component."""
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    steps = F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")).cast("long") + OFFSET)
    return F.when(usable & (F.size(vector) > 0), steps)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


@dataclass(frozen=True)
class Whitening:
    """A fitted projection. ``base + rest / n`` is the mean, split so that centring is exact up to one rounding."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dimension(self) -> int:
        return len(self.base)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of ``(n * x - S) ** 2``, exact."""
        away = x - self.base
        reach = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if reach**2 * self.dimension < 2**63:
            return pa.array(((self.n * away - self.rest) ** 2).sum(1)).cast(pa.decimal128(38, 0))
        exact = ((self.n * away.astype(object) - self.rest.astype(object)) ** 2).sum(1)
        return pa.array([Decimal(int(v)) for v in exact], pa.decimal128(38, 0))


def _summed(fit_list: DataFrame, d: int, per_batch) -> np.ndarray:
    """Sum over all tasks of the matrix that ``per_batch`` makes of a block of vectors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for low in range(0, len(batch), 8192):
                part = per_batch(_matrix(batch.column(0).slice(low, 8192), d))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"]
            )

    rows = fit_list.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((int(rows["i"].max()) + 1, int(rows["j"].max()) + 1))
    out[rows["i"], rows["j"]] = rows["v"]
    return out


def _sums(fit_list: DataFrame, d: int) -> tuple[int, list[int]]:
    """``(n, S)`` as exact integers of any size."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(0))]
        numbers = [Decimal(v) for v in [n, *total]]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(numbers, pa.decimal128(38, 0))], ["i", "v"])

    rows = fit_list.mapInArrow(partial, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    found = {r["i"]: int(r["v"]) for r in rows}
    return found[0], [found[i + 1] for i in range(d)]


def fit(vectors: DataFrame, components: int = 16, vector: str = "embedding") -> Whitening | None:
    """Mean, leading components and their values over the distinct integer vectors (``whole``); None without any.

    The distinct vectors are written once and read three times: sums, covariance, check of the result. Vectors
    of another length than most of the distinct ones (ties: the longer) take no part.
    """
    usable = vectors.select(whole(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    fit_list = stage(usable.dropDuplicates(["x"]), "whitening-vectors")
    lengths = fit_list.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None
    d = lengths["d"]
    fit_list = fit_list.filter(F.size("x") == d)
    n, sums = _sums(fit_list, d)
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    model = Whitening(n, base, rest, np.zeros(0), np.zeros((d, 0)), 0.0)
    covariance = _summed(fit_list, d, lambda x: (c := model.centred(x)).T @ c) / n
    covariance = (covariance + covariance.T) / 2
    values, found = leading_components(covariance, components)
    model = Whitening(n, base, rest, values, found, float(np.trace(covariance)))
    if not len(values):
        return model
    # One more row holds the sums, so that the check is centred as well.
    both = _summed(fit_list, d, lambda x: (w := model.project(x)).T @ np.column_stack([w, np.ones(len(w))])) / n
    mean = both[:, -1]
    error = np.abs(both[:, :-1] - np.outer(mean, mean) - np.eye(len(values))).max()
    return Whitening(n, base, rest, values, found, model.trace, float(error))


def apply(model: Whitening | None, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable row and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``."""
    columns = "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    usable = vectors.select(F.col(key).alias("vec_id"), whole(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    kind = usable.schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.values):
        empty = usable.select("vec_id", *(F.lit(None).alias(c) for c in columns[1:])).filter("false")
        kinds = dict(zip(columns, (kind, "int", "long", "decimal(38,0)", "double", "double", "double")))
        return empty.select(*(F.col(c).cast(t).alias(c) for c, t in kinds.items()))
    usable = usable.filter(F.size("x") == model.dimension)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), model.dimension)
            found = model.project(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * found.shape[1]
            each = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), model.deviation(x), each], ["vec_id", "deviation", "each"])

    rows = usable.mapInArrow(project, f"vec_id {kind}, deviation decimal(38,0), each array<double>")
    share = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    rows = rows.select("vec_id", "deviation", F.posexplode("each").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, (F.col("at") + 1).cast("int")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


def whiten(vectors: DataFrame, components: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vectors`` whitened by their own leading components (see ``fit`` and ``apply``).

    Rows whose vector is null, empty, holds a null or non-finite component (or one of 2**34 and more), or has
    another length than most, give no rows. Repeated vectors count once in the fit and come back once per row;
    rows with a null id come back with it. Components without variance (dimensions that follow from others,
    a single vector) are left out, so there may be fewer than ``components``; equal values have any orthogonal
    directions. An empty table gives no rows; other columns, whatever their names, are not read.
    """
    return apply(fit(vectors, components, vector), vectors, key, vector)
