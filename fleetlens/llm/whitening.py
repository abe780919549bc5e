"""Whitening of embeddings by their leading principal components.

1. Every entry c becomes the integer floor(64 * c) + 1000000; each distinct integer vector is
   one row of the fit list (a stored table).
2. Two passes over the fit list: count and per-dimension sums, then the products of the
   entries centred at the integer nearest to their mean. Tasks add up in integers (in blocks
   small enough that double products are exact) and Spark adds the tasks' partial sums by matrix
   entry; the fraction of a step by which the integer centre misses the mean is taken out
   exactly at the end. The covariance is the correctly rounded one, however rows are dealt out.
3. The driver has one dimension x dimension matrix: Householder reflections make it
   tridiagonal, bisection on Sturm counts gives the leading eigenvalues, inverse iteration the
   eigenvectors, made orthogonal again within clusters of near-equal eigenvalues.
4. Mean, components and eigenvalues go to the tasks, which project every row. A third pass over
   the fit list measures how far the whitened covariance is from the identity.

Defined results: a vector that is null, empty or holds a null or non-finite entry gives no rows;
an entry of ``LIMIT`` or more in size counts as non-finite, and so does a vector whose length is
not the most common one of the fit list (ties: the longest). Components whose eigenvalue is under
``RANK_TOLERANCE`` of the largest are left out, so an empty table, or one with a single distinct
vector, gives no rows. Repeated rows count once in the fit and are projected each; components of
tied eigenvalues are any orthonormal basis. A deviation over 2^63 - 1 is null. Other columns are
ignored, null ids kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import load, query, stage

COMPONENTS = 16
STEPS, SHIFT = 64.0, 1_000_000
LIMIT = 2.0 ** 42
RANK_TOLERANCE = 1e-10
EXACT = 1 << 53


def integer_rows(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id and the integer vector x of every row whose vector is usable."""
    entry = F.col(column)
    usable = F.coalesce(F.forall(entry, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LIMIT)), F.lit(False)) & (F.size(entry) > 0)
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * STEPS).cast("long") + SHIFT)
    return vectors.where(usable).select(F.col(key).alias("vec_id"), x.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def products(y: np.ndarray) -> np.ndarray:
    """Exact y' y as Python integers."""
    peak = int(np.abs(y).max(initial=0))
    if peak * peak * len(y) < EXACT:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    big = y.astype(object)
    return big.T @ big


def _decimals(values) -> pa.Array:
    from decimal import Decimal
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def fit_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list and its exact per-dimension sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"))
                n, total = n + len(x), total + x.sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), _decimals(total)], names=["j", "n", "s"])

    rows = fit.select("x").mapInArrow(run, "j int, n long, s decimal(38,0)").groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("j").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def fit_products(fit: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Exact sums of the products of all pairs of entries less ``centre``."""
    d = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = products(matrix(batch.column("x")) - centre)
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(total[i, j])], names=["i", "j", "v"])

    sums = fit.select("x").mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d), dtype=object)
    for r in sums.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["v"])
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and orthogonal q with a = q T q', by Householder reflections."""
    a, n = np.array(a, dtype=float), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v /= size
        a[k + 1:, k:] -= 2 * np.outer(v, v @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues of the tridiagonal matrix under each value of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = np.zeros(len(at), dtype=int), np.ones(len(at))
    for k, x in enumerate(diagonal):
        pivot = x - at - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    margin = np.finfo(float).eps * n * (np.abs(diagonal) + reach).max(initial=0)
    low = np.full(k, (diagonal - reach).min() - margin)
    high = np.full(k, (diagonal + reach).max() + margin)
    wanted = n - 1 - np.arange(k)  # so many eigenvalues lie under the one looked for
    for _ in range(2100):  # more halvings than there are doubles between any two bounds
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        under = sturm_count(diagonal, off, middle) <= wanted
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return low + (high - low) / 2


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x of (T - shift) x = b, by elimination with row exchanges; a pivot of 0 becomes ``tiny``."""
    n = len(diagonal)
    main, upper, second, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), b.copy()
    for k in range(n - 1):
        below = [off[k], main[k + 1], upper[k + 1]]
        if abs(below[0]) > abs(main[k]):
            (main[k], upper[k], second[k]), below = below, [main[k], upper[k], second[k]]
            x[k], x[k + 1] = x[k + 1], x[k]
        if main[k] == 0:
            main[k] = tiny
        f = below[0] / main[k]
        main[k + 1], upper[k + 1] = below[1] - f * upper[k], below[2] - f * second[k]
        x[k + 1] -= f * x[k]
    for k in range(n - 1, -1, -1):
        if k + 1 < n:
            x[k] -= upper[k] * x[k + 1]
        if k + 2 < n:
            x[k] -= second[k] * x[k + 2]
        x[k] /= main[k] if abs(main[k]) > tiny else tiny
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5, cluster: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors (columns) of the falling ``values``; those of a cluster are made orthogonal in every round."""
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny * 1e20)
    tiny = np.finfo(float).eps * scale
    rng, found, first = np.random.default_rng(11), [], 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > cluster * scale:
            first = k
        x = rng.standard_normal(n)
        for _ in range(rounds):
            x = _solve_shifted(diagonal, off, value, x / np.abs(x).max(), tiny)
            for _ in range(2):
                for other in found[first:]:
                    x = x - (x @ other) * other
            x /= np.linalg.norm(x)
        found.append(x)
    return np.array(found).reshape(len(values), n).T


def principal_components(covariance: np.ndarray, k: int = COMPONENTS, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues, falling, and their unit eigenvectors as columns; none of an eigenvalue under ``tolerance`` of the largest."""
    diagonal, off, q = tridiagonal(covariance)
    values = leading_eigenvalues(diagonal, off, min(k, len(diagonal)))
    values = values[(values > tolerance * values[0]) & (values > 0)] if len(values) else values
    if not len(values):
        return values, np.zeros((len(covariance), 0))
    return values, q @ inverse_iteration(diagonal, off, values)


@dataclass
class Whitening:
    """A fitted transform; all of it is bounded by the dimension, not by the rows."""

    n: int
    centre: np.ndarray  # int64: the integers next to the means
    rest: list[int]     # n * mean - n * centre, exact
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dimension(self) -> int:
        return len(self.centre)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - np.array([r / self.n for r in self.rest])) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)^2 of every row, exact; null if it is no long."""
        y = x - self.centre
        peak = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest))
        if self.dimension * peak * peak < 1 << 63:
            return ((y * self.n - np.array(self.rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        sums = ((y.astype(object) * self.n - np.array(self.rest, dtype=object)) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in sums]


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list) - identity, measured over all of it."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = model.whiten(matrix(batch.column("x")))
                total += np.vstack([w.sum(axis=0), w.T @ w])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    total = np.zeros((k + 1, k))
    for r in fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"]
    mean = total[0] / model.n
    return float(np.abs(total[1:] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def fit(rows: DataFrame, components: int = COMPONENTS, tolerance: float = RANK_TOLERANCE) -> Whitening | None:
    """Fit on the distinct vectors of ``rows`` (see ``integer_rows``); None if there is nothing to whiten."""
    distinct = stage(rows.select("x").distinct(), "whitening-fit")
    common = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    distinct = distinct.where(F.size("x") == common["d"])
    n, sums = fit_sums(distinct)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    at = np.array(centre, dtype=np.int64)
    sum_of_products = fit_products(distinct, at)
    # the integer centre misses the mean by rest / n: taken out before anything is rounded
    covariance = np.array([[(n * int(v) - a * b) / (n * n) for v, b in zip(line, rest)] for line, a in zip(sum_of_products, rest)], dtype=float)
    values, vectors = principal_components(covariance, components, tolerance)
    if not len(values):
        return None
    model = Whitening(n, at, rest, values, vectors, float(np.trace(covariance)))
    model.identity_error = identity_error(distinct, model)
    return model


def whitened(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per row of ``rows`` and component."""
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = matrix(batch.column("x"))
            each = pa.array(np.repeat(np.arange(m), k))
            cols = [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(each), pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error))]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == model.dimension).select("vec_id", "x").mapInArrow(run, schema)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    """The whole ``embeddings`` table projected on up to 16 whitened components."""
    rows = integer_rows(load(spark, sf_dir, "embeddings"))
    return whitened(rows, fit(rows))
