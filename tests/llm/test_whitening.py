"""Whitening against NumPy's eigensolver and Python integers."""

import math

import numpy as np
import pytest

from fleetlens.llm import whitening as wh
from fleetlens.llm.common import load
from fleetlens_helpers import SF_SMOKE

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors):
    """n, deviation per vector, eigenvalues and eigenvectors by plain Python and LAPACK."""
    x = [[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors]
    fit = [list(t) for t in {tuple(v) for v in x}]
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    dev = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    z = np.array([[(n * c - t) / n for c, t in zip(v, s)] for v in fit])
    e, p = np.linalg.eigh(z.T @ z / n)
    return n, dev, e[::-1], p[:, ::-1], np.array([[(n * c - t) / n for c, t in zip(v, s)] for v in x])


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in enumerate(vectors)], SCHEMA)


def out(spark, df, **kw):
    rows = wh.integer_rows(df)
    return wh.whitened(rows, wh.fit(rows, **kw)).toPandas()


def check(got, vectors, k=16):
    n, dev, e, p, z = brute(vectors)
    assert set(got.n) == {n} and got.identity_error.max() <= 1e-4
    for i in range(len(vectors)):
        mine = got[got.vec_id == i].sort_values("component")
        assert list(mine.component) == list(range(1, k + 1)) and set(mine.deviation) == {dev[i]}
    for c in range(k):
        mine = got[got.component == c + 1].sort_values("vec_id")
        want = z @ p[:, c] / math.sqrt(e[c])
        err = min(np.abs(mine.whitened.to_numpy() - s * want).max() for s in (1, -1))
        assert err < 1e-6
        assert abs(mine.explained.iloc[0] / (e[c] / e.sum()) - 1) < 1e-9


def test_whole_table_equals_lapack(spark):
    df = load(spark, SF_SMOKE, "embeddings")
    vectors = [r["embedding"] for r in df.orderBy("vec_id").collect()]
    check(out(spark, df), vectors)


def test_far_means_small_spread_and_copies(spark):
    r = np.random.default_rng(5)
    a = (r.normal(size=(200, 20)) * np.linspace(0.5, 3, 20) + 1e6).astype(np.float32)
    vectors = [*a, *a[:50], a[0], a[0]]
    check(out(spark, table(spark, vectors)), vectors)


def test_odd_rows_and_empty_tables(spark):
    good = [[0.1, 2.0, -1.5], [3.0, 0.5, 0.25], [0.0, -2.0, 7.0], [1.0, 1.0, 1.0], [5.0, -3.0, 2.0]]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0, 0], [float("inf"), 0, 0], [1.0, 2.0], [1e20, 0, 0]]
    df = table(spark, good + bad).withColumn("component", wh.F.lit(7)).withColumn("N", wh.F.lit("x"))
    got = out(spark, df)
    check(got, good, k=3)
    assert set(got.vec_id) == set(range(len(good)))
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [None, None], [[]]):
        assert len(out(spark, table(spark, vectors))) == 0
    assert len(out(spark, table(spark, [[1.0, 2.0], [1.0, 5.0], [1.0, 9.0]]))) == 3  # rank one


def test_same_bits_for_any_partitioning(spark):
    df = load(spark, SF_SMOKE, "embeddings")
    one, many = wh.fit(wh.integer_rows(df.coalesce(1))), wh.fit(wh.integer_rows(df.repartition(13)))
    assert np.array_equal(one.values, many.values) and np.array_equal(one.components, many.components)


def test_large_entries_are_exact(spark):
    vectors = [[2.0 ** 40 + 2.0 ** 18 * i * i, -3.0 * 2.0 ** 20 * i, 5.0 + i] for i in range(6)]
    got = out(spark, table(spark, vectors))
    _, dev, *_ = brute(np.array(vectors, dtype=np.float32).tolist())
    for i, want in enumerate(dev):
        assert set(got[got.vec_id == i].deviation.map(lambda v: None if v != v else int(v))) == {want if want < 2 ** 63 else None}


@pytest.mark.parametrize("kind", ["random", "ties", "diagonal", "low rank", "graded"])
def test_eigenpairs(kind):
    r = np.random.default_rng(1)
    q, _ = np.linalg.qr(r.normal(size=(30, 30)))
    e = {"random": r.random(30) + 0.1, "ties": np.repeat([9.0, 4.0, 1.0], 10), "diagonal": np.arange(1.0, 31), "low rank": np.r_[np.arange(1.0, 6), np.zeros(25)],
         "graded": 10.0 ** np.linspace(3, -3, 30)}[kind]
    a = np.diag(e) if kind == "diagonal" else (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = wh.principal_components(a, 16)
    assert len(values) == min(16, int((e > 1e-10 * e.max()).sum()))
    assert np.allclose(values, np.sort(e)[::-1][:len(values)], rtol=1e-9, atol=1e-12 * e.max())
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * e.max()


def test_sturm_counts():
    d, off = np.array([2.0, -1.0, 3.0, 0.0]), np.array([1.0, 0.0, 2.0])
    e = np.linalg.eigvalsh(np.diag(d) + np.diag(off, 1) + np.diag(off, -1))
    at = np.array([-5.0, -1.2, 0.0, 1.0, 2.5, 9.0])
    assert list(wh.sturm_count(d, off, at)) == [int((e < t).sum()) for t in at]
