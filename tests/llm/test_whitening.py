import math

import numpy as np
import pytest

from panelcast.llm.whitening import below, fit, leading_components, leading_values, tridiagonal, vectors_of, whiten


def brute(rows):
    """Per row: n, deviation, and the covariance of the fit list, from plain integers."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in usable]
    fit_list = sorted({x for _, x in whole})
    n, sums = len(fit_list), [sum(c) for c in zip(*fit_list)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit_list])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in whole]
    each = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in whole])
    return n, [i for i, _ in whole], deviation, each, centred.T @ centred / n


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    mix = rng.standard_normal((24, 24)) * (0.8 ** np.arange(24))
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(24) @ mix]) for i in range(400)]
    rows[50:150] = [(i, rows[0][1]) for i in range(50, 150)]
    rows += [(800, None), (801, [1.0, None] * 12), (802, [math.nan] + [0.0] * 23), (803, [math.inf] + [0.0] * 23)]
    return rows + [(None, rows[7][1]), (7, rows[7][1]), (900, [])]


def test_matches_plain_eigenvectors(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(5)
    n, ids, deviation, each, covariance = brute(vectors)
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    got = whiten(df).collect()
    assert len(got) == 16 * len(ids)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for k in range(16):
        rows = sorted(((r.vec_id is None, r.vec_id, int(r.deviation), r.whitened) for r in got if r.component == k + 1), key=repr)
        want = sorted(((i is None, i, d, w) for i, d, w in zip(ids, deviation, each @ directions[:, k] / math.sqrt(values[k]))), key=repr)
        assert [r[:3] for r in rows] == [w[:3] for w in want]
        a, b = (np.array([r[3] for r in x]) for x in (rows, want))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        share = {r.explained for r in got if r.component == k + 1}
        assert len(share) == 1 and abs(share.pop() / (values[k] / values.sum()) - 1) < 1e-10


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1], [9, 1e-3, 1e-6, 0, 0], [4, 4 - 1e-14, 4 - 2e-14, 3], [7], [2, 1], [1] * 40])
def test_clusters_and_gaps(values):
    """Equal, nearly equal and vanishing eigenvalues: right values, orthogonal vectors, small residuals."""
    rng, d = np.random.default_rng(len(values)), len(values)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    matrix = turn @ np.diag(np.array(values, float)) @ turn.T
    got, vectors = leading_components((matrix + matrix.T) / 2, d)
    want = sorted((v for v in values if v > 1e-9), reverse=True)
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-9, atol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-12 * max(values)


def test_diagonal_and_zero_matrices():
    got, vectors = leading_components(np.diag([3.0, 3.0, 1.0, 3.0]), 4)
    assert got.tolist() == [3, 3, 3, 1] and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12
    assert len(leading_components(np.zeros((3, 3)), 3)[0]) == 0


def test_steps():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    diagonal, off, q = tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.abs(q @ t @ q.T - a).max() < 1e-12 and np.abs(q.T @ q - np.eye(30)).max() < 1e-13
    values = np.sort(np.linalg.eigvalsh(a))[::-1]
    assert below(diagonal, off, np.array([values[4] + 1e-9, values[4] - 1e-9, 1e9])).tolist() == [26, 25, 30]
    assert np.abs(leading_values(diagonal, off, 9) - values[:9]).max() < 1e-12
    assert np.abs(t @ (x := vectors_of(diagonal, off, values[:9])) - x * values[:9]).max() < 1e-11


def test_exact_far_from_double(spark):
    """Sums that doubles and 64 bits cannot hold."""
    rows = [(i, [float(2**33 - i), float(-(2**33) + 3 * i * i)]) for i in range(900)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    _, ids, deviation, _, _ = brute(rows)
    assert {(r.vec_id, int(r.deviation)) for r in got} == set(zip(ids, deviation)) and got[0].identity_error < 1e-9
    assert max(deviation) > 2**53


def test_fewer_components_and_edges(spark, vectors):
    schema = "vec_id long, embedding array<float>"
    flat = [(i, [float(i % 5), 2.0 * (i % 5), 1.0]) for i in range(40)] + [(99, [1.0])]
    got = whiten(spark.createDataFrame(flat, schema)).collect()
    assert len(got) == 40 and {r.component for r in got} == {1} and {r.n for r in got} == {5}
    assert abs(got[0].explained - 1) < 1e-12
    none = whiten(spark.createDataFrame([], schema))
    assert none.count() == 0 and none.columns == whiten(spark.createDataFrame(flat, schema)).columns
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0
    assert fit(spark.createDataFrame([(1, None), (2, [None])], schema)) is None
    theirs = spark.createDataFrame([(*r, "a", 1) for r in vectors], schema + ", n string, component int")
    assert whiten(theirs, 2).count() == 2 * 402
