import math
import random
from fractions import Fraction

import numpy as np
import pytest

from sluice.llm import whitening


def frame(spark, vectors, ids=None, parts=3):
    ids = range(len(vectors)) if ids is None else ids
    # clashing names that the operator uses inside
    rows = [(i, v, 5, "x", 1.0) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, component string, whitened double").repartition(parts)


def made(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.3).astype(np.float32).tolist()


def checked(rows, vectors, k):
    """Rows against double-precision eigenvectors of the integers' covariance."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, d = fit.shape
    s = fit.sum(0)
    near = (fit - 1_000_000).astype(float)
    mean = near.mean(0)
    v = (near - mean).T @ (near - mean) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    want = ((np.array(x, object) - 1_000_000).astype(float) - mean) @ u / np.sqrt(e)
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(got) == len(vectors) * k
    for c in range(k):
        mine = np.array([got[i, c + 1].whitened for i in range(len(vectors))])
        assert min(np.abs(mine - want[:, c]).max(), np.abs(mine + want[:, c]).max()) < 1e-8
        assert got[0, c + 1].explained == pytest.approx(e[c] / np.trace(v), rel=1e-12)
    for i, row in enumerate(x):
        r = got[i, 1]
        assert r.n == n and r.deviation == sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True))
        assert r.identity_error < 1e-10


def test_equals_double_precision_eigenvectors(spark):
    vectors = made(300, 20)
    vectors += vectors[:40]  # repeats count once in the fit, all are returned
    df = frame(spark, vectors)
    checked(whitening.whiten(df, whitening.fit_whitening(df)).collect(), vectors, 16)


def test_fewer_dimensions_than_components(spark):
    vectors = made(50, 5, 1)
    df = frame(spark, vectors)
    checked(whitening.whiten(df, whitening.fit_whitening(df)).collect(), vectors, 5)


def test_broken_vectors_go_and_odd_rows_stay(spark):
    vectors = [*made(30, 3, 2), None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0], [], [3e38, 0.0, 0.0]]
    df = frame(spark, vectors, [None, 1, 1, *range(3, len(vectors))])
    rows = whitening.whiten(df, whitening.fit_whitening(df)).collect()
    ids = sorted((r.vec_id is not None, r.vec_id or 0) for r in rows)
    assert ids == sorted([(False, 0)] * 3 + [(True, 1)] * 6 + [(True, i) for i in range(3, 30) for _ in range(3)])


def test_no_variance_or_no_rows(spark):
    for vectors in ([], [[1.0, 2.0]] * 5, [None]):
        df = frame(spark, vectors, parts=1) if vectors else frame(spark, [[1.0]]).limit(0)
        got = whitening.whiten(df, whitening.fit_whitening(df))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.collect() == []


def test_constant_dimension_has_no_component(spark):
    vectors = [[*v, 0.5] for v in made(40, 3, 3)]
    df = frame(spark, vectors)
    rows = whitening.whiten(df, whitening.fit_whitening(df)).collect()
    assert {r.component for r in rows} == {1, 2, 3}


def test_equal_eigenvalues_give_orthonormal_components(spark):
    # a cube's corners and a longer axis: one eigenvalue twice
    vectors = [[a, b, 3 * c] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    df = frame(spark, vectors)
    fit = whitening.fit_whitening(df)
    assert [round(e) for e in fit.eigenvalues] == [9 * 64**2, 64**2, 64**2]
    u = np.array(fit.components)
    assert np.abs(u @ u.T - np.eye(3)).max() < 1e-14 and fit.identity_error < 1e-12


def determinant(m):
    """Of an integer matrix, by fraction elimination."""
    m, out = [[Fraction(x) for x in r] for r in m], Fraction(1)
    for k in range(len(m)):
        at = next((i for i in range(k, len(m)) if m[i][k]), None)
        if at is None:
            return 0
        if at != k:
            m[k], m[at], out = m[at], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k], strict=True)]
    return int(out)


@pytest.mark.parametrize("d", [1, 2, 3, 7, 12])
def test_polynomial_is_exact(spark, d):
    rng = random.Random(d)
    a = [[rng.randint(-(10**9), 10**9) if rng.random() < 0.7 else 0 for _ in range(d)] for _ in range(d)]
    matrix = [[sum(x * y for x, y in zip(r, s, strict=True)) for s in a] for r in a]
    c = whitening.characteristic_polynomial(spark, matrix)
    for x in (0, 1, -7, 10**15 + 3, -(10**18)):
        moved = [[(x if i == j else 0) - matrix[i][j] for j in range(d)] for i in range(d)]
        assert sum(k * x**p for p, k in enumerate(c)) == determinant(moved)


def test_roots_are_found_with_their_multiplicity():
    def polynomial(roots):
        c = [1]
        for r in roots:
            c = [(c[k - 1] if k else 0) - r * (c[k] if k < len(c) else 0) for k in range(len(c) + 1)]
        return c

    for roots in ([5], [0, 0, 3], [7, 7, 7, 2], [10**20, 10**20 + 1, 10**20 + 1, 4, 0], list(range(1, 21)), [1 << 40, 1 << 40, 1]):
        found = [(Fraction(a, 1 << b), m) for a, b, m in whitening.largest_roots(polynomial(roots), 16)]
        assert [m for _, m in found] == [m for _, m in sorted({r: roots.count(r) for r in roots if r}.items(), reverse=True)][: len(found)]
        want = sorted((r for r in roots if r), reverse=True)[: sum(m for _, m in found)]
        flat = [v for v, m in found for _ in range(m)]
        assert len(flat) >= min(16, len(want)) and all(abs(a - b) < Fraction(1, 10**12) for a, b in zip(flat, want, strict=True))


def test_large_entries_stay_exact(spark):
    vectors = [[1e12, 2.0], [-1e12, 5.0], [3e11, -8.0], [7e11, 1.0]]
    df = frame(spark, vectors)
    fit = whitening.fit_whitening(df)
    x = [[math.floor(64 * float(np.float32(c))) for c in v] for v in vectors]
    assert fit.sums == [sum(c) for c in zip(*x, strict=True)] and fit.n == 4
    assert all(r.deviation is None for r in whitening.whiten(df, fit).collect())
    assert fit.identity_error < 1e-9
