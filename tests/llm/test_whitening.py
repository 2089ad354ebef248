"""Whitening against exact integer covariances and NumPy's double solver; the refinement by itself."""

import math
from collections import Counter

import numpy as np
import pytest

from reelstar.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x int, n long, component string"


def _rows(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], SCHEMA).repartition(3)


def _check(spark, rows, dim, k=8, digits=7):
    model = whitening.fit(_rows(spark, rows), k)
    got = whitening.whiten(_rows(spark, rows), model).collect()
    good = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) and abs(c) < 2.0**52 for c in v)]
    n, sums = len(good), [sum(x[d] for _, x in good) for d in range(dim)]
    z = [[n * x[d] - sums[d] for d in range(dim)] for _, x in good]
    cov = [[sum(r[p] * r[q] for r in z) for q in range(dim)] for p in range(dim)]
    value, vec = np.linalg.eigh(np.array([[c / n**3 for c in row] for row in cov]))
    value, vec = value[::-1][:k], vec[:, ::-1][:, :k]
    want = Counter()
    for (i, _), r in zip(good, z):
        exact = sum(c * c for c in r)
        for c in range(min(k, dim)):
            w = float(np.array([v / n for v in r]) @ vec[:, c] / np.sqrt(value[c]))
            want[i, c + 1, n, exact if exact < 1 << 63 else None, round(abs(w), digits)] += 1
    assert Counter((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), digits)) for r in got) == want
    assert all(abs(r.explained - value[r.component - 1] / sum(cov[d][d] for d in range(dim)) * n**3) < 1e-9 for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    return got


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    spread = np.array([3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05])
    rows = [(i, [float(np.float32(c)) for c in rng.normal(0.3, 1, 10) * spread]) for i in range(300)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (7, rows[8][1]), *((1000 + i, rows[3][1]) for i in range(150))]
    rows += [(2000, None), (2001, [1.0] * 9 + [None]), (2002, [float("nan")] * 10), (2003, [float("inf")] + [0.0] * 9), (2004, []),
             (2005, [1.0] * 9), (2006, [1e300] + [0.0] * 9)]
    _check(spark, rows, 10)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(0, 1, 4) * [2.0**44, 2.0**43, 2.0**42, 2.0**41]]) for i in range(60)]
    got = _check(spark, rows, 4, digits=5)
    assert all(r.deviation is None and r.distance > 2.0**40 for r in got)


def test_small_and_flat_tables(spark):
    empty = _rows(spark, [])
    assert whitening.whiten(empty, whitening.fit(empty)).count() == 0
    nothing = _rows(spark, [(1, None), (2, [])])
    assert whitening.whiten(nothing, whitening.fit(nothing)).count() == 0
    flat = _rows(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    got = whitening.whiten(flat, whitening.fit(flat)).collect()
    assert len(got) == 4 and {(r.n, r.deviation, r.whitened, r.identity_error, r.explained) for r in got} == {(2, 0, None, 0.0, 0.0)}
    line = _rows(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])      # one direction only
    got = whitening.whiten(line, whitening.fit(line)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got) and got[0].identity_error < 1e-12


def _orthonormal(rng, d):
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(5):
        q = q @ (np.longdouble(1.5) * np.eye(d) - np.longdouble(0.5) * q.T @ q)
    return q


@pytest.mark.parametrize("values", [
    [8, 7, 6, 5, 4, 3, 2, 1], [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5, 0.5, 0.1, 1e-6], [1] * 8, [1, 1 - 1e-12, 1 - 3e-12, 0.7, 0.7 - 1e-10, 0.2, 0, 0]])
def test_refinement_reaches_extended_precision(values):
    q = _orthonormal(np.random.default_rng(1), 8)
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    value, x = whitening.eigenvectors((a + a.T) / 2)
    assert np.abs(value - np.array(values, np.longdouble)).max() < 1e-17
    assert np.abs(a @ x - x * value).max() < 1e-17 and np.abs(x.T @ x - np.eye(8)).max() < 1e-14
    first = whitening._first_vectors(a)
    assert np.abs(a @ first - first * np.diag(first.T @ a @ first)).max() > 1e-9 or len(set(values)) == 1   # float32 alone is far


def test_matrices_of_any_size():
    assert whitening.eigenvectors(np.zeros((0, 0)))[1].shape == (0, 0)
    value, x = whitening.eigenvectors(np.zeros((3, 3)))
    assert not value.any() and np.allclose(x.T @ x, np.eye(3))
    assert whitening.eigenvectors(np.array([[4.0]]))[0] == [4]
