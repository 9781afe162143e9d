"""Whitening against numpy's eigenvalues and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from areacast.llm import whitening
from areacast.llm.common import importable, table

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, component int, x binary, size int, n long"


def frame(spark, vectors):
    importable(spark)
    return spark.createDataFrame([(i, v, 1, b"own", 9, 9) for i, v in vectors], SCHEMA)


def plain(vectors):
    """Rows that take part, exact n and S, and numpy's components."""
    rows = [(i, [math.floor(256 * c) for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for x in fit])
    values, axes = np.linalg.eigh(y.T @ y / n)
    return rows, n, sums, values[::-1], axes[:, ::-1].T


def check(spark, vectors, most=4):
    rows, n, sums, values, axes = plain(vectors)
    got = whitening.whiten(frame(spark, vectors), most=most).collect()
    k = min(most, sum(v > 1e-10 * values[0] for v in values))
    assert len(got) == len(rows) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    signs = [0] * (k + 1)
    for i, x in rows:
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        own = by[i, deviation]
        y = np.array([float(Fraction(n * v - s, n)) for v, s in zip(x, sums)])
        for c in range(1, k + 1):
            assert own[c].n == n
            assert own[c].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            assert own[c].identity_error <= 1e-9
            want = y @ axes[c - 1] / math.sqrt(values[c - 1])
            if abs(want) > 1e-6:
                signs[c] = signs[c] or math.copysign(1, want * own[c].whitened)
            assert own[c].whitened == pytest.approx(signs[c] * want, abs=1e-8)


def test_against_numpy(spark):
    r = np.random.default_rng(12)
    x = (r.normal(size=(60, 7)) @ r.normal(size=(7, 7)) * 0.2 + 0.5).astype(np.float32)
    vectors = [(i, v) for i, v in enumerate(x.tolist())]
    vectors += [(5, vectors[5][1]), (None, vectors[6][1]), (70, vectors[6][1])] * 20  # repeated rows
    vectors += [(80, None), (81, [0.5] * 6 + [None]), (82, [NAN] + [0.5] * 6), (83, [0.5] * 6 + [INF]), (84, [-0.0] * 7), (85, [0.0] * 7)]
    check(spark, vectors)
    check(spark, vectors, most=7)


def test_fewer_directions_than_components(spark):
    check(spark, [(i, [0.25 * i, 0.5 * i, 0.125 * i * i]) for i in range(9)])
    for few in ([], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, None)], [(1, []), (2, [])]):
        out = whitening.whiten(frame(spark, few))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_sizes_and_entries_beyond_a_long_take_no_part(spark):
    vectors = [(i, [0.01 * i * i, 0.3 * (i % 3)]) for i in range(12)]
    odd = [(50, [0.5]), (51, [0.5, 0.5, 0.5]), (52, []), (53, [1e30, 0.0])]
    one, two = (
        sorted((r.vec_id, r.component, r.n, r.deviation, round(r.whitened, 9)) for r in whitening.whiten(frame(spark, v)).collect())
        for v in (vectors, vectors + odd)
    )
    assert one == two and len(one) == 24


def test_wide_entries_stay_exact(spark):
    check(spark, [(i, [float(2 ** (10 + i)), 800.5 * (i % 3), -float(2**14) * (i % 2)]) for i in range(6)])
    far = whitening.whiten(frame(spark, [(1, [2.0**40, 1.0]), (2, [0.0, 3.0]), (3, [1.0, 0.0])])).collect()
    assert {r.deviation for r in far if r.vec_id == 1} == {None}


def test_factor_and_rotations():
    r = np.random.default_rng(4)
    a = r.normal(size=(33, 20)) * np.logspace(0, -6, 20)
    s = a @ a.T
    factor, order = whitening.pivoted_cholesky(s)
    assert factor.shape[1] <= 21 and np.allclose(factor @ factor.T, s[np.ix_(order, order)], atol=1e-12)
    values, vectors = whitening.eigen(s)
    assert np.all(np.diff(values) <= 0)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    assert np.allclose(values[:15], np.linalg.svd(a, compute_uv=False)[:15] ** 2, rtol=1e-6)
    assert whitening.eigen(np.zeros((3, 3)))[0].size == 0


def test_table(spark):
    rows = table(spark, "/root/testdata/sf0.001", "embeddings")
    check(spark, [(r.vec_id, r.embedding) for r in rows.select("vec_id", "embedding").collect()])
