"""FEAST and whitening against direct computation."""

import math
from fractions import Fraction

import numpy as np
import pytest

from bandwise.llm import feast, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n int, code string"


def test_inertia_counts_signs():
    rng = np.random.default_rng(0)
    for p in (1, 2, 7, 40):
        a = rng.standard_normal((p, p))
        a = a + a.T
        np.fill_diagonal(a, 0) if p == 7 else None
        e = np.linalg.eigvalsh(a)
        assert feast.inertia(a) == ((e > 0).sum(), 0, (e < 0).sum())
    assert feast.inertia(np.zeros((3, 3))) == (0, 3, 0)
    low = rng.standard_normal((6, 2))
    assert feast.inertia(low @ low.T)[0] == 2


@pytest.mark.parametrize("values", [np.linspace(1, 3, 40), np.ones(20), np.r_[5, 5, 5, 4, 4, np.ones(25)],
                                    np.r_[1e6, 10, 1, 1e-3, np.zeros(6)], np.array([2.0]),
                                    np.r_[1 + 1e-7 * np.arange(24), 0.5]])
def test_greatest_eigenpairs(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    e, u = feast.greatest_eigenpairs(v, 16)
    wanted = np.sort(values[values > 1e-12 * values.max()])[::-1][:16]
    assert len(e) == len(wanted) and np.abs(e - wanted).max() < 1e-12 * values.max()
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12
    assert np.abs(v @ u - u * e).max() < 1e-12 * values.max()


def test_an_interval_inside_the_spectrum():
    v = np.diag(np.arange(1.0, 31.0))
    e, u = feast.interval_eigenpairs(v, 9.5, 14.2)
    assert np.allclose(e, [14, 13, 12, 11, 10], atol=1e-12) and np.allclose(np.abs(u[9:14, ::-1]), np.eye(5), atol=1e-10)
    assert feast.interval_eigenpairs(v, 9.2, 9.8)[0].size == 0


def whole(vector):
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector)


def brute_force(rows):
    usable = [(i, whole(v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in usable})
    n, p = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(p)]
    centred = [[Fraction(x[j] * n - sums[j], n) for j in range(p)] for x in fit]
    v = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(p)] for i in range(p)])
    e, u = np.linalg.eigh(v)
    return usable, n, sums, e[::-1], u[:, ::-1], v.trace()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in (rng.standard_normal(6) * np.r_[3, 2, 1.5, 1, .5, 0.2]).astype(np.float32)])
            for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [rows[1], (None, rows[2][1]), (200, None), (201, [1.0, None] * 3),
             (202, [math.nan] + [0.0] * 5), (203, [math.inf] + [0.0] * 5), (204, []), (205, [1.0, 2.0]), (206, [3e30] * 6)]
    return rows


def found(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "c", 2, "x") for i, v in rows], SCHEMA)
    return whitening.whiten(df.repartition(3)).collect()


def test_whitening_equals_brute_force(spark, rows):
    got = found(spark, rows)
    usable, n, sums, e, u, trace = brute_force([r for r in rows if r[0] not in (205, 206)])
    assert len(got) == 6 * len(usable) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-10
    by_component = {}
    for r in got:
        by_component.setdefault(r.component, []).append(r)
    for k in range(6):
        some = sorted(by_component[k + 1], key=lambda r: (r.vec_id is None, r.vec_id or 0))
        wanted = sorted(usable, key=lambda r: (r[0] is None, r[0] or 0))
        assert [r.vec_id for r in some] == [i for i, _ in wanted]
        assert [r.deviation for r in some] == [sum((n * x - s) ** 2 for x, s in zip(v, sums)) for _, v in wanted]
        white = np.array([(np.array(v) - np.array(sums) / n) @ u[:, k] / e[k] ** 0.5 for _, v in wanted])
        mine = np.array([r.whitened for r in some])
        assert min(np.abs(white - mine).max(), np.abs(white + mine).max()) < 1e-8
        assert np.allclose([r.explained for r in some], e[k] / trace, rtol=1e-10)


def test_fewer_components_and_none(spark):
    line = [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)]
    assert {r.component for r in found(spark, line)} == {1}
    assert found(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert found(spark, [(1, None)]) == [] and found(spark, []) == []


def test_sums_beyond_64_bits_stay_exact(spark):
    rows = [(1, [1e12, 0.5]), (2, [-1e12, 1.5]), (3, [5e11, -3.0])]
    got = {(r.vec_id, r.component): r for r in found(spark, rows)}
    assert got[1, 1].deviation is None and got[1, 1].n == 3
    assert got[1, 1].explained == pytest.approx(1.0) and {c for _, c in got} == {1}


def test_widths_of_packed_vectors():
    for x in ([1, -2], [40_000, 0], [1 << 40, 3]):
        b = whitening.packed(np.array(x))
        assert np.frombuffer(b, f"<i{len(b) // 2}").tolist() == x
