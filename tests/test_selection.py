"""Inversions, Kendall's S and slopes of given ranks, against all pairs."""

import numpy as np
import pytest

from cellgrid.operators import selection, stats


def _pairs(x, y):
    i, j = np.nonzero(x[:, None] < x[None])
    return np.sort((y[j] - y[i]) / (x[j] - x[i])), int(np.sign(y[j] - y[i]).sum())


def _series():
    rng = np.random.default_rng(3)
    n = 300
    yield "plain", np.arange(n) * 1.0, rng.normal(size=n).cumsum()
    yield "ties", rng.integers(0, 60, n) * 1.0, rng.integers(0, 9, n) * 1.0
    yield "same value", np.arange(n) * 1.0, np.full(n, 2.5)
    yield "line", np.arange(n) + 1950.0, 0.1 * np.arange(n)
    yield "one outlier", rng.random(n), np.where(np.arange(n) == 7, 1e6, rng.random(n))
    yield "one x", np.full(30, 4.0), np.arange(30) * 1.0
    yield "short", np.array([1.0, 2, 4]), np.array([3.0, 1, 9])
    yield None, np.arange(50) * 2.0, rng.normal(size=50)


def _frame(spark):
    rows = [(k, float(a), float(b)) for k, x, y in _series() for a, b in zip(x, y)] + [("short", None, 1.0), ("short", 9.0, None), ("nothing", None, None)]
    return spark.createDataFrame(rows, "k string, x double, y double").repartition(3)


def test_inversions_of_arrays():
    rng = np.random.default_rng(1)
    for n, most in ((0, 1), (1, 1), (50, 5), (200, 1000)):
        v, w = rng.integers(0, most + 1, n), rng.integers(1, 4, n)
        want = [(i, j) for i in range(n) for j in range(i + 1, n) if v[i] > v[j]]
        assert selection.inversions(v) == len(want)
        assert selection.inversions(v, w) == sum(int(w[i] * w[j]) for i, j in want)
        assert sorted(zip(*(a.tolist() for a in selection.listed(v)))) == want


@pytest.mark.parametrize("task", [37, 10**6])
def test_kendall_equals_all_pairs(spark, task):
    got = {r.k: r for r in selection.kendall(_frame(spark), ["k"], "x", "y", task).collect()}
    for k, x, y in _series():
        slopes, s = _pairs(x, y)
        assert (got[k].n, got[k].s, got[k].pairs) == (len(x), s, len(slopes)), k
    assert "nothing" not in got


@pytest.mark.parametrize(("few", "task", "most"), [(10**4, 10**6, 1), (20, 61, 300)])
def test_slopes_equal_all_pairs(spark, few, task, most):
    df = _frame(spark)
    want = {k: _pairs(x, y)[0] for k, x, y in _series()}
    ranks = [(k, r) for k, s in want.items() for r in {0, len(s) // 3, len(s) // 2, len(s) - 1} if 0 <= r < len(s)]
    wanted = spark.createDataFrame([*ranks, ("short", 3), ("short", -1), ("one x", 0)], "k string, rank long")
    got = {(r.k, r["rank"]): r.slope for r in selection.slopes(df, ["k"], "x", "y", wanted, few, task, most).collect()}
    assert got.keys() == set(ranks)
    for k, r in ranks:
        assert got[k, r] == want[k][r] or k == "line" and got[k, r] == pytest.approx(want[k][r], rel=1e-9), (k, r)


def test_a_long_series(spark):
    """Two hundred thousand points: the median slope of a line with noise, and S of a shuffled order, known by a sum."""
    n = 200_000
    df = spark.range(n).selectExpr("'a' AS k", "CAST(id AS DOUBLE) AS x", "CAST((id * 7919) % 200003 AS DOUBLE) AS y")
    r = selection.kendall(df, ["k"], "x", "y", 50_000).first()
    y = (np.arange(n) * 7919) % 200003
    assert r.s == n * (n - 1) / 2 - 2 * selection.inversions(y) and r.pairs == n * (n - 1) // 2
    assert stats.mann_kendall(df, ["k"], "x", "y").first().s == r.s
