"""Scenes accepted against their composite, against plain numpy passes."""

import numpy as np
import pytest

from cellgrid.operators import scenes


def _brute(stack, colder, share, least, most):
    """stack: scene x cell with NaN. Accepted sets and shares of every pass."""
    def shares(reference):
        both = ~np.isnan(stack) & ~np.isnan(reference)
        cold = (stack < reference - colder) & both
        return np.array([c.sum() / b.sum() if b.any() else 0.0 for c, b in zip(cold, both)])

    def median(rows, enough):
        n = (~np.isnan(rows)).sum(0)
        out = np.full(rows.shape[1], np.nan)
        for c in np.flatnonzero(n >= max(1, enough)):
            out[c] = np.nanmedian(rows[:, c])
        return out

    reference, sets, found = median(stack, 1), [], []
    for _ in range(most):
        s = shares(reference)
        found.append(s)
        sets.append(tuple(np.flatnonzero(s < share).tolist()))
        if len(sets) > 1 and sets[-1] == sets[-2]:
            return sets, found, True
        reference = median(stack[list(sets[-1])], least) if sets[-1] else np.full(stack.shape[1], np.nan)
    return sets, found, False


def _frame(spark, stack):
    rows = [(s, c // 10, c % 10, float(v)) for s, row in enumerate(stack) for c, v in enumerate(row)] + [(None, 0, 0, 1.0), (0, 0, 0, None)]
    return spark.createDataFrame(rows, "scene int, row int, col int, v double").repartition(3)


def _stack(seed):
    rng = np.random.default_rng(seed)
    stack = rng.normal(30, 4, (16, 40))
    stack[:5] -= rng.random((5, 1)) * 9
    stack[rng.random(stack.shape) < 0.3] = np.nan
    return stack


@pytest.mark.parametrize(("seed", "share", "most"), [(2, 0.2, 20), (6, 0.12, 20), (1, 0.15, 3)])
def test_passes_equal_numpy(spark, seed, share, most):
    stack = _stack(seed)
    sets, found, settled = _brute(stack, 5.0, share, 3, most)
    got = {r.scene: r for r in scenes.accepted(_frame(spark, stack), "scene", ["row", "col"], "v", 5.0, share, 3, most).collect()}
    assert [got[s].cold_share for s in range(16)] == pytest.approx(found[-1].tolist())
    assert [got[s].first_share for s in range(16)] == pytest.approx(found[0].tolist())
    assert {s for s in got if got[s].used} == set(sets[-1]) and got[0].settled == settled and got[0].passes == len(sets)


def test_a_rejected_scene_comes_back(spark):
    for seed in range(200):
        stack = _stack(seed)
        sets, found, settled = _brute(stack, 5.0, 0.2, 3, 20)
        back = [s for k in range(1, len(sets)) for s in set(sets[k]) - set(sets[k - 1]) if s in sets[-1]]
        if settled and back:
            break
    assert back
    got = {r.scene: r.used for r in scenes.accepted(_frame(spark, stack), "scene", ["row", "col"], "v", 5.0, 0.2, 3).collect()}
    assert {s for s in got if got[s]} == set(sets[-1]) and got[back[0]]


def test_sets_that_go_round_end_where_all_passes_would(spark):
    for seed in range(3000):
        rng = np.random.default_rng(seed)
        stack = rng.integers(0, 12, (5, 4)).astype(float)
        sets, found, settled = _brute(stack, 2.0, 0.3, 1, 21)
        if not settled and len(set(sets)) < len(sets):
            break
    assert not settled
    for most in (20, 21):
        sets, found, _ = _brute(stack, 2.0, 0.3, 1, most)
        got = {r.scene: r for r in scenes.accepted(_frame(spark, stack), "scene", ["row", "col"], "v", 2.0, 0.3, 1, most).collect()}
        assert [got[s].cold_share for s in range(5)] == pytest.approx(found[-1].tolist()) and not got[0].settled
