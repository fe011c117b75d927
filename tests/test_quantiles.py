"""Order statistics and percentiles of groups against sorted lists and numpy."""

import random

import numpy as np
import pytest

from cellgrid.operators import quantiles


def _table(spark):
    rng = random.Random(4)
    groups = {"many": [rng.gauss(0, 1) for _ in range(3000)], "ties": [float(rng.randint(0, 3)) for _ in range(2500)], "one value": [2.5] * 1500, "few": [1.0, 9.0, 4.0], "one": [7.0], None: [rng.random() for _ in range(900)]}
    rows = [(k, v) for k, values in groups.items() for v in values] + [("none", None), ("few", None)]
    rng.shuffle(rows)
    return groups, spark.createDataFrame(rows, "k string, v double").repartition(3)


@pytest.mark.parametrize("within", [10, 500, 10**6])
def test_percentiles_of_groups(spark, within):
    groups, df = _table(spark)
    points = {"low": 0.0, "q": 0.25, "mid": 0.5, "p90": 0.9, "top": 1.0}
    got = {r.k: r for r in quantiles.percentiles(df, ["k"], "v", points, within).collect()}
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        assert [got[k][n] for n in points] == pytest.approx(np.quantile(values, list(points.values())).tolist(), abs=1e-12), k


def test_ranks_of_groups(spark):
    groups, df = _table(spark)
    ranks = [(k, r) for k, values in groups.items() for r in (0, 1, len(values) // 3, len(values) - 1)]
    wanted = spark.createDataFrame([*ranks, ("few", 3), ("few", -1), ("nowhere", 0)], "k string, rank long")
    got = sorted(((r.k or "", r["rank"], r.v) for r in quantiles.order_statistics(df, ["k"], "v", wanted, within=20).collect()))
    assert got == sorted({(k or "", r, sorted(groups[k])[r]) for k, r in ranks if r < len(groups[k])})
