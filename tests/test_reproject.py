"""Projections there and back, and reprojection against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.functions import cells as C
from cellgrid.operators import reproject as R


def test_utm_there_and_back(spark):
    places = [(lat + 0.123, lon) for lat in (-79, -30, 0, 4, 60, 83) for lon in (-78.4, -75.0, -72.1)]
    df = spark.createDataFrame(places, "lat double, lon double")
    for north in (True, False):
        x, y = C.utm(F.col("lat"), F.col("lon"), -75.0, north)
        lat, lon = C.from_utm(F.col("x"), F.col("y"), -75.0, north)
        for r in df.select("lat", "lon", x.alias("x"), y.alias("y")).select("lat", "lon", lat.alias("a"), lon.alias("b")).collect():
            assert (r.a, r.b) == pytest.approx((r.lat, r.lon), abs=2e-8)  # a millimetre


def _turned(angle, x0, y0):
    c, s = math.cos(angle), math.sin(angle)
    forward = lambda x, y: (x0 + c * x - s * y, y0 + s * x + c * y)
    backward = lambda x, y: (c * (x - x0) + s * (y - y0), -s * (x - x0) + c * (y - y0))
    return forward, backward


@pytest.mark.parametrize("step", [0.7, 3.3])
def test_all_methods_against_loops(spark, step):
    rng = np.random.default_rng(5)
    source = R.Lattice(10.0, 50.0, 1.5, 14, 9)
    forward, backward = _turned(0.4, 3.0, -7.0)
    target = R.bounding(source, forward, step, spark)
    grid = rng.normal(size=(14, 9))
    grid[rng.random(grid.shape) < 0.2] = np.nan
    rows = [(r, c, None if np.isnan(v) and r % 2 else float(v)) for (r, c), v in np.ndenumerate(grid)] + [(99, 0, 5.0), (0, -1, 5.0)]
    cells = spark.createDataFrame(rows, "row int, col int, v double").repartition(3)
    want = {h: {} for h in R.HOW}
    inside = {}
    for (r, c), v in np.ndenumerate(grid):
        if not np.isnan(v):
            x, y = forward(source.west + (c + 0.5) * source.step, source.north - (r + 0.5) * source.step)
            inside.setdefault((math.floor((target.north - y) / step), math.floor((x - target.west) / step)), []).append(v)
    for r in range(target.rows):
        for c in range(target.cols):
            x, y = backward(target.west + (c + 0.5) * step, target.north - (r + 0.5) * step)
            v, u = (source.north - y) / source.step - 0.5, (x - source.west) / source.step - 0.5
            if (r, c) in inside:
                want["average"][r, c], want["sum"][r, c] = np.mean(inside[r, c]), np.sum(inside[r, c])
            if not (-0.5 <= v <= 13.5 and -0.5 <= u <= 8.5):
                continue
            near = grid[min(13, math.floor(v + 0.5)), min(8, math.floor(u + 0.5))]
            if not np.isnan(near):
                want["nearest"][r, c] = near
                want["average"].setdefault((r, c), near)
            four = [((1 - abs(v - a)) * (1 - abs(u - b)), grid[a, b]) for a in (math.floor(v), math.floor(v) + 1) for b in (math.floor(u), math.floor(u) + 1) if 0 <= a < 14 and 0 <= b < 9 and not np.isnan(grid[a, b])]
            if sum(w for w, _ in four) > 0:
                want["bilinear"][r, c] = sum(w * g for w, g in four) / sum(w for w, _ in four)
    assert set(inside) <= {(r, c) for r in range(target.rows) for c in range(target.cols)}
    for how in R.HOW:
        got = {(r.row, r.col): r.v for r in R.reproject(cells, "v", source, target, forward, backward, how).collect()}
        assert got.keys() == want[how].keys(), how
        assert all(got[k] == pytest.approx(want[how][k], abs=1e-9) for k in got), how
    with pytest.raises(ValueError, match="how must be"):
        R.reproject(cells, "v", source, target, forward, backward, "cubic")
