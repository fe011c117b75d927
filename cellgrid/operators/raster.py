"""Neighbourhoods on the cell table: composites, morphology, components, distances, kernels, and polylines."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.operators import graph
from cellgrid.operators.joins import nearest

#: Row-major numbers: row times this, plus column.
WIDE = 1 << 31


def composite(stack: DataFrame, keys: Sequence[str], value: str, least: int = 3) -> DataFrame:
    """Median and count of the values of each cell; the median is null with fewer values than least."""
    out = stack.groupBy(*keys).agg(F.median(value).alias("_m"), F.count(value).alias("n"))
    return out.select(*keys, F.when(F.col("n") >= least, F.col("_m")).alias("median"), "n")


def square(radius: int) -> list[tuple[int, int]]:
    return [(r, c) for r in range(-radius, radius + 1) for c in range(-radius, radius + 1)]


def disc(radius: int) -> list[tuple[int, int]]:
    return [(r, c) for r, c in square(radius) if r * r + c * c <= radius * radius]


def moved(cells: DataFrame, columns: Sequence[str], offsets: Iterable[tuple[int, int]]) -> DataFrame:
    """Every cell's columns at the places of the cells that see it: one row for each offset (a fixed, small number)."""
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in offsets])
    out = cells.select("row", "col", *columns, F.explode(steps).alias("_o"))
    return out.select((F.col("row") + F.col("_o.r")).alias("row"), (F.col("col") + F.col("_o.c")).alias("col"), *columns, F.col("_o.r").alias("dr"), F.col("_o.c").alias("dc"))


def focal(cells: DataFrame, value: str, offsets: Iterable[tuple[int, int]], how: Column, name: str = "focal") -> DataFrame:
    """Adds an aggregate (of the column value) over the cells at the offsets around each cell."""
    around = moved(cells, [value], offsets).groupBy("row", "col").agg(how.alias(name))
    return cells.join(around, ["row", "col"], "left")


def dilate(cells: DataFrame, flag: str, offsets: Iterable[tuple[int, int]]) -> DataFrame:
    return focal(cells, flag, offsets, F.bool_or(flag), "dilated")


def erode(cells: DataFrame, flag: str, offsets: Sequence[tuple[int, int]]) -> DataFrame:
    """A cell stays if all its neighbours are there and set."""
    return focal(cells, flag, offsets, F.count(F.when(F.col(flag), 1)) == len(offsets), "eroded")


def components(cells: DataFrame, flag: str) -> DataFrame:
    """row, col, label of set cells: 8-neighbours share the least row-major number of their component."""
    at = F.col("row").cast("long") * WIDE + F.col("col")
    now = cells.filter(F.col(flag)).select("row", "col", at.alias("id")).checkpoint()
    # Half of the eight neighbours give every edge once.
    beside = moved(now, ["id"], [(0, 1), (1, -1), (1, 0), (1, 1)]).select("row", "col", F.col("id").alias("other"))
    edges = now.join(beside, ["row", "col"]).select("id", "other")
    label = graph.components(edges, "id", "other")
    return now.join(label, F.col("id") == F.col("node"), "left").select("row", "col", F.coalesce("label", "id").alias("label"))


def distance(cells: DataFrame, flag: str, reach: float = 4.0, row_m: float = 1.0, col_m: float = 1.0) -> DataFrame:
    """Adds the distance to the nearest set cell, however far; null if none is set.

    Set cells have 0. The nearest set cell of another one lies on the rim of the set ones, so only the rim is searched, in
    bins that start at reach and grow for the cells still without an answer."""
    x, y = F.col("col") * float(col_m), F.col("row") * float(row_m)
    on = F.coalesce(F.col(flag), F.lit(False))
    around = focal(cells.select("row", "col", on.cast("int").alias("_on")), "_on", square(1), F.sum("_on"), "_n")
    rim = around.filter("_on = 1 and _n < 9").select((F.col("row").cast("long") * WIDE + F.col("col")).alias("_to"), x.alias("_x2"), y.alias("_y2")).checkpoint()
    off = cells.filter(~on).select((F.col("row").cast("long") * WIDE + F.col("col")).alias("_id"), x.alias("_x"), y.alias("_y"))
    far = nearest(off, rim, "_id", "_to", ("_x", "_y"), ("_x2", "_y2"), reach * max(row_m, col_m)).select("_id", "distance")
    keyed = cells.withColumn("_id", F.col("row").cast("long") * WIDE + F.col("col")).join(far, "_id", "left").drop("_id")
    return keyed.withColumn("distance", F.when(on, 0.0).otherwise(F.col("distance")))


def clear_mask(cells: DataFrame, kind: str, keep: Sequence, away: Sequence, radius: int, name: str = "clear") -> DataFrame:
    """Adds whether a cell's class is one to keep and none of the classes to stay away from lies within the radius."""
    bad = F.col(kind).isin(*away)
    near = moved(cells.filter(bad), [], disc(radius)).select("row", "col").distinct().withColumn("_bad", F.lit(True))
    return cells.join(near, ["row", "col"], "left").withColumn(name, F.col(kind).isin(*keep) & F.col("_bad").isNull()).drop("_bad")


def focal_tiles(cells: DataFrame, value: str, radius: int, how: Callable[[np.ndarray], np.ndarray], name: str = "focal", tile: int = 128) -> DataFrame:
    """row, col and an aggregate over the square of a large radius: how takes windows (cells x values, NaN where there is no
    cell) and gives a value for each.

    A cell goes to its own tile and to the tiles whose halo it lies in (nine at most), instead of once to every cell that
    sees it; a tile is a small dense array."""

    def tiles(c: str):
        return F.explode(F.sequence(F.floor((F.col(c) - radius) / tile), F.floor((F.col(c) + radius) / tile)))

    sent = cells.select("row", "col", F.col(value).cast("double").alias("_v"), tiles("row").alias("_tr"))
    sent = sent.select("*", tiles("col").alias("_tc"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        top, left = int(key[0]) * tile, int(key[1]) * tile
        wide = np.full((tile + 2 * radius, tile + 2 * radius), np.nan)
        wide[pdf["row"] - top + radius, pdf["col"] - left + radius] = pdf["_v"]
        own = pdf[pdf["row"].between(top, top + tile - 1) & pdf["col"].between(left, left + tile - 1)]
        windows = np.lib.stride_tricks.sliding_window_view(wide, (2 * radius + 1,) * 2)
        picked = windows[own["row"] - top, own["col"] - left].reshape(len(own), -1) if len(own) else np.empty((0, 1))
        parts = [how(picked[k : k + 4096]) for k in range(0, len(picked), 4096)]
        return pd.DataFrame({"row": own["row"], "col": own["col"], name: np.concatenate(parts) if parts else []})

    return sent.groupBy("_tr", "_tc").applyInPandas(run, f"row int, col int, {name} double")


def frequency(stack: DataFrame, keys: Sequence[str], flag: Column, valid: Column, least: int = 1) -> DataFrame:
    """Share of valid observations in which flag holds, and their number; null with fewer than least."""
    hit = F.when(valid, F.when(flag, 1.0).otherwise(0.0))
    out = stack.groupBy(*keys).agg(F.avg(hit).alias("_f"), F.count(hit).alias("n"))
    return out.select(*keys, F.when(F.col("n") >= least, F.col("_f")).alias("share"), "n")


def class_fractions(cells: DataFrame, size: int, kind: str, classes: Sequence[str]) -> DataFrame:
    """Share of each class in blocks of size x size cells; cells without a class do not count."""
    at = [F.floor(F.col("row") / size).alias("block_row"), F.floor(F.col("col") / size).alias("block_col")]
    return cells.groupBy(*at).agg(*[F.avg(F.when(F.col(kind).isNotNull(), (F.col(kind) == c).cast("double"))).alias(c) for c in classes])


def resample(cells: DataFrame, value: str, scale: float, rows: int, cols: int, how: str = "average") -> DataFrame:
    """row, col, value of a coarser or finer grid with the same corner, scale source cells to a cell: nearest, bilinear
    (over the neighbours that have a value), average or sum of the source cells whose centre falls in."""
    target = cells.sparkSession.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    place = lambda c: (F.col(c) + 0.5) * scale - 0.5
    source = cells.filter(F.col(value).isNotNull())
    if how in ("average", "sum"):
        at = [F.floor((F.col(c) + 0.5) / scale).cast("int").alias(c) for c in ("row", "col")]
        return source.groupBy(*at).agg((F.avg if how == "average" else F.sum)(value).alias(value)).filter(f"row < {rows} and col < {cols}")
    if how == "nearest":
        asked = target.select("row", "col", F.floor(place("row") + 0.5).cast("int").alias("_r"), F.floor(place("col") + 0.5).cast("int").alias("_c"))
        return asked.join(source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), value), ["_r", "_c"]).select("row", "col", value)
    asked = target.withColumns({"_y": place("row"), "_x": place("col")})
    corners = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (0, 1) for c in (0, 1)]))
    asked = asked.withColumn("_k", corners).withColumns({"_r": (F.floor("_y") + F.col("_k.r")).cast("int"), "_c": (F.floor("_x") + F.col("_k.c")).cast("int")})
    asked = asked.withColumn("_w", (1 - F.abs(F.col("_y") - F.col("_r"))) * (1 - F.abs(F.col("_x") - F.col("_c"))))
    met = asked.join(source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), value), ["_r", "_c"])
    return met.groupBy("row", "col").agg(F.try_divide(F.sum(F.col(value) * F.col("_w")), F.sum("_w")).alias(value))


def bank(x: Column, y: Column, x1: float, y1: float, x2: float, y2: float) -> Column:
    """1 left of a line's direction, -1 right of it, 0 on it."""
    return F.signum((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)).cast("int")


def rings(distance_: Column, edges: Sequence[float]) -> Column:
    """Number of the first edge that a distance does not exceed (from 0); null beyond the last."""
    out = F.lit(None).cast("int")
    for k in range(len(edges) - 1, -1, -1):
        out = F.when(distance_ <= edges[k], k).otherwise(out)
    return out


def smooth(cells: DataFrame, value: str, sigma: float, cut: float = 4.0) -> DataFrame:
    """Gaussian kernel, zero outside the table, cut at so many sigmas: rows, then columns; row, col, smooth."""
    reach = int(cut * sigma + 0.5)
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    table = F.array(*[F.lit(w / sum(weights)) for w in weights])
    out = cells.select("row", "col", F.coalesce(value, F.lit(0.0)).alias("smooth"))
    for axis in (0, 1):
        line = [(k, 0) if axis == 0 else (0, k) for k in range(-reach, reach + 1)]
        weight = F.get(table, F.col("dr" if axis == 0 else "dc") + reach)
        out = moved(out, ["smooth"], line).groupBy("row", "col").agg(F.sum(F.col("smooth") * weight).alias("smooth"))
    return cells.select("row", "col").join(out, ["row", "col"])


def shift_test(cells: DataFrame, value: str, flag: str) -> DataFrame:
    """dr, dc, mean: mean value under the flag moved by each of the nine one-cell shifts, least mean first."""
    shifted = moved(cells.filter(F.col(flag)), [flag], square(1))
    return shifted.join(cells.select("row", "col", value), ["row", "col"]).groupBy("dr", "dc").agg(F.avg(value).alias("mean")).orderBy("mean", "dr", "dc")


def sample_lines(lines: DataFrame, key: str, points: str, step: float) -> DataFrame:
    """key, x, y, length: points along polylines (array of struct<x, y>) at most step apart, with the length each stands
    for."""
    parts = lines.select(key, F.explode(F.arrays_zip(F.slice(points, F.lit(1), F.size(points) - 1).alias("a"), F.slice(points, F.lit(2), F.size(points) - 1).alias("b"))).alias("s"))
    a, b = F.col("s.a"), F.col("s.b")
    size = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    cut = parts.select(key, a.alias("a"), b.alias("b"), size.alias("l"), F.greatest(F.lit(1), F.ceil(size / step)).cast("int").alias("n"))
    cut = cut.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
    t = (F.col("k") - 0.5) / F.col("n")
    return cut.select(key, (F.col("a.x") + t * (F.col("b.x") - F.col("a.x"))).alias("x"), (F.col("a.y") + t * (F.col("b.y") - F.col("a.y"))).alias("y"), (F.col("l") / F.col("n")).alias("length"))


def interpolate(df: DataFrame, x: Column, curve: Sequence[tuple[float, float]], name: str) -> DataFrame:
    """Adds the value of a piecewise linear curve at x, the end values beyond its ends."""
    value = F.lit(float(curve[-1][1]))
    for (x0, y0), (x1, y1) in reversed(list(zip(curve, curve[1:], strict=False))):
        value = F.when(x <= x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0))).otherwise(value)
    return df.withColumn(name, F.when(x <= curve[0][0], float(curve[0][1])).otherwise(value))


def monotone(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str = "monotone") -> DataFrame:
    """Running maximum along the order."""
    return df.withColumn(name, F.max(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
