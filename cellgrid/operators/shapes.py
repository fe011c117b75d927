"""Polygons and lines as arrays of struct<x, y>: clipped areas, cells touched, simplification, stitching, set metrics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.cells import inside_ring
from cellgrid.operators import graph
from cellgrid.operators.joins import nearest_segment, within
from cellgrid.operators.raster import sample_lines

POINT = "struct<x:double,y:double>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring_area(ring: Column) -> Column:
    """Area inside a ring that closes itself; 0 for fewer than three points."""
    n = F.size(ring)

    def part(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, n))
        return a["x"] * b["y"] - b["x"] * a["y"]

    twice = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), part), F.lit(0.0), lambda s, v: s + v)
    return F.when(n >= 3, F.abs(twice) / 2).otherwise(0.0)


def perimeter(ring: Column) -> Column:
    n = F.size(ring)
    side = lambda i: F.hypot(F.get(ring, F.pmod(i + 1, n))["x"] - F.get(ring, i)["x"], F.get(ring, F.pmod(i + 1, n))["y"] - F.get(ring, i)["y"])
    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), side), F.lit(0.0), lambda s, v: s + v)


def half_plane(ring: Column, axis: str, bound: Column, above: bool) -> Column:
    """The part of a ring with the coordinate not below (or not above) a bound. Parts of a ring that is not convex may hang
    together by edges of no width, which takes nothing from the area."""
    n, other = F.size(ring), "y" if axis == "x" else "x"
    inside = (lambda p: p[axis] >= bound) if above else (lambda p: p[axis] <= bound)

    def step(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, n))
        t = F.try_divide(bound - a[axis], b[axis] - a[axis])
        cut = a[other] + t * (b[other] - a[other])
        crossing = point(bound, cut) if axis == "x" else point(cut, bound)
        return F.filter(F.array(F.when(inside(a), point(a["x"], a["y"])), F.when(inside(a) != inside(b), crossing)), lambda p: p.isNotNull())

    return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(0), n - 1), step))).otherwise(F.array().cast(f"array<{POINT}>"))


def cell_overlaps(shapes: DataFrame, size: float) -> DataFrame:
    """Each shape's columns with row, col, part (its area inside the cell) and area: one row for each cell of the grid of this
    size that a ring overlaps. Rows and columns count from the origin."""
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    span = lambda v: F.sequence(F.floor(F.array_min(v) / size), F.floor(F.array_max(v) / size))
    out = shapes.withColumn("area", ring_area(F.col("ring"))).withColumn("row", F.explode(span(ys)))
    # Strips first: a row's strip of the ring is cut once, then into cells; one cut a step, each worked out once.
    out = out.withColumn("_strip", half_plane(F.col("ring"), "y", F.col("row") * size, True)).filter(F.size("_strip") > 0)
    out = out.withColumn("_strip", half_plane(F.col("_strip"), "y", (F.col("row") + 1) * size, False)).filter(F.size("_strip") > 0)
    out = out.withColumn("col", F.explode(span(F.transform("_strip", lambda p: p["x"]))))
    out = out.withColumn("_strip", half_plane(F.col("_strip"), "x", F.col("col") * size, True)).filter(F.size("_strip") > 0)
    out = out.withColumn("_strip", half_plane(F.col("_strip"), "x", (F.col("col") + 1) * size, False))
    return out.withColumn("part", ring_area(F.col("_strip"))).drop("_strip").filter("part > 0")


def spread_by_area(shapes: DataFrame, size: float, value: str) -> DataFrame:
    """row, col, value: each shape's value spread over the cells by area and summed."""
    return cell_overlaps(shapes, size).groupBy("row", "col").agg(F.sum(F.col(value) * F.col("part") / F.col("area")).alias(value))


def touched(shapes: DataFrame, size: float, keys: Sequence[str]) -> DataFrame:
    """keys, row, col: all cells that a shape covers at least a part of."""
    return cell_overlaps(shapes, size).select(*keys, "row", "col").distinct()


def highest_level(cells: DataFrame, shapes: DataFrame, x: str, y: str, level: str, size: float) -> DataFrame:
    """Adds level: the highest of the shapes that hold a cell's centre, 0 outside all: what is left when levels are written
    one after another in rising order."""
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    span = lambda v: F.explode(F.sequence(F.floor(F.array_min(v) / size), F.floor(F.array_max(v) / size)))
    boxes = shapes.select("ring", F.col(level).alias("_l"), span(xs).alias("_bx"), ys.alias("_ys")).withColumn("_by", span(F.col("_ys"))).drop("_ys")
    keyed = cells.withColumns({"_pid": F.monotonically_increasing_id(), "_bx": F.floor(F.col(x) / size), "_by": F.floor(F.col(y) / size)})
    hit = F.when(inside_ring(F.col(x), F.col(y), F.col("ring")), F.col("_l")).alias("_hit")
    met = keyed.join(boxes, ["_bx", "_by"], "left").select("_pid", F.struct(*cells.columns).alias("_cell"), hit)
    return met.groupBy("_pid").agg(F.first("_cell").alias("_cell"), F.coalesce(F.max("_hit"), F.lit(0)).alias(level)).select("_cell.*", level)


def line_near(lines: DataFrame, border: DataFrame, key: str, points: str, step: float, reach: float, inside: Column) -> DataFrame:
    """key, inside, length: length of lines within reach of a border (segments x1, y1, x2, y2, name), split by a condition on
    the sampled points' x and y."""
    sampled = sample_lines(lines, key, points, step).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    near = nearest_segment(sampled, border, "_id", ("x", "y"), "name", reach).filter(F.col("distance") <= reach)
    return sampled.join(near.select("_id"), "_id").groupBy(key, inside.alias("inside")).agg(F.sum("length").alias("length"))


def axis_types(shapes: DataFrame, key: str, axis: DataFrame, step: float, reach: float = 500.0) -> DataFrame:
    """key, nearest, centre, type: least distance of a shape's boundary (sampled) and distance of its centre to an axis of
    segments; type 1 within reach, else 2."""
    closed = shapes.select(key, F.concat("ring", F.slice("ring", 1, 1)).alias("_line"), "ring")
    border = sample_lines(closed, key, "_line", step).select(key, "x", "y", F.lit(1).alias("_c"))
    mean = lambda c: F.aggregate("ring", F.lit(0.0), lambda s, p: s + p[c]) / F.size("ring")
    centres = closed.select(key, mean("x").alias("x"), mean("y").alias("y"), F.lit(0).alias("_c"))
    points = border.unionByName(centres).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    far = points.join(nearest_segment(points, axis, "_id", ("x", "y"), "name", reach), "_id")
    out = far.groupBy(key).agg(F.min(F.when(F.col("_c") == 1, F.col("distance"))).alias("nearest"), F.min(F.when(F.col("_c") == 0, F.col("distance"))).alias("centre"))
    return out.withColumn("type", F.when(F.col("nearest") <= reach, 1).otherwise(2))


def dividers(shapes: DataFrame, key: str, roads: DataFrame, step: float, reach: float = 10.0, share: float = 0.9, width: float = 10.0) -> DataFrame:
    """key, near, width, divider: share of the boundary (sampled) within reach of a road, mean width 2 A / P, and whether both
    make the shape a strip beside roads."""
    closed = shapes.select(key, F.concat("ring", F.slice("ring", 1, 1)).alias("_line"))
    points = sample_lines(closed, key, "_line", step).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    near = nearest_segment(points, roads, "_id", ("x", "y"), "name", reach)
    far = points.join(near.select("_id", "distance"), "_id", "left")
    part = F.sum(F.when(F.col("distance") <= reach, F.col("length")).otherwise(0.0)) / F.sum("length")
    mean = (2 * ring_area(F.col("ring")) / perimeter(F.col("ring"))).alias("width")
    out = far.groupBy(key).agg(part.alias("near")).join(shapes.select(key, mean), key)
    return out.withColumn("divider", (F.col("near") >= share) & (F.col("width") < width))


def clusters(shapes: DataFrame, key: str, x: str, y: str, area: str, gap: float, sizes: Sequence[float]) -> DataFrame:
    """key, cluster (least key), total area, and the number of the size classes it reaches: shapes whose places lie within
    the gap belong together, through others too. Equal places are one, by their least key."""
    spots = shapes.groupBy(x, y).agg(F.min(key).alias("_a")).checkpoint()
    far = spots.select(F.col("_a").alias("_b"), F.col(x).alias("_x2"), F.col(y).alias("_y2"))
    edges = within(spots, far, (x, y), ("_x2", "_y2"), gap).select("_a", "_b")
    label = graph.components(edges, "_a", "_b").withColumnRenamed("label", "cluster")
    named = spots.join(label, F.col("_a") == F.col("node")).select(x, y, "cluster")
    own = shapes.join(named, [x, y]).select(key, "cluster", area)
    total = own.groupBy("cluster").agg(F.sum(area).alias("total"))
    reached = sum(((F.col("total") >= s).cast("int") for s in sizes), F.lit(0))
    return own.drop(area).join(total, "cluster").select(key, "cluster", "total", reached.alias("reached"))


def overlap_scores(cells: DataFrame, keys: Sequence[str], a: Column, b: Column, area: Column) -> DataFrame:
    """common, iou, covered: area in both of two sets of cells, over their union, and over the second."""
    part = lambda c: F.sum(F.when(c, area).otherwise(0.0))
    out = cells.groupBy(*keys).agg(part(a & b).alias("common"), part(a | b).alias("_u"), part(b).alias("_b"))
    return out.select(*keys, "common", F.try_divide("common", "_u").alias("iou"), F.try_divide("common", "_b").alias("covered"))


def assemble(elements: DataFrame, kind: str, points: str, outer: str, inner: str) -> DataFrame:
    """Adds geometry, ring, holes and closed: a node is a point, a way whose ends meet (four points at least) a polygon, any
    other a line; a relation is a polygon of its outer ring less its inner ones."""
    p, n = F.col(points), F.size(points)
    closed = (n >= 4) & (F.get(p, F.lit(0)) == F.get(p, n - 1))
    shape = F.when(F.col(kind) == "node", "point").when((F.col(kind) == "relation") | closed, "polygon").otherwise("line")
    ring = F.when(F.col(kind) == "relation", F.col(outer)).when(closed, F.slice(p, F.lit(1), n - 1))
    return elements.withColumns({"geometry": shape, "ring": ring, "holes": F.when(F.col(kind) == "relation", F.col(inner)), "closed": F.coalesce(closed, F.lit(False))})


# --- one feature at a time ------------------------------------------------------------------------------------------------


def _kept(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """Numbers of the points that Douglas and Peucker's rule keeps."""
    keep = np.zeros(len(xy), dtype=bool)
    keep[[0, -1]] = True
    open_ = [(0, len(xy) - 1)]
    while open_:
        a, b = open_.pop()
        if b - a < 2:
            continue
        way, off = xy[b] - xy[a], xy[a + 1 : b] - xy[a]
        size = float(way @ way)
        t = np.clip(off @ way / size, 0, 1) if size else np.zeros(len(off))
        far = np.hypot(*(off - t[:, None] * way).T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[a + 1 + k] = True
            open_ += [(a, a + 1 + k), (a + 1 + k, b)]
    return np.flatnonzero(keep)


def simplify(lines: DataFrame, points: str, tolerance: float) -> DataFrame:
    """Lines with only the points that are needed to stay within the tolerance; one feature at a time, in Arrow batches."""

    @F.pandas_udf(f"array<{POINT}>")
    def run(batch: pd.Series) -> pd.Series:
        def one(line):
            if line is None or len(line) < 3:
                return line
            xy = np.array([(p["x"], p["y"]) for p in line], dtype=float)
            return [line[k] for k in _kept(xy, tolerance)]

        return batch.map(one)

    return lines.withColumn(points, run(F.col(points)))


def stitch(parts: DataFrame, feature: str, order: str, points: str) -> DataFrame:
    """feature, chain, line, closed: a feature's lines joined where ends meet (turned round if need be), each chain from its
    first part in order. A feature is one group: its lines are what one boundary or river has."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = [[(p["x"], p["y"]) for p in line] for line in pdf.sort_values(order)[points] if line is not None and len(line)]
        name, rows = pdf[feature].iloc[0], []
        while left:
            chain = left.pop(0)
            grown = True
            while grown and chain[0] != chain[-1]:
                grown = False
                for k, line in enumerate(left):
                    if line[0] == chain[-1] or line[-1] == chain[-1]:
                        chain = chain + (line if line[0] == chain[-1] else line[::-1])[1:]
                    elif line[-1] == chain[0] or line[0] == chain[0]:
                        chain = (line if line[-1] == chain[0] else line[::-1])[:-1] + chain
                    else:
                        continue
                    del left[k]
                    grown = True
                    break
            rows.append((name, len(rows), [{"x": x, "y": y} for x, y in chain], len(chain) > 3 and chain[0] == chain[-1]))
        return pd.DataFrame(rows, columns=[feature, "chain", "line", "closed"])

    kind = parts.schema[feature].dataType.simpleString()
    return parts.groupBy(feature).applyInPandas(run, f"`{feature}` {kind}, chain int, line array<{POINT}>, closed boolean")


def without_small_holes(shapes: DataFrame, holes: str, least: float) -> DataFrame:
    """Drops holes (array of rings) below an area."""
    return shapes.withColumn(holes, F.filter(holes, lambda h: ring_area(h) >= least))
