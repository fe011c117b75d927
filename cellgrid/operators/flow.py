"""Flow over terrain: filled surface, steepest descent, accumulation, drain targets, height above drainage."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.operators.raster import moved, square

NEIGHBOURS = [s for s in square(1) if s != (0, 0)]


def fill(cells: DataFrame, value: str, tile: int = 256) -> DataFrame:
    """Adds filled: depressions raised to just above their spill, from the border (cells that lack a neighbour) inwards.

    filled is the least level at which water leaves: a cell's own height or the next number above the least filled
    neighbour, whichever is larger. Tiles are flooded side by side from their own border cells and from the levels that
    their neighbours' rims have so far; only tiles whose surroundings sank are flooded again, until none does. The result is
    the one of a single queue over the whole table, but a task holds one tile."""
    at = lambda c: F.floor(F.col(c) / tile).cast("int")
    base = cells.select("row", "col", F.col(value).cast("double").alias("_z"), at("row").alias("_tr"), at("col").alias("_tc"))
    now = base.withColumn("_out", F.lit(float("inf"))).checkpoint()
    active = None
    while True:
        # Rim cells go to the tiles that see them, at the level known so far.
        tiles = lambda c: F.explode(F.array_distinct(F.array(at(c), F.floor((F.col(c) - 1) / tile).cast("int"), F.floor((F.col(c) + 1) / tile).cast("int"))))
        halo = now.select("row", "col", "_z", "_out", F.col("_tr").alias("_or"), F.col("_tc").alias("_oc"), tiles("row").alias("_tr")).select("*", tiles("col").alias("_tc"))
        halo = halo.filter("_tr <> _or or _tc <> _oc").select("row", "col", "_z", "_tr", "_tc", "_out")
        sent = now.unionByName(halo)
        if active is not None:
            sent = sent.join(active, ["_tr", "_tc"])
        flooded = sent.groupBy("_tr", "_tc").applyInPandas(_flood(tile), "row int, col int, _z double, _tr int, _tc int, _out double, _sank boolean")
        flooded = flooded.checkpoint()
        rim = flooded.filter("_sank").select(tiles("row").alias("_r"), "col", "_tr", "_tc").select("_r", tiles("col").alias("_c"), "_tr", "_tc")
        rest = now if active is None else now.join(active, ["_tr", "_tc"], "left_anti")
        done = flooded.drop("_sank")
        now = (done if active is None else done.unionByName(rest)).checkpoint()
        active = rim.filter("_r <> _tr or _c <> _tc").select(F.col("_r").alias("_tr"), F.col("_c").alias("_tc")).distinct().checkpoint()
        if not active.limit(1).count():
            return cells.join(now.select("row", "col", F.col("_out").alias("filled")), ["row", "col"])


def _flood(tile: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        top, left = int(key[0]) * tile - 1, int(key[1]) * tile - 1
        r, c = pdf["row"].to_numpy() - top, pdf["col"].to_numpy() - left
        z = np.full((tile + 2, tile + 2), np.nan)
        z[r, c] = pdf["_z"].to_numpy(float)
        old = np.full(z.shape, np.inf)
        old[r, c] = pdf["_out"].to_numpy(float)
        there = ~np.isnan(z)
        out = np.full(z.shape, np.inf)
        todo = there.copy()
        todo[[0, -1]] = False
        todo[:, [0, -1]] = False
        queue = [(old[y, x], y, x) for y, x in zip(*np.nonzero(there & ~todo), strict=True) if old[y, x] < np.inf]
        # Own cells whose 3 x 3 square is not full are the border of the table.
        full = np.lib.stride_tricks.sliding_window_view(there, (3, 3)).all((2, 3))
        for y, x in zip(*np.nonzero(todo[1:-1, 1:-1] & ~full), strict=True):
            out[y + 1, x + 1] = z[y + 1, x + 1]
            todo[y + 1, x + 1] = False
            queue.append((z[y + 1, x + 1], y + 1, x + 1))
        heapq.heapify(queue)
        while queue:
            level, y, x = heapq.heappop(queue)
            for dy, dx in NEIGHBOURS:
                a, b = y + dy, x + dx
                if 0 <= a < len(z) and 0 <= b < len(z) and todo[a, b]:
                    todo[a, b] = False
                    out[a, b] = max(z[a, b], np.nextafter(level, np.inf))
                    heapq.heappush(queue, (out[a, b], a, b))
        own = (r > 0) & (r <= tile) & (c > 0) & (c <= tile)
        mine = pdf[own]
        level = out[r[own], c[own]]
        return mine.assign(_out=level, _sank=level < mine["_out"].to_numpy(float))

    return run


def descent(cells: DataFrame, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """row, col, value, the columns to keep, down_row, down_col: the neighbour of steepest fall (first in row-major order of
    equal ones), null where none is lower.

    Every cell hands its height to its neighbours, which gather them in one aggregate: summed up where the rows are read, and
    no join whose side could be sent to all."""
    own = (F.col("dr") == 0) & (F.col("dc") == 0)
    # moved() looks from the neighbour: its place is this cell less the offset.
    seen = moved(cells.select("row", "col", value, *keep), [value, *keep], square(1)).groupBy("row", "col").agg(
        F.max(own).alias("_there"), F.max(F.when(own, F.col(value))).alias(value), *[F.max(F.when(own, F.col(k))).alias(k) for k in keep],
        *[F.max(F.when((F.col("dr") == a) & (F.col("dc") == b), F.col(value))).alias(f"_z{k}") for k, (a, b) in enumerate(NEIGHBOURS)],
    )
    falls = []
    for k, (a, b) in enumerate(NEIGHBOURS):
        fall = (F.col(value) - F.col(f"_z{k}")) / F.hypot(F.lit(float(a)), F.lit(float(b)))
        falls.append(F.when(fall > 0, F.struct(fall.alias("_s"), F.lit(a).alias("_a"), F.lit(b).alias("_b"))))
    best = seen.filter("_there").withColumn("_m", F.greatest(*falls))
    return best.select("row", "col", value, *keep, (F.col("row") - F.col("_m._a")).alias("down_row"), (F.col("col") - F.col("_m._b")).alias("down_col"))


def _ids(links: DataFrame) -> DataFrame:
    width = 1 << 31
    return links.select((F.col("row").cast("long") * width + F.col("col")).alias("id"), (F.col("down_row").cast("long") * width + F.col("down_col")).alias("down"), "*")


def targets(links: DataFrame, stop: str, most: int = 64) -> DataFrame:
    """row, col, target_row, target_col: the first cell downstream (itself included) where stop holds, null if the flow
    ends before. Pointers double each round: rounds grow with the logarithm of the longest path."""
    ids = _ids(links)
    now = ids.select("row", "col", "id", F.when(F.col(stop) | F.col("down").isNull(), F.col("id")).otherwise(F.col("down")).alias("at"), F.col(stop).alias("is_stop")).checkpoint()
    stops = now.select(F.col("id").alias("at"), "is_stop")
    for _ in range(most):
        jump = now.select(F.col("id").alias("at"), F.col("at").alias("_n"))
        new = now.join(jump, "at").select("row", "col", "id", F.col("_n").alias("at"), "is_stop", (F.col("_n") != F.col("at")).alias("moved")).checkpoint()
        now = new.drop("moved")
        if not new.filter("moved").limit(1).count():
            break
    width = 1 << 31
    found = now.drop("is_stop").join(stops.filter("is_stop"), "at", "left")
    hit = F.when(F.col("is_stop"), F.col("at"))
    return found.select("row", "col", F.floor(hit / width).cast("int").alias("target_row"), F.pmod(hit, F.lit(width)).cast("int").alias("target_col"))


def accumulation(links: DataFrame, weight: str, most: int = 64) -> DataFrame:
    """row, col, upstream: the sum of the weights of all cells that drain through a cell, its own included.

    Doubling again: in round k every cell hands what it gathered over 2**k steps to the cell 2**k steps below."""
    now = _ids(links).select("row", "col", "id", "down", F.col(weight).cast("double").alias("upstream")).checkpoint()
    for _ in range(most):
        given = now.filter("down is not null").groupBy(F.col("down").alias("id")).agg(F.sum("upstream").alias("_g"))
        jump = now.select(F.col("id").alias("down"), F.col("down").alias("_n"))
        new = now.join(given, "id", "left").withColumn("upstream", F.col("upstream") + F.coalesce("_g", F.lit(0.0))).drop("_g")
        now = new.join(jump, "down", "left").select("row", "col", "id", F.col("_n").alias("down"), "upstream").checkpoint()
        if not now.filter("down is not null").limit(1).count():
            break
    return now.select("row", "col", "upstream")


def height_above(cells: DataFrame, found: DataFrame, value: str) -> DataFrame:
    """row, col, hand: height above the drainage cell that a cell drains to, not below 0."""
    level = cells.select(F.col("row").alias("target_row"), F.col("col").alias("target_col"), F.col(value).alias("_l"))
    out = cells.join(found, ["row", "col"]).join(level, ["target_row", "target_col"], "left")
    return out.select("row", "col", F.greatest(F.lit(0.0), F.col(value) - F.col("_l")).alias("hand"))


def least_upstream(links: DataFrame, value: str, group: str) -> DataFrame:
    """row, col, lowest: the least value of a cell and of all cells that flow into it through cells of its own group (null:
    no group). Doubling as in accumulation."""
    ids = _ids(links)
    own = ids.select("row", "col", "id", "down", F.col(value).cast("double").alias("lowest"), F.col(group).alias("_g"))
    below = own.select(F.col("id").alias("down"), F.col("_g").alias("_gd"))
    now = own.join(below, "down", "left").select("row", "col", "id", F.when(F.col("_g") == F.col("_gd"), F.col("down")).alias("down"), "lowest").checkpoint()
    while now.filter("down is not null").limit(1).count():
        given = now.filter("down is not null").groupBy(F.col("down").alias("id")).agg(F.min("lowest").alias("_l"))
        jump = now.select(F.col("id").alias("down"), F.col("down").alias("_n"))
        new = now.join(given, "id", "left").withColumn("lowest", F.least("lowest", "_l")).drop("_l")
        now = new.join(jump, "down", "left").select("row", "col", "id", F.col("_n").alias("down"), "lowest").checkpoint()
    return now.select("row", "col", "lowest")


def floored(levels: DataFrame, found: DataFrame, level: str, major_level: str, minor: str) -> DataFrame:
    """levels with the level of minor cells not below the major river's at the cell they drain to (found: see targets)."""
    major = levels.select(F.col("row").alias("target_row"), F.col("col").alias("target_col"), F.col(major_level).alias("_m"))
    at = found.join(major, ["target_row", "target_col"]).select("row", "col", "_m")
    return levels.join(at, ["row", "col"], "left").withColumn(level, F.when(F.col(minor), F.greatest(level, "_m")).otherwise(F.col(level))).drop("_m")


def canal_drains(points: DataFrame, canal: str, own: str, left: str, right: str, share: float = 0.6, above: float = 0.5) -> DataFrame:
    """canal, points, pct_low, drains: points of a canal that lie no higher than above over the lower of both flanks."""
    good = points.dropna(subset=[own, left, right])
    low = F.avg((F.col(own) <= F.least(left, right) + above).cast("double"))
    return good.groupBy(canal).agg(F.count("*").alias("points"), (100 * low).alias("pct_low"), (low >= share).alias("drains"))


def straight_runs(links: DataFrame, inside: str, least: int = 30) -> DataFrame:
    """runs, cells: stretches of at least so many cells with one direction of flow, each within the flagged cells.

    Along one direction a stretch is a run of consecutive steps on a line of the grid: gaps and islands on that line."""
    dr, dc = F.col("down_row") - F.col("row"), F.col("down_col") - F.col("col")
    flagged = links.filter(F.col(inside))
    turn = flagged.select("row", "col", F.coalesce(dr, F.lit(0)).alias("dr"), F.coalesce(dc, F.lit(0)).alias("dc"))
    still = turn.filter("dr = 0 and dc = 0").select(F.lit(1).cast("long").alias("n"))
    going = turn.filter("dr <> 0 or dc <> 0")
    # Steps along the direction, and the line that the cell lies on.
    step = F.when(F.col("dr") != 0, F.col("row") * F.col("dr")).otherwise(F.col("col") * F.col("dc"))
    line = F.col("row") * F.col("dc") - F.col("col") * F.col("dr")
    w = Window.partitionBy("dr", "dc", "_line").orderBy("_step")
    lined = going.withColumns({"_step": step, "_line": line}).withColumn("_run", F.col("_step") - F.row_number().over(w))
    runs = lined.groupBy("dr", "dc", "_line", "_run").agg(F.count("*").alias("n")).select("n").unionByName(still).filter(F.col("n") >= least)
    return runs.agg(F.count("*").alias("runs"), F.coalesce(F.sum("n"), F.lit(0)).alias("cells"))


def network(links: DataFrame, inside: str, group: str) -> DataFrame:
    """group, segments: links between flagged cells as pairs of places, in row-major order."""
    # A link's two ends meet at its lower cell, in an aggregate of at most nine rows a place.
    part = F.struct("row", "col", "down_row", "down_col")
    flagged = links.filter(F.col(inside))
    ends = flagged.select("row", "col", F.lit(True).alias("_there"), F.lit(None).cast(flagged.schema[group].dataType).alias("_g"), F.when(F.lit(False), part).alias("_p"))
    given = flagged.filter("down_row is not null and down_col is not null")
    given = given.select(F.col("down_row").alias("row"), F.col("down_col").alias("col"), F.lit(False).alias("_there"), F.col(group).alias("_g"), part.alias("_p"))
    met = ends.unionByName(given).groupBy("row", "col").agg(F.max("_there").alias("_there"), F.collect_list(F.when(~F.col("_there"), F.struct("_g", "_p"))).alias("_in"))
    kept = met.filter("_there").select(F.explode("_in").alias("_l")).select(F.col("_l._g").alias(group), F.col("_l._p").alias("_p"))
    return kept.groupBy(group).agg(F.array_sort(F.collect_list("_p")).alias("segments"))
