"""Rasters carried from one map projection to the lattice of another."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From coordinates of one projection to those of another: (x, y) to (x, y), as columns.
Projection = Callable[[Column, Column], tuple[Column, Column]]
HOW = ("nearest", "bilinear", "average", "sum")


@dataclass(frozen=True)
class Lattice:
    """Cells of one size from a corner: columns go east, rows go south."""

    west: float
    north: float
    step: float
    rows: int
    cols: int

    def x(self, col: Column) -> Column:
        return F.lit(self.west) + (col + 0.5) * self.step

    def y(self, row: Column) -> Column:
        return F.lit(self.north) - (row + 0.5) * self.step

    def place(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column in cells, whole numbers at the centres."""
        return (F.lit(self.north) - y) / self.step - 0.5, (x - F.lit(self.west)) / self.step - 0.5

    def cells(self, spark) -> DataFrame:
        """All cells, made where they are used."""
        every = spark.range(self.rows * self.cols)
        return every.select(F.floor(F.col("id") / self.cols).cast("int").alias("row"), (F.col("id") % self.cols).cast("int").alias("col"))


def bounding(source: Lattice, forward: Projection, step: float, spark) -> Lattice:
    """The lattice of a step, in the other projection, around a source lattice: its rim's cells, half a cell out, carried over.
    Only four numbers reach the driver."""
    rim = source.cells(spark).filter((F.col("row") == 0) | (F.col("row") == source.rows - 1) | (F.col("col") == 0) | (F.col("col") == source.cols - 1))
    half = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-0.5, 0.5) for b in (-0.5, 0.5)]))
    rim = rim.withColumn("h", half)
    x, y = forward(source.x(F.col("col") + F.col("h.a")), source.y(F.col("row") + F.col("h.b")))
    w, e, s, n = rim.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    west, north = step * (w // step), step * (n // step + 1)
    return Lattice(west, north, step, int((north - s) // step) + 1, int((e - west) // step) + 1)


def reproject(cells: DataFrame, value: str, source: Lattice, target: Lattice, forward: Projection, backward: Projection, how: str = "average") -> DataFrame:
    """row, col, value of the target lattice's cells that the source reaches; null, and NaN, is no data.

    nearest and bilinear (over the neighbours that have a value) look up where a target cell's centre lies in the source:
    backward carries the target's coordinates there. average and sum carry every source cell's centre forward and take those
    that fall in a target cell; average gives a target cell in which none falls the nearest one, as a coarser source does.
    Cells outside the source's lattice play no part. Targets are made in ranges, and met by row and column of the source:
    no task sees more than its share, and nothing is broadcast."""
    if how not in HOW:
        raise ValueError(f"how must be one of {', '.join(HOW)}")
    spark = cells.sparkSession
    inside = F.col("row").between(0, source.rows - 1) & F.col("col").between(0, source.cols - 1)
    known = cells.filter(inside & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select("row", "col", F.col(value).cast("double").alias("_v"))

    at = target.cells(spark)
    if how in ("average", "sum"):
        x, y = forward(source.x(F.col("col")), source.y(F.col("row")))
        row, col = target.place(x, y)
        moved = known.select(F.floor(row + 0.5).cast("int").alias("row"), F.floor(col + 0.5).cast("int").alias("col"), "_v")
        moved = moved.filter(F.col("row").between(0, target.rows - 1) & F.col("col").between(0, target.cols - 1))
        met = moved.groupBy("row", "col").agg((F.avg if how == "average" else F.sum)("_v").alias(value))
        if how == "sum":
            return met
        rest = _nearest(at.join(met, ["row", "col"], "left_anti"), known, value, source, target, backward)
        return met.unionByName(rest)
    if how == "nearest":
        return _nearest(at, known, value, source, target, backward)
    asked = _carried(at, source, target, backward)
    corners = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (0, 1) for c in (0, 1)]))
    asked = asked.withColumn("_k", corners).withColumns({"_r": (F.floor("_y") + F.col("_k.r")).cast("int"), "_c": (F.floor("_x") + F.col("_k.c")).cast("int")})
    asked = asked.withColumn("_w", (1 - F.abs(F.col("_y") - F.col("_r"))) * (1 - F.abs(F.col("_x") - F.col("_c"))))
    met = asked.join(known.withColumnsRenamed({"row": "_r", "col": "_c"}), ["_r", "_c"])
    return met.groupBy("row", "col").agg(F.try_divide(F.sum(F.col("_v") * F.col("_w")), F.sum("_w")).alias(value)).filter(F.col(value).isNotNull())


def _carried(at: DataFrame, source: Lattice, target: Lattice, backward: Projection) -> DataFrame:
    """Target cells with their place (_y, _x) in the source, those within its outer edges."""
    x, y = backward(target.x(F.col("col")), target.y(F.col("row")))
    row, col = source.place(x, y)
    asked = at.select("row", "col", row.alias("_y"), col.alias("_x"))
    return asked.filter(F.col("_y").between(-0.5, source.rows - 0.5) & F.col("_x").between(-0.5, source.cols - 0.5))


def _nearest(at: DataFrame, known: DataFrame, value: str, source: Lattice, target: Lattice, backward: Projection) -> DataFrame:
    asked = _carried(at, source, target, backward)
    asked = asked.select("row", "col", F.floor(F.col("_y") + 0.5).cast("int").alias("_r"), F.floor(F.col("_x") + 0.5).cast("int").alias("_c"))
    return asked.join(known.withColumnsRenamed({"row": "_r", "col": "_c"}), ["_r", "_c"]).select("row", "col", F.col("_v").alias(value))
