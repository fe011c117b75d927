"""Areal reallocation: totals of blocks spread over cells so that sums are kept."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.operators.quantiles import joined


def spread(cells: DataFrame, block: str, total: str, weight: Column) -> DataFrame:
    """Adds allocated: the block's total (the same in all its rows) by weight, evenly where no weight is positive."""
    sized = cells.withColumn("_w", F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0)))
    sums = sized.groupBy(block).agg(F.sum("_w").alias("_s"), F.count("*").alias("_n"))
    part = F.when(F.col("_s") > 0, F.col("_w") / F.col("_s")).otherwise(1.0 / F.col("_n"))
    return joined(sized, sums, [block]).withColumn("allocated", F.col(total) * part).drop("_w", "_s", "_n")


def residual(cells: DataFrame, block: str, total: str, known: str, margin: float, weight: Column) -> DataFrame:
    """What a block's total leaves after (1 + margin) times the known part, not below 0, spread by weight."""
    sums = cells.groupBy(block).agg(F.sum(known).alias("_known"))
    rest = F.greatest(F.col(total) - (1 + margin) * F.col("_known"), F.lit(0.0))
    return spread(joined(cells, sums, [block]).withColumn("_rest", rest), block, "_rest", weight).drop("_rest", "_known")


def anchor(cells: DataFrame, targets: DataFrame, kind: str, value: str) -> DataFrame:
    """Scales the values of each class so that they sum to the class's target; targets is a small table of classes."""
    sums = cells.groupBy(kind).agg(F.sum(value).alias("_s")).join(targets, kind)
    factors = sums.select(kind, F.try_divide("target", "_s").alias("_f"))
    return cells.join(factors, kind, "left").withColumn("anchored", F.col(value) * F.coalesce("_f", F.lit(1.0))).drop("_f")


def around(cells: DataFrame, row: int, col: int, radius: float, value: str, cell_m: float = 1.0) -> DataFrame:
    """Cells, cells with a value, sum and mean within a radius of a place: one row."""
    near = F.hypot((F.col("row") - row) * cell_m, (F.col("col") - col) * cell_m) <= radius
    reach = int(radius / cell_m) + 1
    box = F.col("row").between(row - reach, row + reach) & F.col("col").between(col - reach, col + reach)
    return cells.filter(box & near).agg(F.count("*").alias("cells"), F.count(value).alias("valid"), F.sum(value).alias("sum"), F.avg(value).alias("mean"))


def inspect(cells: DataFrame, row: int, col: int, columns: Sequence[str]) -> DataFrame:
    """The values at one cell."""
    return cells.filter((F.col("row") == row) & (F.col("col") == col)).select("row", "col", *columns)


def redistribute(cells: DataFrame, block: str, truth: str, weight: Column) -> DataFrame:
    """Adds allocated: what a block truly holds in all, dealt out anew by a weight (evenly where a block has none)."""
    return spread(cells.withColumn("_t", F.sum(truth).over(Window.partitionBy(block))), block, "_t", weight).drop("_t")


def scale_dissimilarity(cells: DataFrame, a: str, b: str, sizes: Sequence[int]) -> DataFrame:
    """size, dissimilarity: half the summed differences of two distributions, over blocks of each size (1: cells)."""
    from cellgrid.operators.aggregate import dissimilarity

    at = F.explode(F.array(*map(F.lit, sizes))).alias("size")
    blocks = cells.select("row", "col", a, b, at).groupBy("size", F.floor(F.col("row") / F.col("size")).alias("_r"), F.floor(F.col("col") / F.col("size")).alias("_c"))
    return dissimilarity(blocks.agg(F.sum(a).alias(a), F.sum(b).alias(b)), ["size"], a, b)


def held_out(cells: DataFrame, block: str, truth: str, weights: Mapping[str, Column], sizes: Sequence[int]) -> DataFrame:
    """method, size, dissimilarity: how far known counts, dealt out again within blocks by each weight, lie from the truth."""
    out = None
    for name, weight in weights.items():
        made = scale_dissimilarity(redistribute(cells, block, truth, weight), truth, "allocated", sizes).withColumn("method", F.lit(name))
        out = made if out is None else out.unionByName(made)
    return out


def greedy_pages(items: DataFrame, document: str, order: str, size: str, capacity: float) -> DataFrame:
    """Adds page: items of a document in order, a new page where the next item would pass the capacity (a larger item has a
    page of its own). Sequential within a document: a task streams through its documents, one after the other, and holds
    a batch of rows."""
    schema = items.select("*", F.lit(0).alias("page")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, page, used = object(), 0, 0.0
        for batch in batches:
            pages = []
            for doc, value in zip(batch.column(document).to_pylist(), batch.column(size).to_pylist(), strict=True):
                if doc != last:
                    last, page, used = doc, 0, 0.0
                value = math.nan if value is None else float(value)
                if used and used + value > capacity:
                    page, used = page + 1, 0.0
                pages.append(page)
                used += value
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pages, pa.int32())], names=[*batch.schema.names, "page"])

    ordered = items.repartition(document).sortWithinPartitions(document, F.asc_nulls_last(order))
    return ordered.mapInArrow(run, schema)
