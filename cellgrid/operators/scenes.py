"""Scenes accepted against the composite of the accepted: a fixpoint over a stack of scenes and cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.operators.quantiles import joined, percentiles


def composite_of(stack: DataFrame, keys: Sequence[str], value: str, least: int = 1) -> DataFrame:
    """keys and reference: the median of the values of each cell that has at least so many."""
    counts = stack.groupBy(*keys).agg(F.count(value).alias("_n")).filter(F.col("_n") >= least)
    return joined(percentiles(stack, keys, value, {"reference": 0.5}), counts, keys).drop("_n")


def cold_shares(stack: DataFrame, reference: DataFrame, scene: str, keys: Sequence[str], value: str, colder: float) -> DataFrame:
    """scene, cold_share: of a scene's cells that have a value and a reference, the share of those that lie more than colder
    below it; 0 where there are none."""
    both = joined(stack, reference, keys, "left").withColumn("_r", F.when(F.col(value).isNotNull(), F.col("reference")))
    cold = F.count(F.when(F.col(value) < F.col("_r") - colder, 1))
    return both.groupBy(scene).agg(F.coalesce(F.try_divide(cold, F.count("_r")), F.lit(0.0)).alias("cold_share"))


def accepted(
    stack: DataFrame, scene: str, keys: Sequence[str], value: str, colder: float = 10.0, share: float = 0.2, least: int = 3, most_passes: int = 20
) -> DataFrame:
    """scene, first_share, cold_share, used for every scene of a stack (scene, keys, value), and passes, settled.

    The first pass compares each scene with the median of all scenes; every other pass compares all scenes, those rejected
    too, with the composite (cells of at least so many values) of the scenes that the pass before accepted: a scene whose
    share of cold cells is below the given one. It ends when a pass accepts what the one before did (settled), or after
    most_passes. A set seen before that is no neighbour means that sets go round in a circle; the set that the last pass
    would reach is then taken from the circle without going round it.

    Only a fingerprint of the accepted set reaches the driver in each pass. Null scenes and values play no part; repeated
    rows of a scene's cell count as values of their own."""
    stack = stack.filter(F.col(scene).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(scene, *keys, value)
    reference = composite_of(stack, keys, value)
    passes: list[DataFrame] = []
    prints: list[tuple] = []
    settled = False
    while len(passes) < most_passes:
        shares = cold_shares(stack, reference, scene, keys, value, colder).withColumn("used", F.col("cold_share") < share).checkpoint()
        passes.append(shares)
        kept = shares.filter("used")
        prints.append(tuple(kept.agg(F.count("*"), F.sum(F.xxhash64(scene).cast("decimal(38,0)")), F.expr(f"bit_xor(xxhash64('other', {scene}))")).first()))
        settled = len(prints) > 1 and prints[-1] == prints[-2]
        if settled or prints[-1] in prints[:-1]:
            break
        reference = composite_of(joined(stack, kept.select(scene), [scene], "left_semi"), keys, value, least)
    last, count = passes[-1], len(passes)
    if not settled and prints[-1] in prints[:-1]:
        start = prints.index(prints[-1])
        around = len(prints) - 1 - start
        # Of the circle's passes that reach this set; what follows a set depends on the set alone.
        last, count = passes[start + 1 + (most_passes - 2 - start) % around], most_passes
    first = passes[0].select(scene, F.col("cold_share").alias("first_share"))
    out = joined(last, first, [scene])
    return out.select(scene, "first_share", "cold_share", "used", F.lit(count).alias("passes"), F.lit(settled).alias("settled"))
