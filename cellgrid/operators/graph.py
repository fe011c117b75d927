"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the least node of each component; an edge may stand either way round, or as a loop.

    Every round hands the least node of each neighbourhood to the nodes above, then to those below. Rounds grow with the
    logarithm of a path, the edge table never grows, and lineage is cut each time."""
    nodes = edges.select(F.explode(F.array(a, b)).alias("node")).distinct()
    now = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("_n")).agg(F.least("_n", F.min("v")).alias("_m"))
        up = now.join(least, F.col("v") == F.col("_n")).select("u", F.col("_m").alias("v")).distinct().checkpoint()
        least = up.groupBy(F.col("u").alias("_n")).agg(F.min("v").alias("_m"))
        down = up.join(least, F.col("u") == F.col("_n")).filter("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        now = down.unionByName(least.select(F.col("_n").alias("u"), F.col("_m").alias("v"))).distinct().checkpoint()
        parents = now.select(F.col("u").alias("node"))
        loose = now.select(F.col("v").alias("node")).join(parents, "node", "left_semi")
        many = now.groupBy("u").count().filter("count > 1").select("u")
        if not loose.limit(1).count() and not many.limit(1).count():
            return nodes.join(now, F.col("node") == F.col("u"), "left").select("node", F.coalesce("v", "node").alias("label"))
