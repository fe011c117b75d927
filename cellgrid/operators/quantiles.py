"""Exact order statistics and percentiles of many groups at once, whatever their sizes.

Spark's exact percentile holds the distinct values of a group in one map. Here only small groups use it. The others are
narrowed all together: a mergeable sketch of what is left of each group proposes cut points, one counting pass tells how
many values lie below, at and between them, and the part that holds a wanted rank is kept, until it is small enough to be
sorted. Every pass is one partial aggregate; no group's values meet in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group (or of what is left of it) that one task may hold.
WITHIN = 100_000
#: Parts into which a pass cuts what is left of a group.
CUTS = 64


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null; the keys of the left side stay."""
    other = right.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    return left.join(other, same, how).drop(*[f"_k{i}" for i in range(len(keys))])


def order_statistics(rows: DataFrame, keys: Sequence[str], value: str, wanted: DataFrame, within: int = WITHIN) -> DataFrame:
    """keys, rank, value for each (keys, rank) of wanted: the value of that rank (from 0) among a group's values in ascending
    order. Rows without a value play no part; a rank that a group doesn't have gives no row."""
    data = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    # What is left of a group for a rank lies strictly between two values (null: open), below counts the values under it.
    sizes = data.groupBy(*keys).agg(F.count("*").alias("_held"))
    none = F.lit(None).cast(data.schema["_v"].dataType)
    left = joined(wanted.select(*keys, F.col("rank").alias("_rank")).distinct(), sizes, keys).filter("_rank >= 0 and _rank < _held")
    left = left.select(*keys, "_rank", F.lit(0).cast("long").alias("_below"), "_held", none.alias("_low"), none.alias("_high"), none.alias("_found")).checkpoint()
    inside = "(_low is null or _v > _low) and (_high is null or _v < _high)"
    while True:
        large = left.filter((F.col("_held") > within) & F.col("_found").isNull())
        if not large.limit(1).count():
            break
        open_ = joined(data, large, keys).filter(inside)
        cuts = F.array_distinct(F.percentile_approx("_v", F.array(*[F.lit(k / CUTS) for k in range(1, CUTS)]), F.lit(10 * CUTS)))
        cuts = joined(large, open_.groupBy(*keys, "_rank").agg(cuts.alias("_cuts")).withColumnRenamed("_rank", "_r"), [*keys]).filter("_rank = _r").drop("_r").checkpoint()
        # Place 2 k is the part below cut k, place 2 k + 1 the cut itself.
        place = F.expr("2 * size(filter(_cuts, c -> c < _v)) + int(array_contains(_cuts, _v))")
        counts = joined(data, cuts, keys).filter(inside).groupBy(*keys, "_rank", place.alias("_place")).agg(F.count("*").alias("_c"))
        run = Window.partitionBy(*keys, "_rank").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("_upto", F.sum("_c").over(run))
        counts = joined(counts.withColumnRenamed("_rank", "_r"), cuts, keys).filter("_r = _rank and _rank - _below >= _upto - _c and _rank - _below < _upto")
        k = F.expr("int(_place div 2)")
        at = F.expr("_place % 2 = 1")
        low = F.when(k > 0, F.get("_cuts", k - 1)).otherwise(F.col("_low"))
        high = F.coalesce(F.get("_cuts", k), F.col("_high"))
        part = counts.select(
            *keys, "_rank", (F.col("_below") + F.col("_upto") - F.col("_c")).alias("_below"), F.col("_c").alias("_held"), low.alias("_low"), high.alias("_high"),
            F.when(at, F.get("_cuts", k)).alias("_found"),
        )
        left = left.filter((F.col("_held") <= within) | F.col("_found").isNotNull()).unionByName(part).checkpoint()
    small = left.filter("_found is null")
    steps = joined(data, small, keys).filter(inside).groupBy(*keys, "_rank", "_below", "_v").agg(F.count("*").alias("_c"))
    run = Window.partitionBy(*keys, "_rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("_upto", F.sum("_c").over(run) + F.col("_below"))
    found = steps.filter("_rank < _upto and _rank >= _upto - _c").select(*keys, F.col("_rank").alias("rank"), F.col("_v").alias(value))
    return found.unionByName(left.filter("_found is not null").select(*keys, F.col("_rank").alias("rank"), F.col("_found").alias(value)))


def percentiles(rows: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], within: int = WITHIN) -> DataFrame:
    """keys and a column for each named point (a fraction): the interpolated percentile of the group's values, exact.

    Groups of rows without values have no row. Groups of up to `within` values are worked out in one aggregate, larger ones
    by order_statistics; both interpolate alike."""
    data = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    exact = data.groupBy(*keys).agg(F.percentile("_v", F.array(*[F.lit(q) for q in points.values()])).alias("_p"))
    plain = lambda of: of.select(*keys, *[F.col("_p")[i].alias(n) for i, n in enumerate(points)])
    sizes = data.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = sizes.filter(F.col("_n") > within).checkpoint()
    if not large.limit(1).count():
        return plain(exact)
    some = joined(data, large.select(*keys), keys, "left_anti").groupBy(*keys).agg(F.percentile("_v", F.array(*[F.lit(q) for q in points.values()])).alias("_p"))
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(q)).alias("q")) for n, q in points.items()])
    asked = large.select(*keys, "_n", F.inline(names)).withColumn("_at", F.col("q") * (F.col("_n") - 1))
    asked = asked.withColumns({"_lo": F.floor("_at"), "_hi": F.ceil("_at")})
    ranks = asked.select(*keys, F.explode(F.array("_lo", "_hi")).alias("rank"))
    found = order_statistics(joined(data, large.select(*keys), keys, "left_semi"), keys, "_v", ranks, within).checkpoint()
    for side in ("_lo", "_hi"):
        asked = joined(asked, found.withColumnsRenamed({"rank": "_r", "_v": f"{side}v"}), keys).filter(f"{side} = _r").drop("_r")
    between = (F.col("_hi") - F.col("_at")) * F.col("_lov") + (F.col("_at") - F.col("_lo")) * F.col("_hiv")
    value_ = F.when(F.col("_lo") == F.col("_hi"), F.col("_lov")).otherwise(between)
    wide = asked.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, value_)).alias(n) for n in points])
    return plain(some).unionByName(wide)
