"""Priority scores: normalised components, weighted index, ranking, scenarios and what-if effects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.operators.aggregate import exact_percentile


def normalise(long: DataFrame, keys: Sequence[str] = ("component",), raw: str = "raw", direction: str = "direction", floor: str = "floor") -> DataFrame:
    """Adds norm in [0, 1]: the place between a component's least and largest value, turned round where direction is '-';
    a range below the floor counts as the floor; 0 throughout where the range is 0."""
    w = Window.partitionBy(*keys)
    low, high = F.min(raw).over(w), F.max(raw).over(w)
    width = F.greatest(high - low, F.coalesce(F.col(floor), F.lit(0.0)))
    gap = F.when(F.col(direction) == "+", F.col(raw) - low).otherwise(high - F.col(raw))
    value = F.when(width == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(gap, width))))
    return long.withColumn("norm", F.round(value, 4))


def index(long: DataFrame, zone: str, weight: str = "weight", keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Weighted mean of the normalised components by zone (and scenario)."""
    return long.groupBy(*keys, zone).agg(F.round(F.try_divide(F.sum(F.col("norm") * F.col(weight)), F.sum(weight)), digits).alias("index"))


def ranking(scores: DataFrame, zone: str, value: str = "index", keys: Sequence[str] = ()) -> DataFrame:
    """Adds position: largest value first, then by zone. Zones are a dimension of bounded size."""
    return scores.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), zone)))


def leave_one_out(long: DataFrame, zone: str, components: Sequence[str], digits: int = 4) -> DataFrame:
    """Index and position for each scenario: all components alike, and each of them left out."""
    names = F.explode(F.array(F.lit("base"), *map(F.lit, components)))
    runs = long.withColumn("scenario", names).withColumn("weight", F.when(F.col("component") == F.col("scenario"), 0.0).otherwise(1.0))
    return ranking(index(runs, zone, keys=["scenario"], digits=digits), zone, keys=["scenario"])


def rank_range(scenarios: DataFrame, zone: str) -> DataFrame:
    return scenarios.groupBy(zone).agg(F.min("position").alias("best"), F.max("position").alias("worst"))


def replaced(long: DataFrame, variants: DataFrame, zone: str) -> DataFrame:
    """One copy of the components for each variant, its own component's norm in place of the base. Variants are a handful."""
    names = variants.select("variant").distinct()
    own = variants.select("variant", "component", zone, F.col("norm").alias("_n"))
    every = long.withColumn("variant", F.explode(F.array(*[F.lit(r[0]) for r in names.collect()]))).join(own, ["variant", "component", zone], "left")
    return every.withColumn("norm", F.coalesce("_n", "norm")).drop("_n")


def reweighted(long: DataFrame, zone: str, weights: Mapping[str, int]) -> DataFrame:
    """Interactive weights: value, position, the two largest contributions, and whether the next zone is within 0.01."""
    total = float(sum(weights.values()) or 1)
    table = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, v / total)])
    part = F.coalesce("norm", F.lit(0.0)) * F.coalesce(F.try_element_at(table, F.col("component")), F.lit(0.0))
    rows = long.withColumn("_c", part).groupBy(zone).agg(
        F.sum("_c").alias("value"),
        F.collect_list(F.when(F.col("_c") > 0, F.struct((-F.col("_c")).alias("c"), "component"))).alias("_p"),
    )
    order = Window.orderBy(F.desc("value"), zone)
    return rows.select(
        zone, "value", F.row_number().over(order).alias("position"),
        F.array_join(F.transform(F.slice(F.array_sort("_p"), 1, 2), lambda p: p["component"]), ",").alias("reasons"),
        ((F.col("value") - F.lead("value").over(order)) < 0.01).alias("tie"),
    )


def what_if(options: DataFrame, intensity: float) -> DataFrame:
    """Effect of using a share (percent) of what is available: options has available_pp, coef, low, high (per 10
    percentage points), floor (null: none), ndvi_coef, ndvi_cap, km2."""
    pp = F.col("available_pp") * intensity / 100
    effect = lambda c: F.greatest(F.col(c) * pp / 10, F.coalesce(F.col("floor"), F.lit(float("-inf"))))
    ends = F.array_sort(F.array(effect("low"), effect("high")))
    return options.withColumns(
        {
            "pp": pp,
            "delta": effect("coef"),
            "delta_low": ends[0],
            "delta_high": ends[1],
            "delta_ndvi": F.least(F.col("ndvi_coef") * pp / 10, F.col("ndvi_cap")),
            "hectares": pp / 100 * F.col("km2") * 100,
        }
    )


def allocate(options: DataFrame, zone: str, effect: Column, cap: str, total: str) -> DataFrame:
    """Shares a zone's total among its options, strongest effect first, each up to its cap."""
    w = Window.partitionBy(zone).orderBy(effect, "option").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(cap).over(w), F.lit(0.0))
    return options.withColumn("allocated", F.greatest(F.lit(0.0), F.least(F.col(cap), F.col(total) - used)))


def quota_top(rows: DataFrame, year: str, quarter: str, order: Sequence[Column], most: int = 6, quota: int = 2) -> DataFrame:
    """At most `most` rows a year: first up to `quota` of each quarter in order, then the best of the rest."""
    inner = F.row_number().over(Window.partitionBy(year, quarter).orderBy(*order))
    ranked = rows.withColumn("_q", inner)
    outer = F.row_number().over(Window.partitionBy(year).orderBy((F.col("_q") > quota).cast("int"), *order))
    return ranked.withColumn("_k", outer).filter(F.col("_k") <= most).drop("_q", "_k")


def settle(items: DataFrame, value: str, tolerance: float) -> DataFrame:
    """Drops rows below the median of what is kept by more than tolerance until the kept set stays the same.

    The median of all rows is where it starts; a bound that only rises lets nothing come back, so it ends."""
    low = float("-inf")
    while True:
        kept = items.filter(F.col(value) >= low)
        middle = exact_percentile(kept, value, 0.5)
        if middle is None or middle - tolerance <= low or not kept.filter(F.col(value) < middle - tolerance).limit(1).count():
            return kept
        low = middle - tolerance


def mean_component(long: DataFrame, zone: str, parts: Sequence[str], name: str, digits: int = 4) -> DataFrame:
    """One component out of several: the mean of their normalised values takes the place of the parts."""
    inside = F.col("component").isin(*parts)
    made = long.filter(inside).groupBy(zone).agg(F.round(F.avg("norm"), digits).alias("norm"))
    return long.filter(~inside).select(zone, "component", "norm").unionByName(made.select(zone, F.lit(name).alias("component"), "norm"))


def limits(zones: DataFrame, zone: str, tree: str, built: str, water: str, road: str, heat: str, heat_floor: float, green: str, green_top: float) -> DataFrame:
    """What each zone leaves for interventions, in percent: the rest of the surface, roads (not above what is built; all of
    it where roads are unknown), roofs, and how far heat may sink and green may rise before observed bounds."""
    roads = F.when(F.col(road).isNotNull(), F.least(road, built))
    return zones.select(
        zone, (100 - F.col(tree) - F.col(built) - F.col(water)).alias("open_pp"), F.col(built).alias("built_pp"), F.coalesce(roads, F.col(built)).alias("road_pp"),
        F.when(roads.isNull(), F.col(built)).otherwise(F.greatest(F.col(built) - roads, F.lit(0.0))).alias("roof_pp"),
        F.least(F.lit(heat_floor) - F.col(heat), F.lit(0.0)).alias("heat_floor"), F.greatest(F.lit(green_top) - F.col(green), F.lit(0.0)).alias("green_top"),
    )


def catalogue(zones: DataFrame, zone: str, effects: DataFrame) -> DataFrame:
    """One row for each zone and intervention: effects (option, coef, low, high, predicted_low, predicted_high, base) with the
    interval to show (the predicted one if there is one, and its kind) and what the zone has available of its base.

    effects is a handful of rows that the caller states."""
    known = F.col("predicted_low").isNotNull()
    shown = effects.select(
        "option", "coef", "base", F.coalesce("predicted_low", "low").alias("low"), F.coalesce("predicted_high", "high").alias("high"),
        F.when(known, "prediction").otherwise("mean").alias("interval"),
    )
    bases = [c.removesuffix("_pp") for c in zones.columns if c.endswith("_pp")]
    long = zones.select(zone, F.inline(F.array(*[F.struct(F.lit(b).alias("base"), F.col(f"{b}_pp").cast("double").alias("available")) for b in bases])))
    return long.join(shown, "base").select(zone, "option", "coef", "low", "high", "interval", "available")


def sensitivity(cells: DataFrame, keys: Sequence[str], grid: Mapping[str, Column], area: Column) -> DataFrame:
    """keys, setting, pct: percent of the area in which each setting's condition holds; all settings in one aggregate."""
    whole = F.sum(area)
    wide = cells.groupBy(*keys).agg(*[(100 * F.try_divide(F.sum(F.when(c, area).otherwise(0.0)), whole)).alias(f"_{k}") for k, c in enumerate(grid.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("setting"), F.col(f"_{k}").alias("pct")) for k, name in enumerate(grid)])
    return wide.select(*keys, F.inline(rows))


def stability(scores: DataFrame, zone: str, scenario: str, value: str, base: str) -> DataFrame:
    """zone, base position, least and largest position over scenarios, and how many scenarios move it."""
    placed = ranking(scores.filter(F.col(value).isNotNull()), zone, value, [scenario])
    own = F.max(F.when(F.col(scenario) == base, F.col("position")))
    first = F.max(F.when(F.col(scenario) == base, F.col("position"))).over(Window.partitionBy(zone))
    moved = placed.withColumn("_m", (F.col("position") != first).cast("int"))
    return moved.groupBy(zone).agg(own.alias("base"), F.min("position").alias("best"), F.max("position").alias("worst"), F.sum("_m").alias("moved"))


def refilled(scenes: DataFrame, key: str, year: str, quarter: str, order: Sequence[Column], bad: Column, most: int = 6, quota: int = 2) -> DataFrame:
    """quota_top with rejects: chosen rows that turn out bad are struck out and the choice is made again, until none is."""
    pool = scenes.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    struck = pool.filter(F.lit(False)).select(key)
    while True:
        chosen = quota_top(pool.join(struck, key, "left_anti"), year, quarter, order, most, quota).checkpoint()
        new = chosen.filter("_bad").select(key)
        if not new.limit(1).count():
            return chosen.drop("_bad")
        struck = struck.unionByName(new).checkpoint()


def sorted_with_total(rows: DataFrame, column: str, total: Column, descending: bool = False) -> DataFrame:
    """Rows by a column, numbers that are missing lowest; total rows stay last whatever the direction."""
    at = F.col(column)
    return rows.orderBy(F.coalesce(total, F.lit(False)), at.desc_nulls_last() if descending else at.asc_nulls_first())
