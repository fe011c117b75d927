"""Aggregates over zones, classes and blocks: plain, weighted and conditional."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.operators.quantiles import joined, percentiles
from cellgrid.operators.stats import correlation


def finite(value: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: over rows with a value and a positive weight; null if there are none."""
    good = value.isNotNull() & (weight > 0)
    return F.try_divide(F.sum(F.when(good, value * weight)), F.sum(F.when(good, weight)))


def share(condition: Column) -> Column:
    """Aggregate: percent of rows for which condition is true; unknown counts as false."""
    return 100 * F.avg(F.when(condition, 1.0).otherwise(0.0))


def weighted_share(condition: Column, weight: Column) -> Column:
    return 100 * F.try_divide(F.sum(F.when(condition, weight).otherwise(0.0)), F.sum(weight))


def zonal(cells: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column], total: bool = False, points: Mapping[str, tuple[str, float]] | None = None) -> DataFrame:
    """One row for each zone, and one of null keys for all of them together if total. points, of zones only: names of exact
    percentiles, each with its value column and fraction."""
    aggs = [c.alias(n) for n, c in metrics.items()]
    if not total:
        out = cells.groupBy(*keys).agg(*aggs)
        for value in dict.fromkeys(v for v, _ in (points or {}).values()):
            out = joined(out, percentiles(cells, keys, value, {n: q for n, (v, q) in points.items() if v == value}), keys, "left")
        return out
    return cells.groupingSets([[F.col(k) for k in keys], []], *keys).agg(*aggs)


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Lower weighted median: the least value at which the running weight reaches half of the group's.

    Equal values are summed first, so that the windowed rows are distinct values."""
    good = df.filter(F.col(value).isNotNull() & ~F.isnan(value) & (F.col(weight) > 0))
    steps = good.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    run = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = steps.withColumn("_c", F.sum("_w").over(run)).withColumn("_t", F.sum("_w").over(Window.partitionBy(*keys)))
    return cum.filter(F.col("_c") >= F.col("_t") / 2).groupBy(*keys).agg(F.min(value).alias("weighted_median"))


def profile(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """min, mean, max, count and interpolated percentiles pNN."""
    out = df.groupBy(*keys).agg(F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max"), F.count(value).alias("n"))
    return joined(out, percentiles(df, keys, value, {f"p{round(100 * q)}": q for q in shares}), keys, "left")


#: Rows that one task may sort for an exact percentile.
BRACKET = 1_000_000


def exact_percentile(df: DataFrame, value: str, q: float) -> float | None:
    """The interpolated percentile of a whole column, exact at any size: approximate quantiles narrow the range that holds
    it until few enough rows are left to sort; only numbers reach the driver. None without values."""
    rows = df.select(F.col(value).cast("double").alias("v")).filter("v is not null")
    n, low, high = rows.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    place = q * (n - 1)
    k, part = int(place), place - int(place)
    last = min(k + 1, n - 1)
    below, held = 0, n
    while held > BRACKET and low < high:
        inside = rows.filter((F.col("v") >= low) & (F.col("v") <= high))
        at = (k - below) / held
        a, b = inside.approxQuantile("v", [max(0.0, at - 0.002), min(1.0, at + 0.002 + 2 / held)], 0.001)
        less, upto = inside.agg(F.count(F.when(F.col("v") < a, 1)), F.count(F.when(F.col("v") <= b, 1))).first()
        a, less = (a, less) if below + less <= k else (low, 0)
        b, upto = (b, upto) if below + upto > last else (high, held)
        if (a, b) == (low, high):
            break
        low, high, below, held = a, b, below + less, upto - less
    if low == high:
        return low
    counts = rows.filter((F.col("v") >= low) & (F.col("v") <= high)).groupBy("v").agg(F.count("*").alias("c"))
    # Distinct values of the bracket: sorted in one task, or, where values repeat, far fewer.
    upto = counts.withColumn("upto", F.sum("c").over(Window.orderBy("v")) + F.lit(below))
    first = upto.agg(F.min(F.when(F.col("upto") > k, F.col("v"))), F.min(F.when(F.col("upto") > last, F.col("v")))).first()
    return first[0] + (first[1] - first[0]) * part


def with_threshold(df: DataFrame, value: str, quantile: float, name: str = "threshold") -> DataFrame:
    """Adds one percentile of the whole table as a column."""
    return df.withColumn(name, F.lit(exact_percentile(df, value, quantile)).cast("double"))


def tukey_flags(df: DataFrame, keys: Sequence[str], value: str, least: int = 10, factor: float = 1.5) -> DataFrame:
    """Adds outlier: above the upper fence of its group, if the group has enough rows."""
    sizes = df.groupBy(*keys).agg(F.count(value).alias("_n"))
    fences = joined(sizes, percentiles(df, keys, value, {"_a": 0.25, "_b": 0.75}), keys, "left")
    high = F.col("_b") + factor * (F.col("_b") - F.col("_a"))
    return df.join(fences, list(keys)).withColumn("outlier", (F.col("_n") >= least) & (F.col(value) > high)).drop("_a", "_b", "_n")


def class_shares(df: DataFrame, keys: Sequence[str], kind: str, area: Column | None = None) -> DataFrame:
    """Percent of each group's area (or rows) by class."""
    parts = df.groupBy(*keys, kind).agg(F.sum(area if area is not None else F.lit(1.0)).alias("_a"))
    return parts.select(*keys, kind, (100 * F.col("_a") / F.sum("_a").over(Window.partitionBy(*keys))).alias("pct"))


def pivot_counts(df: DataFrame, keys: Sequence[str], kind: str, values: Sequence[str]) -> DataFrame:
    """A count column for each of the given categories, 0 where there are none, and their total."""
    counts = [F.count(F.when(F.col(kind) == v, 1)).alias(v) for v in values]
    return df.groupBy(*keys).agg(*counts, F.count("*").alias("total"))


def blocks(cells: DataFrame, size: int, value: str, row: str = "row", col: str = "col") -> DataFrame:
    """Mean, sum and count over size x size blocks of cells."""
    at = [F.floor(F.col(row) / size).alias("block_row"), F.floor(F.col(col) / size).alias("block_col")]
    return cells.groupBy(*at).agg(F.avg(value).alias("mean"), F.sum(value).alias("sum"), F.count(value).alias("n"))


def modal(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each group, the least of equally frequent ones, and its count."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("_o", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), value)))
    return ranked.filter("_o = 1").select(*keys, F.col(value).alias("mode"), "n")


def contingency(df: DataFrame, keys: Sequence[str], observed: Column, modelled: Column) -> DataFrame:
    """hits, misses, false_alarms; detection, false-alarm ratio and frequency bias, null where undefined."""
    count = lambda c: F.count(F.when(c, 1))
    out = df.groupBy(*keys).agg(count(observed & modelled).alias("hits"), count(observed & ~modelled).alias("misses"), count(~observed & modelled).alias("false_alarms"))
    return out.select(
        "*",
        F.try_divide("hits", F.col("hits") + F.col("misses")).alias("pod"),
        F.try_divide("false_alarms", F.col("hits") + F.col("false_alarms")).alias("far"),
        F.try_divide(F.col("hits") + F.col("false_alarms"), F.col("hits") + F.col("misses")).alias("bias"),
    )


def dissimilarity(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Half the summed differences of two distributions over the rows of each group."""
    totals = df.groupBy(*keys).agg(F.sum(a).alias("_a"), F.sum(b).alias("_b"))
    gap = F.abs(F.try_divide(F.col(a), F.col("_a")) - F.try_divide(F.col(b), F.col("_b")))
    joined = df.join(totals, list(keys)) if keys else df.crossJoin(F.broadcast(totals))  # one row
    return joined.groupBy(*keys).agg((F.sum(gap) / 2).alias("dissimilarity"))


def residual_bins(df: DataFrame, residual: str, x: str, cuts: Sequence[float], least: int = 5) -> DataFrame:
    """Mean residual in half-open bins, the last one closed; bins of fewer rows are left out."""
    bucket = F.lit(None).cast("int")
    for k in range(len(cuts) - 1):
        upper = F.col(x) <= cuts[k + 1] if k == len(cuts) - 2 else F.col(x) < cuts[k + 1]
        bucket = F.coalesce(bucket, F.when((F.col(x) >= cuts[k]) & upper, k))
    out = df.withColumn("bin", bucket).filter("bin is not null").groupBy("bin").agg(F.avg(residual).alias("mean_residual"), F.count("*").alias("n"))
    return out.filter(F.col("n") >= least)


def rank_metrics(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """A position for each metric, largest first, equal values sharing one; and the best and worst of them."""
    ranks = {f"rank_{m}": F.rank().over(Window.orderBy(F.desc(m))) for m in metrics}
    out = df.withColumns(ranks)
    return out.withColumns({"best": F.least(*ranks), "worst": F.greatest(*ranks)})


def cold_share(value: Column, reference: Column, by: float = 10.0) -> Column:
    """Aggregate: share of values more than so much below a reference; 0 where there are none."""
    return F.coalesce(F.avg(F.when(value.isNotNull(), (value < reference - by).cast("double"))), F.lit(0.0))


def offset_state(df: DataFrame, keys: Sequence[str], vegetated: Column, number: Column, limit: float = 1000, least: int = 1000) -> DataFrame:
    """keys, n, share, shifted: whether a scene's numbers hold an offset already, told by how many of its vegetated pixels
    lie below a limit: most do (true), hardly any (false), or it cannot be told or there are too few pixels (null)."""
    seen = F.when(vegetated, (number < limit).cast("double"))
    out = df.groupBy(*keys).agg(F.count(seen).alias("n"), F.avg(seen).alias("share"))
    state = F.when(F.col("n") < least, F.lit(None)).when(F.col("share") > 0.5, True).when(F.col("share") < 0.02, False)
    return out.withColumn("shifted", state)


def all_of(terms: Sequence[tuple[str, float, Callable[[Column], Column]]]) -> Column:
    """Conjunction of conditions on layers, each with what its missing values count as."""
    out = F.lit(True)
    for name, missing, holds in terms:
        out = out & holds(F.coalesce(F.col(name), F.lit(missing)))
    return out


def histogram(df: DataFrame, key: Column, weight: Column | None = None) -> DataFrame:
    """bin, n, weight: rows and summed weights of each integer key."""
    return df.groupBy(key.cast("long").alias("bin")).agg(F.count("*").alias("n"), F.sum(weight if weight is not None else F.lit(1.0)).alias("weight"))


def masked(df: DataFrame, keys: Sequence[str], value: str, inside: Column) -> DataFrame:
    """mean_in, median_in, mean_out and gap (null where either side has no value) of finite values under and off a mask."""
    v = finite(F.col(value).cast("double"))
    a, b = F.when(inside, v), F.when(~inside, v)
    out = df.groupBy(*keys).agg(F.avg(a).alias("mean_in"), F.median(a).alias("median_in"), F.avg(b).alias("mean_out"))
    return out.withColumn("gap", F.col("mean_in") - F.col("mean_out"))


def cross_shares(df: DataFrame, a: str, b: str, area: Column) -> DataFrame:
    """Each pair of two classes with its area's percent of the first class and of the second."""
    parts = df.groupBy(a, b).agg(F.sum(area).alias("area"))
    share = lambda k: 100 * F.try_divide("area", F.sum("area").over(Window.partitionBy(k)))
    return parts.select(a, b, "area", share(a).alias("pct_of_first"), share(b).alias("pct_of_second"))


def profiles(cells: DataFrame, key: str, zone: str, area: Column, distance: str, kind: str, reach: float) -> DataFrame:
    """One row for each polygon: cells, area, least distance, most frequent zone (least on ties), percent of the given class
    of its cells, and type 1 within reach of the axis, else 2."""
    out = cells.groupBy(key).agg(F.count("*").alias("cells"), F.sum(area).alias("area"), F.min(distance).alias("nearest"), share(F.col(kind).cast("boolean")).alias("pct"))
    return out.join(modal(cells, [key], zone).select(key, F.col("mode").alias("zone")), key).withColumn("type", F.when(F.col("nearest") <= reach, 1).otherwise(2))


def bands(df: DataFrame, value: str, cuts: Sequence[float], passes: Column) -> DataFrame:
    """band (number of the half-open range from each cut on), n, passed."""
    at = sum(((F.col(value) >= c).cast("int") for c in cuts), F.lit(-1))
    return df.withColumn("band", at).filter("band >= 0").groupBy("band").agg(F.count("*").alias("n"), F.count(F.when(passes, 1)).alias("passed"))


def composite_keys(df: DataFrame, day: str, platform: str, uri: str, part: int, sep: str = "_") -> Column:
    """date_platform_part: the day, the last two letters of the platform, and one part of a name."""
    piece = F.coalesce(F.get(F.split(F.col(uri), sep), F.lit(part)), F.lit(""))
    return F.concat_ws("_", F.date_format(day, "yyyyMMdd"), F.right(F.col(platform), F.lit(2)), piece)


def coherent(parts: DataFrame, total: DataFrame, keys: Sequence[str], value: str, tolerance: float = 1.0) -> DataFrame:
    """keys, summed, stated, ok: whether parts add up to what a table of totals says."""
    sums = parts.groupBy(*keys).agg(F.sum(value).alias("summed"))
    both = sums.join(total.select(*keys, F.col(value).alias("stated")), list(keys), "full")
    return both.withColumn("ok", F.coalesce(F.abs(F.col("summed") - F.col("stated")) <= tolerance, F.lit(False)))


def mask_sets(cells: DataFrame, period: str, key: str, periods: Sequence[str], hazard: Column) -> DataFrame:
    """key, any, all, count and only: whether a cell is set in some, in every and in how many of the periods, and the period
    in which alone it is, where it lies in no hazard."""
    own = F.collect_set(F.when(F.col(period).isin(*periods), F.col(period)))
    out = cells.groupBy(key).agg(own.alias("_s"), F.bool_or(hazard).alias("_h"))
    n = F.size("_s")
    return out.select(key, (n > 0).alias("any"), (n == len(periods)).alias("all"), n.alias("count"), F.when((n == 1) & ~F.col("_h"), F.get("_s", F.lit(0))).alias("only"))


def distance_groups(cells: DataFrame, keys: Sequence[str], value: str, distance: str, near: float, far: float) -> DataFrame:
    """near, far and gap: means of a value close to a feature and away from it."""
    out = cells.groupBy(*keys).agg(F.avg(F.when(F.col(distance) <= near, F.col(value))).alias("near"), F.avg(F.when(F.col(distance) > far, F.col(value))).alias("far"))
    return out.withColumn("gap", F.col("near") - F.col("far"))


def against(first: DataFrame, second: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, a, b, difference, ratio: two sources of one figure, rows of either side kept."""
    both = first.select(*keys, F.col(value).alias("a")).join(second.select(*keys, F.col(value).alias("b")), list(keys), "full")
    return both.withColumns({"difference": F.col("a") - F.col("b"), "ratio": F.try_divide("a", "b")})


def upright(cells: DataFrame, value: str, reference: str, rows: int) -> DataFrame:
    """r, r_flipped, upright: correlation with a reference as it lies and with rows turned upside down; the first must win."""
    turned = cells.select((F.lit(rows - 1) - F.col("row")).cast("int").alias("row"), "col", F.col(value).alias("_f"))
    out = cells.join(turned, ["row", "col"], "left").agg(correlation(value, reference).alias("r"), correlation("_f", reference).alias("r_flipped"))
    return out.withColumn("upright", F.col("r") > F.coalesce("r_flipped", F.lit(-2.0)))


def control_points(cells: DataFrame, points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """name, row, col and the cells' values at known places (name, row, col; a small table)."""
    return points.join(cells.select("row", "col", *columns), ["row", "col"], "left").select("name", "row", "col", *columns)
