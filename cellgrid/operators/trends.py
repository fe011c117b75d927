"""Trend inference of annual or monthly series: lines with corrected intervals, Theil-Sen limits, exact Kendall tests."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from cellgrid.functions.distributions import kendall_exact, normal_two_sided, t_quantile, t_two_sided
from cellgrid.operators.quantiles import joined
from cellgrid.operators.selection import kendall, slopes
from cellgrid.operators.stats import correlation, gram, mann_kendall, ols_line, welch

Z95 = 1.959963984540054


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of a Student score; null without degrees of freedom."""
    return pd.Series([t_two_sided(a, b) if a == a and b == b and b > 0 else None for a, b in zip(t, df, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def t_975(df: pd.Series) -> pd.Series:
    return pd.Series([t_quantile(0.975, b) if b == b and b > 0 else None for b in df], dtype=float)


@F.pandas_udf(DoubleType())
def kendall_p(n: pd.Series, s: pd.Series, z: pd.Series, ties: pd.Series) -> pd.Series:
    """Two-sided p of Kendall's test: exact for short series without ties, else from the normal score."""
    return pd.Series([kendall_exact(int(k), int(v)) if not t and k <= 33 else normal_two_sided(x) for k, v, x, t in zip(n, s, z, ties, strict=True)])


def line_errors(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """n, slope, intercept, r2, se of the slope, and ar1: the correlation of residuals with the ones before them."""
    good = df.filter(F.col(y).isNotNull())
    line = ols_line(good, keys, x, y)
    error = F.col(y) - (F.col("intercept") + F.col("slope") * F.col(x))
    left = good.join(line, list(keys)).withColumn("_e", error)
    left = left.withColumn("_p", F.lag("_e").over(Window.partitionBy(*keys).orderBy(x)))
    spread = left.groupBy(*keys).agg(
        correlation(F.when(F.col("_p").isNotNull(), F.col("_e")), "_p").alias("ar1"), F.sum(F.col("_e") * F.col("_e")).alias("_ss"),
        F.regr_sxx(y, x).alias("_sxx"), F.min(x).alias("first"), F.max(x).alias("last"),
    )
    se = F.sqrt(F.try_divide(F.col("_ss") / (F.col("n") - 2), F.col("_sxx")))
    return line.join(spread, list(keys)).withColumn("se", se).drop("_ss", "_sxx")


def sen(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """sen, sen_low, sen_high: median of all pairs' slopes and its 95 % limits, by ranks from Kendall's variance."""
    size = kendall(df, keys, x, y).filter("pairs > 0").select(*keys, "pairs")
    size = joined(size, mann_kendall(df, keys, x, y).select(*keys, "variance"), keys).checkpoint()
    n, reach = F.col("pairs"), Z95 * F.sqrt("variance")
    places = {
        "_m1": F.floor((n - 1) / 2), "_m2": F.ceil((n - 1) / 2),
        "_l": F.greatest(F.round((n - reach) / 2).cast("long") - 1, F.lit(0)), "_h": F.least(F.round((n + reach) / 2).cast("long"), n - 1),
    }
    size = size.withColumns(places)
    found = slopes(df, keys, x, y, size.select(*keys, F.explode(F.array(*places)).alias("rank"))).checkpoint()
    at = lambda c: F.max(F.when(F.col("rank") == F.col(c), F.col("slope")))
    wide = joined(size, found, keys).groupBy(*keys).agg((at("_m1") * 0.5 + at("_m2") * 0.5).alias("sen"), at("_l").alias("sen_low"), at("_h").alias("sen_high"))
    return wide.select(*keys, "sen", "sen_low", "sen_high")


def tied(df: DataFrame, keys: Sequence[str], y: str) -> DataFrame:
    """ties: how many values stand more than once in a series."""
    counts = df.filter(F.col(y).isNotNull()).groupBy(*keys, y).agg(F.count("*").alias("_t"))
    return counts.groupBy(*keys).agg(F.count(F.when(F.col("_t") > 1, 1)).alias("ties"))


def record(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 10, scale: float = 10.0) -> DataFrame:
    """The full trend record of each series of at least so many values; slopes and limits are per scale steps of x.

    The line comes with Student limits, plain and with the sample size cut down for residuals that follow each other;
    Theil-Sen with its limits; Mann-Kendall. significant needs both tests, significant_ar1 the corrected one."""
    line = line_errors(df, keys, x, y).filter(F.col("n") >= least)
    kendall = mann_kendall(df, keys, x, y).select(*keys, "s", "z", "tau")
    out = line.join(sen(df, keys, x, y), list(keys)).join(kendall, list(keys))
    n, r, b, se = F.col("n"), F.col("ar1"), F.col("slope"), F.col("se")
    out = out.withColumn("n_eff", F.when(r > 0, n * (1 - r) / (1 + r)).otherwise(n.cast("double")))
    free = F.when(F.col("n_eff") > 3, F.col("n_eff") - 2)
    wide = se * F.sqrt((n - 2) / free)
    out = out.withColumns({"_t": t_975((n - 2).cast("double")), "_ta": t_975(free), "_wide": wide})
    out = out.withColumns({
        "p_line": t_p(F.abs(F.try_divide(b, se)), (n - 2).cast("double")), "p_ar1": t_p(F.abs(F.try_divide(b, F.col("_wide"))), free), "p_kendall": kendall_normal_p("z"),
        "slope_low": (b - F.col("_t") * se) * scale, "slope_high": (b + F.col("_t") * se) * scale,
        "ar1_low": (b - F.col("_ta") * F.col("_wide")) * scale, "ar1_high": (b + F.col("_ta") * F.col("_wide")) * scale,
        "sen": F.col("sen") * scale, "sen_low": F.col("sen_low") * scale, "sen_high": F.col("sen_high") * scale, "slope": b * scale,
    })
    p = F.col("p_kendall") < 0.05
    out = out.withColumns({"significant": (F.col("p_line") < 0.05) & p, "significant_ar1": F.coalesce(F.col("p_ar1") < 0.05, F.lit(False)) & p})
    return out.drop("_t", "_ta", "_wide", "intercept")


@F.pandas_udf(DoubleType())
def kendall_normal_p(z: pd.Series) -> pd.Series:
    return z.map(normal_two_sided, na_action="ignore")


def short(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 6, scale: float = 10.0) -> DataFrame:
    """n, sen, sen_low, sen_high (per scale steps), tau, p_kendall, significant: p below 0.05 and limits on one side of 0."""
    kendall = mann_kendall(df, keys, x, y).filter(F.col("n") >= least).join(tied(df, keys, y), list(keys))
    out = kendall.join(sen(df, keys, x, y), list(keys))
    out = out.withColumns({c: F.col(c) * scale for c in ("sen", "sen_low", "sen_high")})
    out = out.withColumn("p_kendall", kendall_p("n", "s", "z", "ties"))
    return out.select(*keys, "n", "sen", "sen_low", "sen_high", "tau", "p_kendall", one_sided(F.col("p_kendall"), F.col("sen_low"), F.col("sen_high")).alias("significant"))


def one_sided(p: Column, low: Column, high: Column, level: float = 0.05) -> Column:
    return (p < level) & ((low > 0) | (high < 0))


def harmonised(value: Column, year: Column, reliable: Column, change: int, offset: Column) -> Column:
    """Values of reliable years; those before the year of change get the offset, and are null where it is unknown."""
    return F.when(reliable, F.when(year < change, value + offset).otherwise(value))


def robust(trends: DataFrame, keys: Sequence[str], slope: str, significant: str, none_is_robust: bool = True) -> DataFrame:
    """Over the variants of one series: least and largest slope, how many are significant, and whether the reading is
    robust: all significant with one sign (or, if so wanted, none significant)."""
    own = F.when(F.col(significant), F.signum(slope))
    out = trends.filter(F.col(slope).isNotNull()).groupBy(*keys).agg(
        F.min(slope).alias("lowest"), F.max(slope).alias("highest"), F.count("*").alias("variants"),
        F.count(F.when(F.col(significant), 1)).alias("hits"), F.count_distinct(own).alias("_signs"),
    )
    same = (F.col("hits") == F.col("variants")) & (F.col("_signs") == 1)
    return out.withColumn("robust", (same | (F.col("hits") == 0)) if none_is_robust else same).drop("_signs")


def step_and_slope(df: DataFrame, keys: Sequence[str], x: str, y: str, after: Column, scale: float = 10.0) -> DataFrame:
    """n, slope (per scale steps), step, and their classic standard errors: y on x and a dummy that is 1 after a change.

    The sums of products are one aggregate; a series' 3 x 3 system is solved by Cramer's rule in columns."""
    g = gram(df.withColumn("_after", after.cast("double")), y, [x, "_after"], keys)
    a = [[F.col(f"g{min(i, j)}_{max(i, j)}") for j in range(4)] for i in range(4)]

    def det(m) -> Column:
        return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])

    base = [row[:3] for row in a[:3]]
    whole = det(base)
    coef = [F.try_divide(det([[a[i][3] if j == k else base[i][j] for j in range(3)] for i in range(3)]), whole) for k in range(3)]
    minor = lambda k: base[0][0] * base[3 - k][3 - k] - base[0][3 - k] * base[0][3 - k]
    out = g.select(*keys, a[0][0].cast("long").alias("n"), coef[0].alias("_b0"), coef[1].alias("_b1"), coef[2].alias("_b2"),
                   *[F.try_divide(minor(k), whole).alias(f"_v{k}") for k in (1, 2)], *[a[k][3].alias(f"_s{k}") for k in range(4)])
    rest = F.greatest(F.lit(0.0), F.col("_s3") - F.col("_b0") * F.col("_s0") - F.col("_b1") * F.col("_s1") - F.col("_b2") * F.col("_s2"))
    sigma = rest / (F.col("n") - 3)
    return out.filter("n > 3").select(
        *keys, "n", (F.col("_b1") * scale).alias("slope"), (F.sqrt(sigma * F.col("_v1")) * scale).alias("slope_se"),
        F.col("_b2").alias("step"), F.sqrt(sigma * F.col("_v2")).alias("step_se"),
    )


def before_after(df: DataFrame, keys: Sequence[str], after: Column, value: str, least: int = 3) -> DataFrame:
    """change of the mean, its 95 % limits and Welch's p, for groups with so many values on both sides; n0, n1: how many."""
    sides = df.withColumn("_a", after)
    v = lambda c: F.count(F.when(c, F.col(value)))
    counts = sides.groupBy(*keys).agg(v(~F.col("_a")).alias("n0"), v(F.col("_a")).alias("n1")).filter((F.col("n0") >= least) & (F.col("n1") >= least))
    out = counts.join(welch(df, keys, after, value), list(keys)).withColumn("change", F.col("after") - F.col("before"))
    out = out.withColumns({"p": t_p(F.abs("t"), F.col("df")), "_reach": t_975("df") * F.abs(F.try_divide("change", "t"))})
    return out.select(*keys, "n0", "n1", "change", (F.col("change") - F.col("_reach")).alias("low"), (F.col("change") + F.col("_reach")).alias("high"), "p")


def scene_bootstrap(stack: DataFrame, sensor: str, scene: str, cell: str, zone: str, value: str, replicas: int = 200, seed: int = 1) -> DataFrame:
    """zone, difference, low, high: difference of zone medians of the two sensors' cell medians (larger name less the
    smaller), with percentile limits from resampling each sensor's scenes.

    A scene's weight in a replica is a Poisson count drawn by hash, so that no list of scenes is gathered; a cell's
    weighted medians are taken over its own observations, equal ones of a scene counted first, sorted once for all
    replicas: no observation is copied for a replica. Replica 0 is the data itself."""
    steps, total, term = [], 0.0, 0.36787944117144233
    for j in range(8):
        total += term
        steps.append(total)
        term /= j + 1

    def weight(replica: Column) -> Column:
        u = (F.pmod(F.xxhash64(replica, F.col(sensor), F.col(scene), F.lit(seed)), F.lit(1 << 30)) + 0.5) / (1 << 30)
        return F.when(replica == 0, 1).otherwise(sum((F.when(u > s, 1).otherwise(0) for s in steps), F.lit(0)))

    keys = [sensor, zone, cell]
    valid = stack.filter(F.col(value).isNotNull() & F.col(sensor).isNotNull() & F.col(scene).isNotNull())
    counted = valid.groupBy(*keys, scene, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    drawn = valid.select(*keys, scene).distinct()
    drawn = drawn.select(*[F.col(k).alias(k) for k in keys], F.col(scene).alias("_scene"), F.transform(F.sequence(F.lit(0), F.lit(replicas)), weight).alias("_w"))
    kept = [stack.schema[k] for k in keys]
    schema = StructType([StructField("replica", IntegerType()), *kept, StructField("_m", DoubleType())])

    def medians(key: tuple, seen: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        seen = seen.sort_values("_v")
        v, count = seen["_v"].to_numpy(), seen["_c"].to_numpy()
        at = pd.Index(marks["_scene"]).get_indexer(seen[scene])
        found = []
        for replica, w in enumerate(np.stack(marks["_w"].to_numpy()).T):
            upto = np.cumsum(w[at] * count)
            if upto[-1] > 0:
                low, high = v[np.searchsorted(upto, [(upto[-1] - 1) // 2, upto[-1] // 2], side="right")]
                found.append((replica, *key, low if low == high else 0.5 * low + 0.5 * high))
        return pd.DataFrame(found, columns=schema.names)

    cells = counted.groupBy(*keys).cogroup(drawn.groupBy(*keys)).applyInPandas(medians, schema)
    zones = cells.groupBy("replica", sensor, zone).agg(F.median("_m").alias("_z"))
    gaps = zones.groupBy("replica", zone).agg((F.max_by("_z", sensor) - F.min_by("_z", sensor)).alias("_d"), F.count("*").alias("_n")).filter("_n = 2")
    own = F.when(F.col("replica") > 0, F.col("_d"))
    return gaps.groupBy(zone).agg(
        F.max(F.when(F.col("replica") == 0, F.col("_d"))).alias("difference"),
        F.percentile(own, F.lit(0.025)).alias("low"), F.percentile(own, F.lit(0.975)).alias("high"),
    )
