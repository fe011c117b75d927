"""Inference: trends, regressions from Gram matrices, rank tests, bootstraps over blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cellgrid.functions.distributions import normal_two_sided, t_quantile, t_two_sided
from cellgrid.operators.quantiles import joined
from cellgrid.operators.selection import kendall, slopes



def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson's r over rows with both values: NaN where one side does not vary, where Spark's own corr stops at a division
    by zero; null for fewer than two rows."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    flat = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(F.count(x) > 1, F.when(flat, F.lit(float("nan"))).otherwise(r))


def ols_line(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """n, slope, intercept, r2."""
    return df.groupBy(*keys).agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def theil_sen(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """slope, pairs: median of the slopes of all pairs of points of different x, and how many there are; exact at any length."""
    size = kendall(df, keys, x, y).filter("pairs > 0").select(*keys, "pairs").checkpoint()
    last = F.col("pairs") - 1
    found = slopes(df, keys, x, y, size.select(*keys, F.explode(F.array(F.floor(last / 2), F.ceil(last / 2))).alias("rank")))
    middle = found.groupBy(*keys).agg((F.min("slope") * 0.5 + F.max("slope") * 0.5).alias("slope"))
    return joined(size, middle, keys).select(*keys, "slope", "pairs")


def mann_kendall(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """n, s, variance, z (continuity-corrected, ties counted) and tau of each series of two different x or more."""
    n = F.col("n").cast("double")
    var = (n * (n - 1) * (2 * n + 5) - F.col("ties")) / 18.0
    out = kendall(df, keys, x, y).filter("pairs > 0").withColumn("variance", var)
    z = F.when(F.col("s") == 0, 0.0).otherwise(F.try_divide(F.col("s") - F.signum("s"), F.sqrt("variance")))
    return out.select(*keys, "n", "s", "variance", z.alias("z"), (F.col("s") / (n * (n - 1) / 2)).alias("tau"))


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p of a normal score."""
    return z.map(normal_two_sided, na_action="ignore")


def trends(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 10) -> DataFrame:
    """Line, Theil-Sen slope and Mann-Kendall p of series of at least so many points; significant if both p are small."""
    line, sen, kendall = ols_line(df.filter(F.col(y).isNotNull()), keys, x, y), theil_sen(df, keys, x, y), mann_kendall(df, keys, x, y)
    out = line.filter(F.col("n") >= least).join(sen.select(*keys, F.col("slope").alias("sen")), list(keys)).join(kendall.select(*keys, "z", "tau"), list(keys))

    @F.pandas_udf(DoubleType())
    def slope_p(n: pd.Series, r2: pd.Series) -> pd.Series:
        return pd.Series([t_two_sided(((k - 2) * r / (1 - r)) ** 0.5, k - 2) if r < 1 else 0.0 for k, r in zip(n, r2, strict=True)])

    out = out.withColumns({"p_line": slope_p("n", "r2"), "p_kendall": normal_p("z")})
    return out.withColumn("significant", (F.col("p_line") < 0.05) & (F.col("p_kendall") < 0.05))


def gram(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Sums of products of intercept, regressors and y: all that a least-squares fit needs, in one aggregate."""
    cols = [F.lit(1.0), *(F.col(x).cast("double") for x in xs), F.col(y).cast("double")]
    good = df.dropna(subset=[y, *xs])
    sums = [F.sum(a * b).alias(f"g{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    return good.groupBy(*keys).agg(*sums)


def _matrix(row, k: int) -> np.ndarray:
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[f"g{i}_{j}"] or 0.0
    return g


def least_squares(df: DataFrame, y: str, xs: Sequence[str], robust: bool = True) -> DataFrame:
    """term, coef, se, low, high, vif: coefficients with Student intervals; robust: HC1 standard errors.

    Two aggregates over the rows; only matrices of the size of the model reach the driver."""
    k = len(xs) + 1
    good = df.dropna(subset=[y, *xs])
    g = _matrix(gram(good, y, xs).first(), k + 1)
    inverse, n = np.linalg.pinv(g[:k, :k]), g[0, 0]
    coef = inverse @ g[:k, k]
    cols = [F.lit(1.0), *(F.col(x).cast("double") for x in xs)]
    error = F.col(y) - sum((c * float(b) for c, b in zip(cols, coef, strict=True)), F.lit(0.0))
    meat = good.agg(*[F.sum(a * b * error * error).alias(f"g{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]).first()
    m = _matrix(meat, k)
    cov = inverse @ m @ inverse * n / (n - k) if robust else inverse * m[0, 0] / (n - k)
    se, t = np.sqrt(np.diag(cov)), t_quantile(0.975, n - k)
    names = ["intercept", *xs]
    rows = []
    for i, name in enumerate(names):
        others = [j for j in range(k) if j != i]
        total = g[i, i] - g[0, i] ** 2 / n
        fit = g[i, i] - g[i, others] @ np.linalg.pinv(g[np.ix_(others, others)]) @ g[others, i]
        rows.append((name, float(coef[i]), float(se[i]), float(coef[i] - t * se[i]), float(coef[i] + t * se[i]), float(total / fit) if i and fit > 0 else None))
    return df.sparkSession.createDataFrame(rows, "term string, coef double, se double, low double, high double, vif double")


def block_bootstrap(df: DataFrame, y: str, xs: Sequence[str], block: Column, replicas: int = 1000, seed: int = 1) -> DataFrame:
    """term, coef, low, high: percentile intervals from resampling blocks of rows with replacement.

    Each block's Gram matrix is summed once; a replica weighs blocks by Poisson counts, drawn by hash of replica and block,
    so that no block list is gathered anywhere. Replicas' matrices are summed by Spark and solved one by one."""
    k = len(xs) + 1
    blocks = gram(df.withColumn("_b", block), y, xs, ["_b"])
    names = [f"g{i}_{j}" for i in range(k + 1) for j in range(i, k + 1)]
    u = (F.pmod(F.xxhash64(F.col("replica"), F.col("_b"), F.lit(seed)), F.lit(1 << 30)) + 0.5) / (1 << 30)
    steps = np.cumsum([np.exp(-1.0) / np.prod(range(1, j + 1)) for j in range(8)])
    weight = sum((F.when(u > float(s), 1.0).otherwise(0.0) for s in steps), F.lit(0.0))
    spread = blocks.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(replicas)))).withColumn("_w", F.when(F.col("replica") == 0, 1.0).otherwise(weight))
    sums = spread.groupBy("replica").agg(*[F.sum(F.col(n) * F.col("_w")).alias(n) for n in names])

    def solve(batches):
        for pdf in batches:
            rows = [(int(r["replica"]), t, float(c)) for _, r in pdf.iterrows() for t, c in zip(["intercept", *xs], _solved(r, k), strict=True)]
            yield pd.DataFrame(rows, columns=["replica", "term", "coef"])

    solved = sums.mapInPandas(solve, "replica int, term string, coef double")
    return solved.groupBy("term").agg(
        F.max(F.when(F.col("replica") == 0, F.col("coef"))).alias("coef"),
        F.percentile(F.when(F.col("replica") > 0, F.col("coef")), F.lit(0.025)).alias("low"),
        F.percentile(F.when(F.col("replica") > 0, F.col("coef")), F.lit(0.975)).alias("high"),
    )


def _solved(row, k: int) -> np.ndarray:
    g = _matrix(row, k + 1)
    return np.linalg.pinv(g[:k, :k]) @ g[:k, k]


def mean_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ranks from 1, equal values sharing their mean. Counted by distinct value, then joined back."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_c"))
    run = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranks = counts.withColumn(name, F.sum("_c").over(run) - (F.col("_c") - 1) / 2.0).drop("_c")
    return df.join(ranks, [*keys, value])


def spearman(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    ranked = mean_ranks(mean_ranks(df.dropna(subset=[a, b]), keys, a, "_ra"), keys, b, "_rb")
    return ranked.groupBy(*keys).agg(correlation("_ra", "_rb").alias("rho"), F.count("*").alias("n"))


def superiority(df: DataFrame, keys: Sequence[str], inside: Column, value: str) -> DataFrame:
    """Probability that a row inside has a smaller value than one outside (ties half): one less U over n1 n2."""
    ranked = mean_ranks(df.filter(F.col(value).isNotNull()).withColumn("_in", inside), keys, value, "_r")
    n1, n2 = F.count(F.when(F.col("_in"), 1)), F.count(F.when(~F.col("_in"), 1))
    out = ranked.groupBy(*keys).agg(n1.alias("n_in"), n2.alias("n_out"), F.sum(F.when(F.col("_in"), F.col("_r"))).alias("_s"))
    u = F.col("_s") - F.col("n_in") * (F.col("n_in") + 1) / 2
    return out.select(*keys, "n_in", "n_out", (1 - F.try_divide(u, F.col("n_in") * F.col("n_out"))).alias("p_smaller"))


def welch(df: DataFrame, keys: Sequence[str], after: Column, value: str) -> DataFrame:
    """Means before and after, t and degrees of freedom of Welch's test."""
    part = lambda f, c: f(F.when(c, F.col(value)))
    out = df.withColumn("_a", after).groupBy(*keys).agg(
        *[part(f, c).alias(f"{n}{k}") for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp)) for k, c in ((0, ~F.col("_a")), (1, F.col("_a")))]
    )
    a, b = F.col("v0") / F.col("n0"), F.col("v1") / F.col("n1")
    return out.select(
        *keys, F.col("m0").alias("before"), F.col("m1").alias("after"),
        F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(a + b)).alias("t"),
        F.try_divide(F.pow(a + b, 2), a * a / (F.col("n0") - 1) + b * b / (F.col("n1") - 1)).alias("df"),
    )


def correlogram(cells: DataFrame, value: str, lags: Sequence[int]) -> DataFrame:
    """lag, r, n: correlation of pairs of cells that many rows or columns apart."""
    base = cells.filter(F.col(value).isNotNull()).select("row", "col", F.col(value).alias("a"))
    moved = base.withColumn("lag", F.explode(F.array(*map(F.lit, lags)))).withColumn("_d", F.explode(F.array(F.lit(0), F.lit(1))))
    moved = moved.select("lag", (F.col("row") + F.col("lag") * F.col("_d")).alias("row"), (F.col("col") + F.col("lag") * (1 - F.col("_d"))).alias("col"), F.col("a").alias("b"))
    return base.join(moved, ["row", "col"]).groupBy("lag").agg(correlation("a", "b").alias("r"), F.count("*").alias("n"))


def moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Population skewness and excess kurtosis."""
    return df.groupBy(*keys).agg(F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis"))


def prediction_interval(mean: float, low: float, high: float, i2: float, studies: int) -> tuple[float, float]:
    """Where a new study's effect is expected, from a pooled effect's interval and heterogeneity."""
    se = (high - low) / 3.919928
    spread = t_quantile(0.975, studies - 2) * (i2 * studies * se * se + se * se) ** 0.5
    return mean - spread, mean + spread


def binomial_mean(n: Column, p: float, most: int) -> Column:
    """Expected successes of n trials, given that they are at most so many."""
    ways, terms, weights = F.lit(1.0), [], []
    for k in range(most + 1):
        pmf = F.when(n >= k, ways * F.pow(F.lit(p), F.lit(k)) * F.pow(F.lit(1 - p), n - k)).otherwise(0.0)
        terms.append(k * pmf)
        weights.append(pmf)
        ways = ways * (n - k) / (k + 1)
    return F.try_divide(sum(terms[1:], terms[0]), sum(weights[1:], weights[0]))
