"""Kendall's S and order statistics of all pairs' slopes of series of any length, without making the pairs.

Pairs in falling order are inversions. A long series is cut into blocks of x and buckets of y. Pairs in different blocks and
different buckets are told from the counts of a grid; those of one block, and those of one bucket in different blocks, are
counted by tasks that hold a block or a bucket, n log n each.

The slope of two points is below s exactly if they are an inversion of y - s x. So a wanted rank among all slopes is
bracketed by counting inversions for several slopes at once, until few enough pairs lie in the bracket; these are the
inversions between the orders at its two ends, and are listed by the same blocks, buckets and grid.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.operators.quantiles import joined

#: Points that one task counts, blocks of a series at most, points of a series whose slopes one task lists at once.
TASK_POINTS, MOST_BLOCKS, FEW_POINTS = 250_000, 1024, 1500
#: Pairs that are listed for one rank; slopes tried in one pass; points of a series that give the first guess.
LISTED, TRIED, GUESS_POINTS = 500_000, 12, 1000
EPS = 2.0**-52


# --- inversions of arrays ---------------------------------------------------------------------------------------------


def _levels(ranks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bit by bit from the highest: places in order of the bits above, whether the bit is set, where the groups of equal
    bits above begin, and each place's group. Two places are an inversion at the one bit where they first differ."""
    now = np.arange(len(ranks))
    for bit in reversed(range(int(ranks.max(initial=0)).bit_length())):
        own = ranks[now]
        above = own >> (bit + 1)
        edge = np.concatenate(([True], above[1:] != above[:-1]))
        yield now, (own >> bit & 1).astype(bool), np.flatnonzero(edge), np.cumsum(edge) - 1
        now = now[np.argsort(own >> bit, kind="stable")]


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def inversions(values: np.ndarray, weights: np.ndarray | None = None) -> int:
    """Pairs of places of which the first has the larger value, by weight."""
    w = np.ones(len(values), np.int64) if weights is None else weights.astype(np.int64)
    total = 0
    for now, one, start, group in _levels(_ranks(values)):
        own = w[now] * one
        upto = np.cumsum(own)
        before = upto - (upto[start] - own[start])[group]
        total += int((w[now][~one] * before[~one]).sum())
    return total


def listed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all such pairs."""
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for now, one, start, group in _levels(_ranks(values)):
        upto = np.cumsum(one)
        first = (upto[start] - one[start])[group]
        zero = np.flatnonzero(~one)
        times = (upto - first)[zero]
        ends = np.cumsum(times)
        within = np.arange(int(times.sum())) - np.repeat(ends - times, times)
        left.append(now[one][np.repeat(first[zero], times) + within])
        right.append(np.repeat(now[zero], times))
    return np.concatenate(left), np.concatenate(right)


# --- inversions of series ---------------------------------------------------------------------------------------------


def _fields(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def _blocked(points: DataFrame, keys: Sequence[str], sizes: DataFrame, most: int, task: int, columns: Sequence[str] = ("_x", "_y")) -> DataFrame:
    """points and _a, _b: the block of the first column and the bucket of the second, cut where sketches tell; one of each for
    series that one task can hold. Equal values share a block."""
    blocks = min(MOST_BLOCKS, -(-most // task))
    if blocks < 2:
        return points.withColumns({"_a": F.lit(0), "_b": F.lit(0)})
    at = F.array(*[F.lit(k / blocks) for k in range(1, blocks)])
    long = joined(points, sizes.filter(F.col("_n") > task).select(*keys), keys, "left_semi")
    cuts = long.groupBy(*keys).agg(*[F.array_distinct(F.percentile_approx(c, at, F.lit(20 * blocks))).alias(n) for c, n in zip(columns, ("_ca", "_cb"), strict=True)])
    out = joined(points, cuts.checkpoint(), keys, "left")
    place = lambda c, n: F.when(F.col(n).isNull(), 0).otherwise(F.expr(f"size(filter({n}, c -> c < {c}))")).alias
    return out.select(*points.columns, place(columns[0], "_ca")("_a"), place(columns[1], "_cb")("_b"))


def _tasks(points: DataFrame) -> DataFrame:
    """Every point to its block, and to its bucket where that is not all of its series."""
    kinds = F.when(F.col("_long"), F.array(F.struct(F.lit(0).alias("_kind"), F.col("_a").alias("_part")), F.struct(F.lit(1).alias("_kind"), F.col("_b").alias("_part"))))
    kinds = kinds.otherwise(F.array(F.struct(F.lit(0).alias("_kind"), F.col("_a").alias("_part"))))
    return points.withColumn("_k", F.explode(kinds)).select("*", "_k._kind", "_k._part").drop("_k")


def falling(points: DataFrame, keys: Sequence[str], task: int = TASK_POINTS) -> DataFrame:
    """keys, falling: pairs of points (keys, _x, _y, weight _w) with x below and y above, by weight."""
    sizes = points.groupBy(*keys).agg(F.count("*").alias("_n"))
    most = sizes.agg(F.max("_n")).first()[0] or 0
    if most <= task:  # every series fits one task

        def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            order = np.lexsort((pdf["_y"].to_numpy(), pdf["_x"].to_numpy()))
            return pd.DataFrame([[*key, inversions(pdf["_y"].to_numpy()[order], pdf["_w"].to_numpy()[order])]], columns=[*keys, "falling"])

        return points.groupBy(*keys).applyInPandas(whole, f"{_fields(points, keys)}falling long")
    sizes = sizes.checkpoint()
    cut = _blocked(points, keys, sizes, most, task)
    cut = joined(cut, sizes, keys).withColumn("_long", F.col("_n") > task).drop("_n")

    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf["_x"] if key[-2] == 0 else pdf["_a"]
        order = np.lexsort((pdf["_y"].to_numpy(), x.to_numpy()))
        return pd.DataFrame([[*key[:-2], inversions(pdf["_y"].to_numpy()[order], pdf["_w"].to_numpy()[order])]], columns=[*keys, "falling"])

    counts = _tasks(cut).groupBy(*keys, "_kind", "_part").applyInPandas(count, f"{_fields(points, keys)}falling long")
    cells = cut.filter("_long").groupBy(*keys, "_a", "_b").agg(F.sum("_w").alias("_w"))

    def grid(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros((int(pdf["_a"].max()) + 1, int(pdf["_b"].max()) + 1), np.int64)
        held[pdf["_a"], pdf["_b"]] = pdf["_w"]
        earlier = np.cumsum(held, 0) - held
        above = np.cumsum(earlier[:, ::-1], 1)[:, ::-1] - earlier
        return pd.DataFrame([[*key, int((held * above).sum())]], columns=[*keys, "falling"])

    counts = counts.unionByName(cells.groupBy(*keys).applyInPandas(grid, f"{_fields(points, keys)}falling long"))
    return counts.groupBy(*keys).agg(F.sum("falling").alias("falling"))


def _points(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    good = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double")))
    return good.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))


def kendall(df: DataFrame, keys: Sequence[str], x: str, y: str, task: int = TASK_POINTS) -> DataFrame:
    """keys, n, s, pairs, ties: points; pairs rising less those falling; pairs of different x; the tie term of S's variance.

    Points without x or y play no part; equal points count by weight, so a value that a third of a series has is one."""
    points = _points(df, keys, x, y).groupBy(*keys, "_x", "_y").agg(F.count("*").alias("_w")).checkpoint()
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    two = lambda c: (F.sum(wide(c) * (wide(c) - 1)) / 2)
    by_x = points.groupBy(*keys, "_x").agg(F.sum("_w").alias("_t")).groupBy(*keys).agg(F.sum("_t").alias("n"), two("_t").alias("_tx"))
    t = F.col("_t").cast("double")
    by_y = points.groupBy(*keys, "_y").agg(F.sum("_w").alias("_t")).groupBy(*keys).agg(two("_t").alias("_ty"), F.sum(t * (t - 1) * (2 * t + 5)).alias("ties"))
    both = points.groupBy(*keys).agg(two("_w").alias("_txy"))
    out = joined(joined(joined(by_x, by_y, keys), both, keys), falling(points, keys, task), keys)
    pairs = wide("n") * (wide("n") - 1) / 2 - F.col("_tx")
    s = pairs - F.col("_ty") + F.col("_txy") - 2 * wide("falling")
    return out.select(*keys, "n", s.cast("double").alias("s"), pairs.cast("long").alias("pairs"), "ties")


# --- order statistics of slopes ---------------------------------------------------------------------------------------


def _together(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    """Both tables' groups side by side; the second's columns are made anew, as both may come from one table."""
    return a.groupBy(*keys).cogroup(b.select(*[F.col(f"`{c}`").alias(c) for c in b.columns]).groupBy(*keys))


def _listed_slopes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    i, j = np.triu_indices(len(x), 1)
    apart = x[i] < x[j]
    i, j = i[apart], j[apart]
    return (y[j] - y[i]) / (x[j] - x[i])


def slopes(df: DataFrame, keys: Sequence[str], x: str, y: str, ranks: DataFrame, few: int = FEW_POINTS, task: int = TASK_POINTS, most: int = LISTED) -> DataFrame:
    """keys, rank, slope for each (keys, rank) of ranks: the slope of that rank (from 0) among those of all pairs of points of
    different x, in ascending order. A rank that a series doesn't have gives no row.

    Short series list their slopes in one task. In longer ones a rank is bracketed, and the bracket is widened by what rounding
    can do before its pairs are listed. Where more than `most` pairs have one slope up to rounding (a
    value that stays the same, say), the slope is that of one of them."""
    points = _points(df, keys, x, y)
    sizes = points.groupBy(*keys).agg(F.count("*").alias("_n"))
    wanted = joined(ranks.select(*keys, F.col("rank").cast("long").alias("rank")).distinct(), sizes, keys).checkpoint()
    schema = f"{_fields(points, keys)}rank long, slope double"

    def short(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = np.sort(_listed_slopes(own["_x"].to_numpy(), own["_y"].to_numpy()))
        rank = asked["rank"][(asked["rank"] >= 0) & (asked["rank"] < len(found))]
        return pd.DataFrame({**dict(zip(keys, key, strict=True)), "rank": rank, "slope": found[rank]}, columns=[*keys, "rank", "slope"])

    brief = wanted.filter(F.col("_n") <= few)
    own = joined(points, brief.select(*keys).distinct(), keys, "left_semi")
    out = _together(brief, own, keys).applyInPandas(short, schema)
    long = wanted.filter(F.col("_n") > few)
    if not long.limit(1).count():
        return out
    return out.unionByName(_bracketed(joined(points, long.select(*keys).distinct(), keys, "left_semi"), keys, long, schema, task, most))


def _bracketed(points: DataFrame, keys: Sequence[str], wanted: DataFrame, schema: str, task: int, most: int) -> DataFrame:
    """The ranks of long series. Targets are few rows: (keys, rank, ends a and b, inversions at both)."""
    points = points.checkpoint()
    pairs = joined(points.groupBy(*keys, "_x").agg(F.count("*").alias("_t")).groupBy(*keys).agg(
        F.sum("_t").alias("_all"), F.sum(F.col("_t") * (F.col("_t") - 1) / 2).cast("long").alias("_same")), _errors(points, keys), keys)
    pairs = pairs.withColumn("_pairs", (F.col("_all") * (F.col("_all") - 1) / 2).cast("long") - F.col("_same")).drop("_all", "_same")
    guess = _guess(points, keys, joined(wanted, pairs, keys))
    targets = joined(guess, pairs, keys).filter("rank >= 0 and rank < _pairs").withColumns({"_ka": F.lit(0).cast("long"), "_kb": F.col("_pairs")})
    targets = targets.withColumn("_try", F.array_sort(F.array_distinct("_try"))).withColumns({"_a": F.lit(float("-inf")), "_b": F.lit(float("inf")), "_open": F.lit(True)}).checkpoint()
    while targets.filter("_open").limit(1).count():
        tries = targets.filter("_open").select(*keys, F.explode("_try").alias("_s")).distinct()
        moved = joined(points, tries, keys).select(*keys, "_s", "_x", (F.col("_y") - F.col("_s") * F.col("_x")).alias("_y"), F.lit(1).cast("long").alias("_w"))
        counts = falling(moved, [*keys, "_s"], task).checkpoint()
        seen = joined(targets.filter("_open"), counts, keys).filter("_s > _a and _s < _b")
        low, high = F.col("falling") <= F.col("rank"), F.col("falling") > F.col("rank")
        seen = seen.groupBy(*keys, "rank").agg(
            F.max(F.when(low, F.struct("_s", "falling"))).alias("_lo"), F.min(F.when(high, F.struct("_s", "falling"))).alias("_hi")
        ).withColumnRenamed("rank", "_r")
        new = joined(targets.filter("_open"), seen, [*keys], "left").filter("_r is null or _r = rank")
        new = new.withColumns({"_a": F.coalesce("_lo._s", "_a"), "_ka": F.coalesce("_lo.falling", "_ka"), "_b": F.coalesce("_hi._s", "_b"), "_kb": F.coalesce("_hi.falling", "_kb")}).drop("_lo", "_hi", "_r")
        targets = targets.filter("not _open").unionByName(_next(new, most)).checkpoint()
    few = F.col("_kb") - F.col("_ka") <= most
    return _found(points, keys, targets.filter(few), schema, task).unionByName(_tied(points, keys, targets.filter(~few), schema))


def _errors(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, _near, _ex, _ey: the least gap of x; rounding of y - s x may move a slope by (_ey + |s| _ex) / _near at most."""
    gaps = points.select(*keys, "_x").distinct().withColumn("_g", F.col("_x") - F.lag("_x").over(Window.partitionBy(*keys).orderBy("_x")))
    near = gaps.groupBy(*keys).agg(F.coalesce(F.min("_g"), F.lit(1.0)).alias("_near"))
    return joined(points.groupBy(*keys).agg((4 * EPS * F.max(F.abs("_x"))).alias("_ex"), (4 * EPS * F.max(F.abs("_y"))).alias("_ey")), near, keys)


def _sample(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A bounded number of points of each series, those whose hashes are lowest."""
    order = Window.partitionBy(*keys).orderBy(F.xxhash64("_x", "_y"), "_x", "_y")
    return points.withColumn("_i", F.row_number().over(order)).filter(F.col("_i") <= GUESS_POINTS).drop("_i")


def _tied(points: DataFrame, keys: Sequence[str], targets: DataFrame, schema: str) -> DataFrame:
    """Ranks whose bracket has no room left and still holds many pairs: the slope of one of them, from the sample's pairs, or
    else the middle of the bracket, which rounding cannot tell from theirs."""

    def run(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = np.sort(_listed_slopes(own["_x"].to_numpy(), own["_y"].to_numpy()))
        rows = []
        for rank, a, b, near, ex, ey in asked[["rank", "_a", "_b", "_near", "_ex", "_ey"]].itertuples(index=False):
            room = 4 * (ey + max(abs(a), abs(b)) * ex) / near
            some = found[(found >= a - room) & (found <= b + room)]
            rows.append([*key, rank, some[len(some) // 2] if len(some) else (a + b) / 2])
        return pd.DataFrame(rows, columns=[*keys, "rank", "slope"])

    some = joined(points, targets.select(*keys).distinct(), keys, "left_semi")
    return _together(targets, _sample(some, keys), keys).applyInPandas(run, schema)


def _guess(points: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """keys, rank, _try: slopes to try first, from quantiles of the slopes of a bounded sample of each series."""
    def run(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = np.sort(_listed_slopes(own["_x"].to_numpy(), own["_y"].to_numpy()))
        rows = []
        for rank, pairs, near, ex, ey in asked[["rank", "_pairs", "_near", "_ex", "_ey"]].itertuples(index=False):
            at = rank / max(1, pairs) + np.linspace(-0.04, 0.04, TRIED)
            tries, times = np.unique(np.quantile(found, np.clip(at, 0, 1), method="nearest"), return_counts=True) if len(found) else (np.zeros(1), np.ones(1))
            often = tries[times > 1]  # a slope that many pairs share is bracketed at once
            room = 3 * (ey + np.abs(often) * ex) / near
            rows.append([*key, rank, np.concatenate((tries, often - room, often + room))])
        return pd.DataFrame(rows, columns=[*keys, "rank", "_try"])

    return _together(wanted, _sample(points, keys), keys).applyInPandas(run, f"{_fields(points, keys)}rank long, _try array<double>")


def _next(targets: DataFrame, most: int) -> DataFrame:
    """Targets with the slopes to try next, or closed: few enough pairs left, or no room left between the ends."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in targets.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tries, open_ = [], []
            for r in pdf.itertuples(index=False, name=None):
                t = dict(zip(pdf.columns, r, strict=True))
                a, b = t["_a"], t["_b"]
                room = (t["_ey"] + max(abs(a), abs(b)) * t["_ex"]) / t["_near"] if np.isfinite(a) and np.isfinite(b) else 0.0
                step = max(abs(a) if np.isfinite(a) else abs(b), t["_ey"] / EPS * 1e-6, 1e-300)
                if np.isfinite(a) and np.isfinite(b):
                    new = np.linspace(a, b, TRIED + 2)[1:-1]
                elif np.isfinite(b):
                    new = b - step * 4.0 ** np.arange(TRIED)
                else:
                    new = (a if np.isfinite(a) else 0.0) + step * 4.0 ** np.arange(TRIED)
                new = np.unique(new[(new > a) & (new < b) & np.isfinite(new)])
                open_.append(bool(t["_kb"] - t["_ka"] > most and len(new) and (not np.isfinite(b - a) or b - a > 8 * room)))
                tries.append(new)
            pdf["_try"], pdf["_open"] = tries, open_
            yield pdf

    return targets.mapInPandas(run, fields)


def _found(points: DataFrame, keys: Sequence[str], targets: DataFrame, schema: str, task: int) -> DataFrame:
    """Lists the pairs of each target's bracket and takes the one of its rank.

    The ends are moved apart by what rounding may do, so that the wanted slope is safely inside and every pair outside is on
    its side of it. Pairs that tie with an end by the thousands stay outside, where they were counted."""
    room = lambda e: (F.col("_ey") + F.abs(e) * F.col("_ex")) / F.col("_near")
    ends = targets.withColumns({"_a": F.greatest(F.lit(-1e300), F.col("_a") - 4 * room(F.col("_a"))), "_b": F.least(F.lit(1e300), F.col("_b") + 4 * room(F.col("_b")))})
    name = [*keys, "rank"]
    moved = joined(points, ends.select(*name, "_a", "_b"), keys)
    moved = moved.select(*name, "_x", F.col("_y").alias("_v"), (F.col("_y") - F.col("_a") * F.col("_x")).alias("_za"), (F.col("_y") - F.col("_b") * F.col("_x")).alias("_zb"))
    moved = moved.checkpoint()
    below = falling(moved.select(*name, "_x", F.col("_za").alias("_y"), F.lit(1).cast("long").alias("_w")), name, task)
    sizes = moved.groupBy(*name).agg(F.count("*").alias("_n"))
    top = sizes.agg(F.max("_n")).first()[0] or 0
    cut = joined(_blocked(moved, name, sizes, top, task, ("_za", "_zb")), sizes, name).withColumn("_long", F.col("_n") > task).drop("_n").checkpoint()
    out = f"{_fields(moved, name)}slope double, _c long"

    def table(key: Sequence, own: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
        x, v = own["_x"].to_numpy(), own["_v"].to_numpy()
        ahead = x[i] < x[j]
        i, j = i[ahead], j[ahead]
        slope, count = np.unique((v[j] - v[i]) / (x[j] - x[i]), return_counts=True)
        return pd.DataFrame({**dict(zip(name, key, strict=True)), "slope": slope, "_c": count}, columns=[*name, "slope", "_c"])

    def part(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf["_za"] if key[-2] == 0 else pdf["_a"]
        order = np.lexsort((pdf["_x"].to_numpy() if key[-2] == 0 else pdf["_zb"].to_numpy(), first.to_numpy()))
        own = pdf.iloc[order]
        i, j = listed(own["_zb"].to_numpy())
        return table(key[:-2], own, i, j)

    counts = _tasks(cut).groupBy(*name, "_kind", "_part").applyInPandas(part, out)
    if top > task:
        # Cells of which one lies before in one order and behind in the other: all their pairs are listed ones.
        cells = cut.filter("_long").groupBy(*name, "_a", "_b").agg(F.count("*").alias("_c"))
        other = cells.select(*name, F.col("_a").alias("_a2"), F.col("_b").alias("_b2"))
        crossed = joined(cells.drop("_c"), other, name).filter("_a < _a2 and _b > _b2").checkpoint()
        p, q = cut.select(*name, "_a", "_b", "_x", "_v"), cut.select(*name, F.col("_a").alias("_a2"), F.col("_b").alias("_b2"), F.col("_x").alias("_x2"), F.col("_v").alias("_v2"))
        both = joined(joined(p, crossed, [*name, "_a", "_b"]), q, [*name, "_a2", "_b2"]).filter("_x < _x2")
        counts = counts.unionByName(both.groupBy(*name, ((F.col("_v2") - F.col("_v")) / (F.col("_x2") - F.col("_x"))).alias("slope")).agg(F.count("*").alias("_c")))
    steps = joined(counts.groupBy(*name, "slope").agg(F.sum("_c").alias("_c")), below, name)
    upto = F.sum("_c").over(Window.partitionBy(*name).orderBy("slope").rowsBetween(Window.unboundedPreceding, 0)) + F.col("falling")
    steps = steps.withColumn("_upto", upto).filter("rank < _upto and rank >= _upto - _c")
    fields = [part_.split()[0].strip("`") for part_ in schema.split(", ")]
    return steps.select(*fields)
