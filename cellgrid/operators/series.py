"""Time series: quality control, completeness gates, moving windows, climatologies, change points, regimes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _by(keys: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def clip_negative(value: Column) -> Column:
    return F.when(value < 0, 0.0).otherwise(value)


def gap_counts(df: DataFrame, keys: Sequence[str], ts: str, value: str, seconds: int = 3600) -> DataFrame:
    """Rows, nulls, negatives, zeros, and steps that are not of the given length."""
    step = F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(F.lag(ts).over(_by(keys, ts)).cast("timestamp"))
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    v = F.col(value)
    return df.withColumn("_s", step).groupBy(*keys).agg(
        F.count("*").alias("n"), count(v.isNull(), "nulls"), count(v < 0, "negatives"), count(v == 0, "zeros"), count(F.col("_s") != seconds, "gaps")
    )


def trailing(df: DataFrame, keys: Sequence[str], ts: str, value: str, rows: int = 8, least: int = 6, how: str = "avg", name: str = "trailing") -> DataFrame:
    """Mean or sum of the last rows with at least so many values; null before the window is full."""
    w = _by(keys, ts).rowsBetween(1 - rows, 0)
    full = (F.row_number().over(_by(keys, ts)) >= rows) & (F.count(value).over(w) >= least)
    return df.withColumn(name, F.when(full, (F.avg if how == "avg" else F.sum)(value).over(w)))


def daily(hourly: DataFrame, keys: Sequence[str], ts: str, value: str, least: int = 18) -> DataFrame:
    """day, n, mean and max; null means where fewer hours than least have a value."""
    enough = F.count(value) >= least
    return hourly.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        F.count(value).alias("n"), F.when(enough, F.avg(value)).alias("mean"), F.when(enough, F.max(value)).alias("max")
    )


def monthly(days: DataFrame, keys: Sequence[str], day: str, value: str, share: float = 0.75) -> DataFrame:
    """month, n, mean if enough of the calendar's days have a value, total if every one has."""
    month = F.trunc(day, "month").alias("month")
    out = days.groupBy(*keys, month).agg(F.count(value).alias("n"), F.avg(value).alias("_m"), F.sum(value).alias("_s"))
    all_days = F.dayofmonth(F.last_day("month"))
    return out.select(*keys, "month", "n", F.when(F.col("n") >= share * all_days, F.col("_m")).alias("mean"), F.when(F.col("n") == all_days, F.col("_s")).alias("total"))


def month_balanced(days: DataFrame, keys: Sequence[str], day: str, value: str, least: int = 20) -> DataFrame:
    """Mean of the means of calendar months that have enough days."""
    months = days.groupBy(*keys, F.month(day).alias("_m")).agg(F.avg(value).alias("_v"), F.count(value).alias("_n"))
    return months.filter(F.col("_n") >= least).groupBy(*keys).agg(F.avg("_v").alias("balanced"), F.count("*").alias("months"))


def climatology(months: DataFrame, keys: Sequence[str], month: str, value: str, years: tuple[int, int]) -> DataFrame:
    """Mean of each calendar month over a range of years."""
    inside = F.year(month).between(*years)
    return months.filter(inside).groupBy(*keys, F.month(month).alias("calendar_month")).agg(F.avg(value).alias("normal"), F.count(value).alias("n"))


def anomalies(months: DataFrame, normals: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """Difference and percent difference from the calendar month's normal."""
    joined = months.withColumn("calendar_month", F.month(month)).join(normals.drop("n"), [*keys, "calendar_month"])
    gap = F.col(value) - F.col("normal")
    return joined.select(*keys, month, gap.alias("anomaly"), (100 * F.try_divide(gap, F.col("normal"))).alias("pct"))


def best_run(months: DataFrame, keys: Sequence[str], month: str, value: str, rows: int = 6) -> DataFrame:
    """Start and mean of the run of so many rows with the largest mean, all having a value; the first of equal ones."""
    w = _by(keys, month).rowsBetween(0, rows - 1)
    runs = months.select(*keys, F.col(month).alias("start"), F.avg(value).over(w).alias("run_mean"), F.count(value).over(w).alias("_n")).filter(F.col("_n") == rows)
    order = Window.partitionBy(*keys).orderBy(F.desc("run_mean"), "start")
    return runs.withColumn("_r", F.row_number().over(order)).filter("_r = 1").select(*keys, "start", "run_mean")


def second_difference(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> Column:
    """x[t+1] - 2 x[t] + x[t-1]."""
    w = _by(keys, ts)
    return F.lead(value).over(w) - 2 * F.col(value) + F.lag(value).over(w)


def repair_spikes(df: DataFrame, keys: Sequence[str], ts: str, value: str, high: float, passes: int = 3) -> DataFrame:
    """Values whose second difference is below -high are replaced by their neighbours' mean, pass by pass; adds repaired,
    the number of the pass that last touched a row (0: none)."""
    out = df.withColumn("repaired", F.lit(0))
    w = _by(keys, ts)
    for k in range(1, passes + 1):
        spike = second_difference(out, keys, ts, value) < -high
        mean = (F.lag(value).over(w) + F.lead(value).over(w)) / 2
        out = out.withColumns({"_spike": F.coalesce(spike, F.lit(False)), "_mean": mean})
        out = out.withColumns({value: F.when(F.col("_spike"), F.col("_mean")).otherwise(F.col(value)), "repaired": F.when(F.col("_spike"), k).otherwise(F.col("repaired"))})
        out = out.drop("_spike", "_mean")
    return out


def change_scan(df: DataFrame, keys: Sequence[str], ts: str, value: str, rows: int = 24) -> DataFrame:
    """The time at which the means of the rows before and from there on differ most, and that difference."""
    w = _by(keys, ts)
    before, after = w.rowsBetween(-rows, -1), w.rowsBetween(0, rows - 1)
    gap = F.avg(value).over(after) - F.avg(value).over(before)
    full = (F.count(value).over(before) == rows) & (F.count(value).over(after) == rows)
    scanned = df.select(*keys, F.col(ts).alias("at"), gap.alias("change"), full.alias("_f")).filter("_f")
    order = Window.partitionBy(*keys).orderBy(F.desc(F.abs("change")), "at")
    return scanned.withColumn("_r", F.row_number().over(order)).filter("_r = 1").select(*keys, "at", "change")


def log_change(days: DataFrame, keys: Sequence[str], day: str, value: str, rows: int = 30, least: int = 25) -> DataFrame:
    """Logarithm of the mean after over the mean before each day, the day itself left out; null with too few values."""
    w = _by(keys, day)
    before, after = w.rowsBetween(-rows, -1), w.rowsBetween(1, rows)
    enough = (F.count(value).over(before) >= least) & (F.count(value).over(after) >= least)
    ratio = F.try_divide(F.avg(value).over(after), F.avg(value).over(before))
    return days.select(*keys, day, F.when(enough & (ratio > 0), F.ln(ratio)).alias("log_change"))


def regimes(df: DataFrame, table: DataFrame, day: str, start: str = "start", name: str = "regime") -> DataFrame:
    """Adds the last regime that started by the day; a day on which a later regime starts is named change_<regime>.

    The regimes' table is a dimension of a few rows; it is broadcast."""
    first = Window.orderBy(start)
    ranges = table.select(F.col(start).alias("_from"), F.lead(start).over(first).alias("_to"), F.col(name).alias("_name"), F.row_number().over(first).alias("_k"))
    at = F.col(day)
    hit = (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    label = F.when((at == F.col("_from")) & (F.col("_k") > 1), F.concat(F.lit("change_"), "_name")).otherwise(F.col("_name"))
    return df.join(F.broadcast(ranges), hit, "left").withColumn(name, label).drop("_from", "_to", "_name", "_k")


def calendar_percentile(days: DataFrame, keys: Sequence[str], doy: str, value: str, q: float = 0.9, half: int = 2, period: int = 365) -> DataFrame:
    """Type-8 percentile of each calendar day over a centred window of days, all years together."""
    spread = days.withColumn("_d", F.explode(F.sequence(F.lit(-half), F.lit(half)))).withColumn("target", F.pmod(F.col(doy) - 1 + F.col("_d"), F.lit(period)) + 1)
    lists = spread.filter(F.col(value).isNotNull()).groupBy(*keys, "target").agg(F.array_sort(F.collect_list(value)).alias("_v"))
    return lists.select(*keys, F.col("target").alias("calendar_day"), percentile_type8(F.col("_v"), q).alias("threshold"), F.size("_v").alias("n"))


def percentile_type8(values: Column, q: float) -> Column:
    """Median-unbiased percentile of an ascending array."""
    n = F.size(values)
    place = F.greatest(F.lit(1.0), F.least(n.cast("double"), q * (n + 1 / 3) + 1 / 3))
    low = F.floor(place).cast("int")
    a, b = F.get(values, low - 1), F.get(values, F.least(low, n - 1))
    return a + (place - low) * (b - a)


def exceedances(days: DataFrame, keys: Sequence[str], year: str, doy: str, value: str, base: tuple[int, int], q: float = 0.9, half: int = 2) -> DataFrame:
    """Days a year above the calendar percentile. Within the base years the percentile leaves the year itself out and
    doubles each of the others in turn; the counts are averaged, so that base years are treated as any other year."""
    inside = days.filter(F.col(year).between(*base) & F.col(value).isNotNull())
    spread = inside.select(*keys, year, doy, F.explode(F.sequence(F.lit(-half), F.lit(half))).alias("_d"), value)
    spread = spread.withColumn("target", F.pmod(F.col(doy) - 1 + F.col("_d"), F.lit(365)) + 1)
    by_year = spread.groupBy(*keys, "target", F.col(year).alias("_y")).agg(F.collect_list(value).alias("_v"))
    lists = by_year.groupBy(*keys, "target").agg(F.collect_list(F.struct("_y", "_v")).alias("_all"))
    threshold = lambda values: percentile_type8(F.array_sort(values), q)
    asked = days.filter(F.col(value).isNotNull()).select(*keys, F.col(year).alias("_year"), F.col(doy).alias("target"), F.col(value).alias("_x")).join(lists, [*keys, "target"])
    others = F.filter("_all", lambda p: p["_y"] != F.col("_year"))
    rest = F.flatten(F.transform(others, lambda p: p["_v"]))
    above = F.transform(others, lambda p: F.when(F.col("_x") > threshold(F.concat(rest, p["_v"])), 1.0).otherwise(0.0))
    mean = F.try_divide(F.aggregate(above, F.lit(0.0), lambda s, v: s + v), F.size(above))
    whole = F.when(F.col("_x") > threshold(F.flatten(F.transform("_all", lambda p: p["_v"]))), 1.0).otherwise(0.0)
    own = F.exists("_all", lambda p: p["_y"] == F.col("_year"))
    return asked.groupBy(*keys, F.col("_year").alias("year")).agg(F.sum(F.when(own & (F.size(others) > 0), mean).otherwise(whole)).alias("days"))


def diurnal(hourly: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """day, amplitude (maximum less mean) and hour of the first maximum."""
    at = F.struct(F.col(value), (-F.hour(ts)).alias("h"))
    out = hourly.groupBy(*keys, F.to_date(ts).alias("day")).agg((F.max(value) - F.avg(value)).alias("amplitude"), F.max(at).alias("_m"))
    return out.select(*keys, "day", "amplitude", (-F.col("_m.h")).alias("peak_hour"))


def year_flags(scenes: DataFrame, keys: Sequence[str], day: str, valid: Column, least: int = 4, quarters: int = 3) -> DataFrame:
    """year, n, quarters, reliable and the reasons why not."""
    out = scenes.filter(valid).groupBy(*keys, F.year(day).alias("year")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.quarter(day))).alias("quarters"))
    reasons = F.filter(F.array(F.when(F.col("n") < least, "few"), F.when(F.size("quarters") < quarters, "seasons")), lambda x: x.isNotNull())
    return out.withColumn("reasons", F.array_join(reasons, ",")).withColumn("reliable", F.col("reasons") == "").withColumn("quarters", F.size("quarters"))
