"""Climate and air tables: annual and period summaries, comparisons of a station with a model, regimes, guidelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.operators.quantiles import joined, order_statistics, percentiles
from cellgrid.operators.series import trailing
from cellgrid.operators.stats import correlation

#: Standard atmosphere (fixed values): share of pressure lost with height, exponent, reference temperature in kelvin.
LAPSE, POWER, REFERENCE_K = 2.25577e-5, 5.25588, 298.15


def reference_factor(height_m: float, kelvin: float = REFERENCE_K) -> float:
    """What a concentration at a height is multiplied by to stand for one at sea level and reference temperature."""
    return kelvin / REFERENCE_K / (1 - LAPSE * height_m) ** POWER


def year_days(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))


def annual_table(days: DataFrame, keys: Sequence[str], day: str, mean: str, high: str, low: str, rain: str, hot: float) -> DataFrame:
    """One row a year: means, extremes, totals, wettest day and five days, hot days, completeness, and whether it is partial.

    The five-day sum ends on its day and needs all five, whichever year they lie in; the year of its last day has it.
    months counts months with a value on every day of the calendar; full_total is null unless all twelve are complete."""
    wet = trailing(days, keys, day, rain, 5, 5, "sum", "_five")
    year = F.year(day).alias("year")
    full = F.dayofmonth(F.last_day("_month"))
    months = days.groupBy(*keys, year, F.trunc(day, "month").alias("_month")).agg(F.count(rain).alias("_n"), F.sum(rain).alias("_s"))
    months = months.groupBy(*keys, "year").agg(F.count(F.when(F.col("_n") == full, 1)).alias("months"), F.sum(F.when(F.col("_n") == full, F.col("_s"))).alias("_t"))
    out = wet.groupBy(*keys, year).agg(
        F.avg(mean).alias("mean"), F.avg(high).alias("mean_high"), F.avg(low).alias("mean_low"), F.max(high).alias("highest"), F.min(low).alias("lowest"),
        F.sum(rain).alias("total"), F.max(rain).alias("wettest_day"), F.max("_five").alias("wettest_five"), F.count(F.when(F.col(high) >= hot, 1)).alias("hot_days"),
        F.count(mean).alias("_nm"), F.count(rain).alias("_nr"), F.max(F.when(F.col(mean).isNotNull(), F.col(day))).alias("until"),
    )
    share = F.least("_nm", "_nr") / year_days(F.col("year"))
    out = out.join(months, [*keys, "year"]).withColumns({"completeness": share, "partial": share < 1, "full_total": F.when(F.col("months") == 12, F.col("_t"))})
    return out.drop("_nm", "_nr", "_t")


def period_blocks(days: DataFrame, keys: Sequence[str], period: Column, value: str, regime: str, limits: Mapping[str, float], factor: float = 1.0) -> DataFrame:
    """Summaries of periods: days, valid days, mean, 99th percentile, maximum, days over each limit (strictly), the same
    for each 365 valid days, days over the limits times a factor, days of each regime, and whether regimes mix.

    A day on which a regime changes (change_<name>) belongs to that regime when it is told whether they mix."""
    v = F.col(value)
    out = days.withColumn("period", period).groupBy(*keys, "period").agg(
        F.count("*").alias("days"), F.count(value).alias("valid"), F.avg(value).alias("mean"), F.percentile(value, F.lit(0.99)).alias("p99"), F.max(value).alias("highest"),
        *[F.count(F.when(v > limit, 1)).alias(name) for name, limit in limits.items()],
        *[F.count(F.when(v * factor > limit, 1)).alias(f"{name}_corrected") for name, limit in limits.items()],
    )
    counts = days.withColumn("period", period).groupBy(*keys, "period", regime).agg(F.count("*").alias("_n"))
    plain = F.regexp_replace(regime, "^change_", "")
    regimes = counts.groupBy(*keys, "period").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(regime, "_n")))).alias("regimes"), (F.count_distinct(plain) > 1).alias("mixed")
    )
    scaled = {f"{name}_per_365": F.col(name) * 365.0 / F.greatest(F.col("valid"), F.lit(1)) for name in limits}
    return out.withColumns(scaled).join(regimes, [*keys, "period"])


def window_changes(days: DataFrame, keys: Sequence[str], day: str, value: str, regime: str, rows: int = 30, least: int = 25) -> DataFrame:
    """log_change of every day (means of the rows after and before it, itself left out), regime, and calm: all rows of both
    windows and the day itself in one regime, none of them a day of change."""
    w = Window.partitionBy(*keys).orderBy(day)
    before, after, around = w.rowsBetween(-rows, -1), w.rowsBetween(1, rows), w.rowsBetween(-rows, rows)
    enough = (F.count(value).over(before) >= least) & (F.count(value).over(after) >= least)
    ratio = F.try_divide(F.avg(value).over(after), F.avg(value).over(before))
    one = (F.min(regime).over(around) == F.max(regime).over(around)) & (F.count("*").over(around) == 2 * rows + 1) & ~F.col(regime).startswith("change_")
    return days.select(*keys, day, regime, F.when(enough & (ratio > 0), F.ln(ratio)).alias("log_change"), one.alias("calm"))


def change_against_null(changes: DataFrame, keys: Sequence[str], day: str, regime: str) -> DataFrame:
    """For each day of change: its log change, its percentile among calm windows, how many there are, whether it lies
    outside their 2.5 to 97.5 percentiles and beyond the same calendar day of other years (calm ones), and unusual: both."""
    null = changes.filter("calm and log_change is not null")
    limits = null.groupBy(*keys).agg(F.percentile("log_change", F.array(F.lit(0.025), F.lit(0.975))).alias("_q"), F.count("*").alias("windows"))
    events = changes.filter(F.col(regime).startswith("change_") & F.col("log_change").isNotNull()).select(*keys, day, regime, F.col("log_change").alias("change"))
    against = events.join(null.select(*keys, F.col("log_change").alias("_x")), list(keys))
    places = against.groupBy(*keys, day).agg((100 * F.avg(F.when(F.col("_x") <= F.col("change"), 1.0).otherwise(0.0))).alias("percentile"))
    same = null.select(*keys, F.col(day).alias("_d"), F.abs("log_change").alias("_a"))
    date = lambda c: F.date_format(c, "MM-dd")
    others = events.join(same.withColumn("_md", date("_d")), [F.col("_md") == date(day), *[events[k] == same[k] for k in keys], F.year("_d") != F.year(day)])
    others = others.groupBy(*[events[k] for k in keys], day).agg(F.max("_a").alias("_most"))
    out = events.join(limits, list(keys)).join(places, [*keys, day]).join(others, [*keys, day], "left")
    outside = (F.col("change") < F.col("_q")[0]) | (F.col("change") > F.col("_q")[1])
    beyond = F.abs("change") > F.coalesce("_most", F.lit(0.0))
    return out.select(*keys, day, regime, "change", "windows", "percentile", outside.alias("outside"), (outside & beyond).alias("unusual"))


def regime_scenarios(days: DataFrame, keys: Sequence[str], value: str, regime: str, old: str, new: str, assumptions: Mapping[str, Column]) -> DataFrame:
    """assumption, old_mean, new_mean, change_pct: the new regime's values rescaled by each assumption against the old
    regime's mean; agree: whether all assumptions give the change one sign."""
    parts = F.array(*[F.struct(F.lit(n).alias("assumption"), c.cast("double").alias("_v")) for n, c in assumptions.items()])
    long = days.select(*keys, regime, value, F.inline(parts))
    out = long.groupBy(*keys, "assumption").agg(F.avg(F.when(F.col(regime) == old, F.col(value))).alias("old_mean"), F.avg(F.when(F.col(regime) == new, F.col("_v"))).alias("new_mean"))
    out = out.withColumn("change_pct", 100 * (F.try_divide(F.col("new_mean"), F.col("old_mean")) - 1))
    sign = F.signum("change_pct")
    w = Window.partitionBy(*keys)
    return out.withColumn("agree", F.min(sign).over(w) == F.max(sign).over(w))


def trimmed(hours: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Whole days only: from the first midnight to the last full day that has a value; adds steady: the step before the
    row is one hour (true for the first row)."""
    w = Window.partitionBy(*keys)
    day = F.to_date(ts)
    sized = hours.withColumns({"_last": F.max(F.when(F.col(value).isNotNull(), F.col(ts))).over(w), "_n": F.count("*").over(Window.partitionBy(*keys, day))})
    kept = sized.filter((F.col(ts) <= F.col("_last")) & (F.col("_n") == 24) & (F.to_date("_last") >= day))
    last = F.hour("_last") == 23
    kept = kept.filter(last | (day < F.to_date("_last")))
    step = F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(F.lag(ts).over(w.orderBy(ts)).cast("timestamp"))
    return kept.withColumn("steady", F.coalesce(step == 3600, F.lit(True))).drop("_last", "_n")


def half_year_bias(station: DataFrame, model: DataFrame, keys: Sequence[str], day: str, value: str, hours: str, low: float, high: float) -> DataFrame:
    """semester, days, bias: mean of station less model over common days; station days need 18 to 24 hours and a value in
    the range."""
    good = station.filter(F.col(hours).between(18, 24) & F.col(value).between(low, high))
    both = good.join(model.select(*keys, day, F.col(value).alias("_m")), [*keys, day]).filter(F.col("_m").isNotNull())
    name = F.concat(F.year(day).cast("string"), F.when(F.month(day) > 6, "-S2").otherwise("-S1")).alias("semester")
    return both.groupBy(*keys, name).agg(F.count("*").alias("days"), F.avg(F.col(value) - F.col("_m")).alias("bias"))


def common_days(first: DataFrame, second: DataFrame, third: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """keys, day, a, b, c: the days on which all three series have a value."""
    parts = [s.filter(F.col(value).isNotNull()).select(*keys, day, F.col(value).alias(n)) for s, n in ((first, "a"), (second, "b"), (third, "c"))]
    return parts[0].join(parts[1], [*keys, day]).join(parts[2], [*keys, day])


def station_scores(both: DataFrame, keys: Sequence[str], day: str, a: str, b: str) -> DataFrame:
    """n, bias, r, and r of the anomalies from each series' own mean of the calendar month."""
    w = Window.partitionBy(*keys, F.month(day))
    wide = both.dropna(subset=[a, b]).withColumns({"_a": F.col(a) - F.avg(a).over(w), "_b": F.col(b) - F.avg(b).over(w)})
    return wide.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(F.col(a) - F.col(b)).alias("bias"), correlation(a, b).alias("r"), correlation("_a", "_b").alias("r_anomaly"))


def matched_threshold(both: DataFrame, keys: Sequence[str], a: str, b: str, at: float, least: int = 365) -> DataFrame:
    """n, frequency, threshold: the value of b that is reached as often as a reaches `at` (median-unbiased percentile, one
    decimal), null with too few common rows or where a always or never does."""
    common = both.dropna(subset=[a, b])
    sizes = common.groupBy(*keys).agg(F.count("*").alias("n"), F.avg((F.col(a) >= at).cast("double")).alias("frequency"))
    n = F.col("n")
    place = F.greatest(F.lit(1.0), F.least(n.cast("double"), (1 - F.col("frequency")) * (n + 1 / 3) + 1 / 3))
    sizes = sizes.withColumn("_at", place).withColumns({"_lo": F.floor("_at") - 1, "_hi": F.least(F.floor("_at"), n - 1)})
    found = order_statistics(common, keys, b, sizes.select(*keys, F.explode(F.array("_lo", "_hi")).alias("rank")))
    wide = joined(sizes, found, keys, "left").groupBy(*keys, "n", "frequency", "_at").agg(
        F.max(F.when(F.col("rank") == F.col("_lo"), F.col(b))).alias("_l"), F.max(F.when(F.col("rank") == F.col("_hi"), F.col(b))).alias("_h")
    )
    value = F.col("_l") + (F.col("_at") - F.floor("_at")) * (F.col("_h") - F.col("_l"))
    good = (F.col("n") >= least) & (F.col("frequency") > 0) & (F.col("frequency") < 1)
    return wide.select(*keys, "n", "frequency", F.when(good, F.round(value, 1)).alias("threshold"))


def yearly_frequency_r(both: DataFrame, keys: Sequence[str], day: str, a: Column, b: Column, days: int = 300, publish: int = 10) -> DataFrame:
    """years, r, low, high: correlation of two yearly frequencies over years of enough common days, with Fisher's limits;
    published: whether there are enough years."""
    part = lambda c: 100 * F.avg(c.cast("double"))
    years = both.groupBy(*keys, F.year(day).alias("_y")).agg(F.count("*").alias("_n"), part(a).alias("_a"), part(b).alias("_b")).filter(F.col("_n") >= days)
    out = years.groupBy(*keys).agg(F.count("*").alias("years"), correlation("_a", "_b").alias("r")).filter("years >= 4")
    z = F.atanh(F.greatest(F.lit(-0.999999), F.least(F.lit(0.999999), F.col("r"))))
    reach = 1.96 / F.sqrt(F.col("years") - 3)
    return out.withColumns({"low": F.tanh(z - reach), "high": F.tanh(z + reach), "published": F.col("years") >= publish})


def normals_trend(normals: DataFrame, station: str, period: str, start: str, value: str, distance: str, within: float = 40.0) -> DataFrame:
    """station, first, last, per_decade: change between a near station's first and last normals over their shift."""
    near = normals.filter((F.col(distance) <= within) & F.col(value).isNotNull())
    out = near.groupBy(station).agg(
        F.min_by(period, start).alias("first"), F.max_by(period, start).alias("last"), F.min(start).alias("_a"), F.max(start).alias("_b"),
        F.min_by(value, start).alias("_x"), F.max_by(value, start).alias("_y"), F.count("*").alias("_n"),
    )
    return out.filter("_n > 1").select(station, "first", "last", (10 * F.try_divide(F.col("_y") - F.col("_x"), F.col("_b") - F.col("_a"))).alias("per_decade"))


def zone_years(cells: DataFrame, year: str, zone: str, value: str, core: Column, rural: Column, share: float = 0.5, least_core: int = 200) -> DataFrame:
    """year, zone, median, mean, core, island: zone statistics where at least such a share of the cells has a value; core:
    the median of core cells where there are enough; island: the zone's median less that of the rural cells of the year."""
    enough = F.avg(F.col(value).isNotNull().cast("double")) >= share
    hit = F.when(core, F.col(value))
    zones = cells.groupBy(year, zone).agg(
        F.when(enough, F.median(value)).alias("median"), F.when(enough, F.avg(value)).alias("mean"), F.when(F.count(hit) >= least_core, F.median(hit)).alias("core")
    )
    ground = cells.filter(rural).groupBy(year).agg(F.median(value).alias("_r"))
    return zones.join(ground, year, "left").withColumn("island", F.col("median") - F.col("_r")).drop("_r")


def guideline_ratio(means: DataFrame, limits: DataFrame, key: str, value: str, limit: str = "limit") -> DataFrame:
    """Adds the limit and the ratio of the value to it; limits is a dimension of a row for each substance."""
    return means.join(limits.select(key, limit), key, "left").withColumn("ratio", F.try_divide(F.col(value), F.col(limit)))


def climatology_summary(months: DataFrame, keys: Sequence[str], month: str, value: str, years: tuple[int, int]) -> DataFrame:
    """calendar_month, mean, per_year (sum over the number of years), and mean_complete over years that have all months."""
    inside = months.filter(F.year(month).between(*years))
    sized = inside.withColumn("_c", F.count(value).over(Window.partitionBy(*keys, F.year(month))))
    return sized.groupBy(*keys, F.month(month).alias("calendar_month")).agg(
        F.avg(value).alias("mean"), (F.sum(value) / (years[1] - years[0] + 1)).alias("per_year"), F.avg(F.when(F.col("_c") == 12, F.col(value))).alias("mean_complete")
    )


def repair_summary(before: DataFrame, after: DataFrame, keys: Sequence[str], ts: str, value: str, top: int = 12) -> tuple[DataFrame, DataFrame]:
    """Counts of repaired rows by pass, decade and hour; and the rows of the largest corrections."""
    both = after.filter("repaired > 0").select(*keys, ts, "repaired", F.col(value).alias("new")).join(before.select(*keys, ts, F.col(value).alias("old")), [*keys, ts])
    counts = both.groupBy(*keys, "repaired", (F.floor(F.year(ts) / 10) * 10).alias("decade"), F.hour(ts).alias("hour")).agg(F.count("*").alias("n"))
    largest = both.withColumn("correction", F.col("new") - F.col("old")).orderBy(F.desc(F.abs("correction")), *keys, ts).limit(top)
    return counts, largest


def diurnal_contrast(daily: DataFrame, keys: Sequence[str], day: str, amplitude: str, peak: str, change: str) -> DataFrame:
    """Monthly means of amplitude and hour of the maximum, averaged before and from a date on, and their difference."""
    months = daily.groupBy(*keys, F.trunc(day, "month").alias("_m"), (F.col(day) >= F.lit(change).cast("date")).alias("_after")).agg(F.avg(amplitude).alias("_a"), F.avg(peak).alias("_p"))
    part = lambda c, after: F.avg(F.when(F.col("_after") == after, F.col(c)))
    out = months.groupBy(*keys).agg(part("_a", False).alias("amplitude_before"), part("_a", True).alias("amplitude_after"), part("_p", False).alias("hour_before"), part("_p", True).alias("hour_after"))
    return out.withColumns({"amplitude_change": F.col("amplitude_after") - F.col("amplitude_before"), "hour_change": F.col("hour_after") - F.col("hour_before")})


def shown_series(years: DataFrame, keys: Sequence[str], year: str, value: str, partial: str, reliable: str, change: int) -> DataFrame:
    """Series for a chart: partial years dropped, unreliable ones null, split into the part before a year and that from it."""
    good = F.when(F.col(reliable), F.col(value))
    return years.filter(~F.col(partial)).select(*keys, year, F.when(F.col(year) < change, good).alias("before"), F.when(F.col(year) >= change, good).alias("since"))


def lagged(months: DataFrame, keys: Sequence[str], month: str, value: str, lags: Sequence[int]) -> DataFrame:
    """Adds <value>_<k>: the value k calendar months earlier (by date, so that gaps stay gaps), and null where there is none."""
    out = months
    for k in lags:
        old = months.select(*keys, F.add_months(month, k).alias(month), F.col(value).alias(f"{value}_{k}"))
        out = out.join(old, [*keys, month], "left")
    return out


def lag_correlations(wide: DataFrame, keys: Sequence[str], target: str, value: str, lags: Sequence[int]) -> DataFrame:
    """lag, r, n: correlation of target with the lagged values and with the sum of the last two months (lag -1 stands for
    it), over months that have all of them."""
    full = wide.dropna(subset=[target, *[f"{value}_{k}" for k in lags]])
    parts = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"{value}_{k}").alias("_x")) for k in lags], F.struct(F.lit(-1).alias("lag"), (F.col(f"{value}_{lags[0]}") + F.col(f"{value}_{lags[1]}")).alias("_x")))
    long = full.select(*keys, target, F.inline(parts))
    return long.groupBy(*keys, "lag").agg(correlation(target, "_x").alias("r"), F.count("*").alias("n"))


def dry_months(wide: DataFrame, keys: Sequence[str], value: str, share: float = 1 / 3) -> DataFrame:
    """The rows whose value is at most the given percentile of their group's."""
    limits = percentiles(wide, keys, value, {"_q": share})
    return wide.join(limits, list(keys)).filter(F.col(value) <= F.col("_q")).drop("_q")


def detrended(df: DataFrame, keys: Sequence[str], x: str, y: str, name: str = "residual") -> DataFrame:
    """Adds what is left of y after its own line over x."""
    lines = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"))
    return df.join(lines, list(keys)).withColumn(name, F.col(y) - F.col("_a") - F.col("_b") * F.col(x)).drop("_a", "_b")


def correlation_matrix(df: DataFrame, keys: Sequence[str], columns: Sequence[str], least: int = 5) -> DataFrame:
    """first, second, r, n for each pair of columns, over rows that have both; null with fewer rows than least."""
    found = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    both = lambda a, b: F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1))
    wide = df.groupBy(*keys).agg(*[F.struct(correlation(a, b).alias("r"), both(a, b).alias("n")).alias(f"_{k}") for k, (a, b) in enumerate(found)])
    rows = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.when(F.col(f"_{k}.n") >= least, F.col(f"_{k}.r")).alias("r"), F.col(f"_{k}.n").alias("n")) for k, (a, b) in enumerate(found)])
    return wide.select(*keys, F.inline(rows))


def elapsed(day: Column, until: Column, days: int = 365) -> Column:
    """Whether a day lies within the last so many days up to a day."""
    return (day > F.date_sub(until, days)) & (day <= until)


def first_with_data(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(F.when(F.col(value).isNotNull(), F.col(day))).alias("first"))


def yearly_downloads(items: DataFrame, keys: Sequence[str], day: str, size: Column, bandwidth: float, latency: float, requests: int, limit_hours: float = 12.0) -> DataFrame:
    """n_year (from the median month), hours to fetch them, and a verdict: feasible, slow (up to twice the limit) or not."""
    months = items.groupBy(*keys, F.trunc(day, "month").alias("_m")).agg(F.count("*").alias("_n"), F.avg(size).alias("_b"))
    out = months.groupBy(*keys).agg((12 * F.median("_n")).alias("n_year"), F.avg("_b").alias("bytes"))
    hours = F.col("n_year") * (F.col("bytes") / bandwidth + requests * latency) / 3600
    verdict = F.when(F.col("hours") <= limit_hours, "feasible").when(F.col("hours") <= 2 * limit_hours, "slow").otherwise("not feasible")
    return out.withColumn("hours", hours).withColumn("verdict", verdict)


