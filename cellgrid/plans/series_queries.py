"""Queries of trends, annual tables and comparisons of series."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cellgrid.functions import text as X
from cellgrid.operators import climate as K
from cellgrid.operators import series, trends
from cellgrid.plans import adapter as D
from cellgrid.plans.registry import SPIKES, query, rounded
from cellgrid.session import read_table, shared_folder
from cellgrid.streaming.daily import trailing_stream

ODAYS = """odays AS (SELECT o_orderstatus AS var, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS mean, max(o_totalprice) AS high,
    min(o_totalprice) AS low, sum(o_totalprice) AS rain, count(*) AS n FROM orders GROUP BY 1, 2)"""
STEPS = "m AS (SELECT var, (year(month) - 1995) * 12 + month(month) AS t, value FROM monthly)"


def odays(spark, sf_dir):
    v = F.col("o_totalprice")
    orders = read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("var"), F.to_date("o_orderdate").alias("day"))
    return orders.agg(F.avg(v).alias("mean"), F.max(v).alias("high"), F.min(v).alias("low"), F.sum(v).alias("rain"), F.count("*").alias("n"))


def steps(spark, sf_dir):
    return D.monthly(spark, sf_dir).select("var", ((F.year("month") - 1995) * 12 + F.month("month")).alias("t"), "value")


def sen_sql(table: str, x: str, scale: float) -> str:
    return f"""p AS (SELECT a.var, (b.value - a.value) / (b.{x} - a.{x}) AS s, sign(b.value - a.value) AS g FROM {table} a JOIN {table} b ON a.var = b.var AND a.{x} < b.{x}),
    o AS (SELECT var, list(s ORDER BY s) AS v, median(s) AS mid, CAST(sum(g) AS DOUBLE) AS sg, count(*) AS k FROM p GROUP BY var),
    ti AS (SELECT var, sum(c) AS n, sum(c * (c - 1) * (2 * c + 5)) AS ties FROM (SELECT var, value, count(*) AS c FROM {table} GROUP BY 1, 2) GROUP BY var),
    kd AS (SELECT o.*, n, (n * (n - 1) * (2 * n + 5) - ties) / 18.0 AS vr FROM o JOIN ti USING (var)),
    sn AS (SELECT *, {scale} * mid AS sen, {scale} * v[CAST(greatest(CAST(round((k - 1.959963984540054 * sqrt(vr)) / 2) AS INTEGER) - 1, 0) + 1 AS INTEGER)] AS sen_low,
        {scale} * v[CAST(least(CAST(round((k + 1.959963984540054 * sqrt(vr)) / 2) AS INTEGER), k - 1) + 1 AS INTEGER)] AS sen_high,
        CASE WHEN sg = 0 THEN 0 ELSE (sg - sign(sg)) / sqrt(vr) END AS z, sg / (n * (n - 1) / 2) AS tau FROM kd)"""


@query(f"""WITH {D.MONTHLY}, {STEPS}, {sen_sql("m", "t", 10.0)},
    l AS (SELECT var, count(*) AS n, min(t) AS first, max(t) AS last, regr_slope(value, t) AS b, regr_intercept(value, t) AS a, regr_r2(value, t) AS r2, regr_sxx(value, t) AS sxx FROM m GROUP BY var HAVING count(*) >= 10),
    e AS (SELECT m.var, value - (a + b * t) AS e, lag(value - (a + b * t)) OVER (PARTITION BY m.var ORDER BY t) AS p FROM m JOIN l USING (var)),
    r AS (SELECT var, corr(e, p) FILTER (p IS NOT NULL) AS r1, sum(e * e) AS ss FROM e GROUP BY var)
    SELECT l.var, l.n, first, last, round(10 * b, 4) AS slope, round(sqrt(ss / (l.n - 2) / sxx), 5) AS se, round(r2, 6) AS r2, round(r1, 5) AS ar1, round(CASE WHEN r1 > 0 THEN l.n * (1 - r1) / (1 + r1) ELSE l.n END, 4) AS n_eff,
    round(sen, 4) AS sen, round(sen_low, 4) AS sen_low, round(sen_high, 4) AS sen_high, sg AS s, round(z, 5) AS z, round(tau, 6) AS tau FROM l JOIN r USING (var) JOIN sn USING (var)""")
def trend_record(spark, sf_dir):
    out = trends.record(steps(spark, sf_dir), ["var"], "t", "value")
    out = rounded(rounded(rounded(out, "slope", "n_eff", "sen", "sen_low", "sen_high"), "se", "ar1", "z", digits=5), "r2", "tau", digits=6)
    return out.select("var", "n", "first", "last", "slope", "se", "r2", "ar1", "n_eff", "sen", "sen_low", "sen_high", "s", "z", "tau")


@query()
def trend_tests(spark, sf_dir):
    """The p values and limits of trend_record, which need distributions that SQL lacks."""
    out = trends.record(steps(spark, sf_dir), ["var"], "t", "value")
    names = ["p_line", "p_ar1", "p_kendall", "slope_low", "slope_high", "ar1_low", "ar1_high"]
    return rounded(out, *names, digits=5).select("var", *names, "significant", "significant_ar1")


@query(f"""WITH {D.YEARLY}, {sen_sql("yearly", "year", 10.0)} SELECT var, CAST(n AS BIGINT) AS n, round(sen, 4) AS sen, round(sen_low, 4) AS sen_low, round(sen_high, 4) AS sen_high, round(tau, 6) AS tau FROM sn WHERE n >= 6""")
def sen_short(spark, sf_dir):
    out = trends.short(D.yearly(spark, sf_dir), ["var"], "year", "value")
    return rounded(rounded(out, "sen", "sen_low", "sen_high"), "tau", digits=6).select("var", "n", "sen", "sen_low", "sen_high", "tau")


_FLAGGED = """f AS (SELECT o_orderpriority AS var, year(o_orderdate) AS year, avg(o_totalprice) AS value, count(*) > 300 AS reliable FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2)"""


@query(f"""WITH {_FLAGGED} SELECT var, year, round(CASE WHEN reliable THEN CASE WHEN year < 1998 THEN value + CASE WHEN var = '5-LOW' THEN NULL ELSE 250.0 END ELSE value END END, 4) AS value FROM f""")
def harmonised_offset(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    years = orders.groupBy(F.col("o_orderpriority").alias("var"), F.year("o_orderdate").alias("year")).agg(F.avg("o_totalprice").alias("value"), (F.count("*") > 300).alias("reliable"))
    offset = F.when(F.col("var") != "5-LOW", 250.0)
    return rounded(years.select("var", "year", trends.harmonised(F.col("value"), F.col("year"), F.col("reliable"), 1998, offset).alias("value")), "value")


@query(f"""WITH {D.CELLS}, v AS (SELECT class AS var, CAST(zone % 4 AS INTEGER) AS variant, regr_slope(value, dist) AS slope, abs(regr_slope(value, dist)) > 0.2 AS hit FROM cells GROUP BY 1, 2)
    SELECT var, round(min(slope), 6) AS lowest, round(max(slope), 6) AS highest, count(*) AS variants, count(*) FILTER (hit) AS hits,
    (count(*) FILTER (hit) = count(*) AND count(DISTINCT sign(slope)) FILTER (hit) = 1) OR count(*) FILTER (hit) = 0 AS robust FROM v GROUP BY var""")
def robust_over_variants(spark, sf_dir):
    parts = D.cells(spark, sf_dir).groupBy(F.col("class").alias("var"), (F.col("zone") % 4).alias("variant")).agg(F.regr_slope("value", "dist").alias("slope"))
    out = trends.robust(parts.withColumn("hit", F.abs("slope") > 0.2), ["var"], "slope", "hit")
    return rounded(out, "lowest", "highest", digits=6)


_DUMMY = "CASE WHEN t >= 40 THEN 1.0 ELSE 0.0 END"


@query(f"""WITH {D.MONTHLY}, {STEPS}, d AS (SELECT *, {_DUMMY} AS d FROM m),
    s AS (SELECT var, count(*) AS n, var_pop(t) AS vt, var_pop(d) AS vd, covar_pop(t, d) AS ctd, covar_pop(t, value) AS cty, covar_pop(d, value) AS cdy, avg(t) AS mt, avg(d) AS md, avg(value) AS my, var_pop(value) AS vy FROM d GROUP BY var),
    c AS (SELECT *, (cty * vd - cdy * ctd) / (vt * vd - ctd * ctd) AS b1, (cdy * vt - cty * ctd) / (vt * vd - ctd * ctd) AS b2 FROM s),
    e AS (SELECT *, n * (vy - b1 * cty - b2 * cdy) / (n - 3) AS sigma FROM c)
    SELECT var, n, round(10 * b1, 3) AS slope, round(10 * sqrt(sigma * vd / (n * (vt * vd - ctd * ctd))), 3) AS slope_se, round(b2, 3) AS step, round(sqrt(sigma * vt / (n * (vt * vd - ctd * ctd))), 3) AS step_se FROM e""")
def step_and_slope(spark, sf_dir):
    out = trends.step_and_slope(steps(spark, sf_dir), ["var"], "t", "value", F.col("t") >= 40)
    return rounded(out, "slope", "slope_se", "step", "step_se", digits=3)


@query()
def scene_bootstrap(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").filter("l_returnflag in ('A', 'N')")
    stack = items.select("l_returnflag", F.trunc("l_shipdate", "month").alias("scene"), (F.col("l_suppkey") % 50).alias("cell"), (F.col("l_suppkey") % 5).alias("zone"), "l_extendedprice")
    return rounded(trends.scene_bootstrap(stack, "l_returnflag", "scene", "cell", "zone", "l_extendedprice"), "difference", "low", "high")


@query(f"""WITH {ODAYS}, five AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY var ORDER BY day) >= 5 AND count(rain) OVER w = 5 THEN sum(rain) OVER w END AS f FROM odays WINDOW w AS (PARTITION BY var ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
    mo AS (SELECT var, year(day) AS year, last_day(day) AS l, count(rain) AS c, sum(rain) AS s FROM odays GROUP BY 1, 2, 3),
    mm AS (SELECT var, year, count(*) FILTER (c = day(l)) AS months, sum(s) FILTER (c = day(l)) AS t FROM mo GROUP BY 1, 2),
    y AS (SELECT var, year(day) AS year, avg(mean) AS mean, avg(high) AS mean_high, avg(low) AS mean_low, max(high) AS highest, min(low) AS lowest, sum(rain) AS total, max(rain) AS wettest_day, max(f) AS wettest_five,
        count(*) FILTER (high >= 300000) AS hot_days, max(day) FILTER (mean IS NOT NULL) AS until, least(count(mean), count(rain)) / dayofyear(make_date(year(day), 12, 31)) AS completeness FROM five GROUP BY var, year(day))
    SELECT var, year, round(mean, 4) AS mean, round(mean_high, 4) AS mean_high, round(mean_low, 4) AS mean_low, highest, lowest, round(total, 2) AS total, round(wettest_day, 2) AS wettest_day, round(wettest_five, 2) AS wettest_five,
    hot_days, until, months, round(completeness, 6) AS completeness, completeness < 1 AS partial, round(CASE WHEN months = 12 THEN t END, 2) AS full_total FROM y JOIN mm USING (var, year)""", dates=("until",))
def annual_table(spark, sf_dir):
    out = K.annual_table(odays(spark, sf_dir), ["var"], "day", "mean", "high", "low", "rain", 300000)
    return rounded(rounded(rounded(out, "mean", "mean_high", "mean_low"), "total", "wettest_day", "wettest_five", "full_total", digits=2), "completeness", digits=6)


_REGIME = "CASE WHEN day = DATE '1997-03-01' THEN 'change_b' WHEN day < DATE '1997-03-01' THEN 'a' WHEN day = DATE '1999-07-10' THEN 'change_c' WHEN day < DATE '1999-07-10' THEN 'b' ELSE 'c' END"


def _with_regime(spark, sf_dir):
    table = spark.createDataFrame([("1990-01-01", "a"), ("1997-03-01", "b"), ("1999-07-10", "c")], "s string, regime string").select(F.to_date("s").alias("start"), "regime")
    return series.regimes(odays(spark, sf_dir).select("var", "day", F.col("mean").alias("value")), table, "day")


@query(f"""WITH {ODAYS}, d AS (SELECT var, day, mean AS value, {_REGIME} AS regime, year(day) AS period FROM odays)
    SELECT var, period, count(*) AS days, count(value) AS valid, round(avg(value), 4) AS mean, round(quantile_cont(value, 0.99), 4) AS p99, max(value) AS highest, count(*) FILTER (value > 200000) AS day_limit,
    count(*) FILTER (value * 1.1 > 200000) AS day_limit_corrected, round(count(*) FILTER (value > 200000) * 365.0 / greatest(count(value), 1), 6) AS day_limit_per_365,
    count(*) FILTER (regime = 'b') AS in_b, count(DISTINCT replace(regime, 'change_', '')) > 1 AS mixed FROM d GROUP BY 1, 2""")
def period_blocks(spark, sf_dir):
    out = K.period_blocks(_with_regime(spark, sf_dir), ["var"], F.year("day"), "value", "regime", {"day_limit": 200000.0}, 1.1)
    out = out.withColumn("in_b", F.coalesce(F.try_element_at("regimes", F.lit("b")), F.lit(0)).cast("long")).drop("regimes")
    return rounded(rounded(out, "mean", "p99"), "day_limit_per_365", digits=6)


@query(f"""WITH {ODAYS}, d AS (SELECT var, day, mean AS value, {_REGIME} AS regime FROM odays),
    s AS (SELECT *, avg(value) OVER b AS x, count(value) OVER b AS nb, avg(value) OVER a AS y, count(value) OVER a AS na,
        min(regime) OVER r = max(regime) OVER r AND count(*) OVER r = 61 AND NOT starts_with(regime, 'change_') AS calm FROM d
        WINDOW b AS (PARTITION BY var ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY var ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING), r AS (PARTITION BY var ORDER BY day ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING)),
    c AS (SELECT var, day, regime, calm, CASE WHEN nb >= 25 AND na >= 25 AND y / x > 0 THEN ln(y / x) END AS c FROM s),
    n AS (SELECT * FROM c WHERE calm AND c IS NOT NULL), q AS (SELECT var, quantile_cont(c, 0.025) AS lo, quantile_cont(c, 0.975) AS hi, count(*) AS windows FROM n GROUP BY var),
    e AS (SELECT * FROM c WHERE starts_with(regime, 'change_') AND c IS NOT NULL),
    p AS (SELECT e.var, e.day, 100 * avg(CASE WHEN n.c <= e.c THEN 1.0 ELSE 0.0 END) AS percentile FROM e JOIN n USING (var) GROUP BY 1, 2),
    o AS (SELECT e.var, e.day, max(abs(n.c)) AS most FROM e JOIN n ON n.var = e.var AND strftime(n.day, '%m-%d') = strftime(e.day, '%m-%d') AND year(n.day) <> year(e.day) GROUP BY 1, 2)
    SELECT e.var, e.day, regime, round(c, 6) AS change, windows, round(percentile, 6) AS percentile, c < lo OR c > hi AS outside, (c < lo OR c > hi) AND abs(c) > coalesce(most, 0) AS unusual
    FROM e JOIN q USING (var) JOIN p USING (var, day) LEFT JOIN o USING (var, day)""", dates=("day",))
def change_against_null(spark, sf_dir):
    changes = K.window_changes(_with_regime(spark, sf_dir), ["var"], "day", "value", "regime").checkpoint()
    return rounded(K.change_against_null(changes, ["var"], "day", "regime"), "change", "percentile", digits=6)


@query(f"""WITH {ODAYS}, d AS (SELECT var, day, mean AS value, {_REGIME} AS regime FROM odays), l AS (SELECT d.*, assumption, value * f AS v FROM d, (VALUES ('bound', 0.9), ('shared', 1.02)) AS t(assumption, f)),
    m AS (SELECT var, assumption, avg(value) FILTER (regime = 'a') AS old_mean, avg(v) FILTER (regime = 'b') AS new_mean FROM l GROUP BY 1, 2), c AS (SELECT *, 100 * (new_mean / old_mean - 1) AS change_pct FROM m)
    SELECT var, assumption, round(old_mean, 4) AS old_mean, round(new_mean, 4) AS new_mean, round(change_pct, 6) AS change_pct, min(sign(change_pct)) OVER w = max(sign(change_pct)) OVER w AS agree FROM c WINDOW w AS (PARTITION BY var)""")
def regime_scenarios(spark, sf_dir):
    out = K.regime_scenarios(_with_regime(spark, sf_dir), ["var"], "value", "regime", "a", "b", {"bound": F.col("value") * 0.9, "shared": F.col("value") * 1.02})
    return rounded(rounded(out, "old_mean", "new_mean"), "change_pct", digits=6)


@query(f"""WITH {D.HOURLY}, h AS (SELECT *, max(ts) FILTER (value IS NOT NULL) OVER (PARTITION BY var) AS l, count(*) OVER (PARTITION BY var, CAST(ts AS DATE)) AS c FROM hourly),
    k AS (SELECT * FROM h WHERE c = 24 AND (CAST(ts AS DATE) < CAST(l AS DATE) OR (CAST(ts AS DATE) = CAST(l AS DATE) AND hour(l) = 23)))
    SELECT var, ts, coalesce(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY var ORDER BY ts)) = 3600, true) AS steady FROM k""")
def whole_days(spark, sf_dir):
    return K.trimmed(D.hourly(spark, sf_dir), ["var"], "ts", "value").select("var", "ts", "steady")


_STATION = f"WITH {ODAYS}, a AS (SELECT day, mean AS value, n + 15 AS hours FROM odays WHERE var = 'F'), b AS (SELECT day, mean AS value FROM odays WHERE var = 'O'), c AS (SELECT day, mean AS value FROM odays WHERE var = 'P')"


def _three(spark, sf_dir):
    days = odays(spark, sf_dir)
    part = lambda v: days.filter(F.col("var") == v).select("day", F.col("mean").alias("value"), (F.col("n") + 15).alias("hours"))
    return part("F"), part("O"), part("P")


@query(_STATION + """ SELECT year(a.day) || CASE WHEN month(a.day) > 6 THEN '-S2' ELSE '-S1' END AS semester, count(*) AS days, round(avg(a.value - b.value), 4) AS bias
    FROM a JOIN b USING (day) WHERE a.hours BETWEEN 18 AND 24 AND a.value BETWEEN 50000 AND 300000 GROUP BY 1""")
def half_year_bias(spark, sf_dir):
    a, b, _ = _three(spark, sf_dir)
    return rounded(K.half_year_bias(a, b, [], "day", "value", "hours", 50000, 300000), "bias")


@query(_STATION + """ SELECT day, round(a.value, 6) AS a, round(b.value, 6) AS b, round(c.value, 6) AS c FROM a JOIN b USING (day) JOIN c USING (day)""", dates=("day",))
def three_series_days(spark, sf_dir):
    return rounded(K.common_days(*_three(spark, sf_dir), [], "day", "value"), "a", "b", "c", digits=6)


@query(_STATION + """, j AS (SELECT day, a.value AS x, b.value AS y, a.value - avg(a.value) OVER m AS u, b.value - avg(b.value) OVER m AS v FROM a JOIN b USING (day) WINDOW m AS (PARTITION BY month(day)))
    SELECT count(*) AS n, round(avg(x - y), 4) AS bias, round(corr(x, y), 6) AS r, round(corr(u, v), 6) AS r_anomaly FROM j""")
def station_scores(spark, sf_dir):
    both = K.common_days(*_three(spark, sf_dir)[:2], _three(spark, sf_dir)[0], [], "day", "value")
    return rounded(rounded(K.station_scores(both, [], "day", "a", "b"), "bias"), "r", "r_anomaly", digits=6)


@query(_STATION + """, l AS (SELECT count(*) AS n, avg(CASE WHEN a.value >= 170000 THEN 1.0 ELSE 0.0 END) AS frequency, list(b.value ORDER BY b.value) AS v FROM a JOIN b USING (day)),
    h AS (SELECT *, greatest(1, least(n, (1 - frequency) * (n + 1 / 3.0) + 1 / 3.0)) AS h FROM l)
    SELECT n, round(frequency, 8) AS frequency, CASE WHEN n >= 365 AND frequency > 0 AND frequency < 1 THEN round(v[CAST(floor(h) AS INTEGER)] + (h - floor(h)) * (v[CAST(least(floor(h) + 1, n) AS INTEGER)] - v[CAST(floor(h) AS INTEGER)]), 1) END AS threshold FROM h""")
def matched_threshold(spark, sf_dir):
    both = K.common_days(*_three(spark, sf_dir)[:2], _three(spark, sf_dir)[0], [], "day", "value")
    return rounded(K.matched_threshold(both, [], "a", "b", 170000), "frequency", digits=8)


@query(_STATION + """, y AS (SELECT year(day) AS y, 100 * avg(CASE WHEN a.value >= 170000 THEN 1.0 ELSE 0.0 END) AS p, 100 * avg(CASE WHEN b.value > 165000 THEN 1.0 ELSE 0.0 END) AS q FROM a JOIN b USING (day) GROUP BY 1 HAVING count(*) >= 60),
    r AS (SELECT count(*) AS years, corr(p, q) AS r FROM y HAVING count(*) >= 4)
    SELECT years, round(r, 6) AS r, round(tanh(atanh(greatest(-0.999999, least(0.999999, r))) - 1.96 / sqrt(years - 3)), 6) AS low, round(tanh(atanh(greatest(-0.999999, least(0.999999, r))) + 1.96 / sqrt(years - 3)), 6) AS high, years >= 10 AS published FROM r""")
def yearly_frequency_r(spark, sf_dir):
    both = K.common_days(*_three(spark, sf_dir)[:2], _three(spark, sf_dir)[0], [], "day", "value")
    return rounded(K.yearly_frequency_r(both, [], "day", F.col("a") >= 170000, F.col("b") > 165000, days=60), "r", "low", "high", digits=6)


@query("""WITH n AS (SELECT c_nationkey AS station, c_mktsegment AS period, 1901 + 10 * (ascii(c_mktsegment) - 65) AS start, avg(c_acctbal) AS value, min((c_nationkey * 7) % 60) AS km FROM customer GROUP BY 1, 2),
    k AS (SELECT * FROM n WHERE km <= 40 AND value IS NOT NULL) SELECT station, arg_min(period, start) AS first, arg_max(period, start) AS last,
    round(10 * (arg_max(value, start) - arg_min(value, start)) / (max(start) - min(start)), 6) AS per_decade FROM k GROUP BY station HAVING count(*) > 1""")
def normals_trend(spark, sf_dir):
    start = (1901 + 10 * (F.ascii("c_mktsegment") - 65)).alias("start")
    normals = read_table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("station"), F.col("c_mktsegment").alias("period"), start)
    normals = normals.agg(F.avg("c_acctbal").alias("value"), F.min((F.col("c_nationkey") * 7) % 60).alias("km"))
    return rounded(K.normals_trend(normals, "station", "period", "start", "value", "km"), "per_decade", digits=6)


_YEARS = f"WITH {D.CELLS}, y AS (SELECT 2000 + row % 4 AS year, zone, CASE WHEN cell_id % 5 <> 0 OR zone % 7 = 0 AND cell_id % 2 = 0 THEN value END AS value, dist FROM cells)"


@query(_YEARS + """, z AS (SELECT year, zone, CASE WHEN avg(CASE WHEN value IS NOT NULL THEN 1.0 ELSE 0.0 END) >= 0.5 THEN median(value) END AS median, CASE WHEN avg(CASE WHEN value IS NOT NULL THEN 1.0 ELSE 0.0 END) >= 0.5 THEN avg(value) END AS mean,
    CASE WHEN count(value) FILTER (dist < 700) >= 8 THEN median(value) FILTER (dist < 700) END AS core FROM y GROUP BY 1, 2), r AS (SELECT year, median(value) AS r FROM y WHERE dist >= 900 GROUP BY 1)
    SELECT z.year, zone, round(median, 4) AS median, round(mean, 4) AS mean, round(core, 4) AS core, round(median - r, 4) AS island FROM z LEFT JOIN r USING (year)""")
def zone_years(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    gap = (F.col("cell_id") % 5 != 0) | ((F.col("zone") % 7 == 0) & (F.col("cell_id") % 2 == 0))
    years = cells.select((2000 + F.col("row") % 4).alias("year"), "zone", F.when(gap, F.col("value")).alias("value"), "dist")
    return rounded(K.zone_years(years, "year", "zone", "value", F.col("dist") < 700, F.col("dist") >= 900, least_core=8), "median", "mean", "core", "island")


@query("""WITH m AS (SELECT event_type AS var, avg(value) AS value FROM events GROUP BY 1), l AS (SELECT * FROM (VALUES ('click', 15.0), ('view', 40.0)) AS t(var, "limit"))
    SELECT m.var, round(value, 6) AS value, "limit", round(value / "limit", 6) AS ratio FROM m LEFT JOIN l USING (var)""")
def guideline_ratio(spark, sf_dir):
    means = read_table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("var")).agg(F.avg("value").alias("value"))
    limits = spark.createDataFrame([("click", 15.0), ("view", 40.0)], "var string, limit double")
    return rounded(K.guideline_ratio(means, limits, "var", "value"), "value", "ratio", digits=6)


@query(f"""WITH {D.MONTHLY}, s AS (SELECT *, count(value) OVER (PARTITION BY var, year(month)) AS c FROM monthly WHERE year(month) BETWEEN 1996 AND 2001)
    SELECT var, month(month) AS calendar_month, round(avg(value), 4) AS mean, round(sum(value) / 6, 4) AS per_year, round(avg(value) FILTER (c = 12), 4) AS mean_complete FROM s GROUP BY 1, 2""")
def climatology_summary(spark, sf_dir):
    return rounded(K.climatology_summary(D.monthly(spark, sf_dir), ["var"], "month", "value", (1996, 2001)), "mean", "per_year", "mean_complete")


@query(f"WITH {SPIKES} SELECT var, repaired, CAST(year(ts) // 10 * 10 AS BIGINT) AS decade, hour(ts) AS hour, count(*) AS n FROM s3 WHERE repaired > 0 GROUP BY ALL")
def repair_counts(spark, sf_dir):
    hours = D.hourly(spark, sf_dir)
    return K.repair_summary(hours, series.repair_spikes(hours, ["var"], "ts", "value", 40), ["var"], "ts", "value")[0]


@query(f"""WITH {SPIKES}, j AS (SELECT s3.var, s3.ts, repaired, round(s3.value, 6) AS new, round(hourly.value, 6) AS old, s3.value - hourly.value AS correction FROM s3 JOIN hourly USING (var, ts) WHERE repaired > 0)
    SELECT * REPLACE (round(correction, 6) AS correction) FROM (SELECT * FROM j ORDER BY abs(correction) DESC, var, ts LIMIT 12)""")
def repair_largest(spark, sf_dir):
    hours = D.hourly(spark, sf_dir)
    return rounded(K.repair_summary(hours, series.repair_spikes(hours, ["var"], "ts", "value", 40), ["var"], "ts", "value")[1], "new", "old", "correction", digits=6)


@query(f"""WITH {D.HOURLY}, d AS (SELECT var, CAST(ts AS DATE) AS day, max(value) - avg(value) AS a, min(hour(ts)) FILTER (value = m) AS p FROM (SELECT *, max(value) OVER (PARTITION BY var, CAST(ts AS DATE)) AS m FROM hourly) GROUP BY 1, 2),
    mo AS (SELECT var, day >= DATE '2024-01-16' AS after, avg(a) AS a, avg(p) AS p FROM d GROUP BY var, date_trunc('month', day), 2),
    x AS (SELECT var, avg(a) FILTER (NOT after) AS amplitude_before, avg(a) FILTER (after) AS amplitude_after, avg(p) FILTER (NOT after) AS hour_before, avg(p) FILTER (after) AS hour_after FROM mo GROUP BY var)
    SELECT var, round(amplitude_before, 6) AS amplitude_before, round(amplitude_after, 6) AS amplitude_after, round(hour_before, 6) AS hour_before, round(hour_after, 6) AS hour_after,
    round(amplitude_after - amplitude_before, 6) AS amplitude_change, round(hour_after - hour_before, 6) AS hour_change FROM x""")
def diurnal_contrast(spark, sf_dir):
    daily = series.diurnal(D.hourly(spark, sf_dir), ["var"], "ts", "value")
    out = K.diurnal_contrast(daily, ["var"], "day", "amplitude", "peak_hour", "2024-01-16")
    return rounded(out, *[c for c in out.columns if c != "var"], digits=6)


@query(f"""WITH {_FLAGGED} SELECT var, year, round(CASE WHEN year < 1998 AND reliable THEN value END, 4) AS before, round(CASE WHEN year >= 1998 AND reliable THEN value END, 4) AS since FROM f WHERE year < 2001""")
def chart_series(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    years = orders.groupBy(F.col("o_orderpriority").alias("var"), F.year("o_orderdate").alias("year")).agg(F.avg("o_totalprice").alias("value"), (F.count("*") > 300).alias("reliable"))
    return rounded(K.shown_series(years.withColumn("partial", F.col("year") >= 2001), ["var"], "year", "value", "partial", "reliable", 1998), "before", "since")


_LAGS = f"""{D.MONTHLY}, w AS (SELECT a.var, a.month, a.value, b0.value AS value_0, b1.value AS value_1, b2.value AS value_2 FROM monthly a LEFT JOIN monthly b0 ON b0.var = a.var AND b0.month = a.month
    LEFT JOIN monthly b1 ON b1.var = a.var AND b1.month + INTERVAL 1 MONTH = a.month LEFT JOIN monthly b2 ON b2.var = a.var AND b2.month + INTERVAL 2 MONTH = a.month)"""


@query(f"WITH {_LAGS} SELECT var, month, round(value, 4) AS value, round(value_0, 4) AS value_0, round(value_1, 4) AS value_1, round(value_2, 4) AS value_2 FROM w", dates=("month",))
def lagged_months(spark, sf_dir):
    return rounded(K.lagged(D.monthly(spark, sf_dir), ["var"], "month", "value", (0, 1, 2)), "value", "value_0", "value_1", "value_2")


@query(f"""WITH {_LAGS}, x AS (SELECT w.*, (m.value * (1 + month(w.month) / 10.0)) AS y FROM w JOIN monthly m ON m.var = w.var AND m.month = w.month WHERE value_1 IS NOT NULL AND value_2 IS NOT NULL),
    l AS (SELECT var, y, 0 AS lag, value_0 AS x FROM x UNION ALL SELECT var, y, 1, value_1 FROM x UNION ALL SELECT var, y, 2, value_2 FROM x UNION ALL SELECT var, y, -1, value_0 + value_1 FROM x)
    SELECT var, lag, round(corr(y, x), 6) AS r, count(*) AS n FROM l GROUP BY 1, 2""")
def lag_correlations(spark, sf_dir):
    wide = K.lagged(D.monthly(spark, sf_dir), ["var"], "month", "value", (0, 1, 2)).withColumn("y", F.col("value") * (1 + F.month("month") / 10.0))
    return rounded(K.lag_correlations(wide, ["var"], "y", "value", (0, 1, 2)), "r", digits=6)


@query(f"WITH {D.MONTHLY}, q AS (SELECT var, quantile_cont(value, 1 / 3.0) AS q FROM monthly GROUP BY var) SELECT monthly.var, month FROM monthly JOIN q USING (var) WHERE value <= q", dates=("month",))
def dry_months(spark, sf_dir):
    return K.dry_months(D.monthly(spark, sf_dir), ["var"], "value").select("var", "month")


@query(f"WITH {D.MONTHLY}, {STEPS}, l AS (SELECT var, regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM m GROUP BY var) SELECT var, t, round(value - a - b * t, 4) AS residual FROM m JOIN l USING (var)")
def detrended(spark, sf_dir):
    return rounded(K.detrended(steps(spark, sf_dir), ["var"], "t", "value"), "residual").select("var", "t", "residual")


@query(f"""WITH {ODAYS} SELECT var, 'mean' AS first, 'high' AS second, round(corr(mean, high), 6) AS r, count(*) AS n FROM odays GROUP BY var UNION ALL SELECT var, 'mean', 'low', round(corr(mean, low), 6), count(*) FROM odays GROUP BY var
    UNION ALL SELECT var, 'high', 'low', round(corr(high, low), 6), count(*) FROM odays GROUP BY var""")
def correlation_matrix(spark, sf_dir):
    return rounded(K.correlation_matrix(odays(spark, sf_dir), ["var"], ["mean", "high", "low"]), "r", digits=6)


@query(f"WITH {ODAYS} SELECT var, day FROM odays WHERE day > DATE '2001-07-31' - 365 AND day <= DATE '2001-07-31'", dates=("day",))
def last_year_window(spark, sf_dir):
    return odays(spark, sf_dir).filter(K.elapsed(F.col("day"), F.lit("2001-07-31").cast("date"))).select("var", "day")


@query(f"WITH {D.DAILY} SELECT var, min(day) FILTER (mean IS NOT NULL) AS first FROM daily GROUP BY var", dates=("first",))
def first_with_data(spark, sf_dir):
    return K.first_with_data(series.daily(D.hourly(spark, sf_dir), ["var"], "ts", "value"), ["var"], "day", "mean")


@query("""WITH m AS (SELECT o_orderpriority AS var, date_trunc('month', o_orderdate) AS m, count(*) AS n, avg(o_totalprice) AS b FROM orders GROUP BY 1, 2), y AS (SELECT var, 12 * median(n) AS n_year, avg(b) AS bytes FROM m GROUP BY 1),
    h AS (SELECT *, n_year * (bytes / 10000.0 + 3 * 0.9) / 3600 AS hours FROM y)
    SELECT var, n_year, round(bytes, 4) AS bytes, round(hours, 6) AS hours, CASE WHEN hours <= 12 THEN 'feasible' WHEN hours <= 24 THEN 'slow' ELSE 'not feasible' END AS verdict FROM h""")
def yearly_downloads(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "var")
    return rounded(rounded(K.yearly_downloads(orders, ["var"], "o_orderdate", F.col("o_totalprice"), 10000.0, 0.9, 3), "bytes"), "hours", digits=6)


@query(f"WITH {D.CELLS} SELECT cell_id, round(value * {K.reference_factor(919.0)!r}, 6) AS corrected FROM cells")
def reference_factor(spark, sf_dir):
    return D.cells(spark, sf_dir).select("cell_id", F.round(F.col("value") * K.reference_factor(919.0), 6).alias("corrected"))


@query("""SELECT o_orderkey, quarter(o_orderdate) AS quarter, month(o_orderdate) IN (1, 2, 7, 8) AS dry, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS before, day(last_day(o_orderdate)) AS days FROM orders""", dates=("before",))
def month_arithmetic(spark, sf_dir):
    day = F.col("o_orderdate")
    return read_table(spark, sf_dir, "orders").select("o_orderkey", F.quarter(day).alias("quarter"), F.month(day).isin(1, 2, 7, 8).alias("dry"), X.month_before(day).alias("before"), X.days_in_month(day).alias("days"))


@query(f"""WITH {D.HOURLY} SELECT var, CAST(epoch(ts) AS BIGINT) AS at, round(CASE WHEN row_number() OVER (PARTITION BY var ORDER BY ts) >= 8 AND count(value) OVER w >= 6 THEN avg(value) OVER w END, 9) AS trailing
    FROM hourly WINDOW w AS (PARTITION BY var ORDER BY ts ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""")
def streaming_trailing(spark, sf_dir):
    """The trailing mean as a stateful stream over the hourly table, which is written to the shared folder first."""
    where = f"{shared_folder(spark)}/hourly-{uuid.uuid4().hex}"
    D.hourly(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(where)
    return rounded(trailing_stream(spark, where, "var", "ts", "value"), "trailing", digits=9).select("var", F.unix_timestamp("ts").alias("at"), "trailing")


@query(f"""WITH {D.CELLS}, s AS (SELECT class, avg(value) FILTER (weight < 3) AS m0, avg(value) FILTER (weight >= 3) AS m1, count(value) FILTER (weight < 3) AS n0, count(value) FILTER (weight >= 3) AS n1 FROM cells GROUP BY class)
    SELECT class, round(m1 - m0, 4) AS change, n0, n1 FROM s WHERE n0 >= 3 AND n1 >= 3""")
def before_after(spark, sf_dir):
    return rounded(trends.before_after(D.cells(spark, sf_dir), ["class"], F.col("weight") >= 3, "value"), "change").select("class", "change", "n0", "n1")
