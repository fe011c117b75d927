"""Every query of the library by name, with its DuckDB SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.functions import cells as C
from cellgrid.functions import text as X
from cellgrid.operators import aggregate as A
from cellgrid.operators import allocate, flow, joins, raster, score, series, stats
from cellgrid.plans import adapter as D
from cellgrid.session import read_table
from cellgrid.sources import layers
from cellgrid.streaming.daily import daily_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, dates: tuple[str, ...] = ()):
    """Registers a query under its name, with its oracle. Columns of dates are shown as text on both sides."""

    def register(f):
        def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({d: F.col(d).cast("string") for d in dates})

        QUERIES[f.__name__] = shown if dates else f
        if sql:
            shown_sql = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({shown_sql}) FROM ({sql})" if dates else sql
        return f

    return register


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- scores ---------------------------------------------------------------------------------------------------------

COMPONENTS = (("heat", "+", 0.05), ("shade", "-", 0.05), ("people", "+", 0.0))
_BASE = f"""WITH {D.CELLS}, cut AS (SELECT quantile_cont(value, 0.9) AS threshold FROM cells),
    base AS (SELECT zone, avg(CASE WHEN value > threshold THEN 1.0 ELSE 0.0 END) AS heat,
        sum(CASE WHEN weight > 0 THEN dist * weight END) / nullif(sum(CASE WHEN weight > 0 THEN weight END), 0) AS shade,
        sum(weight) AS people FROM cells, cut GROUP BY zone),
    long AS (SELECT zone, 'heat' AS component, heat AS raw, '+' AS direction, 0.05 AS floor FROM base
        UNION ALL SELECT zone, 'shade', shade, '-', 0.05 FROM base UNION ALL SELECT zone, 'people', people, '+', 0.0 FROM base),
    normed AS (SELECT zone, component, raw, round(CASE WHEN greatest(max(raw) OVER c - min(raw) OVER c, floor) = 0 THEN 0 ELSE
        least(1, greatest(0, CASE direction WHEN '+' THEN raw - min(raw) OVER c ELSE max(raw) OVER c - raw END
        / greatest(max(raw) OVER c - min(raw) OVER c, floor))) END, 4) AS norm FROM long WINDOW c AS (PARTITION BY component))"""


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = A.with_threshold(D.cells(spark, sf_dir), "value", 0.9)
    base = A.zonal(cells, ["zone"], {
        "heat": F.avg(F.when(F.col("value") > F.col("threshold"), 1.0).otherwise(0.0)),
        "shade": A.weighted_mean(F.col("dist"), F.col("weight")),
        "people": F.sum("weight"),
    })
    parts = F.array(*[F.struct(F.lit(n).alias("component"), F.col(n).alias("raw"), F.lit(d).alias("direction"), F.lit(f).alias("floor")) for n, d, f in COMPONENTS])
    return score.normalise(base.select("zone", F.inline(parts)))


@query(_BASE + """, scored AS (SELECT zone, round(sum(norm) / 3, 4) AS "index" FROM normed GROUP BY zone)
    SELECT zone, "index", row_number() OVER (ORDER BY "index" DESC, zone) AS position FROM scored""")
def priority_index(spark, sf_dir):
    return score.ranking(score.index(_components(spark, sf_dir).withColumn("weight", F.lit(1.0)), "zone"), "zone")


@query(_BASE + " SELECT zone, component, round(raw, 4) AS raw, norm FROM normed")
def priority_components(spark, sf_dir):
    return rounded(_components(spark, sf_dir).select("zone", "component", "raw", "norm"), "raw")


_LOO = """, runs AS (SELECT scenario, zone, round(sum(CASE WHEN component = scenario THEN 0 ELSE norm END)
    / sum(CASE WHEN component = scenario THEN 0.0 ELSE 1.0 END), 6) AS "index"
    FROM normed, (VALUES ('base'), ('heat'), ('shade'), ('people')) AS s(scenario) GROUP BY 1, 2),
    placed AS (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY "index" DESC, zone) AS position FROM runs)"""


@query(_BASE + _LOO + ' SELECT scenario, zone, "index", position FROM placed')
def leave_one_out(spark, sf_dir):
    return score.leave_one_out(_components(spark, sf_dir), "zone", [n for n, *_ in COMPONENTS], digits=6)


@query(_BASE + _LOO + " SELECT zone, min(position) AS best, max(position) AS worst FROM placed GROUP BY zone")
def rank_range_loo(spark, sf_dir):
    return score.rank_range(leave_one_out(spark, sf_dir), "zone")


@query(_BASE + """, part AS (SELECT zone, component, norm * CASE component WHEN 'heat' THEN 0.5 WHEN 'shade' THEN 1.0 / 6 ELSE 2.0 / 6 END AS c FROM normed),
    total AS (SELECT zone, sum(c) AS value, array_to_string(list_slice(list(component ORDER BY c DESC, component) FILTER (c > 0), 1, 2), ',') AS reasons FROM part GROUP BY zone)
    SELECT zone, round(value, 4) AS value, row_number() OVER (ORDER BY value DESC, zone) AS position, coalesce(reasons, '') AS reasons,
    value - lead(value) OVER (ORDER BY value DESC, zone) < 0.01 AS tie FROM total""")
def reweighted_ranking(spark, sf_dir):
    return rounded(score.reweighted(_components(spark, sf_dir), "zone", {"heat": 3, "shade": 1, "people": 2}), "value")


@query(f"""WITH {D.CELLS}, options AS (SELECT zone, avg(dist) / 20 AS available_pp, -0.3 AS coef, -0.5 AS low, -0.1 AS high,
    CASE WHEN zone % 3 = 0 THEN NULL ELSE -0.2 END AS floor, count(*) / 100.0 AS km2 FROM cells GROUP BY zone),
    used AS (SELECT *, available_pp * 40 / 100 AS pp FROM options)
    SELECT zone, round(pp, 4) AS pp, round(greatest(coef * pp / 10, coalesce(floor, -1e300)), 4) AS delta,
    round(least(greatest(low * pp / 10, coalesce(floor, -1e300)), greatest(high * pp / 10, coalesce(floor, -1e300))), 4) AS delta_low,
    round(greatest(greatest(low * pp / 10, coalesce(floor, -1e300)), greatest(high * pp / 10, coalesce(floor, -1e300))), 4) AS delta_high,
    round(least(0.02 * pp / 10, 0.015), 4) AS delta_ndvi, round(pp / 100 * km2 * 100, 4) AS hectares FROM used""")
def what_if_effect(spark, sf_dir):
    options = D.cells(spark, sf_dir).groupBy("zone").agg((F.avg("dist") / 20).alias("available_pp"), (F.count("*") / 100.0).alias("km2"))
    options = options.withColumns({
        "coef": F.lit(-0.3), "low": F.lit(-0.5), "high": F.lit(-0.1), "floor": F.when(F.col("zone") % 3 != 0, -0.2),
        "ndvi_coef": F.lit(0.02), "ndvi_cap": F.lit(0.015),
    })
    names = ["pp", "delta", "delta_low", "delta_high", "delta_ndvi", "hectares"]
    return rounded(score.what_if(options, 40), *names).select("zone", *names)


@query(f"""WITH {D.CELLS}, options AS (SELECT zone, class AS option, sum(weight) AS cap, -avg(value) AS effect FROM cells GROUP BY 1, 2),
    total AS (SELECT *, sum(cap) OVER (PARTITION BY zone) * 0.5 AS total FROM options)
    SELECT zone, option, round(greatest(0, least(cap, total - coalesce(sum(cap) OVER (PARTITION BY zone ORDER BY effect, option
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))), 4) AS allocated FROM total""")
def greedy_allocation(spark, sf_dir):
    from pyspark.sql import Window

    options = D.cells(spark, sf_dir).groupBy("zone", F.col("class").alias("option")).agg(F.sum("weight").alias("cap"), (-F.avg("value")).alias("effect"))
    options = options.withColumn("total", F.sum("cap").over(Window.partitionBy("zone")) * 0.5)
    return rounded(score.allocate(options, "zone", F.col("effect"), "cap", "total"), "allocated").select("zone", "option", "allocated")


@query("""WITH scenes AS (SELECT o_orderkey AS id, year(o_orderdate) AS y, quarter(o_orderdate) AS q, o_totalprice AS v FROM orders WHERE o_orderstatus = 'F'),
    a AS (SELECT *, row_number() OVER (PARTITION BY y, q ORDER BY v DESC, id) AS r FROM scenes),
    b AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY CASE WHEN r > 2 THEN 1 ELSE 0 END, v DESC, id) AS k FROM a)
    SELECT id, y, q FROM b WHERE k <= 6""")
def quota_top_k(spark, sf_dir):
    scenes = read_table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    scenes = scenes.select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.col("o_totalprice").alias("v"))
    return score.quota_top(scenes, "y", "q", [F.desc("v"), F.col("id")]).select("id", "y", "q")


# --- aggregates -----------------------------------------------------------------------------------------------------


@query(f"""WITH {D.CELLS} SELECT zone, count(*) AS cells, round(avg(value), 4) AS mean, round(quantile_cont(value, 0.9), 4) AS p90,
    round(sum(CASE WHEN weight > 0 THEN value * weight END) / nullif(sum(CASE WHEN weight > 0 THEN weight END), 0), 4) AS weighted,
    round(100 * avg(CASE WHEN dist <= 300 THEN 1.0 ELSE 0.0 END), 4) AS pct_near,
    round(100 * sum(CASE WHEN dist <= 300 THEN weight ELSE 0 END) / nullif(sum(weight), 0), 4) AS people_near FROM cells GROUP BY zone""")
def zonal_stats(spark, sf_dir):
    near = F.col("dist") <= 300
    out = A.zonal(D.cells(spark, sf_dir), ["zone"], {
        "cells": F.count("*"), "mean": F.avg("value"),
        "weighted": A.weighted_mean(F.col("value"), F.col("weight")), "pct_near": A.share(near),
        "people_near": A.weighted_share(near, F.col("weight")),
    }, points={"p90": ("value", 0.9)})
    return rounded(out, "mean", "p90", "weighted", "pct_near", "people_near")


@query(f"WITH {D.CELLS} SELECT zone, count(*) AS cells, round(sum(value), 2) AS total FROM cells GROUP BY GROUPING SETS ((zone), ())")
def zonal_rollup(spark, sf_dir):
    return rounded(A.zonal(D.cells(spark, sf_dir), ["zone"], {"cells": F.count("*"), "total": F.sum("value")}, total=True), "total", digits=2)


@query(f"""WITH {D.CELLS}, steps AS (SELECT zone, dist, sum(weight) AS w FROM cells WHERE weight > 0 GROUP BY 1, 2),
    cum AS (SELECT *, sum(w) OVER (PARTITION BY zone ORDER BY dist) AS c, sum(w) OVER (PARTITION BY zone) AS t FROM steps)
    SELECT zone, min(dist) AS weighted_median FROM cum WHERE c >= t / 2 GROUP BY zone""")
def weighted_median_lower(spark, sf_dir):
    return A.weighted_median(D.cells(spark, sf_dir), ["zone"], "dist", "weight")


@query(f"""WITH {D.CELLS} SELECT class, round(min(value), 4) AS min, round(avg(value), 4) AS mean, round(max(value), 4) AS max, count(value) AS n,
    round(quantile_cont(value, 0.1), 4) AS p10, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.9), 4) AS p90 FROM cells GROUP BY class""")
def percentile_profile(spark, sf_dir):
    return rounded(A.profile(D.cells(spark, sf_dir), ["class"], "value"), "min", "mean", "max", "p10", "p50", "p90")


@query(f"""WITH {D.CELLS}, q AS (SELECT zone, quantile_cont(value, 0.75) + 0.2 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS fence, count(value) AS n FROM cells GROUP BY zone)
    SELECT cell_id, n >= 10 AND value > fence AS outlier FROM cells JOIN q USING (zone)""")
def tukey_outliers(spark, sf_dir):
    return A.tukey_flags(D.cells(spark, sf_dir), ["zone"], "value", factor=0.2).select("cell_id", "outlier")


@query(f"WITH {D.CELLS}, p AS (SELECT zone, class, sum(weight) AS a FROM cells GROUP BY 1, 2) SELECT zone, class, round(100 * a / sum(a) OVER (PARTITION BY zone), 4) AS pct FROM p")
def class_shares(spark, sf_dir):
    return rounded(A.class_shares(D.cells(spark, sf_dir), ["zone"], "class", F.col("weight")), "pct")


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(f"WITH {D.CELLS} SELECT zone, " + ", ".join(f"count(*) FILTER (class = '{s}') AS \"{s}\"" for s in SEGMENTS) + ", count(*) AS total FROM cells GROUP BY zone")
def pivot_counts(spark, sf_dir):
    return A.pivot_counts(D.cells(spark, sf_dir), ["zone"], "class", SEGMENTS)


@query(f"WITH {D.CELLS} SELECT CAST(row // 4 AS BIGINT) AS block_row, CAST(col // 4 AS BIGINT) AS block_col, round(avg(value), 8) AS mean, round(sum(value), 2) AS sum, count(value) AS n FROM cells GROUP BY 1, 2")
def block_downsample(spark, sf_dir):
    return rounded(rounded(A.blocks(D.cells(spark, sf_dir), 4, "value"), "mean", digits=8), "sum", digits=2)


@query(f"WITH {D.CELLS}, c AS (SELECT zone, class, count(*) AS n FROM cells GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY n DESC, class) AS k FROM c) SELECT zone, class AS mode, n FROM r WHERE k = 1")
def modal_class(spark, sf_dir):
    return A.modal(D.cells(spark, sf_dir), ["zone"], "class")


@query(f"""WITH {D.CELLS}, c AS (SELECT class, count(*) FILTER (value > 5000 AND dist > 500) AS hits, count(*) FILTER (value > 5000 AND NOT dist > 500) AS misses,
    count(*) FILTER (NOT value > 5000 AND dist > 500) AS false_alarms FROM cells GROUP BY class)
    SELECT *, round(hits / nullif(hits + misses, 0), 6) AS pod, round(false_alarms / nullif(hits + false_alarms, 0), 6) AS far, round((hits + false_alarms) / nullif(hits + misses, 0), 6) AS bias FROM c""")
def contingency_scores(spark, sf_dir):
    return rounded(A.contingency(D.cells(spark, sf_dir), ["class"], F.col("value") > 5000, F.col("dist") > 500), "pod", "far", "bias", digits=6)


@query(f"""WITH {D.CELLS}, t AS (SELECT class, sum(weight) AS a, sum(dist) AS b FROM cells GROUP BY class)
    SELECT class, round(sum(abs(weight / a - dist / b)) / 2, 6) AS dissimilarity FROM cells JOIN t USING (class) GROUP BY class""")
def dissimilarity(spark, sf_dir):
    return rounded(A.dissimilarity(D.cells(spark, sf_dir), ["class"], "weight", "dist"), "dissimilarity", digits=6)


@query(f"""WITH {D.CELLS}, z AS (SELECT zone, round(avg(value), 4) AS area, round(sum(value * weight) / nullif(sum(weight), 0), 4) AS people, round(median(dist), 4) AS middle FROM cells GROUP BY zone),
    r AS (SELECT *, rank() OVER (ORDER BY area DESC) AS rank_area, rank() OVER (ORDER BY people DESC) AS rank_people, rank() OVER (ORDER BY middle DESC) AS rank_middle FROM z)
    SELECT *, least(rank_area, rank_people, rank_middle) AS best, greatest(rank_area, rank_people, rank_middle) AS worst FROM r""")
def rank_across_metrics(spark, sf_dir):
    zones = A.zonal(D.cells(spark, sf_dir), ["zone"], {
        "area": F.round(F.avg("value"), 4), "people": F.round(A.weighted_mean(F.col("value"), F.col("weight")), 4)
    }, points={"middle": ("dist", 0.5)}).withColumn("middle", F.round("middle", 4))
    return A.rank_metrics(zones, ["area", "people", "middle"])


@query(f"WITH {D.CELLS} SELECT zone, round(100 * avg(CASE WHEN value > (SELECT quantile_cont(value, 0.9) FROM cells) THEN 1.0 ELSE 0.0 END), 4) AS pct FROM cells GROUP BY zone")
def extreme_share(spark, sf_dir):
    cells = A.with_threshold(D.cells(spark, sf_dir), "value", 0.9)
    return rounded(A.zonal(cells, ["zone"], {"pct": A.share(F.col("value") > F.col("threshold"))}), "pct")


@query(f"""WITH {D.CELLS}, b AS (SELECT CASE WHEN dist < 100 THEN 0 WHEN dist < 300 THEN 1 WHEN dist <= 600 THEN 2 END AS bin, value FROM cells)
    SELECT bin, round(avg(value), 4) AS mean_residual, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY bin HAVING count(*) >= 5""")
def binned_residuals(spark, sf_dir):
    return rounded(A.residual_bins(D.cells(spark, sf_dir), "value", "dist", [0, 100, 300, 600]), "mean_residual")


# --- series ---------------------------------------------------------------------------------------------------------


@query(f"WITH {D.DAILY} SELECT var, day, n, round(mean, 9) AS mean, round(max, 9) AS max FROM daily", dates=("day",))
def hourly_to_daily_gate(spark, sf_dir):
    return rounded(series.daily(D.hourly(spark, sf_dir), ["var"], "ts", "value"), "mean", "max", digits=9)


@query(f"""WITH {D.HOURLY} SELECT var, ts, round(CASE WHEN row_number() OVER (PARTITION BY var ORDER BY ts) >= 8 AND count(value) OVER w >= 6 THEN avg(value) OVER w END, 9) AS trailing
    FROM hourly WINDOW w AS (PARTITION BY var ORDER BY ts ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""")
def trailing_mean_min_count(spark, sf_dir):
    return rounded(series.trailing(D.hourly(spark, sf_dir), ["var"], "ts", "value"), "trailing", digits=9).select("var", "ts", "trailing")


@query(f"""WITH {D.DAILY} SELECT var, day, round(CASE WHEN row_number() OVER (PARTITION BY var ORDER BY day) >= 5 AND count(mean) OVER w = 5 THEN sum(mean) OVER w END, 6) AS trailing
    FROM daily WINDOW w AS (PARTITION BY var ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""", dates=("day",))
def sum5_all_valid(spark, sf_dir):
    days = series.daily(D.hourly(spark, sf_dir), ["var"], "ts", "value")
    return rounded(series.trailing(days, ["var"], "day", "mean", 5, 5, "sum"), "trailing", digits=6).select("var", "day", "trailing")


@query(f"""WITH {D.DAILY}, m AS (SELECT var, CAST(date_trunc('month', day) AS DATE) AS month, count(mean) AS n, avg(mean) AS a, sum(mean) AS s FROM daily GROUP BY 1, 2)
    SELECT var, month, n, round(CASE WHEN n >= 0.75 * day(last_day(month)) THEN a END, 6) AS mean, round(CASE WHEN n = day(last_day(month)) THEN s END, 6) AS total FROM m""", dates=("month",))
def monthly_completeness(spark, sf_dir):
    days = series.daily(D.hourly(spark, sf_dir), ["var"], "ts", "value")
    return rounded(series.monthly(days, ["var"], "day", "mean"), "mean", "total", digits=6)


@query(f"WITH {D.MONTHLY} SELECT var, month(month) AS calendar_month, round(avg(value), 4) AS normal, count(value) AS n FROM monthly WHERE year(month) BETWEEN 1995 AND 1998 GROUP BY 1, 2")
def calendar_climatology(spark, sf_dir):
    return rounded(series.climatology(D.monthly(spark, sf_dir), ["var"], "month", "value", (1995, 1998)), "normal")


@query(f"""WITH {D.MONTHLY}, c AS (SELECT var, month(month) AS m, avg(value) AS normal FROM monthly WHERE year(month) BETWEEN 1995 AND 1998 GROUP BY 1, 2)
    SELECT monthly.var, month, round(value - normal, 4) AS anomaly, round(100 * (value - normal) / normal, 4) AS pct FROM monthly JOIN c ON c.var = monthly.var AND c.m = month(month)""", dates=("month",))
def anomaly_vs_climatology(spark, sf_dir):
    months = D.monthly(spark, sf_dir)
    return rounded(series.anomalies(months, series.climatology(months, ["var"], "month", "value", (1995, 1998)), ["var"], "month", "value"), "anomaly", "pct")


@query("""WITH d AS (SELECT o_orderpriority AS var, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2),
    m AS (SELECT var, month(day) AS m, avg(value) AS v, count(value) AS n FROM d GROUP BY 1, 2) SELECT var, round(avg(v), 4) AS balanced, count(*) AS months FROM m WHERE n >= 20 GROUP BY var""")
def month_balanced_mean(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("var"), F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("value"))
    return rounded(series.month_balanced(orders, ["var"], "day", "value"), "balanced")


@query(f"""WITH {D.MONTHLY}, r AS (SELECT var, month AS start, avg(value) OVER w AS v, count(value) OVER w AS n FROM monthly WINDOW w AS (PARTITION BY var ORDER BY month ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
    k AS (SELECT *, row_number() OVER (PARTITION BY var ORDER BY v DESC, start) AS k FROM r WHERE n = 6) SELECT var, start, round(v, 4) AS run_mean FROM k WHERE k = 1""", dates=("start",))
def best_run(spark, sf_dir):
    return rounded(series.best_run(D.monthly(spark, sf_dir), ["var"], "month", "value"), "run_mean")


@query(f"""WITH {D.HOURLY} SELECT var, ts, round(lead(value) OVER w - 2 * value + lag(value) OVER w, 6) AS second FROM hourly WINDOW w AS (PARTITION BY var ORDER BY ts)""")
def second_difference(spark, sf_dir):
    hours = D.hourly(spark, sf_dir)
    return hours.select("var", "ts", F.round(series.second_difference(hours, ["var"], "ts", "value"), 6).alias("second"))


_SPIKE = """s{k} AS (SELECT var, ts, CASE WHEN b - 2 * value + a < -40 THEN (a + b) / 2 ELSE value END AS value, CASE WHEN b - 2 * value + a < -40 THEN {k} ELSE repaired END AS repaired
    FROM (SELECT *, lead(value) OVER w AS b, lag(value) OVER w AS a FROM {src} WINDOW w AS (PARTITION BY var ORDER BY ts)))"""
SPIKES = f"""{D.HOURLY}, s0 AS (SELECT *, 0 AS repaired FROM hourly), {_SPIKE.format(k=1, src="s0")}, {_SPIKE.format(k=2, src="s1")}, {_SPIKE.format(k=3, src="s2")}"""


@query(f"WITH {SPIKES} SELECT var, ts, round(value, 6) AS value, repaired FROM s3")
def spike_repair(spark, sf_dir):
    return rounded(series.repair_spikes(D.hourly(spark, sf_dir), ["var"], "ts", "value", 40), "value", digits=6)


@query(f"""WITH {D.HOURLY}, s AS (SELECT var, ts AS "at", avg(value) OVER b AS x, count(value) OVER b AS nb, avg(value) OVER a AS y, count(value) OVER a AS na FROM hourly
    WINDOW b AS (PARTITION BY var ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY var ORDER BY ts ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING)),
    k AS (SELECT var, "at", y - x AS change, row_number() OVER (PARTITION BY var ORDER BY abs(y - x) DESC, "at") AS k FROM s WHERE nb = 24 AND na = 24)
    SELECT var, "at", round(change, 6) AS change FROM k WHERE k = 1""")
def change_point_scan(spark, sf_dir):
    return rounded(series.change_scan(D.hourly(spark, sf_dir), ["var"], "ts", "value"), "change", digits=6)


@query(f"""WITH {D.MONTHLY}, s AS (SELECT var, month, avg(value) OVER b AS x, count(value) OVER b AS nb, avg(value) OVER a AS y, count(value) OVER a AS na FROM monthly
    WINDOW b AS (PARTITION BY var ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY var ORDER BY month ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING))
    SELECT var, month, round(CASE WHEN nb >= 10 AND na >= 10 AND y / x > 0 THEN ln(y / x) END, 6) AS log_change FROM s""", dates=("month",))
def before_after_log_change(spark, sf_dir):
    return rounded(series.log_change(D.monthly(spark, sf_dir), ["var"], "month", "value", 12, 10), "log_change", digits=6)


_REGIMES = (("2023-12-01", "a"), ("2024-01-08", "b"), ("2024-01-20", "c"))


@query(f"""WITH {D.DAILY}, r AS (SELECT CAST(s AS DATE) AS start, n FROM (VALUES ('2023-12-01', 'a'), ('2024-01-08', 'b'), ('2024-01-20', 'c')) AS t(s, n)),
    x AS (SELECT *, lead(start) OVER (ORDER BY start) AS stop, row_number() OVER (ORDER BY start) AS k FROM r)
    SELECT var, day, CASE WHEN day = start AND k > 1 THEN 'change_' || x.n ELSE x.n END AS regime FROM daily LEFT JOIN x ON day >= start AND (stop IS NULL OR day < stop)""", dates=("day",))
def regime_asof(spark, sf_dir):
    table = spark.createDataFrame(_REGIMES, "s string, regime string").select(F.to_date("s").alias("start"), "regime")
    days = series.daily(D.hourly(spark, sf_dir), ["var"], "ts", "value")
    return series.regimes(days, table, "day").select("var", "day", "regime")


@query(f"""WITH {D.HOURLY} SELECT var, CAST(ts AS DATE) AS day, round(max(value) - avg(value), 9) AS amplitude, min(hour(ts)) FILTER (value = m) AS peak_hour
    FROM (SELECT *, max(value) OVER (PARTITION BY var, CAST(ts AS DATE)) AS m FROM hourly) GROUP BY 1, 2""", dates=("day",))
def diurnal_cycle(spark, sf_dir):
    return rounded(series.diurnal(D.hourly(spark, sf_dir), ["var"], "ts", "value"), "amplitude", digits=9)


@query(f"""WITH {D.HOURLY}, s AS (SELECT *, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY var ORDER BY ts)) AS step FROM hourly)
    SELECT var, count(*) AS n, count(*) FILTER (value IS NULL) AS nulls, count(*) FILTER (value < 0) AS negatives, count(*) FILTER (value = 0) AS zeros, count(*) FILTER (step <> 3600) AS gaps FROM s GROUP BY var""")
def gap_counts(spark, sf_dir):
    return series.gap_counts(D.hourly(spark, sf_dir), ["var"], "ts", "value")


@query("""WITH o AS (SELECT o_orderpriority AS var, o_orderdate AS d, o_totalprice AS v FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'P'),
    y AS (SELECT var, year(d) AS year, count(*) AS n, count(DISTINCT quarter(d)) AS quarters FROM o GROUP BY 1, 2),
    r AS (SELECT *, concat_ws(',', CASE WHEN n < 30 THEN 'few' END, CASE WHEN quarters < 3 THEN 'seasons' END) AS reasons FROM y) SELECT *, reasons = '' AS reliable FROM r""")
def year_reliability(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderpriority").alias("var"), "o_orderdate", "o_totalprice")
    return series.year_flags(orders, ["var"], "o_orderdate", F.col("o_totalprice") > 200000, least=30)


@query("""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS value FROM orders GROUP BY 1), t AS (SELECT *, strftime(day, '%m-%d') AS md FROM d),
    s AS (SELECT md, sum(value) AS s, count(value) AS n FROM t GROUP BY md) SELECT day, round(value - (s - value) / nullif(n - 1, 0), 7) AS difference, n - 1 AS years FROM t JOIN s USING (md)""", dates=("day",))
def same_day_other_years(spark, sf_dir):
    days = read_table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("value"))
    return rounded(joins.same_day_other_years(days, [], "day", "value"), "difference", digits=7)


_DOY = """days AS (SELECT year(o_orderdate) AS year, CAST(dayofyear(o_orderdate) - CASE WHEN day(last_day(make_date(year(o_orderdate), 2, 1))) = 29 AND dayofyear(o_orderdate) > 59 THEN 1 ELSE 0 END AS INTEGER) AS doy,
    avg(o_totalprice) AS value FROM orders GROUP BY 1, 2)"""


def _days(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.groupBy(F.year("o_orderdate").alias("year"), X.day_365(F.to_date("o_orderdate")).alias("doy")).agg(F.avg("o_totalprice").alias("value"))


@query(f"""WITH {_DOY}, spread AS (SELECT ((doy - 1 + d + 365) % 365) + 1 AS calendar_day, value FROM days, (VALUES (-2), (-1), (0), (1), (2)) AS o(d)),
    l AS (SELECT calendar_day, list(value ORDER BY value) AS v, count(*) AS n FROM spread GROUP BY 1), p AS (SELECT *, greatest(1, least(n, 0.9 * (n + 1 / 3.0) + 1 / 3.0)) AS h FROM l)
    SELECT calendar_day, round(v[CAST(floor(h) AS INTEGER)] + (h - floor(h)) * (v[CAST(least(floor(h) + 1, n) AS INTEGER)] - v[CAST(floor(h) AS INTEGER)]), 4) AS threshold, n FROM p""")
def calendar_percentile(spark, sf_dir):
    return rounded(series.calendar_percentile(_days(spark, sf_dir), [], "doy", "value"), "threshold")


@query()
def percentile90_bootstrap(spark, sf_dir):
    return rounded(series.exceedances(_days(spark, sf_dir), [], "year", "doy", "value", (1995, 1999)), "days")


# --- statistics -----------------------------------------------------------------------------------------------------


@query(f"WITH {D.YEARLY} SELECT var, regr_count(value, year) AS n, round(regr_slope(value, year), 4) AS slope, round(regr_intercept(value, year), 2) AS intercept, round(regr_r2(value, year), 6) AS r2 FROM yearly GROUP BY var")
def ols_trend(spark, sf_dir):
    return rounded(rounded(rounded(stats.ols_line(D.yearly(spark, sf_dir), ["var"], "year", "value"), "slope"), "intercept", digits=2), "r2", digits=6)


_PAIRS = f"WITH {D.YEARLY}, p AS (SELECT a.var, a.year AS x1, b.year AS x2, a.value AS y1, b.value AS y2 FROM yearly a JOIN yearly b ON a.var = b.var AND a.year < b.year)"


@query(_PAIRS + " SELECT var, round(median((y2 - y1) / (x2 - x1)), 4) AS slope, count(*) AS pairs FROM p GROUP BY var")
def theil_sen(spark, sf_dir):
    return rounded(stats.theil_sen(D.yearly(spark, sf_dir), ["var"], "year", "value"), "slope")


@query(_PAIRS + """, s AS (SELECT var, CAST(sum(sign(y2 - y1)) AS DOUBLE) AS s FROM p GROUP BY var), t AS (SELECT var, sum(t) AS n, sum(t * (t - 1) * (2 * t + 5)) AS ties FROM (SELECT var, value, count(*) AS t FROM yearly GROUP BY 1, 2) GROUP BY var),
    v AS (SELECT s.var, n, s, (n * (n - 1) * (2 * n + 5) - ties) / 18.0 AS var_ FROM s JOIN t USING (var))
    SELECT var, CAST(n AS BIGINT) AS n, s, round(var_, 6) AS variance, round(CASE WHEN s = 0 THEN 0 ELSE (s - sign(s)) / sqrt(var_) END, 6) AS z, round(s / (n * (n - 1) / 2), 6) AS tau FROM v""")
def mann_kendall_s(spark, sf_dir):
    return rounded(stats.mann_kendall(D.yearly(spark, sf_dir), ["var"], "year", "value"), "variance", "z", "tau", digits=6)


@query()
def full_trends(spark, sf_dir):
    months = D.monthly(spark, sf_dir).select("var", F.months_between("month", F.lit("1995-01-01")).alias("t"), "value")
    return rounded(stats.trends(months, ["var"], "t", "value"), "slope", "intercept", "r2", "sen", "z", "tau", "p_line", "p_kendall")


@query(f"""WITH {D.CELLS}, a AS (SELECT zone, value, dist, rank() OVER (PARTITION BY zone ORDER BY value) + (count(*) OVER (PARTITION BY zone, value) - 1) / 2.0 AS ra,
    rank() OVER (PARTITION BY zone ORDER BY dist) + (count(*) OVER (PARTITION BY zone, dist) - 1) / 2.0 AS rb FROM cells) SELECT zone, round(corr(ra, rb), 6) AS rho, count(*) AS n FROM a GROUP BY zone""")
def spearman(spark, sf_dir):
    return rounded(stats.spearman(D.cells(spark, sf_dir), ["zone"], "value", "dist"), "rho", digits=6)


@query(f"""WITH {D.CELLS}, a AS (SELECT class, weight >= 4 AS inside, rank() OVER (PARTITION BY class ORDER BY dist) + (count(*) OVER (PARTITION BY class, dist) - 1) / 2.0 AS r FROM cells),
    s AS (SELECT class, count(*) FILTER (inside) AS n_in, count(*) FILTER (NOT inside) AS n_out, sum(r) FILTER (inside) AS s FROM a GROUP BY class)
    SELECT class, n_in, n_out, round(1 - (s - n_in * (n_in + 1) / 2.0) / (n_in * n_out), 6) AS p_smaller FROM s""")
def mann_whitney_u(spark, sf_dir):
    return rounded(stats.superiority(D.cells(spark, sf_dir), ["class"], F.col("weight") >= 4, "dist"), "p_smaller", digits=6)


@query(f"""WITH {D.CELLS}, m AS (SELECT class, avg(value) AS m FROM cells GROUP BY class), c AS (SELECT class, value - m AS d FROM cells JOIN m USING (class))
    SELECT class, round(avg(d * d * d) / pow(avg(d * d), 1.5), 6) AS skewness, round(avg(d * d * d * d) / pow(avg(d * d), 2) - 3, 6) AS kurtosis FROM c GROUP BY class""")
def moments(spark, sf_dir):
    return rounded(stats.moments(D.cells(spark, sf_dir), ["class"], "value"), "skewness", "kurtosis", digits=6)


@query(f"""WITH {D.CELLS}, s AS (SELECT class, avg(value) FILTER (weight < 3) AS m0, avg(value) FILTER (weight >= 3) AS m1, var_samp(value) FILTER (weight < 3) / count(value) FILTER (weight < 3) AS a,
    var_samp(value) FILTER (weight >= 3) / count(value) FILTER (weight >= 3) AS b, count(value) FILTER (weight < 3) AS n0, count(value) FILTER (weight >= 3) AS n1 FROM cells GROUP BY class)
    SELECT class, round(m0, 4) AS before, round(m1, 4) AS after, round((m1 - m0) / sqrt(a + b), 6) AS t, round(pow(a + b, 2) / (a * a / (n0 - 1) + b * b / (n1 - 1)), 4) AS df FROM s""")
def welch_test(spark, sf_dir):
    return rounded(rounded(stats.welch(D.cells(spark, sf_dir), ["class"], F.col("weight") >= 3, "value"), "before", "after", "df"), "t", digits=6)


@query(f"""WITH {D.CELLS}, l AS (SELECT l, dr, dc FROM (VALUES (1, 0, 1), (1, 1, 0), (2, 0, 2), (2, 2, 0)) AS t(l, dr, dc))
    SELECT l AS lag, round(corr(a.value, b.value), 6) AS r, count(*) AS n FROM cells a, l, cells b WHERE a.row = b.row + dr AND a.col = b.col + dc GROUP BY l""")
def correlogram(spark, sf_dir):
    return rounded(stats.correlogram(D.cells(spark, sf_dir), "value", [1, 2]), "r", digits=6)


@query(f"""WITH {D.CELLS} SELECT 'slope' AS term, round(regr_slope(value, dist), 6) AS coef FROM cells UNION ALL SELECT 'intercept', round(regr_intercept(value, dist), 6) FROM cells""")
def gram_regression(spark, sf_dir):
    out = stats.least_squares(D.cells(spark, sf_dir), "value", ["dist"]).select(F.when(F.col("term") == "dist", "slope").otherwise("intercept").alias("term"), "coef")
    return rounded(out, "coef", digits=6)


@query()
def robust_regression(spark, sf_dir):
    return rounded(stats.least_squares(D.cells(spark, sf_dir), "value", ["dist", "weight"]), "coef", "se", "low", "high", "vif")


@query()
def block_bootstrap(spark, sf_dir):
    block = F.floor(F.col("row") / 5) * 100 + F.floor(F.col("col") / 5)
    return rounded(stats.block_bootstrap(D.cells(spark, sf_dir), "value", ["dist", "weight"], block), "coef", "low", "high")


# --- joins ----------------------------------------------------------------------------------------------------------


#: The zones' edges, and the places that the even-odd rule puts inside.
EDGES = """edges AS (SELECT n_nationkey AS k, n_name, (n_nationkey % 5) * 200.0 + x1 AS x1, (n_nationkey // 5) * 200.0 + y1 AS y1, (n_nationkey % 5) * 200.0 + x2 AS x2, (n_nationkey // 5) * 200.0 + y2 AS y2
    FROM nation, (VALUES (10.0, 10.0, 190.0, 10.0), (190.0, 10.0, 190.0, 100.0), (190.0, 100.0, 100.0, 190.0), (100.0, 190.0, 10.0, 190.0), (10.0, 190.0, 10.0, 10.0)) AS e(x1, y1, x2, y2))"""
INSIDE = f"""{D.PLACES}, {EDGES}, hits AS (SELECT place, k, n_name FROM places JOIN edges ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""


@query(f"WITH {INSIDE}, one AS (SELECT place, arg_min(n_name, k) AS zone_id FROM hits GROUP BY place) SELECT place, zone_id FROM places LEFT JOIN one USING (place)")
def point_in_polygon(spark, sf_dir):
    return joins.points_in_zones(D.places(spark, sf_dir), D.zones(spark, sf_dir), "x", "y", 100.0).select("place", "zone_id")


@query(f"""WITH {D.PLACES}, p AS (SELECT a.place, b.place AS neighbour, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM places a JOIN places b ON a.place <> b.place),
    k AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY d, neighbour) AS k FROM p) SELECT place, neighbour, round(d, 4) AS distance FROM k WHERE k = 1""")
def nearest_neighbour(spark, sf_dir):
    places = D.places(spark, sf_dir).select("place", "x", "y")
    others = places.select(F.col("place").alias("neighbour"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return rounded(joins.nearest(places, others, "place", "neighbour", ("x", "y"), ("x2", "y2"), 30.0, others=True), "distance")


@query(f"""WITH {D.PLACES} SELECT a.place, count(*) AS n, round(avg(b.size), 8) AS mean FROM places a JOIN places b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 150 GROUP BY a.place""")
def radius_mean(spark, sf_dir):
    places = D.places(spark, sf_dir)
    others = places.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("size").alias("other"))
    return rounded(joins.mean_within(places, others, "place", ("x", "y"), ("x2", "y2"), "other", 150.0), "mean", digits=8)


@query("""WITH k AS (SELECT l_orderkey AS id, l_linenumber AS source, l_extendedprice AS value, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END, l_quantity DESC, l_linenumber, l_extendedprice) AS k
    FROM lineitem WHERE l_discount > 0.02) SELECT id, source, value FROM k WHERE k = 1""")
def mosaic_priority(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("source"), F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("value"), "l_returnflag", "l_quantity")
    order = [F.when(F.col("l_returnflag") == "A", 0).otherwise(1), F.desc("l_quantity"), F.col("source"), F.col("value")]
    return joins.first_source(items, ["id"], "value", order).select("id", "source", "value")


@query(f"""WITH {D.CELLS}, e AS (SELECT g AS target, g * 7.3 AS lo, (g + 1) * 7.3 AS hi FROM (SELECT unnest(range(0, CAST(ceil((max(col) + 1) / 7.3) AS BIGINT))) AS g FROM cells)),
    f AS (SELECT g AS target, g * 4.6 AS lo, (g + 1) * 4.6 AS hi FROM (SELECT unnest(range(0, CAST(ceil((max(row) + 1) / 4.6) AS BIGINT))) AS g FROM cells)),
    c AS (SELECT col, target, least(col + 1, hi) - greatest(col, lo) AS share FROM (SELECT DISTINCT col FROM cells), e WHERE col < hi AND lo < col + 1),
    r AS (SELECT row, target, least(row + 1, hi) - greatest(row, lo) AS share FROM (SELECT DISTINCT row FROM cells), f WHERE row < hi AND lo < row + 1)
    SELECT r.target AS row, c.target AS col, round(sum(value * r.share * c.share), 4) AS value FROM cells JOIN r USING (row) JOIN c USING (col) GROUP BY 1, 2""")
def overlap_regrid(spark, sf_dir):
    cells = D.cells(spark, sf_dir).select("row", "col", "value")

    def shares(axis: str, width: float):
        last = cells.agg(F.max(axis)).first()[0]
        edges = spark.range(math.ceil((last + 1) / width)).select(F.col("id").alias("target"), (F.col("id") * width).alias("lo"), ((F.col("id") + 1) * width).alias("hi"))
        source = cells.select(F.col(axis).alias("source")).distinct().select("source", F.col("source").cast("double").alias("lo"), (F.col("source") + 1.0).alias("hi"))
        return joins.overlap_shares(source, edges)

    return rounded(joins.regrid(cells, shares("row", 4.6), shares("col", 7.3), "value"), "value")


@query()
def dedup_name_distance(spark, sf_dir):
    places = D.places(spark, sf_dir).withColumn("name", F.concat(F.lit("n"), F.col("place") % 10))
    return joins.merge_names(places, ["zone", "name"], [-F.col("size"), F.col("place")], "x", "y", "place", 300.0).select("place", "kept_key")


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS f FROM lineitem), c AS (SELECT k, count(*) AS n, min(f) AS f FROM a GROUP BY k)
    SELECT f AS flag, count(*) AS orders FROM c WHERE n = 1 GROUP BY f""")
def set_only_in(spark, sf_dir):
    pairs = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("flag")).distinct()
    only = None
    for f in ("A", "N", "R"):
        own, rest = pairs.filter(F.col("flag") == f), pairs.filter(F.col("flag") != f)
        part = layers.unseen(own, rest.select("k"), "k")
        only = part if only is None else only.unionByName(part)
    return only.groupBy("flag").agg(F.count("*").alias("orders"))


@query("""WITH h AS (SELECT event_type AS var, CAST(ts AS DATE) AS day, count(value) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2) SELECT * FROM h""", dates=("day",))
def streaming_daily(spark, sf_dir):
    return rounded(daily_stream(spark, f"{sf_dir}/events.parquet", "event_type", "ts", "value"), "total")


# --- cells and text -------------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, (f <> 0 AND f & 10 = 0) AS passes FROM (SELECT l_orderkey, l_linenumber, CAST((l_orderkey + l_linenumber) % 16 AS INTEGER) AS f FROM lineitem)""")
def qa_bit_filter(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_orderkey") + F.col("l_linenumber")) % 16).cast("int").alias("f"))
    return items.select("l_orderkey", "l_linenumber", C.passes_quality(F.col("f"), 10).alias("passes"))


@query("""SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount > 0 AND l_tax > 0 THEN (l_tax - l_discount) / (l_tax + l_discount) END, 6) AS ratio FROM lineitem""")
def ndvi_like_ratio(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(C.ratio_index(F.col("l_tax"), F.col("l_discount")), 6).alias("ratio"))


@query(f"""WITH {D.CELLS}, e AS (SELECT cell_id, value, CAST(least(65535, greatest(1, round((value + 1000) / 0.25) + 1)) AS INTEGER) AS code FROM cells)
    SELECT cell_id, code, round((code - 1) * 0.25 - 1000, 4) AS decoded, abs((code - 1) * 0.25 - 1000 - value) <= 0.125 + 1e-9 AS close FROM e""")
def layer_code_roundtrip(spark, sf_dir):
    cells = D.cells(spark, sf_dir).withColumn("code", C.encode_layer(F.col("value"), 0.25, -1000.0))
    decoded = C.decode_layer(F.col("code"), 0.25, -1000.0)
    return cells.select("cell_id", "code", F.round(decoded, 4).alias("decoded"), (F.abs(decoded - F.col("value")) <= 0.125 + 1e-9).alias("close"))


@query(f"""WITH {D.CELLS} SELECT cell_id, CASE WHEN weight <= 1 AND dist <= 600 THEN 3 WHEN dist <= 100 OR value <= 2000 THEN 2 WHEN value <= 5000 THEN 1 ELSE 0 END AS hazard,
    CASE WHEN value >= 8000 THEN 'high' WHEN value >= 4000 THEN 'mid' ELSE 'low' END AS band FROM cells""")
def class_rules(spark, sf_dir):
    hazard = C.hazard_class(F.col("value"), F.col("weight"), F.col("dist"), low=5000, mid=2000, high=1, reach=600, near=100)
    return D.cells(spark, sf_dir).select("cell_id", hazard.alias("hazard"), C.band(F.col("value"), [4000, 8000], ["low", "mid", "high"]).alias("band"))


@query(f"""WITH {D.CELLS}, g AS (SELECT cell_id, 4.77 - (row + 0.5) * 0.00025 AS lat, -75.95 + (col + 0.5) * 0.00025 AS lon FROM cells)
    SELECT cell_id, round(lat, 6) AS lat, round(lon, 6) AS lon, round(0.00025 * 110574.0 * 0.00025 * 111320.0 * cos(radians(lat)), 4) AS area,
    round(2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - 4.7) / 2), 2) + cos(radians(4.7)) * cos(radians(lat)) * pow(sin(radians(lon + 75.9) / 2), 2))), 6) AS km FROM g""")
def cell_geometry(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    lat, lon = D.GRID.lat(F.col("row")), D.GRID.lon(F.col("col"))
    km = C.haversine_km(F.lit(4.7), F.lit(-75.9), lat, lon)
    return cells.select("cell_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"), F.round(D.GRID.area_m2(F.col("row")), 4).alias("area"), F.round(km, 6).alias("km"))


@query("""WITH h AS (SELECT DISTINCT CAST(dayofyear(ts) AS INTEGER) AS day, CAST(hour(ts) AS DOUBLE) AS hour FROM events), s AS (SELECT day, hour, 2 * pi() / 365 * (day - 1 + (hour - 12) / 24) AS g FROM h),
    d AS (SELECT day, hour, 0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) AS dec,
    229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eq FROM s),
    z AS (SELECT day, hour, sin(radians(4.75)) * sin(dec) + cos(radians(4.75)) * cos(dec) * cos(radians((hour * 60 + eq + 4 * -75.9) / 4 - 180)) AS c FROM d)
    SELECT day, hour, round(CASE WHEN c > 0.01 THEN 1098 * c * exp(-0.057 / c) ELSE 0 END, 4) AS ghi FROM z""")
def clear_sky_radiation(spark, sf_dir):
    """Of every hour in which there was an event."""
    ts = F.col("ts").cast("timestamp_ntz")
    hours = read_table(spark, sf_dir, "events").select(F.dayofyear(ts).alias("day"), F.hour(ts).cast("double").alias("hour")).distinct()
    return hours.select("day", "hour", F.round(C.clear_sky(C.cos_zenith(F.col("day"), F.col("hour"), F.lit(4.75), F.lit(-75.9))), 4).alias("ghi"))


@query(r"""SELECT p_partkey, trim(regexp_replace(lower(p_name || '  --' || p_brand), '[^a-z0-9]+', ' ', 'g')) AS name,
    replace(replace('<' || p_type || '>&', '&', '&amp;'), '<', '&lt;').replace('>', '&gt;') AS html FROM part""")
def name_normalise(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    name = X.normal_name(F.concat("p_name", F.lit("  --"), "p_brand"))
    return part.select("p_partkey", name.alias("name"), X.escape_html(F.concat(F.lit("<"), "p_type", F.lit(">&"))).alias("html"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k, CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) IN (1, 2) THEN 'private' WHEN CAST(json_extract(props, '$.k') AS INTEGER) > 50 THEN 'public' ELSE 'undeclared' END AS access FROM events""")
def json_flatten(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").alias("props"))
    flat = X.flatten(events)
    k = F.col("props_k")
    return flat.select("event_id", "props_k", F.when(k.isin(1, 2), "private").when(k > 50, "public").otherwise("undeclared").alias("access"))


@query("""SELECT event_id, CAST(ts - INTERVAL 5 HOURS AS TIMESTAMP) AS local, round(hour(ts - INTERVAL 5 HOURS) * 60 + minute(ts - INTERVAL 5 HOURS) + second(ts - INTERVAL 5 HOURS) / 60.0, 4) AS minutes FROM events""")
def local_minutes(spark, sf_dir):
    local = X.local_time(F.col("ts"))
    return read_table(spark, sf_dir, "events").select("event_id", local.alias("local"), F.round(X.minutes_of_day(local), 4).alias("minutes"))


# --- raster, flow, allocation ---------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT l_suppkey AS cell, count(l_extendedprice) AS n, median(l_extendedprice) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT cell, round(CASE WHEN n >= 3 THEN m END, 4) AS median, n FROM s""")
def composite_median_min_n(spark, sf_dir):
    stack = read_table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("cell"), "l_extendedprice")
    return rounded(raster.composite(stack, ["cell"], "l_extendedprice"), "median")


@query(f"""WITH {D.CELLS} SELECT a.cell_id, bool_or(b.dist < 100) AS dilated, min(b.value) AS low FROM cells a JOIN cells b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY a.cell_id""")
def dilation_and_minimum(spark, sf_dir):
    cells = D.cells(spark, sf_dir).withColumn("flag", F.col("dist") < 100)
    wide = raster.focal(raster.dilate(cells, "flag", raster.square(1)), "value", raster.square(1), F.min("value"), "low")
    return wide.select("cell_id", "dilated", "low")


@query()
def connected_components(spark, sf_dir):
    return raster.components(D.cells(spark, sf_dir).withColumn("flag", F.col("dist") < 350), "flag")


@query(f"""WITH {D.CELLS} SELECT a.cell_id, round(min(sqrt((a.row - b.row) * (a.row - b.row) + (a.col - b.col) * (a.col - b.col))), 4) AS distance
    FROM cells a, cells b WHERE b.dist < 20 GROUP BY a.cell_id""")
def distance_transform(spark, sf_dir):
    cells = D.cells(spark, sf_dir).withColumn("flag", F.col("dist") < 20)
    return rounded(raster.distance(cells, "flag"), "distance").select("cell_id", "distance")


@query(f"""WITH {D.CELLS}, k AS (SELECT CAST(g AS INTEGER) AS k, exp(-0.5 * g * g) / (SELECT sum(exp(-0.5 * g * g)) FROM range(-4, 5) AS r(g)) AS w FROM range(-4, 5) AS r(g)),
    a AS (SELECT row + k AS row, col, sum(dist * w) AS v FROM cells, k GROUP BY 1, 2), b AS (SELECT row, col + k AS col, sum(v * w) AS v FROM a, k GROUP BY 1, 2)
    SELECT row, col, round(v, 4) AS smooth FROM cells JOIN b USING (row, col)""")
def gaussian_density(spark, sf_dir):
    return rounded(raster.smooth(D.cells(spark, sf_dir), "dist", 1.0), "smooth")


@query()
def priority_flood(spark, sf_dir):
    return rounded(flow.fill(D.cells(spark, sf_dir), "value"), "filled").select("row", "col", "filled")


@query()
def height_above_drainage(spark, sf_dir):
    cells = flow.fill(D.cells(spark, sf_dir), "value").select("row", "col", F.col("filled").alias("z")).checkpoint()
    links = flow.descent(cells, "z").withColumn("one", F.lit(1.0)).checkpoint()
    drained = links.join(flow.accumulation(links, "one"), ["row", "col"]).withColumn("channel", F.col("upstream") >= 5)
    return rounded(flow.height_above(cells, flow.targets(drained, "channel"), "z"), "hand")


@query(f"""WITH {D.CELLS}, t AS (SELECT zone, count(*) * 10.0 AS total, sum(weight) AS w, count(*) AS n FROM cells GROUP BY zone)
    SELECT cell_id, round(total * CASE WHEN w > 0 THEN weight / w ELSE 1.0 / n END, 6) AS allocated FROM cells JOIN t USING (zone)""")
def dasymetric_share(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    totals = cells.groupBy("zone").agg((F.count("*") * 10.0).alias("total"))
    return rounded(allocate.spread(cells.join(totals, "zone"), "zone", "total", F.col("weight")), "allocated", digits=6).select("cell_id", "allocated")


@query(f"WITH {D.CELLS}, s AS (SELECT class, sum(dist) AS s FROM cells GROUP BY class) SELECT cell_id, round(dist * length(class) * 1000 / s, 6) AS anchored FROM cells JOIN s USING (class)")
def anchored_classes(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    targets = cells.select("class").distinct().withColumn("target", F.length("class") * 1000.0)
    return rounded(allocate.anchor(cells, targets, "class", "dist"), "anchored", digits=6).select("cell_id", "anchored")


@query(f"WITH {D.CELLS} SELECT count(*) AS cells, count(value) AS valid, round(sum(value), 4) AS sum, round(avg(value), 4) AS mean FROM cells WHERE sqrt((row - 10) * (row - 10) + (col - 20) * (col - 20)) * 25 <= 150")
def disc_summary(spark, sf_dir):
    return rounded(allocate.around(D.cells(spark, sf_dir), 10, 20, 150, "value", 25.0), "sum", "mean")
