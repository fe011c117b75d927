"""Queries of neighbourhoods, resampling, flow and aggregates on the cell table."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from cellgrid.functions import cells as C
from cellgrid.operators import aggregate as A
from cellgrid.operators import allocate, flow, joins, raster, reproject
from cellgrid.plans import adapter as D
from cellgrid.plans.registry import SEGMENTS, query, rounded
from cellgrid.session import read_table
from cellgrid.sources import layers


@query(f"""WITH {D.CELLS} SELECT a.cell_id, a.class IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AND NOT EXISTS (SELECT 1 FROM cells b WHERE b.class = 'HOUSEHOLD' AND (a.row - b.row) * (a.row - b.row) + (a.col - b.col) * (a.col - b.col) <= 1) AS clear FROM cells a""")
def clear_mask(spark, sf_dir):
    return raster.clear_mask(D.cells(spark, sf_dir), "class", ("BUILDING", "MACHINERY", "AUTOMOBILE"), ("HOUSEHOLD",), 1).select("cell_id", "clear")


@query(f"""WITH {D.CELLS} SELECT a.cell_id, round(quantile_cont(b.value, 0.1), 6) AS p10 FROM cells a JOIN cells b ON abs(a.row - b.row) <= 3 AND abs(a.col - b.col) <= 3 GROUP BY a.cell_id""")
def moving_percentile(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    low = raster.focal_tiles(cells, "value", 3, lambda w: np.nanpercentile(w, 10, axis=1), "p10", tile=64)
    return rounded(cells.join(low, ["row", "col"]), "p10", digits=6).select("cell_id", "p10")


@query(f"""WITH {D.CELLS} SELECT a.cell_id, round(avg(b.value), 9) AS mean FROM cells a JOIN cells b ON abs(a.row - b.row) <= 4 AND abs(a.col - b.col) <= 4 GROUP BY a.cell_id""")
def moving_mean(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    mean = raster.focal_tiles(cells, "value", 4, lambda w: np.nanmean(w, axis=1), "mean", tile=32)
    return rounded(cells.join(mean, ["row", "col"]), "mean", digits=9).select("cell_id", "mean")


@query("""SELECT l_suppkey AS cell, round(CASE WHEN count(*) FILTER (l_discount > 0.01) >= 3 THEN avg(CASE WHEN l_quantity > 40 THEN 1.0 ELSE 0.0 END) FILTER (l_discount > 0.01) END, 8) AS share, count(*) FILTER (l_discount > 0.01) AS n FROM lineitem GROUP BY 1""")
def water_frequency(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "cell")
    return rounded(raster.frequency(items, ["cell"], F.col("l_quantity") > 40, F.col("l_discount") > 0.01, 3), "share", digits=8)


@query(f"WITH {D.CELLS} SELECT CAST(row // 5 AS BIGINT) AS block_row, CAST(col // 5 AS BIGINT) AS block_col, " + ", ".join(f"round(avg(CASE WHEN class = '{s}' THEN 1.0 ELSE 0.0 END), 8) AS \"{s}\"" for s in SEGMENTS) + " FROM cells GROUP BY 1, 2")
def class_fractions(spark, sf_dir):
    return rounded(raster.class_fractions(D.cells(spark, sf_dir), 5, "class", SEGMENTS), *SEGMENTS, digits=8)


_TARGET = """size AS (SELECT CAST(ceil((max(row) + 1) / 1.6) AS BIGINT) AS h, CAST(ceil((max(col) + 1) / 1.6) AS BIGINT) AS w FROM cells),
    t AS (SELECT CAST(g // w AS INTEGER) AS row, CAST(g % w AS INTEGER) AS col, ((g // w) + 0.5) * 1.6 - 0.5 AS y, ((g % w) + 0.5) * 1.6 - 0.5 AS x FROM (SELECT w, unnest(range(0, h * w)) AS g FROM size))"""


def _extent(cells, scale=1.0):
    """Rows and columns of the cells' grid at so many cells to a cell."""
    last = cells.agg(F.max("row"), F.max("col")).first()
    return tuple(math.ceil((k + 1) / scale) for k in last)


@query(f"""WITH {D.CELLS}, {_TARGET}, k AS (SELECT t.row, t.col, (1 - abs(y - (floor(y) + r))) * (1 - abs(x - (floor(x) + c))) AS w, CAST(floor(y) + r AS INTEGER) AS sr, CAST(floor(x) + c AS INTEGER) AS sc FROM t, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS o(r, c))
    SELECT k.row, k.col, round(sum(value * w) / nullif(sum(w), 0), 4) AS value FROM k JOIN cells ON cells.row = sr AND cells.col = sc WHERE value IS NOT NULL GROUP BY 1, 2""")
def resample_bilinear(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    return rounded(raster.resample(cells, "value", 1.6, *_extent(cells, 1.6), "bilinear"), "value")


@query(f"""WITH {D.CELLS}, {_TARGET} SELECT t.row, t.col, value FROM t JOIN cells ON cells.row = CAST(floor(y + 0.5) AS INTEGER) AND cells.col = CAST(floor(x + 0.5) AS INTEGER)""")
def resample_nearest(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    return raster.resample(cells, "value", 1.6, *_extent(cells, 1.6), "nearest")


@query(f"""WITH {D.CELLS} SELECT CAST(floor((row + 0.5) / 3.5) AS INTEGER) AS row, CAST(floor((col + 0.5) / 3.5) AS INTEGER) AS col, round(avg(value), 6) AS value FROM cells GROUP BY 1, 2""")
def resample_average(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    return rounded(raster.resample(cells, "value", 3.5, *_extent(cells, 3.5)), "value", digits=6)


#: The cells as a UTM grid of 30 m near a corner, and the degree grid that they are carried to.
_UTM = {"west": 470_000.0, "north": 527_000.0, "step": 30.0}
_DEGREES = 0.00035
_SERIES = {"n": (1 / 298.257223563) / (2 - 1 / 298.257223563)}
_SERIES |= {"r": 0.9996 * 6378137.0 / (1 + _SERIES["n"]) * (1 + _SERIES["n"] ** 2 / 4 + _SERIES["n"] ** 4 / 64), "e": 2 * math.sqrt(_SERIES["n"]) / (1 + _SERIES["n"])}


def _utm_sql(source: str, keep: str) -> str:
    """x, y in metres of lat, lon in degrees, meridian 75 west."""
    n = _SERIES["n"]
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    x = " + ".join(["eta", *(f"{c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(alpha, 1))])
    y = " + ".join(["xi", *(f"{c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(alpha, 1))])
    e = repr(_SERIES["e"])
    return f"""(SELECT {keep}, 500000 + {_SERIES["r"]!r} * ({x}) AS x, {_SERIES["r"]!r} * ({y}) AS y FROM (SELECT *, atan2(q, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + q * q)) AS eta
        FROM (SELECT *, radians(lon + 75) AS lam, sinh(atanh(sin(radians(lat))) - {e} * atanh({e} * sin(radians(lat)))) AS q FROM {source})))"""


def _degrees_sql(source: str, keep: str) -> str:
    """lat, lon of x, y: the same series the other way."""
    n = _SERIES["n"]
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    up = " - ".join(["xi", *(f"{c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(beta, 1))])
    across = " - ".join(["eta", *(f"{c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(beta, 1))])
    lat = " + ".join(["chi", *(f"{c!r} * sin({2 * j} * chi)" for j, c in enumerate(delta, 1))])
    return f"""(SELECT {keep}, degrees({lat}) AS lat, -75 + degrees(atan2(sinh(v), cos(u))) AS lon FROM (SELECT *, asin(sin(u) / cosh(v)) AS chi FROM (SELECT *, {up} AS u, {across} AS v
        FROM (SELECT *, y / {_SERIES["r"]!r} AS xi, (x - 500000) / {_SERIES["r"]!r} AS eta FROM {source}))))"""


_REPROJECTED = f"""WITH {D.CELLS}, size AS MATERIALIZED (SELECT max(row) + 1 AS h, max(col) + 1 AS w FROM cells),
    rim AS (SELECT 470000 + 30 * c AS x, 527000 - 30 * r AS y FROM (SELECT h, w, unnest(range(0, h + 1)) AS r FROM size), (SELECT unnest(range(0, w + 1)) AS c FROM size) WHERE r <= 1 OR r >= h - 1 OR c <= 1 OR c >= w - 1),
    box AS MATERIALIZED (SELECT west, north, CAST(floor((north - s) / {_DEGREES}) AS BIGINT) + 1 AS h, CAST(floor((e - west) / {_DEGREES}) AS BIGINT) + 1 AS w FROM (SELECT {_DEGREES} * floor(min(lon) / {_DEGREES}) AS west, {_DEGREES} * (floor(max(lat) / {_DEGREES}) + 1) AS north, min(lat) AS s, max(lon) AS e FROM {_degrees_sql("rim", "x, y")})),
    target AS (SELECT CAST(g // w AS INTEGER) AS row, CAST(g % w AS INTEGER) AS col, west + (g % w + 0.5) * {_DEGREES} AS lon, north - (g // w + 0.5) * {_DEGREES} AS lat FROM (SELECT *, unnest(range(0, h * w)) AS g FROM box)),
    asked AS MATERIALIZED (SELECT a.row, a.col, (527000 - y) / 30 - 0.5 AS v, (x - 470000) / 30 - 0.5 AS u FROM {_utm_sql("target", "row, col")} a, size WHERE (527000 - y) / 30 BETWEEN 0 AND h AND (x - 470000) / 30 BETWEEN 0 AND w),
    near AS MATERIALIZED (SELECT a.row, a.col, value FROM asked a JOIN cells c ON c.row = CAST(floor(v + 0.5) AS INTEGER) AND c.col = CAST(floor(u + 0.5) AS INTEGER)),
    four AS (SELECT a.row, a.col, sum(value * w) / nullif(sum(w), 0) AS value FROM (SELECT *, (1 - abs(v - (floor(v) + r))) * (1 - abs(u - (floor(u) + c))) AS w FROM asked, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS o(r, c)) a
        JOIN cells k ON k.row = CAST(floor(v) + r AS INTEGER) AND k.col = CAST(floor(u) + c AS INTEGER) GROUP BY 1, 2),
    moved AS MATERIALIZED (SELECT CAST(floor((north - lat) / {_DEGREES}) AS INTEGER) AS row, CAST(floor((lon - west) / {_DEGREES}) AS INTEGER) AS col, avg(value) AS mean, sum(value) AS total
        FROM {_degrees_sql("(SELECT value, 470000 + 30 * (col + 0.5) AS x, 527000 - 30 * (row + 0.5) AS y FROM cells)", "value")}, box GROUP BY 1, 2)
    SELECT 'nearest' AS how, row, col, round(value, 2) AS value FROM near UNION ALL SELECT 'bilinear', row, col, round(value, 2) FROM four WHERE value IS NOT NULL UNION ALL SELECT 'sum', row, col, round(total, 2) FROM moved
    UNION ALL SELECT 'average', row, col, round(mean, 6) FROM moved UNION ALL SELECT 'average', row, col, round(value, 6) FROM near WHERE (row, col) NOT IN (SELECT (row, col) FROM moved)"""


@query(_REPROJECTED)
def reprojected(spark, sf_dir):
    """The whole grid of cells, as a UTM grid, on a grid of degrees, by each method."""
    cells = D.cells(spark, sf_dir)
    rows, cols = _extent(cells)
    source = reproject.Lattice(**_UTM, rows=rows, cols=cols)
    to_degrees = lambda x, y: tuple(reversed(C.from_utm(x, y, -75.0)))
    to_metres = lambda lon, lat: C.utm(lat, lon, -75.0)
    target = reproject.bounding(source, to_degrees, _DEGREES, spark)
    done = [reproject.reproject(cells, "value", source, target, to_degrees, to_metres, how).select(F.lit(how).alias("how"), "row", "col", "value") for how in reproject.HOW]
    every = reduce(lambda a, b: a.unionByName(b), done)
    return every.withColumn("value", F.when(F.col("how") == "average", F.round("value", 6)).otherwise(F.round("value", 2)))


@query(f"""WITH {D.CELLS}, u AS (SELECT quantile_cont(value, 0.99) AS p FROM cells WHERE class <> 'HOUSEHOLD') SELECT cell_id, round(least(100, greatest(0, 100 * value / p)), 6) AS scaled FROM cells, u""")
def percentile_index(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    top = A.exact_percentile(cells.filter("class <> 'HOUSEHOLD'"), "value", 0.99)
    scaled = F.least(F.lit(100.0), F.greatest(F.lit(0.0), 100 * F.col("value") / F.lit(top)))
    return cells.select("cell_id", F.round(scaled, 6).alias("scaled"))


_LINE = "CASE WHEN t <= 0 THEN sqrt(pow(col - 5, 2) + pow(row - 2, 2)) WHEN t >= 1 THEN sqrt(pow(col - 45, 2) + pow(row - 25, 2)) ELSE sqrt(pow(col - 5 - 40 * t, 2) + pow(row - 2 - 23 * t, 2)) END"


@query(f"""WITH {D.CELLS}, c AS (SELECT cell_id, row, col, ((col - 5) * 40 + (row - 2) * 23) / 2129.0 AS t FROM cells), d AS (SELECT *, {_LINE} AS d FROM c)
    SELECT cell_id, CASE WHEN d <= 2.3 THEN 0 WHEN d <= 5.1 THEN 1 WHEN d <= 9.7 THEN 2 END AS ring, CAST(sign(40 * (row - 2) - 23 * (col - 5)) AS INTEGER) AS bank, round(d, 6) AS distance FROM d""")
def corridor_rings(spark, sf_dir):
    x, y = F.col("col").cast("double"), F.col("row").cast("double")
    far = C.segment_distance(x, y, F.lit(5.0), F.lit(2.0), F.lit(45.0), F.lit(25.0))
    return D.cells(spark, sf_dir).select("cell_id", raster.rings(far, [2.3, 5.1, 9.7]).alias("ring"), raster.bank(x, y, 5, 2, 45, 25).alias("bank"), F.round(far, 6).alias("distance"))


@query(f"""WITH {D.CELLS}, s AS (SELECT row + dr AS row, col + dc AS col, dr, dc FROM cells, (SELECT a.x AS dr, b.x AS dc FROM (VALUES (-1), (0), (1)) AS a(x), (VALUES (-1), (0), (1)) AS b(x)) WHERE dist < 200)
    SELECT dr, dc, round(avg(value), 6) AS mean FROM s JOIN cells USING (row, col) GROUP BY 1, 2""")
def shift_test(spark, sf_dir):
    cells = D.cells(spark, sf_dir).withColumn("flag", F.col("dist") < 200)
    return rounded(raster.shift_test(cells, "value", "flag"), "mean", digits=6)


@query(f"""WITH {D.CELLS} SELECT cell_id, round(CASE WHEN value <= 0 THEN 0.0 WHEN value <= 1000 THEN 0.0 + (value - 0) * (0.25 / 1000) WHEN value <= 6000 THEN 0.25 + (value - 1000) * ((1.0 - 0.25) / 5000) ELSE 1.0 END, 8) AS rate,
    max(value) OVER (PARTITION BY zone ORDER BY cell_id ROWS UNBOUNDED PRECEDING) AS monotone FROM cells""")
def calibration_curve(spark, sf_dir):
    cells = raster.interpolate(D.cells(spark, sf_dir), F.col("value"), [(0, 0.0), (1000, 0.25), (6000, 1.0)], "rate")
    return rounded(raster.monotone(cells, ["zone"], "cell_id", "value"), "rate", digits=8).select("cell_id", "rate", "monotone")


# --- aggregates ---------------------------------------------------------------------------------------------------------


@query(f"WITH {D.CELLS} SELECT zone, round(coalesce(avg(CASE WHEN value < dist * 5 - 10 THEN 1.0 ELSE 0.0 END), 0), 8) AS cold FROM cells GROUP BY zone")
def cold_share(spark, sf_dir):
    return rounded(D.cells(spark, sf_dir).groupBy("zone").agg(A.cold_share(F.col("value"), F.col("dist") * 5).alias("cold")), "cold", digits=8)


@query("""WITH g AS (SELECT l_suppkey % 7 AS scene, count(*) AS n, avg(CASE WHEN l_quantity * (1 + l_suppkey % 7) < 50 THEN 1.0 ELSE 0.0 END) AS share FROM lineitem WHERE l_discount < 0.08 GROUP BY 1)
    SELECT scene, n, round(share, 8) AS share, CASE WHEN n < 1000 THEN NULL WHEN share > 0.5 THEN true WHEN share < 0.02 THEN false END AS shifted FROM g""")
def offset_state(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").withColumn("scene", F.col("l_suppkey") % 7)
    return rounded(A.offset_state(items, ["scene"], F.col("l_discount") < 0.08, F.col("l_quantity") * (1 + F.col("scene")), limit=50), "share", digits=8)


@query(f"WITH {D.CELLS}, g AS (SELECT cell_id, CASE WHEN weight > 2 THEN dist END AS d, CASE WHEN weight < 5 THEN value END AS v FROM cells) SELECT cell_id, coalesce(d, 100) < 400 AND coalesce(v, 0) > 1000 AS inside FROM g")
def mask_terms(spark, sf_dir):
    cells = D.cells(spark, sf_dir).select("cell_id", F.when(F.col("weight") > 2, F.col("dist")).alias("d"), F.when(F.col("weight") < 5, F.col("value")).alias("v"))
    return cells.select("cell_id", A.all_of([("d", 100.0, lambda c: c < 400), ("v", 0.0, lambda c: c > 1000)]).alias("inside"))


@query(f"WITH {D.CELLS} SELECT CAST(floor(value / 500) AS BIGINT) AS bin, count(*) AS n, sum(weight) AS weight FROM cells GROUP BY 1")
def histogram(spark, sf_dir):
    return A.histogram(D.cells(spark, sf_dir), F.floor(F.col("value") / 500), F.col("weight"))


@query(f"WITH {D.CELLS} SELECT zone, round(avg(value) FILTER (dist < 300), 6) AS mean_in, round(median(value) FILTER (dist < 300), 6) AS median_in, round(avg(value) FILTER (dist >= 300), 6) AS mean_out, round(avg(value) FILTER (dist < 300) - avg(value) FILTER (dist >= 300), 6) AS gap FROM cells GROUP BY zone")
def masked_means(spark, sf_dir):
    return rounded(A.masked(D.cells(spark, sf_dir), ["zone"], "value", F.col("dist") < 300), "mean_in", "median_in", "mean_out", "gap", digits=6)


@query(f"""WITH {D.CELLS}, p AS (SELECT class, CAST(zone % 3 AS INTEGER) AS level, sum(weight) AS area FROM cells GROUP BY 1, 2)
    SELECT class, level, area, round(100 * area / sum(area) OVER (PARTITION BY class), 8) AS pct_of_first, round(100 * area / sum(area) OVER (PARTITION BY level), 8) AS pct_of_second FROM p""")
def cross_shares(spark, sf_dir):
    cells = D.cells(spark, sf_dir).withColumn("level", (F.col("zone") % 3).cast("int"))
    return rounded(A.cross_shares(cells, "class", "level", F.col("weight")), "pct_of_first", "pct_of_second", digits=8)


@query(f"""WITH {D.CELLS}, p AS (SELECT CAST(row // 3 AS BIGINT) AS poly, zone, weight, dist, value > 5000 AS high FROM cells), c AS (SELECT poly, zone, count(*) AS n FROM p GROUP BY 1, 2),
    m AS (SELECT poly, zone FROM (SELECT *, row_number() OVER (PARTITION BY poly ORDER BY n DESC, zone) AS k FROM c) WHERE k = 1)
    SELECT p.poly, count(*) AS cells, sum(weight) AS area, min(dist) AS nearest, round(100 * avg(CASE WHEN high THEN 1.0 ELSE 0.0 END), 8) AS pct, m.zone, CASE WHEN min(dist) <= 5 THEN 1 ELSE 2 END AS type FROM p JOIN m USING (poly) GROUP BY p.poly, m.zone""")
def polygon_profiles(spark, sf_dir):
    cells = D.cells(spark, sf_dir).select(F.floor(F.col("row") / 3).alias("poly"), "zone", "weight", "dist", (F.col("value") > 5000).alias("high"))
    return rounded(A.profiles(cells, "poly", "zone", F.col("weight"), "dist", "high", 5), "pct", digits=8)


@query(f"WITH {D.CELLS}, b AS (SELECT CASE WHEN dist >= 600 THEN 2 WHEN dist >= 300 THEN 1 WHEN dist >= 100 THEN 0 END AS band, value FROM cells) SELECT band, count(*) AS n, count(*) FILTER (value > 3000) AS passed FROM b WHERE band IS NOT NULL GROUP BY band")
def band_passes(spark, sf_dir):
    return A.bands(D.cells(spark, sf_dir), "dist", [100, 300, 600], F.col("value") > 3000)


@query("""SELECT strftime(o_orderdate, '%Y%m%d') || '_' || right(o_orderpriority, 2) || '_' || coalesce(nullif(split_part(o_orderpriority, '-', 2), ''), '') AS key, count(*) AS n FROM orders GROUP BY 1""")
def composite_keys(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.groupBy(A.composite_keys(orders, "o_orderdate", "o_orderpriority", "o_orderpriority", 1, "-").alias("key")).agg(F.count("*").alias("n"))


@query(f"""WITH {D.CELLS}, s AS (SELECT zone, sum(weight) AS summed FROM cells GROUP BY zone), t AS (SELECT n_nationkey AS zone, 180.0 AS stated FROM nation)
    SELECT zone, summed, stated, coalesce(abs(summed - stated) <= 40, false) AS ok FROM s FULL JOIN t USING (zone)""")
def coherent_totals(spark, sf_dir):
    totals = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zone"), F.lit(180.0).alias("weight"))
    return A.coherent(D.cells(spark, sf_dir), totals, ["zone"], "weight", 40)


@query("""WITH c AS (SELECT l_suppkey AS cell, l_returnflag AS period, l_discount > 0.09 AS h FROM lineitem WHERE l_quantity > 47), s AS (SELECT cell, count(DISTINCT period) FILTER (period IN ('A', 'N', 'R')) AS n, min(period) AS p, bool_or(h) AS h FROM c GROUP BY cell)
    SELECT cell, n > 0 AS "any", n = 3 AS "all", CAST(n AS INTEGER) AS count, CASE WHEN n = 1 AND NOT h THEN p END AS only FROM s""")
def mask_sets(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").filter("l_quantity > 47").withColumnRenamed("l_suppkey", "cell")
    return A.mask_sets(items, "l_returnflag", "cell", ["A", "N", "R"], F.col("l_discount") > 0.09)


@query("""WITH d AS (SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS f FROM lineitem WHERE l_quantity > 45) SELECT day FROM d WHERE f = 'A' INTERSECT SELECT day FROM d WHERE f = 'R'""", dates=("day",))
def common_days(spark, sf_dir):
    days = read_table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.to_date("l_shipdate").alias("day"), "l_returnflag")
    part = lambda f: days.filter(F.col("l_returnflag") == f).select("day")
    return part("A").intersect(part("R"))


@query(f"WITH {D.CELLS} SELECT class, round(avg(value) FILTER (dist <= 200), 6) AS near, round(avg(value) FILTER (dist > 600), 6) AS far, round(avg(value) FILTER (dist <= 200) - avg(value) FILTER (dist > 600), 6) AS gap FROM cells GROUP BY class")
def near_and_far(spark, sf_dir):
    return rounded(A.distance_groups(D.cells(spark, sf_dir), ["class"], "value", "dist", 200, 600), "near", "far", "gap", digits=6)


@query("""WITH a AS (SELECT c_nationkey AS zone, avg(c_acctbal) AS a FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS zone, avg(s_acctbal) AS b FROM supplier WHERE s_nationkey <> 3 GROUP BY 1)
    SELECT zone, round(a, 4) AS a, round(b, 4) AS b, round(a - b, 4) AS difference, round(a / nullif(b, 0), 4) AS ratio FROM a FULL JOIN b USING (zone)""")
def source_comparison(spark, sf_dir):
    a = read_table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("zone")).agg(F.avg("c_acctbal").alias("v"))
    b = read_table(spark, sf_dir, "supplier").filter("s_nationkey <> 3").groupBy(F.col("s_nationkey").alias("zone")).agg(F.avg("s_acctbal").alias("v"))
    return rounded(A.against(a, b, ["zone"], "v"), "a", "b", "difference", "ratio")


@query(f"""WITH {D.CELLS}, t AS (SELECT a.row, a.col, a.value AS v, a.value + 50 * a.weight AS ref, b.value AS f FROM cells a LEFT JOIN cells b ON b.row = (SELECT max(row) FROM cells) - a.row AND b.col = a.col)
    SELECT round(corr(v, ref), 8) AS r, round(corr(f, ref), 8) AS r_flipped, corr(v, ref) > coalesce(corr(f, ref), -2) AS upright FROM t""")
def upright_layer(spark, sf_dir):
    cells = D.cells(spark, sf_dir).withColumn("ref", F.col("value") + 50 * F.col("weight"))
    return rounded(A.upright(cells, "value", "ref", _extent(cells)[0]), "r", "r_flipped", digits=8)


_POINTS = "(VALUES ('bridge', 2, 7), ('square', 11, 40), ('nowhere', 900, 2)) AS p(name, row, col)"


@query(f"WITH {D.CELLS} SELECT name, p.row, p.col, value, dist FROM {_POINTS} LEFT JOIN cells ON cells.row = p.row AND cells.col = p.col")
def control_points(spark, sf_dir):
    points = spark.createDataFrame([("bridge", 2, 7), ("square", 11, 40), ("nowhere", 900, 2)], "name string, row int, col int")
    return A.control_points(D.cells(spark, sf_dir), points, ["value", "dist"])


@query(f"""WITH {D.CELLS}, g AS (SELECT cell_id, 4.77 - (row + 0.5) * 0.00025 AS lat, -75.95 + (col + 0.5) * 0.00025 AS lon FROM cells UNION ALL SELECT -1, 9.0, 9.0)
    SELECT cell_id, CASE WHEN floor((4.77 - lat) / 0.00025) BETWEEN 0 AND 519 THEN CAST(floor((4.77 - lat) / 0.00025) AS BIGINT) END AS row, CASE WHEN floor((lon + 75.95) / 0.00025) BETWEEN 0 AND 427 THEN CAST(floor((lon + 75.95) / 0.00025) AS BIGINT) END AS col FROM g""")
def point_to_cell(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    places = cells.select("cell_id", D.GRID.lat(F.col("row")).alias("lat"), D.GRID.lon(F.col("col")).alias("lon")).unionAll(spark.createDataFrame([(-1, 9.0, 9.0)], "cell_id long, lat double, lon double"))
    return places.select("cell_id", D.GRID.row_of(F.col("lat")).alias("row"), D.GRID.col_of(F.col("lon")).alias("col"))


@query("""SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity <> 30 AND l_discount > 0.01 THEN (40000 + l_quantity * 100) * 0.00341802 + 149.0 - 273.15 END, 6) AS celsius,
    CASE WHEN l_quantity > 1 AND l_extendedprice > 1 THEN CAST(round_even(greatest(-1, least(1, (l_quantity * 900 - l_extendedprice) / (l_quantity * 900 + l_extendedprice))) * 10000, 0) AS INTEGER) END AS indexed FROM lineitem""")
def band_numbers(spark, sf_dir):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    number = F.when(q != 30, 40000 + q * 100).otherwise(0)
    indexed = F.when((q > 1) & (p > 1), C.censored_index(q * 900, p))
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(C.thermal_celsius(number, F.col("l_discount") > 0.01), 6).alias("celsius"), indexed.alias("indexed"))


_WAYS = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ST_B10' ELSE 'ST_B6' END"


@query(f"SELECT o_orderkey, {_WAYS} AS band, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 31 ELSE 27 END AS mask, o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1997-01-01' AS used FROM orders")
def platform_routing(spark, sf_dir):
    route = C.platform_band(F.col("o_orderpriority"), ("1-URGENT", "2-HIGH"), ("ST_B10", 31), ("ST_B6", 27))
    used = C.item_used(F.col("o_orderstatus"), "F", F.col("o_orderpriority"), ("5-LOW",), F.col("o_orderdate"), "1997-01-01")
    return read_table(spark, sf_dir, "orders").select("o_orderkey", route[0].alias("band"), route[1].alias("mask"), used.alias("used"))


# --- flow and allocation --------------------------------------------------------------------------------------------------


@query()
def least_upstream(spark, sf_dir):
    cells = D.cells(spark, sf_dir).select("row", "col", "value", (F.col("zone") % 4).alias("group"))
    links = flow.descent(cells, "value", ["group"]).checkpoint()
    return flow.least_upstream(links, "value", "group")


@query()
def straight_runs(spark, sf_dir):
    links = flow.descent(D.cells(spark, sf_dir), "cell_id").withColumn("inside", F.lit(True))
    return flow.straight_runs(links, "inside", 10)


@query()
def drainage_network(spark, sf_dir):
    cells = D.cells(spark, sf_dir).select("row", "col", "value", "zone", (F.col("dist") < 700).alias("inside"))
    links = flow.descent(cells, "value", ["zone", "inside"])
    return flow.network(links, "inside", "zone").select("zone", F.size("segments").alias("n"), F.to_json("segments").alias("segments"))


@query("""WITH p AS (SELECT l_suppkey AS canal, l_quantity AS own, CASE WHEN l_linenumber <> 4 THEN l_quantity * (1 + l_tax) - l_discount * 20 END AS l, l_quantity + 2 AS r FROM lineitem)
    SELECT canal, count(*) AS points, round(100 * avg(CASE WHEN own <= least(l, r) + 0.5 THEN 1.0 ELSE 0.0 END), 8) AS pct_low, avg(CASE WHEN own <= least(l, r) + 0.5 THEN 1.0 ELSE 0.0 END) >= 0.6 AS drains FROM p WHERE l IS NOT NULL GROUP BY canal""")
def canal_drains(spark, sf_dir):
    q = F.col("l_quantity")
    points = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("canal"), q.alias("own"), F.when(F.col("l_linenumber") != 4, q * (1 + F.col("l_tax")) - F.col("l_discount") * 20).alias("l"), (q + 2).alias("r"))
    return rounded(flow.canal_drains(points, "canal", "own", "l", "r"), "pct_low", digits=8)


@query(f"""WITH {D.CELLS}, l AS (SELECT row, col, dist / 100 AS level, value / 1000 AS major, weight < 3 AS minor, row - row % 3 AS tr, col - col % 3 AS tc FROM cells)
    SELECT a.row, a.col, round(CASE WHEN a.minor THEN greatest(a.level, coalesce(b.major, a.level)) ELSE a.level END, 8) AS level FROM l a LEFT JOIN l b ON b.row = a.tr AND b.col = a.tc""")
def floored_levels(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    levels = cells.select("row", "col", (F.col("dist") / 100).alias("level"), (F.col("value") / 1000).alias("major"), (F.col("weight") < 3).alias("minor"))
    found = cells.select("row", "col", (F.col("row") - F.col("row") % 3).alias("target_row"), (F.col("col") - F.col("col") % 3).alias("target_col"))
    return rounded(flow.floored(levels, found, "level", "major", "minor"), "level", digits=8).select("row", "col", "level")


_BLOCKS = "g AS (SELECT * FROM (VALUES (1), (4), (8)) AS t(size))"


@query(f"""WITH {D.CELLS}, {_BLOCKS}, b AS (SELECT size, row // size AS r, col // size AS c, sum(weight) AS a, sum(dist) AS b FROM cells, g GROUP BY 1, 2, 3), t AS (SELECT size, sum(a) AS ta, sum(b) AS tb FROM b GROUP BY 1)
    SELECT size, round(sum(abs(a / ta - b / tb)) / 2, 8) AS dissimilarity FROM b JOIN t USING (size) GROUP BY size""")
def scale_dissimilarity(spark, sf_dir):
    return rounded(allocate.scale_dissimilarity(D.cells(spark, sf_dir), "weight", "dist", [1, 4, 8]), "dissimilarity", digits=8)


_HELD = """x AS (SELECT c.*, sum(weight) OVER z AS t, count(*) OVER z AS n, CASE m WHEN 'distance' THEN dist WHEN 'even' THEN 0.0 END AS w, m FROM cells c, (VALUES ('distance'), ('even')) AS k(m) WINDOW z AS (PARTITION BY m, zone)),
    y AS (SELECT *, t * CASE WHEN sum(w) OVER z > 0 THEN w / sum(w) OVER z ELSE 1.0 / n END AS allocated FROM x WINDOW z AS (PARTITION BY m, zone))"""


@query(f"""WITH {D.CELLS}, {_BLOCKS}, {_HELD}, b AS (SELECT m, size, row // size AS r, col // size AS c, sum(weight) AS a, sum(allocated) AS b FROM y, g WHERE size < 8 GROUP BY ALL), t AS (SELECT m, size, sum(a) AS ta, sum(b) AS tb FROM b GROUP BY ALL)
    SELECT m AS method, size, round(sum(abs(a / ta - b / tb)) / 2, 8) AS dissimilarity FROM b JOIN t USING (m, size) GROUP BY 1, 2""")
def held_out_allocation(spark, sf_dir):
    return rounded(allocate.held_out(D.cells(spark, sf_dir), "zone", "weight", {"distance": F.col("dist"), "even": F.lit(0.0)}, [1, 4]), "dissimilarity", digits=8)


@query(f"""WITH {D.CELLS}, {_HELD} SELECT cell_id, round(allocated, 8) AS allocated FROM y WHERE m = 'distance'""")
def redistributed(spark, sf_dir):
    return rounded(allocate.redistribute(D.cells(spark, sf_dir), "zone", "weight", F.col("dist")), "allocated", digits=8).select("cell_id", "allocated")


@query(f"WITH {D.CELLS} SELECT row, col, value, weight FROM cells WHERE row = 12 AND col = 7")
def point_inspection(spark, sf_dir):
    return allocate.inspect(D.cells(spark, sf_dir), 12, 7, ["value", "weight"])


@query(f"""WITH {D.CELLS}, c AS (SELECT row // 4 AS r, col // 4 AS c, CAST(round(avg(value) / 2000) AS BIGINT) AS level, avg(dist) AS v FROM cells GROUP BY 1, 2)
    SELECT CAST(a.r AS BIGINT) AS row, CAST(a.c AS BIGINT) AS col, count(b.v) AS neighbours, round(avg(b.v), 6) AS mean FROM c a LEFT JOIN c b ON abs(a.r - b.r) + abs(a.c - b.c) = 1 AND a.level = b.level GROUP BY 1, 2""")
def coarse_neighbours(spark, sf_dir):
    coarse = D.cells(spark, sf_dir).groupBy(F.floor(F.col("row") / 4).alias("row"), F.floor(F.col("col") / 4).alias("col")).agg(F.round(F.avg("value") / 2000).cast("long").alias("level"), F.avg("dist").alias("v"))
    return rounded(joins.coarse_neighbours(coarse, "row", "col", "level", "v"), "mean", digits=6)


@query(f"WITH {D.CELLS} SELECT a.cell_id, b.value AS moved FROM cells a JOIN cells b ON b.row + 3 = a.row AND b.col - 2 = a.col")
def shifted_lattice(spark, sf_dir):
    cells = D.cells(spark, sf_dir)
    moved = layers.shifted(cells.select("row", "col", F.col("value").alias("moved")), 3, -2)
    return cells.select("cell_id", "row", "col").join(moved, ["row", "col"]).select("cell_id", "moved")
