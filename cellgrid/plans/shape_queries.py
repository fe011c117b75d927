"""Queries of polygons, lines and spatial joins beyond points in zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellgrid.functions import clib
from cellgrid.operators import joins, polygons, raster, shapes
from cellgrid.plans import adapter as D
from cellgrid.plans.registry import EDGES, INSIDE, query, rounded
from cellgrid.session import read_table

#: A rectangle's part of the zone's square, and of the triangle that its cut corner takes away (both in the zone's own
#: coordinates): what is left is the overlap of a cell of 70 with a zone.
_OVERLAP = """z AS (SELECT n_nationkey AS k, n_name, (n_nationkey % 5) * 200.0 AS x0, (n_nationkey // 5) * 200.0 AS y0 FROM nation), c AS (SELECT k, n_name, r.g AS row, q.g AS col,
    greatest(q.g * 70.0 - x0, 10) AS a, least((q.g + 1) * 70.0 - x0, 190) AS b, greatest(r.g * 70.0 - y0, 10) AS c, least((r.g + 1) * 70.0 - y0, 190) AS d FROM z, range(0, 15) AS r(g), range(0, 15) AS q(g)),
    o AS (SELECT k, n_name, row, col, (b - a) * (d - c) - (pow(greatest(0, b + d - 290), 2) - pow(greatest(0, a + d - 290), 2) - pow(greatest(0, b + c - 290), 2) + pow(greatest(0, a + c - 290), 2)) / 2 AS part
    FROM c WHERE a < b AND c < d)"""


@query(f"WITH {_OVERLAP} SELECT k AS zone_idx, row, col, round(part, 6) AS part FROM o WHERE part > 1e-9")
def cell_overlaps(spark, sf_dir):
    return rounded(shapes.cell_overlaps(D.zones(spark, sf_dir), 70.0), "part", digits=6).select("zone_idx", "row", "col", "part")


@query(f"WITH {_OVERLAP} SELECT row, col, round(sum((100.0 + k) * part / 28350.0), 6) AS people FROM o WHERE part > 1e-9 GROUP BY 1, 2")
def spread_by_area(spark, sf_dir):
    blocks = D.zones(spark, sf_dir).withColumn("people", F.col("zone_idx") + 100.0)
    return rounded(shapes.spread_by_area(blocks, 70.0, "people"), "people", digits=6)


@query(f"WITH {_OVERLAP} SELECT n_name AS zone_id, row, col FROM o WHERE part > 1e-9")
def touched_cells(spark, sf_dir):
    return shapes.touched(D.zones(spark, sf_dir), 70.0, ["zone_id"])


@query(f"""WITH {D.PLACES}, {EDGES}, m AS (SELECT k, v.shift, k % 3 + 1 + v.shift AS level, x1 + 60 * v.shift AS x1, y1 + 60 * v.shift AS y1, x2 + 60 * v.shift AS x2, y2 + 60 * v.shift AS y2 FROM edges, (VALUES (0), (1), (2)) AS v(shift)),
    h AS (SELECT place, k, shift, max(level) AS level FROM places JOIN m ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)
    SELECT place, CAST(coalesce(max(level), 0) AS INTEGER) AS level FROM places LEFT JOIN h USING (place) GROUP BY place""")
def highest_level(spark, sf_dir):
    zones = D.zones(spark, sf_dir).withColumn("shift", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    ring = F.transform("ring", lambda p: shapes.point(p["x"] + 60 * F.col("shift"), p["y"] + 60 * F.col("shift")))
    levels = zones.select(ring.alias("ring"), (F.col("zone_idx") % 3 + 1 + F.col("shift")).cast("int").alias("level"))
    return shapes.highest_level(D.places(spark, sf_dir).select("place", "x", "y"), levels, "x", "y", "level", 100.0).select("place", "level")


@query(f"WITH {INSIDE} SELECT n_name AS zone_id, s_acctbal > 0 AS rich, count(*) AS n FROM hits JOIN supplier ON s_suppkey = place GROUP BY 1, 2")
def classes_in_polygons(spark, sf_dir):
    found = joins.points_in_zones(D.places(spark, sf_dir), D.zones(spark, sf_dir), "x", "y", 100.0).filter("zone_id is not null")
    return found.groupBy("zone_id", (F.col("size") > 0).alias("rich")).agg(F.count("*").alias("n"))


@query(f"""WITH {INSIDE}, e AS (SELECT h.place, h.k, p.size FROM hits h JOIN places p USING (place) WHERE p.size < 9000 AND p.zone % 2 = h.k % 2) SELECT place, max(k) AS into FROM e GROUP BY place""")
def merge_contained(spark, sf_dir):
    zones = D.zones(spark, sf_dir).select(F.col("zone_idx").alias("place"), (F.col("zone_idx") % 2).alias("kind"), (9000.0 + F.col("zone_idx")).alias("area"), "ring")
    places = D.places(spark, sf_dir).filter("size < 9000").select("place", (F.col("zone") % 2).alias("kind"), F.col("size").alias("area"), "x", "y")
    return joins.merge_contained(zones, places, "place", "kind", "area", "x", "y", 100.0)


_SAMPLES = f"WITH {D.PLACES}, s AS (SELECT place, x / 5 AS x, y / 5 AS y, cos(place * 0.7) AS ux, sin(place * 0.7) AS uy, place % 10 AS way, zone % 2 AS kind FROM places)"


@query(_SAMPLES + """, p AS (SELECT a.place, b.place AS other, a.way <> b.way AND a.kind = b.kind AS good, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d, sqrt(pow(a.ux + b.ux, 2) + pow(a.uy + b.uy, 2)) AS bend FROM s a JOIN s b ON a.place <> b.place),
    r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY sqrt(d * d + 10000 * bend * bend), other) AS k FROM p),
    f AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY k) AS f FROM r WHERE k <= 8 AND good AND d <= 40 AND bend <= 0.5) SELECT place, other, round(d, 6) AS distance FROM f WHERE f = 1""")
def antiparallel(spark, sf_dir):
    k = F.col("place")
    samples = D.places(spark, sf_dir).select("place", (F.col("x") / 5).alias("x"), (F.col("y") / 5).alias("y"), clib.cos(k * 7 / 10).alias("ux"), clib.sin(k * 7 / 10).alias("uy"), (k % 10).alias("way"), (F.col("zone") % 2).alias("kind"))
    return rounded(joins.antiparallel(samples, "place", "way", "kind"), "distance", digits=6)


@query(f"""WITH {D.PLACES}, t AS (SELECT place AS other, x AS x2, y AS y2 FROM places WHERE place % 4 = 0), d AS (SELECT place, other, 'key' AS matched FROM places JOIN t ON place * 3 = other),
    n AS (SELECT place, other, row_number() OVER (PARTITION BY place ORDER BY sqrt((x - x2) * (x - x2) + (y - y2) * (y - y2)), other) AS k FROM places, t WHERE place * 3 NOT IN (SELECT other FROM t))
    SELECT * FROM d UNION ALL SELECT place, other, 'nearest' FROM n WHERE k = 1""")
def keyed_or_nearest(spark, sf_dir):
    places = D.places(spark, sf_dir).select("place", "x", "y", (F.col("place") * 3).alias("section"))
    targets = places.filter("place % 4 = 0").select(F.col("place").alias("other"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return joins.keyed_or_nearest(places, targets, "section", "other", "place", ("x", "y"), ("x2", "y2"), 100.0)


@query(f"""WITH {D.CELLS}, l AS (SELECT cell_id, u.e FROM cells, unnest([cell_id % 200, (cell_id * 7) % 200]) AS u(e) WHERE weight = 0), d AS (SELECT u.e, value > 0 AS ok FROM cells, unnest([cell_id % 200, (cell_id * 7) % 200]) AS u(e) WHERE weight > 5)
    SELECT cell_id, bool_and(ok) AS accepted FROM l LEFT JOIN d USING (e) GROUP BY cell_id""")
def inherited_decisions(spark, sf_dir):
    k = F.col("cell_id")
    lines = D.cells(spark, sf_dir).select("cell_id", (k % 200).alias("a"), ((k * 7) % 200).alias("b"), "weight", (F.col("value") > 0).alias("ok"))
    return joins.inherited(lines.filter("weight = 0").select("cell_id", "a", "b"), lines.filter("weight > 5").select("a", "b", "ok"), "cell_id", ["a", "b"], "ok")


@query(f"""WITH {D.PLACES}, p AS (SELECT a.place, b.zone, count(*) AS n FROM places a JOIN places b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 200 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY n DESC, zone) AS k FROM p)
    SELECT place, string_agg(CAST(zone AS VARCHAR), ',' ORDER BY k) AS names FROM r WHERE k <= 3 GROUP BY place""")
def top_names(spark, sf_dir):
    places = D.places(spark, sf_dir)
    named = places.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("zone").alias("near"))
    return joins.top_names(places.select("place", "x", "y"), named, "place", ("x", "y"), ("x2", "y2"), "near", 200.0)


_SEGMENT = "CASE WHEN t <= 0 THEN sqrt(pow(x - x1, 2) + pow(y - y1, 2)) WHEN t >= 1 THEN sqrt(pow(x - x2, 2) + pow(y - y2, 2)) ELSE sqrt(pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2)) END"
_AXIS = "axis AS (SELECT * FROM (VALUES ('a', 0.0, 480.0, 520.0, 500.0), ('b', 520.0, 500.0, 1000.0, 430.0)) AS t(name, x1, y1, x2, y2))"


def axis(spark):
    return spark.createDataFrame([("a", 0.0, 480.0, 520.0, 500.0), ("b", 520.0, 500.0, 1000.0, 430.0)], "name string, x1 double, y1 double, x2 double, y2 double")


def _far(source: str, columns: str) -> str:
    return f"(SELECT {columns}, name, {_SEGMENT} AS d FROM (SELECT *, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS t FROM {source}, axis))"


@query(f"""WITH {D.PLACES}, {_AXIS}, r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY round(d, 9), name) AS k FROM {_far("places", "place")}) SELECT place, name, round(d, 6) AS distance FROM r WHERE k = 1""")
def nearest_segment(spark, sf_dir):
    return rounded(joins.nearest_segment(D.places(spark, sf_dir), axis(spark), "place", ("x", "y"), "name", 60.0), "distance", digits=6)


#: Points along each zone's boundary, at most 25 apart.
_BORDER = f"""{EDGES}, cut AS (SELECT *, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS l, CAST(greatest(1, ceil(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) / 25)) AS INTEGER) AS n FROM edges),
    pts AS (SELECT k, n_name, l / n AS length, x1 + (u.j - 0.5) / n * (x2 - x1) AS x, y1 + (u.j - 0.5) / n * (y2 - y1) AS y FROM cut, unnest(range(1, n + 1)) AS u(j))"""


@query(f"""WITH {_BORDER}, {_AXIS}, f AS (SELECT k, x, y, min(d) AS d FROM {_far("(SELECT k, x, y FROM pts)", "k, x, y")} GROUP BY 1, 2, 3), b AS (SELECT k, min(d) AS nearest FROM f GROUP BY k),
    m AS (SELECT k, avg(x1) AS x, avg(y1) AS y FROM edges GROUP BY k), c AS (SELECT k, min(d) AS centre FROM {_far("m", "k")} GROUP BY k) SELECT k AS zone_idx, round(nearest, 6) AS nearest, round(centre, 6) AS centre, CASE WHEN nearest <= 150 THEN 1 ELSE 2 END AS type FROM b JOIN c USING (k)""")
def axis_types(spark, sf_dir):
    return rounded(shapes.axis_types(D.zones(spark, sf_dir), "zone_idx", axis(spark), 25.0, 150.0), "nearest", "centre", digits=6)


@query(f"""WITH {_BORDER}, {_AXIS}, f AS (SELECT k, x, y, length, min(d) AS d FROM {_far("(SELECT k, x, y, length FROM pts)", "k, x, y, length")} GROUP BY 1, 2, 3, 4)
    SELECT k AS zone_idx, x > 500 AS inside, round(sum(length), 6) AS length FROM f WHERE d <= 120 GROUP BY 1, 2""")
def line_near(spark, sf_dir):
    lines = D.zones(spark, sf_dir).select("zone_idx", F.concat("ring", F.slice("ring", 1, 1)).alias("line"))
    return rounded(shapes.line_near(lines, axis(spark), "zone_idx", "line", 25.0, 120.0, F.col("x") > 500), "length", digits=6)


@query(f"""WITH {_BORDER}, {_AXIS}, f AS (SELECT k, x, y, length, min(d) AS d FROM {_far("(SELECT k, x, y, length FROM pts)", "k, x, y, length")} GROUP BY 1, 2, 3, 4),
    s AS (SELECT k, sum(CASE WHEN d <= 90 THEN length ELSE 0 END) / sum(length) AS near, 2 * 28350.0 / (180 + 90 + sqrt(16200) + 90 + 180) AS width FROM f GROUP BY k)
    SELECT k AS zone_idx, round(near, 8) AS near, round(width, 8) AS width, near >= 0.3 AND width < 90 AS divider FROM s""")
def road_dividers(spark, sf_dir):
    return rounded(shapes.dividers(D.zones(spark, sf_dir), "zone_idx", axis(spark), 25.0, 90.0, 0.3, 90.0), "near", "width", digits=8)


@query(f"""WITH RECURSIVE {D.PLACES}, e AS (SELECT a.place AS a, b.place AS b FROM places a JOIN places b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 70), reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
    l AS (SELECT a AS place, min(b) AS cluster FROM reach GROUP BY a), t AS (SELECT cluster, sum(size) AS total FROM l JOIN places USING (place) GROUP BY cluster)
    SELECT place, cluster, round(total, 2) AS total, CAST(total >= 2000 AS INTEGER) + CAST(total >= 10000 AS INTEGER) AS reached FROM l JOIN t USING (cluster)""")
def place_clusters(spark, sf_dir):
    return rounded(shapes.clusters(D.places(spark, sf_dir), "place", "x", "y", "size", 70.0, [2000, 10000]), "total", digits=2)


@query(f"""WITH {D.CELLS} SELECT class, sum(CASE WHEN value > 3000 AND dist < 500 THEN weight ELSE 0.0 END) AS common, round(sum(CASE WHEN value > 3000 AND dist < 500 THEN weight ELSE 0.0 END) / sum(CASE WHEN value > 3000 OR dist < 500 THEN weight ELSE 0.0 END), 8) AS iou,
    round(sum(CASE WHEN value > 3000 AND dist < 500 THEN weight ELSE 0.0 END) / sum(CASE WHEN dist < 500 THEN weight ELSE 0.0 END), 8) AS covered FROM cells GROUP BY class""")
def overlap_scores(spark, sf_dir):
    out = shapes.overlap_scores(D.cells(spark, sf_dir), ["class"], F.col("value") > 3000, F.col("dist") < 500, F.col("weight"))
    return rounded(out, "iou", "covered", digits=8)


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'point' WHEN c_custkey % 4 = 1 THEN 'polygon' WHEN c_custkey % 3 = 0 THEN 'polygon' ELSE 'line' END AS geometry,
    CASE WHEN c_custkey % 4 = 1 THEN 3 WHEN c_custkey % 4 >= 2 AND c_custkey % 3 = 0 THEN 3 END AS points, c_custkey % 4 >= 2 AND c_custkey % 3 = 0 AS closed FROM customer""")
def assembled(spark, sf_dir):
    k = F.col("c_custkey")
    at = lambda x, y: shapes.point(F.lit(float(x)), F.lit(float(y)))
    line = F.array(at(0, 0), at(1, 0), at(1, 1))
    way = F.when(k % 3 == 0, F.concat(line, F.array(at(0, 0)))).otherwise(line)
    kind = F.when(k % 4 == 0, "node").when(k % 4 == 1, "relation").otherwise("way")
    elements = read_table(spark, sf_dir, "customer").select(k.alias("id"), kind.alias("kind"), F.when(k % 4 >= 2, way).otherwise(F.array(at(0, 0))).alias("p"), line.alias("outer"), F.array(line).alias("inner"))
    out = shapes.assemble(elements, "kind", "p", "outer", "inner")
    return out.select("id", "geometry", F.when(F.col("ring").isNotNull(), F.size("ring")).alias("points"), "closed")


@query()
def simplified_lines(spark, sf_dir):
    places = D.places(spark, sf_dir)
    lines = places.groupBy("zone").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x", "y"))), lambda p: shapes.point(p["x"], p["y"])).alias("line"))
    return shapes.simplify(lines, "line", 150.0).select("zone", F.size("line").alias("points"))


@query()
def stitched_lines(spark, sf_dir):
    edges = D.zones(spark, sf_dir).select("zone_idx", F.posexplode(F.arrays_zip(F.col("ring").alias("a"), F.concat(F.slice("ring", 2, 9), F.slice("ring", 1, 1)).alias("b"))).alias("part", "e"))
    parts = edges.select("zone_idx", (F.col("part") * 2 % 5).alias("part"), F.when(F.col("part") % 2 == 0, F.array("e.a", "e.b")).otherwise(F.array("e.b", "e.a")).alias("line"))
    return shapes.stitch(parts, "zone_idx", "part", "line").select("zone_idx", "chain", F.size("line").alias("points"), "closed", F.round(shapes.ring_area(F.slice("line", F.lit(1), F.size("line") - 1)), 4).alias("area"))


@query(f"WITH {_BORDER} SELECT k AS zone_idx, count(*) AS points, round(sum(length), 6) AS length, round(sum(x * length) / sum(length), 6) AS x FROM pts GROUP BY k")
def sampled_borders(spark, sf_dir):
    lines = D.zones(spark, sf_dir).select("zone_idx", F.concat("ring", F.slice("ring", 1, 1)).alias("line"))
    out = raster.sample_lines(lines, "zone_idx", "line", 25.0).groupBy("zone_idx").agg(F.count("*").alias("points"), F.sum("length").alias("length"), (F.sum(F.col("x") * F.col("length")) / F.sum("length")).alias("x"))
    return rounded(out, "length", "x", digits=6)


@query(f"WITH {EDGES} SELECT k AS zone_idx, n_name AS zone_id, (min(x1) + max(x1)) / 2 AS x, (min(y1) + max(y1)) / 2 AS y FROM edges GROUP BY 1, 2")
def zone_centres(spark, sf_dir):
    middle = lambda c: ((F.array_min(F.transform("ring", lambda p: p[c])) + F.array_max(F.transform("ring", lambda p: p[c]))) / 2).alias(c)
    return D.zones(spark, sf_dir).select("zone_idx", "zone_id", middle("x"), middle("y"))


_GROUNDS = f"{D.PLACES}, r AS (SELECT place, zone, x - (place % 7 + 1) AS x1, x + (place % 7 + 1) AS x2, y - (place % 5 + 1) AS y1, y + (place % 5 + 1) AS y2 FROM places)"
_APART = "sqrt(pow(greatest(0, a.x1 - b.x2, b.x1 - a.x2), 2) + pow(greatest(0, a.y1 - b.y2, b.y1 - a.y2), 2))"


def _grounds(spark, sf_dir):
    """Rectangles around the places."""
    w, h = (F.col("place") % 7 + 1).cast("double"), (F.col("place") % 5 + 1).cast("double")
    corner = lambda a, b: F.struct((F.col("x") + a * w).alias("x"), (F.col("y") + b * h).alias("y"))
    return D.places(spark, sf_dir).select("place", "zone", F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1)).alias("ring"))


@query(f"""WITH {_GROUNDS}, d AS (SELECT a.place, b.place AS other, round({_APART}, 9) AS distance FROM r a JOIN r b ON a.zone % 2 = 0 AND b.zone % 2 = 1)
    SELECT place, other, distance FROM d QUALIFY row_number() OVER (PARTITION BY place ORDER BY distance, other) = 1""")
def nearest_polygons(spark, sf_dir):
    """Of each place's ground in an even zone the nearest one in an odd zone."""
    grounds = _grounds(spark, sf_dir)
    odd = grounds.filter("zone % 2 = 1").select(F.col("place").alias("other"), "ring")
    return polygons.nearest(grounds.filter("zone % 2 = 0"), odd, "place", "other", 20.0)


@query(f"""WITH RECURSIVE {_GROUNDS}, l AS MATERIALIZED (SELECT a.place AS a, b.place AS b FROM r a JOIN r b ON a.place <> b.place AND {_APART} <= 24),
    reach(a, b) AS (SELECT place, place FROM r UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
    SELECT a AS place, min(b) AS cluster FROM reach GROUP BY a""")
def closed_clusters(spark, sf_dir):
    return polygons.clusters(_grounds(spark, sf_dir), "place", 12.0)
