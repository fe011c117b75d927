"""Queries of scenarios, sorting, text and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellgrid.functions import text as X
from cellgrid.operators import allocate, scenes, score
from cellgrid.plans import adapter as D
from cellgrid.plans.registry import _BASE, _components, query, rounded
from cellgrid.session import read_table
from cellgrid.sources import layers


@query(_BASE + """, j AS (SELECT zone, 'deficit' AS component, round(avg(norm), 6) AS norm FROM normed WHERE component IN ('heat', 'shade') GROUP BY zone)
    SELECT zone, component, norm FROM normed WHERE component = 'people' UNION ALL SELECT * FROM j""")
def deficit_component(spark, sf_dir):
    return score.mean_component(_components(spark, sf_dir), "zone", ["heat", "shade"], "deficit", digits=6)


@query(_BASE + """, v AS (SELECT 'people_low' AS variant, 'people' AS component, zone, round(norm / 2, 6) AS norm FROM normed WHERE component = 'people' UNION ALL SELECT 'heat_flat', 'heat', zone, 0.5 FROM normed WHERE component = 'heat'),
    e AS (SELECT w.variant, n.zone, n.component, coalesce(v.norm, n.norm) AS norm FROM normed n, (SELECT DISTINCT variant FROM v) w LEFT JOIN v ON v.variant = w.variant AND v.component = n.component AND v.zone = n.zone),
    i AS (SELECT variant, zone, round(sum(norm) / 3, 9) AS "index" FROM e GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY variant ORDER BY "index" DESC, zone) AS position FROM i""")
def component_variants(spark, sf_dir):
    long = _components(spark, sf_dir).select("zone", "component", "norm").checkpoint()
    low = long.filter("component = 'people'").select(F.lit("people_low").alias("variant"), "component", "zone", F.round(F.col("norm") / 2, 6).alias("norm"))
    flat = long.filter("component = 'heat'").select(F.lit("heat_flat").alias("variant"), "component", "zone", F.lit(0.5).alias("norm"))
    every = score.replaced(long, low.unionByName(flat), "zone").withColumn("weight", F.lit(1.0))
    return score.ranking(score.index(every, "zone", keys=["variant"], digits=9), "zone", keys=["variant"])


_ZONES = f"""{D.CELLS}, zs AS (SELECT zone, avg(dist) / 20 AS tree, avg(weight) * 8 AS built, 1.5 AS water, CASE WHEN zone % 4 <> 0 THEN avg(weight) * 9 - 3 END AS road, 20 + avg(value) / 500 AS heat, avg(dist) / 2000 AS green FROM cells GROUP BY zone),
    lm AS (SELECT zone, 100 - tree - built - water AS open_pp, built AS built_pp, CASE WHEN road IS NULL THEN built ELSE least(road, built) END AS road_pp, CASE WHEN road IS NULL THEN built ELSE greatest(built - least(road, built), 0) END AS roof_pp,
    least(28 - heat, 0) AS heat_floor, greatest(0.3 - green, 0) AS green_top FROM zs)"""


def _limits(spark, sf_dir):
    zones = D.cells(spark, sf_dir).groupBy("zone").agg(
        (F.avg("dist") / 20).alias("tree"), (F.avg("weight") * 8).alias("built"), F.lit(1.5).alias("water"), (F.avg("weight") * 9 - 3).alias("_r"),
        (20 + F.avg("value") / 500).alias("heat"), (F.avg("dist") / 2000).alias("green"),
    ).withColumn("road", F.when(F.col("zone") % 4 != 0, F.col("_r")))
    return score.limits(zones, "zone", "tree", "built", "water", "road", "heat", 28.0, "green", 0.3)


@query(f"WITH {_ZONES} SELECT zone, round(open_pp, 6) AS open_pp, round(built_pp, 6) AS built_pp, round(road_pp, 6) AS road_pp, round(roof_pp, 6) AS roof_pp, round(heat_floor, 6) AS heat_floor, round(green_top, 6) AS green_top FROM lm")
def zone_limits(spark, sf_dir):
    out = _limits(spark, sf_dir)
    return rounded(out, *[c for c in out.columns if c != "zone"], digits=6)


@query(f"""WITH {_ZONES}, ef AS (SELECT * FROM (VALUES ('trees', -0.4, -0.6, -0.2, NULL, NULL, 'open'), ('roofs', -1.1, -1.5, -0.6, -2.0, -0.1, 'roof'), ('pavement', -0.5, -0.7, -0.4, NULL, NULL, 'road')) AS t(option, coef, l, h, pl, ph, base)),
    b AS (SELECT zone, 'open' AS base, open_pp AS available FROM lm UNION ALL SELECT zone, 'built', built_pp FROM lm UNION ALL SELECT zone, 'road', road_pp FROM lm UNION ALL SELECT zone, 'roof', roof_pp FROM lm)
    SELECT zone, option, CAST(coef AS DOUBLE) AS coef, CAST(coalesce(pl, l) AS DOUBLE) AS low, CAST(coalesce(ph, h) AS DOUBLE) AS high, CASE WHEN pl IS NOT NULL THEN 'prediction' ELSE 'mean' END AS interval, round(available, 6) AS available FROM b JOIN ef USING (base)""")
def intervention_catalogue(spark, sf_dir):
    rows = [("trees", -0.4, -0.6, -0.2, None, None, "open"), ("roofs", -1.1, -1.5, -0.6, -2.0, -0.1, "roof"), ("pavement", -0.5, -0.7, -0.4, None, None, "road")]
    effects = spark.createDataFrame(rows, "option string, coef double, low double, high double, predicted_low double, predicted_high double, base string")
    return rounded(score.catalogue(_limits(spark, sf_dir), "zone", effects), "available", digits=6)


_GRID = [(low, reach) for low in (1000, 4000) for reach in (100, 300, 600)]


@query(f"WITH {D.CELLS} " + " UNION ALL ".join(f"SELECT class, '{a}/{b}' AS setting, round(100 * sum(CASE WHEN value > {a} AND dist <= {b} THEN weight ELSE 0.0 END) / sum(weight), 8) AS pct FROM cells GROUP BY class" for a, b in _GRID))
def parameter_sensitivity(spark, sf_dir):
    grid = {f"{a}/{b}": (F.col("value") > a) & (F.col("dist") <= b) for a, b in _GRID}
    return rounded(score.sensitivity(D.cells(spark, sf_dir), ["class"], grid, F.col("weight")), "pct", digits=8)


@query(f"""WITH {D.CELLS}, s AS (SELECT zone, 'base' AS scenario, round(avg(value), 4) AS v FROM cells GROUP BY 1 UNION ALL SELECT zone, 'near', round(avg(value) FILTER (dist < 400), 4) FROM cells GROUP BY 1 UNION ALL SELECT zone, 'heavy', round(avg(value) FILTER (weight > 3), 4) FROM cells GROUP BY 1),
    p AS (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY v DESC, zone) AS k FROM s WHERE v IS NOT NULL), b AS (SELECT *, max(k) FILTER (scenario = 'base') OVER (PARTITION BY zone) AS f FROM p)
    SELECT zone, max(k) FILTER (scenario = 'base') AS base, min(k) AS best, max(k) AS worst, CAST(coalesce(sum(CASE WHEN k <> f THEN 1 ELSE 0 END), 0) AS BIGINT) AS moved FROM b GROUP BY zone""")
def rank_stability(spark, sf_dir):
    v = F.col("value")
    zones = D.cells(spark, sf_dir).groupBy("zone").agg(F.avg(v).alias("base"), F.avg(F.when(F.col("dist") < 400, v)).alias("near"), F.avg(F.when(F.col("weight") > 3, v)).alias("heavy"))
    long = zones.select("zone", F.inline(F.array(*[F.struct(F.lit(n).alias("scenario"), F.round(n, 4).alias("v")) for n in ("base", "near", "heavy")])))
    return score.stability(long, "zone", "scenario", "v", "base")


@query()
def refilled_choice(spark, sf_dir):
    scenes = read_table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.col("o_totalprice").alias("v"))
    return score.refilled(scenes, "id", "y", "q", [F.desc("v"), F.col("id")], F.col("id") % 3 == 0).select("id", "y", "q")


def _passes(count: int, colder: float, share: float, least: int) -> str:
    """Common tables p0 to p<count - 1>: the cold share and the acceptance of each scene, pass by pass."""
    steps = []
    for k in range(count):
        of, enough = ("stack", "") if k == 0 else (f"stack WHERE scene IN (SELECT scene FROM p{k - 1} WHERE used)", f"HAVING count(*) >= {least}")
        reference = f"SELECT cell, quantile_cont(v, 0.5) AS r FROM (SELECT * FROM {of}) GROUP BY cell {enough}"
        steps.append(f"""p{k} AS MATERIALIZED (SELECT scene, s, s < {share} AS used FROM (SELECT scene, coalesce(count(*) FILTER (v < r - {colder}) / nullif(count(r), 0), 0) AS s
            FROM stack LEFT JOIN ({reference}) USING (cell) GROUP BY scene))""")
    return ", ".join(steps)


@query(f"""WITH stack AS MATERIALIZED (SELECT l_suppkey AS scene, date_trunc('month', l_shipdate) AS cell, CAST(sum(l_quantity) AS DOUBLE) AS v FROM lineitem GROUP BY ALL), {_passes(8, 60.0, 0.25, 3)}
    SELECT scene, round(p0.s, 9) AS first_share, round(p7.s, 9) AS cold_share, p7.used FROM p0 JOIN p7 USING (scene)""")
def accepted_scenes(spark, sf_dir):
    """Suppliers as scenes, months as cells."""
    month = F.trunc("l_shipdate", "month").alias("cell")
    stack = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("scene"), month).agg(F.sum("l_quantity").cast("double").alias("v"))
    out = scenes.accepted(stack.checkpoint(), "scene", ["cell"], "v", colder=60.0, share=0.25, least=3, most_passes=8)
    return rounded(out.select("scene", "first_share", "cold_share", "used"), "first_share", "cold_share", digits=9)


@query()
def settled_scenes(spark, sf_dir):
    return score.settle(D.cells(spark, sf_dir).select("cell_id", "value"), "value", 4000.0)


@query(f"""WITH {D.CELLS}, z AS (SELECT CAST(zone AS VARCHAR) AS zone, CASE WHEN zone % 6 <> 1 THEN round(avg(value), 4) END AS v, false AS total FROM cells GROUP BY cells.zone UNION ALL SELECT 'all', round(avg(value), 4), true FROM cells)
    SELECT zone, v, row_number() OVER (ORDER BY total, v DESC NULLS LAST, zone) AS place FROM z""")
def sorted_table(spark, sf_dir):
    from pyspark.sql import Window

    cells = D.cells(spark, sf_dir)
    zones = cells.groupBy("zone").agg(F.round(F.avg("value"), 4).alias("v")).select(F.col("zone").cast("string").alias("zone"), F.when(F.col("zone") % 6 != 1, F.col("v")).alias("v"), F.lit(False).alias("total"))
    every = zones.unionByName(cells.agg(F.round(F.avg("value"), 4).alias("v")).select(F.lit("all").alias("zone"), "v", F.lit(True).alias("total")))
    shown = score.sorted_with_total(every, "v", F.col("total"), descending=True)
    return shown.select("zone", "v", F.row_number().over(Window.orderBy("total", F.desc_nulls_last("v"), "zone")).alias("place"))


@query("""SELECT r_name, count(n_nationkey) AS nations, list(n_name ORDER BY n_name)[1] AS first FROM region LEFT JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name""")
def missing_keys_union(spark, sf_dir):
    """Two tables with other columns as one: missing ones null."""
    region = read_table(spark, sf_dir, "region").select("r_name", F.col("r_regionkey").alias("k"))
    nation = read_table(spark, sf_dir, "nation").select("n_name", F.col("n_regionkey").alias("k"))
    every = region.unionByName(nation, allowMissingColumns=True)
    return every.groupBy("k").agg(F.max("r_name").alias("r_name"), F.count("n_name").alias("nations"), F.min("n_name").alias("first")).drop("k")


_MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN day(o_orderdate) || '-' || ['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic'][month(o_orderdate)] || '-' || year(o_orderdate) END AS shown FROM orders""")
def short_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    name = F.element_at(F.array(*map(F.lit, _MONTHS)), F.month(day))
    text = F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.lit("Estado al "), F.dayofmonth(day), F.lit(" de "), F.initcap(name), F.lit(" de "), F.year(day), F.lit("."))).otherwise(F.lit("sin fecha"))
    return read_table(spark, sf_dir, "orders").select("o_orderkey", X.short_date(text).alias("shown"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN format('{:,.0f}', p_retailprice) || ' hab' WHEN 1 THEN format('{:,.2f}', p_retailprice) || ' °C' ELSE format('{:,.1f}', p_retailprice) || ' %' END AS shown FROM part WHERE p_partkey % 3 = 1""")
def unit_text(spark, sf_dir):
    k = F.col("p_partkey")
    unit = F.when(k % 3 == 0, "hab").when(k % 3 == 1, "°C").otherwise("%")
    return read_table(spark, sf_dir, "part").select("p_partkey", X.by_unit(F.col("p_retailprice"), unit).alias("shown")).filter(k % 3 == 1)


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN event_type ELSE 'x' || user_id END AS name FROM events""")
def alternative_keys(spark, sf_dir):
    k = F.col("event_id")
    values = F.create_map(F.lit("name"), F.when(k % 3 == 1, F.col("event_type")), F.lit("loc_name"), F.when(k % 3 > 0, F.concat(F.lit("x"), F.col("user_id").cast("string"))))
    return read_table(spark, sf_dir, "events").select("event_id", X.first_key(values, ["name", "short", "loc_name"]).alias("name"))


@query("""SELECT event_id, CASE WHEN event_type = 'click' AND event_id % 5 = 0 THEN 'none' WHEN user_id % 7 = 1 OR event_id % 100 >= 50 THEN 'private' WHEN event_type = 'view' THEN 'restricted' WHEN user_id % 7 = 2 THEN 'public' ELSE 'undeclared' END AS access FROM events""")
def tag_access(spark, sf_dir):
    k, u = F.col("event_id"), F.col("user_id")
    kind = F.when((F.col("event_type") == "click") & (k % 5 == 0), "shed").otherwise(F.col("event_type"))
    tags = F.create_map(F.lit("kind"), kind, F.lit("access"), F.when(u % 7 == 1, "private").when(u % 7 == 2, "yes"))
    return read_table(spark, sf_dir, "events").select("event_id", X.access_class(tags, ["shed"], ["view"], (k % 100) / 100.0).alias("access"))


@query(f"""WITH {D.CELLS} SELECT zone, round(avg(value), 4) AS heat_mean, round(max(value), 4) AS heat_max, round(avg(dist), 4) AS green_mean FROM cells GROUP BY zone UNION ALL SELECT NULL, round(avg(value), 4), round(max(value), 4), round(avg(dist), 4) FROM cells""")
def zone_table(spark, sf_dir):
    """The groups heat and green of a zone table, columns without any value left out, and a row for the whole."""
    cells = D.cells(spark, sf_dir)
    aggs = [F.round(F.avg("value"), 4).alias("heat_mean"), F.round(F.max("value"), 4).alias("heat_max"), F.round(F.avg("dist"), 4).alias("green_mean"), F.max(F.lit(None).cast("double")).alias("green_none")]
    wide = cells.groupingSets([[F.col("zone")], []], "zone").agg(*aggs)
    return X.without_empty(wide, ["zone"])


@query("""SELECT n_regionkey AS region, count(*) AS n, list(n_name ORDER BY n_nationkey)[1] AS first FROM nation GROUP BY 1""")
def nested_documents(spark, sf_dir):
    """One JSON document a region, read back and looked into."""
    nation = read_table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), "n_nationkey", "n_name")
    made = layers.documents_by(nation, ["region"], "n_nationkey")
    back = F.from_json("value", "region int, rows array<struct<n_nationkey:int,n_name:string>>, meta struct<unit:string>")
    return made.select("region", back.alias("d")).filter("d.meta.unit is null").select("region", F.size("d.rows").cast("long").alias("n"), F.col("d.rows")[0]["n_name"].alias("first"))


@query("""WITH a AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE month(o_orderdate) <> 4), w AS (SELECT strftime(g, '%Y-%m') AS month FROM range(TIMESTAMP '1996-01-01', TIMESTAMP '1999-01-01', INTERVAL 1 MONTH) AS r(g))
    SELECT month FROM w WHERE month NOT IN (SELECT month FROM a)""")
def missing_months(spark, sf_dir):
    rows = read_table(spark, sf_dir, "orders").filter(F.month("o_orderdate") != 4).select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return layers.missing_months(rows, "month", "1996-01", "1998-12")


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000), p AS (SELECT day, day >= DATE '1997-06-01' AS late FROM d)
    SELECT day, late, coalesce(day - lag(day) OVER (ORDER BY day) = 1, true) AS joined FROM p""", dates=("day",))
def stitched_parts(spark, sf_dir):
    days = read_table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' and o_totalprice > 100000").select(F.to_date("o_orderdate").alias("day")).distinct().withColumn("k", F.lit(1))
    first = days.filter("day < '1997-12-01'").withColumn("late", F.lit(False))
    second = days.filter("day >= '1997-06-01'").withColumn("late", F.lit(True))
    return layers.continuous([first, second], ["k"], "day").select("day", "late", "joined")


@query("""WITH e AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'node' ELSE 'way' END AS kind, s_suppkey % 5 = 0 AS untagged, s_suppkey % 3 <> 0 AND s_suppkey % 4 = 0 AS short, s_acctbal < 0 AS outside FROM supplier)
    SELECT kind, count(*) AS n, count(*) FILTER (untagged) AS untagged, count(*) FILTER (short) AS short, count(*) FILTER (outside) AS outside FROM e GROUP BY kind""")
def element_counts(spark, sf_dir):
    k, p = F.col("s_suppkey"), F.struct(F.when(F.col("s_acctbal") < 0, 9.0).otherwise(0.5).alias("x"), F.lit(0.5).alias("y"))
    points = F.when((k % 3 == 0) | (k % 4 == 0), F.array(p)).otherwise(F.array(p, p))
    tags = F.when(k % 5 != 0, F.create_map(F.lit("name"), F.col("s_name"))).otherwise(F.create_map(F.lit("other"), F.col("s_name")))
    elements = read_table(spark, sf_dir, "supplier").select(F.when(k % 3 == 0, "node").otherwise("way").alias("kind"), tags.alias("tags"), points.alias("p"))
    return layers.element_counts(elements, "kind", "tags", "p", "name", (0.0, 0.0, 1.0, 1.0))


@query("""SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, min(o_totalprice) AS low, max(o_totalprice) AS high, round(avg(o_totalprice), 4) AS mean, count(*) AS n FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28' AND o_custkey <= 700 GROUP BY 1, 2""", dates=("day",))
def aggregated_scan(spark, sf_dir):
    """A day's least, largest and mean value and count of some stations and a range of dates, pushed down to the files."""
    orders = read_table(spark, sf_dir, "orders").filter("o_orderdate between timestamp_ntz'1996-03-01' and timestamp_ntz'1997-02-28' and o_custkey <= 700")
    v = F.col("o_totalprice")
    return orders.groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status")).agg(F.min(v).alias("low"), F.max(v).alias("high"), F.round(F.avg(v), 4).alias("mean"), F.count("*").alias("n"))


@query("""WITH RECURSIVE i AS (SELECT o_custkey AS doc, o_orderkey AS item, o_totalprice AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
    p(doc, item, k, page, used) AS (SELECT doc, item, k, 0, size FROM i WHERE k = 1 UNION ALL SELECT i.doc, i.item, i.k, CASE WHEN used > 0 AND used + size > 500000 THEN page + 1 ELSE page END, CASE WHEN used > 0 AND used + size > 500000 THEN size ELSE used + size END FROM p JOIN i ON i.doc = p.doc AND i.k = p.k + 1)
    SELECT doc, item, CAST(page AS INTEGER) AS page FROM p""")
def greedy_pages(spark, sf_dir):
    items = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("item"), F.col("o_totalprice").alias("size"))
    return allocate.greedy_pages(items, "doc", "item", "size", 500000).select("doc", "item", "page")
