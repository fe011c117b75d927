"""Steps whose work or memory must not grow beyond their input, by their plans and results."""

from pyspark.sql import functions as F

from cellgrid.operators import allocate, flow, trends


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bootstrap_copies_no_observation(spark):
    rows = [("AN"[k % 2], k % 7, k % 4, k // 2 % 2, float(k * 37 % 101)) for k in range(400)]
    stack = spark.createDataFrame(rows, "sensor string, scene int, cell int, zone int, v double")
    out = trends.scene_bootstrap(stack, "sensor", "scene", "cell", "zone", "v", replicas=20)
    assert "Generate" not in _plan(out)
    assert {r.zone for r in out.collect()} == {0, 1}


def test_descent_and_network_need_no_join(spark):
    cells = spark.createDataFrame([(r, c, float(r * 7 + c * 3 % 5), c % 2, (r + c) % 5 > 0) for r in range(9) for c in range(9)], "row int, col int, z double, zone int, inside boolean")
    links = flow.descent(cells, "z", ["zone", "inside"])
    out = flow.network(links, "inside", "zone")
    assert "Join" not in _plan(links) and "Join" not in _plan(out)
    flagged = {(r, c) for r in range(9) for c in range(9) if (r + c) % 5 > 0}
    found = [(r.zone, *p) for r in out.collect() for p in r.segments]
    assert sorted(found) == sorted((r.zone, r.row, r.col, r.down_row, r.down_col) for r in links.collect() if (r.row, r.col) in flagged and (r.down_row, r.down_col) in flagged)


def test_pages_stream_over_batches(spark):
    rows = [(k % 3 if k % 10 else None, k, float(k * 13 % 40)) for k in range(100)]
    items = spark.createDataFrame(rows, "doc long, item long, size double")
    out = allocate.greedy_pages(items, "doc", "item", "size", 60)
    assert "FlatMapGroupsInPandas" not in _plan(out)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = {r.item: (r.doc, r.page) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for doc in (0, 1, 2, None):
        page, used = 0, 0.0
        for _, k, s in (r for r in rows if r[0] == doc):
            if used and used + s > 60:
                page, used = page + 1, 0.0
            used += s
            assert got[k] == (doc, page)


def test_antiparallel_headings_and_ties_are_those_of_sql(spark, tmp_path):
    import duckdb

    from cellgrid.plans.registry import ORACLE_SQL, QUERIES

    at, db = str(tmp_path), duckdb.connect()
    db.execute(f"COPY (SELECT i AS s_suppkey, CAST(i % 25 AS INTEGER) AS s_nationkey, CAST(i AS DOUBLE) AS s_acctbal FROM range(1000) AS r(i)) TO '{at}/supplier.parquet' (FORMAT parquet)")
    db.execute(f"CREATE VIEW supplier AS FROM '{at}/supplier.parquet'")
    got = sorted(tuple(r) for r in QUERIES["antiparallel"](spark, at).collect())
    assert got == sorted(db.execute(f"SELECT * FROM ({ORACLE_SQL['antiparallel']})").fetchall())


def test_antiparallel_tells_equally_far_samples_apart_by_the_bits_of_sql(spark, tmp_path):
    import duckdb

    from cellgrid.plans.registry import ORACLE_SQL, QUERIES

    # By symmetry 768 and 1262 are equally far from 1015; the JVM's cosines and powers put the other one first.
    at, db = str(tmp_path), duckdb.connect()
    db.execute(f"COPY (SELECT k AS s_suppkey, 0 AS s_nationkey, CAST(k AS DOUBLE) AS s_acctbal FROM (VALUES (1015), (768), (1262)) AS t(k)) TO '{at}/supplier.parquet' (FORMAT parquet)")
    db.execute(f"CREATE VIEW supplier AS FROM '{at}/supplier.parquet'")
    got = sorted(tuple(r) for r in QUERIES["antiparallel"](spark, at).collect())
    assert got == sorted(db.execute(f"SELECT * FROM ({ORACLE_SQL['antiparallel']})").fetchall())


def test_antiparallel_widens_its_search_only_where_samples_are_few(spark):
    import math
    import random

    import duckdb
    import pandas as pd

    from cellgrid.operators import joins
    from cellgrid.plans.registry import ORACLE_SQL

    def samples(n):
        draw = random.Random(7)
        place = lambda k: (draw.gauss(50, 0.5), draw.gauss(50, 0.5)) if k < n else (draw.uniform(0, 300), draw.uniform(0, 300))
        rows = [(k, *place(k), draw.uniform(0, 7), draw.randrange(5), draw.randrange(2)) for k in range(n + 100)]
        return [(k, x, y, math.cos(a), math.sin(a), w, c) for k, x, y, a, w, c in rows]

    fields = "place long, x double, y double, ux double, uy double, way long, kind long"
    rows = samples(500)
    got = sorted((r.place, r.other, round(r.distance, 6)) for r in joins.antiparallel(spark.createDataFrame(rows, fields), "place", "way", "kind").collect())
    s = pd.DataFrame(rows, columns=["place", "x", "y", "ux", "uy", "way", "kind"])
    db = duckdb.connect()
    db.register("s", s)
    assert got == sorted(db.execute("WITH p AS" + ORACLE_SQL["antiparallel"].split(", p AS")[1]).fetchall())

    def mates(n):
        four = [(x, y, 100 * u, 100 * v) for _, x, y, u, v, _, _ in samples(n)]
        df = spark.createDataFrame(four, "a double, b double, c double, d double")
        width = 2 * joins._first_radius(df, df, 64.0)
        held = {}
        for row in four:
            held.setdefault(tuple(math.floor(v / width) for v in row), []).append(row)
        return sum(len(b) ** 2 for b in held.values()) / len(four)

    # Four times the samples in one place: each still meets only so many.
    assert mates(500) <= 40 and mates(2000) <= 40


def test_frequencies_that_do_not_vary_have_no_correlation(spark):
    import datetime
    import math

    from cellgrid.operators import climate

    rows = [(datetime.date(2000 + y, 1, 1) + datetime.timedelta(d), 0.0, float(d % (y + 1) == 0)) for y in range(5) for d in range(70)]
    both = spark.createDataFrame(rows, "day date, a double, b double")
    r = climate.yearly_frequency_r(both, [], "day", F.col("a") >= 1, F.col("b") >= 1, days=60).first()
    assert r.years == 5 and math.isnan(r.r)
