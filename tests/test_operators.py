import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.functions import cells as C
from cellgrid.functions import text as X
from cellgrid.functions.distributions import normal_two_sided, t_quantile, t_two_sided
from cellgrid.operators import aggregate, allocate, flow, joins, raster, score, series, stats
from cellgrid.session import nan_to_null, require_columns
from cellgrid.sources import layers
from cellgrid.streaming import daily


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_weighted_median_is_the_lower_one(spark):
    for weights, want in (((1, 1, 1, 1), 20.0), ((1, 1, 1, 5), 40.0)):
        df = spark.createDataFrame([(1, x, float(w)) for x, w in zip((10.0, 20.0, 30.0, 40.0), weights)], "k int, x double, w double")
        assert aggregate.weighted_median(df, ["k"], "x", "w").first().weighted_median == want
    df = spark.createDataFrame([(1, 10.0, 1.0), (1, 20.0, 3.0), (1, float("nan"), 9.0), (1, None, 9.0)], "k int, x double, w double")
    assert aggregate.weighted_median(df, ["k"], "x", "w").first().weighted_median == 20.0


def test_type8_percentile(spark):
    for n, want in ((5, 5.0), (10, 9.633333333)):
        assert one(spark, series.percentile_type8(F.array(*[F.lit(float(k)) for k in range(1, n + 1)]), 0.9)) == pytest.approx(want)


@pytest.mark.parametrize(
    ("values", "direction", "floor", "want"),
    [((0.10, 0.12, 0.13), "+", 0.05, (0.0, 0.4, 0.6)), ((0.10, 0.12, 0.13), "+", None, (0.0, 0.6667, 1.0)), ((0.10, 0.12, 0.13), "-", 0.05, (0.6, 0.2, 0.0)), ((3.0, 3.0, 3.0), "+", None, (0, 0, 0))],
)
def test_normalise(spark, values, direction, floor, want):
    df = spark.createDataFrame([("c", k, v, direction, floor) for k, v in enumerate(values)], "component string, zone int, raw double, direction string, floor double")
    got = {r.zone: r.norm for r in score.normalise(df).collect()}
    assert [got[k] for k in range(3)] == pytest.approx(want, abs=1e-4)


def test_trailing_mean(spark):
    xs = [1, 2, None, 4, 5, 6, 7, 8, None, None, 11, 12]
    df = spark.createDataFrame([(1, k, None if x is None else float(x)) for k, x in enumerate(xs)], "k int, t int, v double")
    got = [r.trailing for r in series.trailing(df, ["k"], "t", "v").orderBy("t").collect()]
    want = [None] * 7 + [33 / 7, 32 / 6, None, 41 / 6, 49 / 6]
    assert got == [None if w is None else pytest.approx(w) for w in want]


def test_mann_kendall_and_sen(spark):
    df = spark.createDataFrame([("a", k, float(y)) for k, y in enumerate((1, 3, 2, 5, 4, 6, 7, 8, 6, 9))], "k string, x int, y double")
    r = stats.mann_kendall(df, ["k"], "x", "y").first()
    assert (r.s, r.variance, r.tau) == (36, 124, 0.8) and r.z == pytest.approx(3.143093, abs=1e-6)
    assert normal_two_sided(r.z) == pytest.approx(0.00167173, abs=1e-7)
    assert stats.theil_sen(df, ["k"], "x", "y").first().slope == pytest.approx(0.8)
    t = stats.trends(df, ["k"], "x", "y").first()
    assert t.significant and t.p_kendall == pytest.approx(0.00167173, abs=1e-7)
    assert t_two_sided(2.0, 10) == pytest.approx(0.0733880) and t_quantile(0.975, 10) == pytest.approx(2.2281389)


def test_least_squares_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = 1.5 + x @ [2.0, -1.0] + rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b), float(c), k // 10) for k, ((a, b), c) in enumerate(zip(x, y))], "a double, b double, y double, blk int")
    full = np.column_stack((np.ones(300), x))
    coef = np.linalg.lstsq(full, y, rcond=None)[0]
    inv, e = np.linalg.inv(full.T @ full), y - full @ coef
    hc1 = np.sqrt(np.diag(inv @ (full.T * e**2) @ full @ inv) * 300 / 297)
    got = {r.term: r for r in stats.least_squares(df, "y", ["a", "b"]).collect()}
    for k, term in enumerate(("intercept", "a", "b")):
        assert got[term].coef == pytest.approx(coef[k]) and got[term].se == pytest.approx(hc1[k])
    boot = {r.term: r for r in stats.block_bootstrap(df, "y", ["a", "b"], F.col("blk"), replicas=200).collect()}
    for k, term in enumerate(("intercept", "a", "b")):
        assert boot[term].coef == pytest.approx(coef[k]) and boot[term].low < coef[k] < boot[term].high
        assert boot[term].high - boot[term].low == pytest.approx(4 * hc1[k], rel=0.4)


def test_binomial_mean(spark):
    n, p, most = 6, 0.3, 3
    pmf = [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(most + 1)]
    want = sum(k * q for k, q in enumerate(pmf)) / sum(pmf)
    assert one(spark, stats.binomial_mean(F.lit(n), p, most)) == pytest.approx(want)


def test_cells_and_text(spark):
    code = C.encode_layer(F.lit(38.78), 0.01, -20.0)
    assert one(spark, code) == 5879 and one(spark, C.decode_layer(code, 0.01, -20.0)) == pytest.approx(38.78)
    assert one(spark, C.encode_layer(F.lit(float("nan")), 1.0, 0.0)) == 0 and one(spark, C.decode_layer(F.lit(0), 1.0, 0.0)) is None
    assert one(spark, C.significant(F.lit(1234.5), 2)) == 1200.0 and one(spark, C.significant(F.lit(0.0))) == 0.0
    x, y = C.utm(F.lit(4.75), F.lit(-75.91), -75.0)
    assert one(spark, x) == pytest.approx(399_066, abs=60) and one(spark, y) == pytest.approx(525_100, abs=400)
    assert one(spark, X.normal_name(F.lit("  Río--La Viéja!"))) == "rio la vieja"
    assert one(spark, X.local_number(F.lit(1234567.891), 2)) == "1.234.567,89" and one(spark, X.local_number(F.lit(None).cast("double"))) == "—"
    assert one(spark, X.escape_html(F.lit("<a & 'b'>"))) == "&lt;a &amp; &#39;b&#39;&gt;"
    assert one(spark, X.settings(F.lit("A = 1\nx\nB = 2"))) == {"A": "1", "B": "2"}
    assert one(spark, X.day_365(F.to_date(F.lit("2024-03-01")))) == 60 and one(spark, X.day_365(F.to_date(F.lit("2024-02-29")))) == 59
    assert one(spark, C.colour(F.lit(0.5), 0.0, 1.0, [(0, 0, 0), (100, 200, 50)])) == [50, 100, 25]
    assert one(spark, C.class_weight(F.lit("primary_link"), F.lit(None).cast("string"), {"primary": 2.0})) == 2.0
    assert one(spark, C.passes_quality(F.lit(4), 2)) and not one(spark, C.passes_quality(F.lit(6), 2))
    assert X.flatten(spark.sql("select named_struct('b', 1, 'c', named_struct('d', 2)) a, 3 e")).columns == ["a_b", "a_c_d", "e"]
    df = nan_to_null(spark.sql("select double('nan') a"))
    assert df.first().a is None and require_columns(df, ["a"], ["z"]) == ["z"]
    with pytest.raises(ValueError):
        require_columns(df, ["q"])


def test_spikes_and_change(spark):
    df = spark.createDataFrame([(1, k, 10.0 if k != 5 else 50.0) for k in range(12)], "k int, t int, v double")
    out = series.repair_spikes(df, ["k"], "t", "v", 30.0).orderBy("t").collect()
    assert [r.v for r in out] == [10.0] * 12 and [r.repaired for r in out].count(1) == 1
    df = spark.createDataFrame([(1, k, 1.0 if k < 40 else 3.0) for k in range(80)], "k int, t int, v double")
    assert series.change_scan(df, ["k"], "t", "v").first().at == 40


def test_names_merge_greedily(spark):
    rows = [("c", "n", 1, 9.0, 0.0, 0.0), ("c", "n", 2, 8.0, 40.0, 0.0), ("c", "n", 3, 7.0, 80.0, 0.0), ("c", "m", 4, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "c string, name string, id int, area double, x double, y double")
    got = {r.id: r.kept_key for r in joins.merge_names(df, ["c", "name"], [-F.col("area")], "x", "y", "id", 50.0).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_flow_on_a_small_basin(spark):
    z = [[9, 9, 9, 9, 9], [9, 5, 4, 5, 9], [9, 4, 1, 4, 9], [9, 5, 3, 5, 9], [9, 9, 2, 9, 9]]
    df = spark.createDataFrame([(0, r, c, float(z[r][c])) for r in range(5) for c in range(5)], "b int, row int, col int, z double")
    filled = flow.fill(df, "z", tile=3).checkpoint()
    by = {(r.row, r.col): r.filled for r in filled.collect()}
    assert by[2, 2] == pytest.approx(3.0) and by[2, 2] > by[3, 2] >= 3.0 and by[4, 2] == 2.0
    links = flow.descent(filled, "filled").withColumn("one", F.lit(1.0)).checkpoint()
    down = {(r.row, r.col): (r.down_row, r.down_col) for r in links.collect()}
    assert down[3, 2] == (4, 2) and down[4, 2] == (None, None)
    total = {(r.row, r.col): r.upstream for r in flow.accumulation(links, "one").collect()}

    def walk(at):
        path = [at]
        while down[path[-1]][0] is not None:
            path.append(down[path[-1]])
        return path

    assert total == {c: float(sum(c in walk(o) for o in down)) for c in down}
    found = flow.targets(links.withColumn("stop", (F.col("row") == 4) & (F.col("col") == 2)), "stop").collect()
    assert {(r.row, r.col): (r.target_row, r.target_col) for r in found} == {o: ((4, 2) if (4, 2) in walk(o) else (None, None)) for o in down}


def test_components_and_distance(spark):
    rng = random.Random(2)
    grid = {(r, c): rng.random() < 0.45 for r in range(15) for c in range(15)}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in grid.items()], "row int, col int, on boolean")
    label = {(r.row, r.col): r.label for r in raster.components(df, "on").collect()}
    assert set(label) == {k for k, v in grid.items() if v}
    seen = {}
    for k in sorted(label):
        if k not in seen:
            stack = [k]
            while stack:
                at = stack.pop()
                if at in label and at not in seen:
                    seen[at] = k[0] * (1 << 31) + k[1]
                    stack += [(at[0] + a, at[1] + b) for a, b in raster.square(1)]
    assert label == seen
    sparse = df.withColumn("on", F.col("on") & ((F.col("row") + F.col("col")) % 13 == 0))
    for table in (df, sparse):
        on = [(r.row, r.col) for r in table.filter("on").collect()]
        far = {(r.row, r.col): r.distance for r in raster.distance(table, "on", 1.0, row_m=2.0).collect()}
        assert far == {k: pytest.approx(min(math.hypot(2 * (k[0] - a), k[1] - b) for a, b in on)) for k in grid}
    assert {r.distance for r in raster.distance(df.withColumn("on", F.lit(False)), "on").collect()} == {None}
    assert raster.erode(df, "on", raster.square(1)).filter("eroded").count() == sum(all(grid.get((r + a, c + b)) for a, b in raster.square(1)) for r, c in grid)


def test_allocation_keeps_sums(spark):
    df = spark.createDataFrame([(k % 4, float(k % 4) * 10, float(k % 3), 1.0) for k in range(40)], "blk int, total double, w double, known double")
    sums = allocate.spread(df, "blk", "total", F.col("w")).groupBy("blk").agg(F.sum("allocated").alias("s")).collect()
    assert all(r.s == pytest.approx(r.blk * 10) for r in sums)
    rest = allocate.residual(df, "blk", "total", "known", 0.1, F.col("w")).groupBy("blk").agg(F.sum("allocated").alias("s")).collect()
    assert all(r.s == pytest.approx(max(0, r.blk * 10 - 11)) for r in rest)


def test_layers_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([(r, c, None if r == c else r + c / 8) for r in range(20) for c in range(10)], "row int, col int, v double")
    layers.write_layer(cells, "v", f"{tmp_path}/v", 0.01, -5.0, {"title": "t"}, F.col("row") < 5)
    back = layers.read_layer(spark, f"{tmp_path}/v", "w").join(cells, ["row", "col"])
    assert back.filter("(w is null) <> (v is null) or abs(w - v) > 0.005001").count() == 0
    assert layers.read_layer(spark, f"{tmp_path}/v", "w", (2, 4, 0, 3)).count() == 12
    assert {r.scope: r.n for r in spark.read.json(f"{tmp_path}/v/meta").collect()} == {"grid": 190, "mask": 45}
    wide, missing = layers.read_layers(spark, {"a": f"{tmp_path}/v"}, ["a"], ["b"])
    assert wide.columns == ["row", "col", "a"] and missing == ["b"]
    with pytest.raises(ValueError):
        layers.read_layers(spark, {}, ["a"])
    shapes = spark.sql("select named_struct('type', 'LineString', 'coordinates', array(array(1.23456789D, 2D))) g, 'x' name")
    assert json.loads(layers.geojson(shapes, "g").first().value)["geometry"]["coordinates"] == [[1.234568, 2.0]]
    layers.write_csv(spark.sql('select \'a"b\' s, array(1) skip'), f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True, escape='"').collect()[0].asDict() == {"s": 'a"b'}
    for k in range(2):
        layers.append_log(spark.createDataFrame([(k,)], "k int"), f"{tmp_path}/log")
    assert layers.read_log(spark, f"{tmp_path}/log", "k int").count() == 2
    (tmp_path / "cat").mkdir()
    (tmp_path / "cat" / "a.json").write_text('{"title": "A", "unit": "m"}')
    (tmp_path / "cat" / "b.json").write_text("{broken")
    assert sorted((r.title or "", r.note or "") for r in layers.catalogue(spark, f"{tmp_path}/cat").collect()) == [("", "unreadable"), ("A", "")]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.sql("select id % 3 var, timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id) ts, id * 1.0D value from range(200)")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = daily.daily_stream(spark, f"{tmp_path}/events.parquet", "var", "ts", "value").collect()
    want = daily.daily_sums(spark.read.parquet(f"{tmp_path}/events.parquet"), "var", "ts", "value").collect()
    assert sorted(got) == sorted(want) and len(got) > 20
    daily.refresh(spark.sql("select 1 p, 1 v union all select 2, 1"), f"{tmp_path}/t", "p")
    daily.refresh(spark.sql("select 2 p, 5 v"), f"{tmp_path}/t", "p")
    assert {(r.p, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {(1, 1), (2, 5)}
