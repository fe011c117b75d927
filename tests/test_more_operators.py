import heapq
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.functions import cells as C
from cellgrid.functions import distributions
from cellgrid.functions import text as X
from cellgrid.operators import aggregate, climate, flow, graph, joins, raster, score, series, shapes, stats, trends
from cellgrid.plans import registry, score_queries
from cellgrid.sources import layers
from cellgrid.streaming import daily

SMALL = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_kendall_exact_counts_all_orders():
    for n in (3, 5, 6):
        sums = [sum(np.sign(b - a) for a, b in itertools.combinations(p, 2)) for p in itertools.permutations(range(n))]
        for s in set(sums):
            assert distributions.kendall_exact(n, int(s)) == pytest.approx(min(1, np.mean([abs(x) >= abs(s) for x in sums])))
    assert distributions.binomial_pmf(2, 5, 0.3) == pytest.approx(0.3087)


def test_trend_record_against_numpy(spark):
    rng = np.random.default_rng(3)
    x, y = np.arange(30.0), np.cumsum(rng.normal(0.3, 1, 30))
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y)] + [("b", 1.0, 2.0)], "k string, x double, y double")
    r = trends.record(df, ["k"], "x", "y", scale=1.0).collect()
    assert [v.k for v in r] == ["a"]
    r = r[0]
    slope, intercept = np.polyfit(x, y, 1)
    e = y - intercept - slope * x
    se = math.sqrt(e @ e / 28 / ((x - x.mean()) ** 2).sum())
    t = distributions.t_quantile(0.975, 28)
    r1 = np.corrcoef(e[:-1], e[1:])[0, 1]
    neff = 30 * (1 - r1) / (1 + r1) if r1 > 0 else 30.0
    assert (r.slope, r.se, r.ar1, r.n_eff) == pytest.approx((slope, se, r1, neff))
    assert (r.slope_low, r.slope_high) == pytest.approx((slope - t * se, slope + t * se))
    assert r.p_line == pytest.approx(distributions.t_two_sided(slope / se, 28))
    wide = se * math.sqrt(28 / (neff - 2))
    assert r.p_ar1 == pytest.approx(distributions.t_two_sided(slope / wide, neff - 2)) and r.ar1_low < r.slope_low
    slopes = sorted((b - a) / (j - i) for (i, a), (j, b) in itertools.combinations(enumerate(y), 2))
    sigma = math.sqrt(30 * 29 * 65 / 18)
    low, high = round((435 - trends.Z95 * sigma) / 2) - 1, round((435 + trends.Z95 * sigma) / 2)
    assert (r.sen, r.sen_low, r.sen_high) == pytest.approx((np.median(slopes), slopes[low], slopes[high]))
    short = trends.short(df, ["k"], "x", "y", scale=1.0).first()
    s = sum(np.sign(b - a) for a, b in itertools.combinations(y, 2))
    assert short.p_kendall == pytest.approx(distributions.kendall_exact(30, int(s)))
    assert short.significant == (short.p_kendall < 0.05 and (short.sen_low > 0 or short.sen_high < 0))


def test_scene_bootstrap_holds_the_difference(spark):
    rng = random.Random(1)
    rows = [(s, f"{s}{k}", c, c % 2, (5.0 if s == "b" else 0.0) + rng.gauss(0, 1)) for s in "ab" for k in range(20) for c in range(12)]
    df = spark.createDataFrame(rows, "sensor string, scene string, cell int, zone int, v double")
    got = {r.zone: r for r in trends.scene_bootstrap(df, "sensor", "scene", "cell", "zone", "v", replicas=60).collect()}
    for zone in (0, 1):
        med = {s: np.median([np.median([v for a, _, c, _, v in rows if a == s and c == k]) for k in range(zone, 12, 2)]) for s in "ab"}
        assert got[zone].difference == pytest.approx(med["b"] - med["a"])
        assert got[zone].low <= got[zone].difference <= got[zone].high and got[zone].high - got[zone].low < 2


def _flooded(z):
    """One queue over the whole table."""
    out, todo, queue = dict(z), set(z), []
    near = lambda k: [(k[0] + a, k[1] + b) for a, b in flow.NEIGHBOURS]
    for k in z:
        if any(n not in z for n in near(k)):
            queue.append((z[k], k))
            todo.discard(k)
    heapq.heapify(queue)
    while queue:
        level, k = heapq.heappop(queue)
        for n in near(k):
            if n in todo:
                todo.discard(n)
                out[n] = max(z[n], np.nextafter(level, np.inf))
                heapq.heappush(queue, (out[n], n))
    return out


@pytest.mark.parametrize("tile", [4, 7, 64])
def test_tiled_fill_equals_one_queue(spark, tile):
    rng = random.Random(tile)
    z = {(r, c): float(rng.randrange(30)) for r in range(23) for c in range(19) if rng.random() < 0.97}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in z.items()], "row int, col int, z double")
    got = {(r.row, r.col): r.filled for r in flow.fill(df, "z", tile=tile).collect()}
    assert got == _flooded(z)


def _links(spark, seed):
    rng = random.Random(seed)
    z = {(r, c): rng.random() * 10 for r in range(12) for c in range(12)}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in z.items()], "row int, col int, z double")
    links = flow.descent(df, "z").checkpoint()
    down = {(r.row, r.col): None if r.down_row is None else (r.down_row, r.down_col) for r in links.collect()}
    return df, links, z, down


def _path(down, k):
    while k is not None:
        yield k
        k = down[k]


def test_height_and_least_upstream_and_network(spark):
    df, links, z, down = _links(spark, 5)
    group = {k: (k[0] // 4) % 2 or None for k in z}
    table = spark.createDataFrame([(r, c, group[r, c], (r + c) % 5 == 0) for r, c in z], "row int, col int, g int, channel boolean")
    both = links.join(table, ["row", "col"]).checkpoint()
    found = flow.targets(both, "channel")
    high = {(r.row, r.col): r.hand for r in flow.height_above(df, found, "z").collect()}
    for k in z:
        stop = next((n for n in _path(down, k) if sum(n) % 5 == 0), None)
        assert high[k] == (None if stop is None else pytest.approx(max(0, z[k] - z[stop]))) or (stop is None and high[k] == 0.0)
    low = {(r.row, r.col): r.lowest for r in flow.least_upstream(both, "z", "g").collect()}
    want = dict(z)
    for k in z:
        for n in _path(down, k):
            if n != k and group[n] != group[k]:
                break
            want[n] = min(want[n], z[k]) if group[k] is not None or n == k else want[n]
    assert low == pytest.approx(want)
    net = flow.network(both.withColumn("inside", F.col("row") < 6), "inside", "g").collect()
    kept = {(k, down[k]) for k in z if k[0] < 6 and down[k] is not None and down[k][0] < 6}
    assert {((s.row, s.col), (s.down_row, s.down_col)) for r in net for s in r.segments} == kept


def test_straight_runs(spark):
    df, links, z, down = _links(spark, 8)
    step = {k: (0, 0) if down[k] is None else (down[k][0] - k[0], down[k][1] - k[1]) for k in z}
    follows = lambda k: down[k] is not None and step[down[k]] == step[k]
    starts = [k for k in z if not any(down[n] == k and step[n] == step[k] for n in z)]
    sizes = []
    for k in starts:
        size = 1
        while follows(k):
            k, size = down[k], size + 1
        sizes.append(size)
    for least in (1, 2, 3):
        r = flow.straight_runs(links.withColumn("inside", F.lit(True)), "inside", least).first()
        assert (r.runs, r.cells) == (sum(s >= least for s in sizes), sum(s for s in sizes if s >= least))


def test_names_merge_as_in_order(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice("ab"), rng.uniform(0, 200), rng.uniform(0, 200), float(rng.randrange(5))) for k in range(150)]
    df = spark.createDataFrame(rows, "id int, name string, x double, y double, area double")
    got = {r.id: r.kept_key for r in joins.merge_names(df, ["name"], [-F.col("area"), F.col("id")], "x", "y", "id", 40.0).collect()}
    kept, want = [], {}
    for k, name, x, y, _ in sorted(rows, key=lambda r: (-r[4], r[0])):
        near = next((q[0] for q in kept if q[1] == name and math.hypot(q[2] - x, q[3] - y) < 40), None)
        want[k] = k if near is None else near
        if near is None:
            kept.append((k, name, x, y))
    assert got == want


def test_nearest_reaches_any_distance(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 900_000.0, 3.0), (3, 5.0, 5.0)], "a int, x double, y double")
    right = spark.createDataFrame([(7, 1.0, 0.0), (8, 0.0, -1.0)], "b int, x2 double, y2 double")
    got = {r.a: (r.b, round(r.distance)) for r in joins.nearest(left, right, "a", "b", ("x", "y"), ("x2", "y2"), 0.5).collect()}
    assert got == {1: (7, 1), 2: (7, 899_999), 3: (7, 6)}
    assert joins.nearest(left, right.limit(0), "a", "b", ("x", "y"), ("x2", "y2"), 1.0).count() == 0
    alone = left.filter("a = 1")
    own = alone.select(F.col("a").alias("b"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    assert joins.nearest(alone, own, "a", "b", ("x", "y"), ("x2", "y2"), 1.0, others=True).count() == 0


def test_exact_percentile_narrows(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "BRACKET", 50)
    rng = np.random.default_rng(2)
    for x in (rng.normal(size=4000), np.repeat([1.0, 2.0, 3.0], 900), rng.integers(0, 40, 3000).astype(float), np.array([4.0])):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
        for q in (0.0, 0.1, 0.5, 0.9, 1.0):
            assert aggregate.exact_percentile(df, "v", q) == pytest.approx(np.quantile(x, q))
    assert aggregate.exact_percentile(df.limit(0), "v", 0.5) is None


def test_settle_and_refill(spark):
    rng = random.Random(6)
    values = [rng.uniform(0, 10) for _ in range(200)] + [-50.0, -20.0]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, v double")
    kept = sorted(values)
    while kept[0] < np.median(kept) - 4:
        kept = [v for v in kept if v >= np.median(kept) - 4]
    assert sorted(r.v for r in score.settle(df, "v", 4.0).collect()) == kept
    rows = [(k, 2000 + k % 3, k % 4 + 1, rng.random(), rng.random() < 0.4) for k in range(200)]
    df = spark.createDataFrame(rows, "id int, y int, q int, v double, bad boolean")
    got = {r.id for r in score.refilled(df, "id", "y", "q", [F.desc("v"), F.col("id")], F.col("bad")).collect()}
    struck: set[int] = set()
    while True:
        chosen = []
        for y in range(2000, 2003):
            pool = sorted((r for r in rows if r[1] == y and r[0] not in struck), key=lambda r: (-r[3], r[0]))
            seen, first, rest = {}, [], []
            for r in pool:
                seen[r[2]] = seen.get(r[2], 0) + 1
                (first if seen[r[2]] <= 2 else rest).append(r)
            chosen += (first + rest)[:6]
        bad = {r[0] for r in chosen if r[4]}
        if not bad:
            break
        struck |= bad
    assert got == {r[0] for r in chosen}


def _type8(values, q):
    v = sorted(values)
    h = max(1.0, min(len(v), q * (len(v) + 1 / 3) + 1 / 3))
    k = math.floor(h)
    return v[k - 1] + (h - k) * (v[min(k, len(v) - 1)] - v[k - 1])


def test_exceedances_leave_the_year_out(spark):
    rng = random.Random(9)
    rows = [(y, d, rng.gauss(0, 1)) for y in range(2000, 2005) for d in range(1, 366) if d % 12 < 4]
    df = spark.createDataFrame(rows, "y int, d int, v double")
    got = {r.year: r.days for r in series.exceedances(df, [], "y", "d", "v", (2000, 2003)).collect()}
    near = lambda a, b: min((a - b) % 365, (b - a) % 365) <= 2
    want = {}
    for y, d, v in rows:
        base = {b: [w for yy, dd, w in rows if yy == b and near(dd, d)] for b in range(2000, 2004)}
        if y in base:
            others = [b for b in base if b != y]
            hits = [v > _type8([w for b in others for w in base[b]] + base[twice], 0.9) for twice in others]
            want[y] = want.get(y, 0) + float(np.mean(hits))
        else:
            want[y] = want.get(y, 0) + float(v > _type8([w for ws in base.values() for w in ws], 0.9))
    assert got == pytest.approx(want)


def test_graph_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1200)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    least = {n: n for p in pairs for n in p}
    for _ in range(300):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert got == least


def test_shapes_one_at_a_time(spark):
    rng = random.Random(2)
    line = [(float(k), rng.choice((0.0, 0.2, 3.0))) for k in range(60)]
    df = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in line]), (2, None), (3, [{"x": 0.0, "y": 0.0}])], "id int, line array<struct<x:double,y:double>>")
    got = {r.id: r.line for r in shapes.simplify(df, "line", 0.5).collect()}
    kept = [(p.x, p.y) for p in got[1]]
    assert kept[0] == line[0] and kept[-1] == line[-1] and set(kept) <= set(line) and len(kept) < 60 and got[2] is None and len(got[3]) == 1
    for p in line:
        a, b = next((a, b) for a, b in zip(kept, kept[1:]) if a[0] <= p[0] <= b[0])
        t = ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])) / ((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2)
        assert math.hypot(p[0] - a[0] - t * (b[0] - a[0]), p[1] - a[1] - t * (b[1] - a[1])) <= 0.5 + 1e-9
    at = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
    parts = [("f", 0, at((0, 0), (1, 0))), ("f", 1, at((5, 5), (6, 6))), ("f", 2, at((1, 1), (1, 0))), ("f", 3, at((1, 1), (0, 1))), ("f", 4, at((0, 0), (0, 1))), ("g", 0, at((1, 1), (2, 2))), ("g", 1, at((0, 0), (1, 1)))]
    made = shapes.stitch(spark.createDataFrame(parts, "f string, o int, line array<struct<x:double,y:double>>"), "f", "o", "line").collect()
    assert {(r.f, r.chain, len(r.line), r.closed) for r in made} == {("f", 0, 5, True), ("f", 1, 2, False), ("g", 0, 3, False)}
    holes = spark.createDataFrame([(1, [at((0, 0), (2, 0), (2, 2), (0, 2)), at((0, 0), (1, 0), (0, 1))])], "id int, h array<array<struct<x:double,y:double>>>")
    assert [len(h) for h in shapes.without_small_holes(holes, "h", 1.0).first().h] == [4]


def test_clipped_area_of_a_hollow_ring(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]
    df = spark.createDataFrame([([{"x": float(x), "y": float(y)} for x, y in ring],)], "ring array<struct<x:double,y:double>>")
    parts = {(r.row, r.col): r.part for r in shapes.cell_overlaps(df, 0.5).collect()}
    whole = abs(sum(ring[k][0] * ring[(k + 1) % 5][1] - ring[(k + 1) % 5][0] * ring[k][1] for k in range(5))) / 2
    assert sum(parts.values()) == pytest.approx(whole) and max(parts.values()) == pytest.approx(0.25) and (7, 3) not in parts


def test_small_expressions(spark):
    low, high = stats.prediction_interval(-10.88, -15.26, -6.50, 0.92, 17)
    assert low < -15.26 and high > -6.5 and low + high == pytest.approx(-21.76)
    assert len(raster.disc(2)) == 13 and (2, 1) not in raster.disc(2)
    assert one(spark, C.segment_distance(*map(F.lit, (0.0, 2.0, -1.0, 0.0, 1.0, 0.0)))) == 2.0
    assert one(spark, X.first_sentence(F.lit("One. Two."))) == "One." and one(spark, X.round_all(F.array(F.lit(1.26), F.lit(float("nan"))), 1)) == [1.3, None]
    assert one(spark, series.clip_negative(F.lit(-2.0))) == 0.0 and one(spark, aggregate.finite(F.lit(float("inf")))) is None
    assert one(spark, X.by_unit(F.lit(1234.5), F.lit("hab"))) in ("1,234 hab", "1,235 hab") and one(spark, X.by_unit(F.lit(2.345), F.lit("%"))) == "2.3 %"
    assert climate.reference_factor(0.0) == pytest.approx(1.0) and climate.reference_factor(919.0) > 1.1
    x, y = C.utm(F.lit(0.0), F.lit(-75.0), -75.0)
    assert one(spark, x) == pytest.approx(500_000.0, abs=1e-6) and one(spark, y) == pytest.approx(0.0, abs=1e-6)
    # A quarter meridian of the ellipsoid is 10 001 965.729 m; the pole lies that far north, times the scale.
    assert one(spark, C.utm(F.lit(89.999999), F.lit(-75.0), -75.0)[1]) == pytest.approx(0.9996 * 10_001_965.729, abs=0.2)


def test_series_of_any_length_have_a_slope(spark):
    """Beyond what one task lists, the slope is bracketed."""
    df = spark.range(4000).selectExpr("'a' AS k", "CAST(id AS DOUBLE) AS x", "CAST(3 * id + id % 2 AS DOUBLE) AS y")
    r = stats.theil_sen(df, ["k"], "x", "y").first()
    assert (r.slope, r.pairs) == (3.0, 4000 * 3999 // 2)


def test_sources_that_may_be_missing(spark, tmp_path):
    assert layers.read_present(spark, f"{tmp_path}/none", "a int") is None
    (tmp_path / "x.json").write_text('{"a": 1}')
    assert layers.read_present(spark, f"{tmp_path}/x.json", "a int").first().a == 1
    rows = spark.createDataFrame([("2020-01", 5.0), ("2020-02", -9.0), ("2020-04", 1.0)], "month string, v double")
    rows.write.partitionBy("month").parquet(f"{tmp_path}/m")
    got = layers.month_slices(spark, f"{tmp_path}/m", "month", "2020-01", "2020-03", "v").collect()
    assert {(r.month, r.v) for r in got} == {("2020-01", 5.0), ("2020-02", None)}
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert {r.k for r in layers.unseen(keys, keys.filter("k = 2"), "k").collect()} == {1, 3}


def test_catalogues_stations_and_pages(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"id": "b", "datetime": "2024-02-01T00:00:00Z", "cloud": 3.5, "more": 1}\n{"id": "a", "datetime": "2024-01-01T00:00:00Z", "assets": {"red": "x"}}')
    got = layers.scenes(spark, f"{tmp_path}/s.json").collect()
    assert [(r.id, r.cloud) for r in got] == [("a", None), ("b", 3.5)] and "more" not in got[0]
    (tmp_path / "ids").write_text("q\n\np\n")
    assert [r.id for r in layers.scenes(spark, f"{tmp_path}/none", f"{tmp_path}/ids").collect()] == ["p", "q"]
    with pytest.raises(ValueError, match="no catalogue"):
        layers.scenes(spark, f"{tmp_path}/none")
    rows = spark.createDataFrame([("s1", "4.7", "-75.9", "25.5"), ("s2", "x", "-75.9", "1"), ("s3", "9.0", "-75.9", "1"), ("s4", "4.7", "-75.9", None)], "code string, lat string, lon string, v string")
    good, bad = layers.stations(rows, "lat", "lon", "v", (4.0, 5.0, -76.0, -75.0))
    assert {(r.code, r.v) for r in good.collect()} == {("s1", 25.5), ("s4", None)} and [r.code for r in bad.collect()] == ["s2"]
    assert layers.complete(rows.union(rows), "code", 4).count() == 4
    with pytest.raises(ValueError, match="4 rows of 5"):
        layers.complete(rows, "code", 5)


def test_before_after_limits_and_p(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(0, 1, 12), rng.normal(1.2, 2, 9)
    df = spark.createDataFrame([(1, False, float(v)) for v in a] + [(1, True, float(v)) for v in b] + [(2, True, 1.0)], "k int, late boolean, v double")
    r = trends.before_after(df, ["k"], F.col("late"), "v").collect()
    assert [x.k for x in r] == [1]
    va, vb = a.var(ddof=1) / 12, b.var(ddof=1) / 9
    free = (va + vb) ** 2 / (va**2 / 11 + vb**2 / 8)
    t, reach = (b.mean() - a.mean()) / math.sqrt(va + vb), distributions.t_quantile(0.975, free) * math.sqrt(va + vb)
    assert (r[0].change, r[0].low, r[0].high) == pytest.approx((b.mean() - a.mean(), b.mean() - a.mean() - reach, b.mean() - a.mean() + reach))
    assert r[0].p == pytest.approx(distributions.t_two_sided(t, free))


def test_streams_over_several_batches(spark, tmp_path):
    rows = [(k % 2, 1_700_000_000 + 3600 * k, None if k % 11 == 0 else float(k)) for k in range(60)]
    df = spark.createDataFrame(rows, "var int, at long, value double").withColumn("ts", F.timestamp_seconds("at"))
    for k in range(3):
        df.filter(F.floor((F.col("at") - 1_700_000_000) / 3600 / 20) == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got = {(r.var, r.ts.timestamp()): r.trailing for r in daily.trailing_stream(spark, f"{tmp_path}/in", "var", "ts", "value").collect()}
    want = series.trailing(df, ["var"], "ts", "value").collect()
    assert len(got) == 60
    for r in want:
        assert got[str(r.var), r.ts.timestamp()] == (None if r.trailing is None else pytest.approx(r.trailing))


def test_queries_without_sql_run(spark):
    for name in ("refilled_choice", "settled_scenes"):
        assert getattr(score_queries, name)(spark, SMALL).count() > 0
    sizes = {n: registry.QUERIES[n](spark, SMALL).count() for n in ("least_upstream", "straight_runs", "drainage_network", "simplified_lines", "stitched_lines", "trend_tests")}
    assert all(sizes.values()) and sizes["least_upstream"] == 150
