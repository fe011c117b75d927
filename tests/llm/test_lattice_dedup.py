"""Lattice hashing against all pairs of a small table."""

import itertools
from collections import defaultdict

import numpy as np
import pytest

from cellgrid.llm import lattice_dedup as ld


def _brute(rows, threshold):
    good = []
    size = max(len(v) for _, v, _ in rows if v is not None)
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            good.append((k, label, x / np.linalg.norm(x)))
    root, links = list(range(len(rows))), defaultdict(int)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, la, x), (b, lb, y) in itertools.combinations(good, 2):
        if la == lb and x @ y >= threshold:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    least = defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return sorted(((i is None, i), links[k], min(least[find(k)], default=None)) for k, (i, _, _) in enumerate(rows))


def _got(frame):
    return sorted(((r.vec_id is None, r.vec_id), r.n_links, r.component_id) for r in frame.collect())


def _table(rng, scale=1.0, size=24):
    rows, k = [], 0
    for group, (n, spread) in enumerate(((120, 0.12), (40, 0.25), (25, 0.4), (1, 0), (150, 0.02))):
        base = rng.normal(size=size)
        base /= np.linalg.norm(base)
        for _ in range(n):
            way = rng.normal(size=size)
            rows.append((k, [float(c) for c in scale * (base + spread * way / np.linalg.norm(way) * rng.random())], group % 2))
            k += 1
    rows += [(k + j, [float(c) for c in scale * rng.normal(size=size)], j % 3) for j in range(150)]
    return rows


@pytest.mark.parametrize("scale", [1.0, 1e160, 1e-200])
def test_all_links_of_a_small_table(spark, monkeypatch, scale):
    rows = _table(np.random.default_rng(4), scale)
    rows += [(5000 + k, rows[3][1], rows[3][2]) for k in range(60)] + [(5000, rows[3][1], rows[3][2])]  # copies, a repeated id
    rows += [(None, rows[130][1], rows[130][2]), (None, None, 1), (6000, [0.0] * 24, 1), (6001, [float("nan")] * 24, 1), (6002, [1.0], 0), (6003, rows[3][1], None), (6004, [None] + [1.0] * 23, 1)]
    monkeypatch.setattr(ld, "BALL_LEAST", 20)
    monkeypatch.setattr(ld, "TILE_ROWS", 30)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    out = ld.near_duplicates(frame, 0.93)
    got = _got(out)
    assert got == _brute(rows, 0.93)
    assert {r.kept for r in out.filter("vec_id = component_id").collect()} == {True}
    assert out.filter("kept and vec_id <> component_id").count() == 0


def test_clashing_columns_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label string, node long, key string, vec int, `a.b` int"
    rows = [(1, [1.0, 0.1], "x", 1, "k", 1, 1), (2, [1.0, 0.1], "x", 1, "k", 1, 1), (3, [1.0, 0.12], "x", 1, "k", 1, 1), (4, [1.0, 0.1], "y", 1, "k", 1, 1)]
    assert _got(ld.near_duplicates(spark.createDataFrame(rows, schema), 0.93)) == [((False, 1), 2, 1), ((False, 2), 2, 1), ((False, 3), 2, 1), ((False, 4), 0, 4)]
    assert ld.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    null = spark.createDataFrame([(1, None, None, 1, None, 1, 1)], schema)
    assert [tuple(r) for r in ld.near_duplicates(null).collect()] == [(1, 0, 1, True)]


def test_decoding_finds_the_nearest_lattice_point():
    z = np.random.default_rng(1).normal(size=(200, 8)) * 2
    p = ld.decode(z)
    assert ((2 * p) % 1 == 0).all() and (p.sum(1) % 2 == 0).all()
    own = ((z - p) ** 2).sum(1)
    for m in ld.minimal_vectors():  # a nearer point would be one of these away, as they bound the cell
        assert (((z - p - m) ** 2).sum(1) >= own - 1e-9).all()
    assert ld.minimal_vectors().shape == (240, 8) and ((ld.minimal_vectors() ** 2).sum(1) == 2).all()


def test_keys_do_not_depend_on_the_batch_and_meetings_are_found_once():
    rng = np.random.default_rng(3)
    x = ld.unit(rng.normal(size=(50, 16)))
    y = ld.unit(x + 0.05 * rng.normal(size=x.shape))
    made, labels = ld.Lattices(16, 2, 6), np.zeros(50, np.int64)
    a, b = made.keys(x, labels), made.keys(y, labels)
    assert (np.concatenate([made.keys(x[k : k + 1], labels[:1]) for k in range(50)]) == a).all()
    first = made.first(a, b)
    for k in range(50):
        meets = [[c for c in set(a[k, t].tolist()) & set(b[k, t].tolist()) if c in (a[k, t, 0], b[k, t, 0])] for t in range(6)]
        assert first[k] == next((min(m) for m in meets if m), 0)


def test_tables_are_added_until_drawn_pairs_meet():
    made = ld.fitted(64, 50_000, 0.93, 0.998)
    rng = np.random.default_rng(9)
    x, way = ld.unit(rng.normal(size=(2000, 64))), rng.normal(size=(2000, 64))
    way = ld.unit(way - (x * way).sum(1, keepdims=True) * x)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * way
    zeros = np.zeros(2000, np.int64)
    assert made.blocks == 2 and (made.first(made.keys(x, zeros), made.keys(y, zeros)) != 0).mean() > 0.99
