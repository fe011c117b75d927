"""Vector codes against plain Python integers, and the annulus search against all entries."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from cellgrid.llm import vector_codes as vc


def _floor(v):
    return (Fraction(v) * 4096).__floor__()


def _brute(rows, parts, entries=16, rounds=6):
    """vec_id: (code, error) and the codebooks, by comparing every part with every entry."""
    kept = [(i, [_floor(c) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = len(kept[0][1]) // parts
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for _, x, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: kept[k][0])[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o[p][1] == k]
                if mine:
                    books[p][k] = [sum(v) // len(mine) for v in zip(*mine)]
    own = assign()
    found = [(i, "".join(f"{k:02x}" for _, k in o), sum(d for d, _ in o), label) for (i, _, label), o in zip(kept, own)]
    text = ",".join(str(v) for p in books for e in p for v in e)
    return found, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e160])
def test_codes_equal_plain_integers(spark, scale):
    rng = random.Random(5)
    near = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    rows = [(k, [(c + rng.gauss(0, 0.3)) * scale for c in near[k % 6]], k % 3 or None) for k in range(90)]
    rows += [(1000 + k, rows[7][1], 1) for k in range(20)]  # copies
    rows += [(2000, None, 1), (2001, [float("nan")] * 16, 1), (2002, [float("inf")] + [0.0] * 15, 2), (2003, [0.0] * 16, None), (2004, [None] + [1.0] * 15, 2)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = vc.compress(frame).collect()
    want, digest = _brute(rows, 8)
    assert sorted((r.vec_id, r.code) for r in got) == sorted((i, c) for i, c, _, _ in want)
    assert {r.codebooks_sha256 for r in got} == {digest}
    labels = {}
    for _, _, e, label in want:
        labels.setdefault(label, []).append(e)
    wide = {i: (e if e < 2**63 else None, sum(labels[label]) if max(labels[label]) < 2**63 and sum(labels[label]) < 2**63 else None) for i, _, e, label in want}
    assert {r.vec_id: (r.error, r.label_error) for r in got} == wide


def test_few_rows_clashing_columns_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label string, code string, own int, `a.b` int"
    rows = [(None, [1.0, 2.0, 3.0], "x", "c", 1, 1), (3, [0.5], None, "c", 1, 1), (3, [0.5], None, "c", 1, 1), (4, [], "x", None, None, None)]
    got = vc.compress(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id is None, r.vec_id) for r in got) == [(False, 3), (False, 3), (False, 4), (True, None)]
    assert all(len(r.code) == 16 and r.error == 0 and r.label_error == 0 for r in got)  # each is an entry of its own
    empty = vc.compress(spark.createDataFrame([], schema))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0


def test_annulus_finds_what_all_entries_give():
    rng = np.random.default_rng(2)
    for scale in (3, 50, 2**24, 2**40):
        entries = rng.integers(-scale, scale, (16, 4))
        entries[5], entries[9] = entries[2], -entries[2]  # equal entries, and an equal norm
        x = np.concatenate((rng.integers(-scale, scale, (300, 4)), entries, np.zeros((2, 4), np.int64)))
        index, best = vc.nearest(x, vc.Codebook.of(entries))
        d = ((x[:, None].astype(object) - entries[None]) ** 2).sum(2)
        assert index.tolist() == [min(range(16), key=lambda k: (row[k], k)) for row in d] and best.tolist() == d.min(1).tolist()


def test_sums_in_pieces():
    for total in (0, -1, 5, 2**48, -(2**48), 2**47, 10**60, -(10**60)):
        assert sum(v << (vc.PIECE_BITS * k) for k, v in vc._pieces(total)) == total
        assert all(-(2**63) <= v < 2**63 for _, v in vc._pieces(total))


def test_a_code_stands_for_a_near_vector():
    books = [vc.Codebook.of(np.array([[0, 4096], [8192, -4096]]))] * 2
    assert vc.decode("0001", books) == [0.0, 1.0, 2.0, -1.0]
