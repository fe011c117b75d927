import math
import random
from collections import Counter

import numpy as np
import pytest

from cellgrid.llm import lm_score, vector_tree

from .cases import AWKWARD, docs


def _brute(rows, target):
    counts = [[Counter(), Counter(), Counter()] for _ in range(2)]  # side: unigram, bigram, context
    seqs = [(i, (t or "").encode().lower().split()) for i, t in rows]
    for i, w in seqs:
        s = [None, *w, None]
        for side in range(2):
            if side == 1 or i in target:
                counts[side][0].update(s[1:])
                counts[side][1].update(zip(s, s[1:]))
                counts[side][2].update(s[:-1])
    words = len(counts[1][0])
    out = {}
    for i, w in seqs:
        s = [None, *w, None]
        own = Counter(s[1:]), Counter(zip(s, s[1:])), Counter(s[:-1])
        loss = []
        for side in range(2):
            take = side == 1 or i in target
            c = [counts[side][k] - own[k] if take else counts[side][k] for k in range(3)]
            total = sum(c[0].values())
            losses = []
            for a, b in zip(s, s[1:]):
                one = (c[0][b] + lm_score.ALPHA) / (total + lm_score.ALPHA * words)
                losses.append(-math.log((c[1][a, b] + lm_score.MU * one) / (c[2][a] + lm_score.MU)))
            loss.append(sum(losses) / len(losses))
        out[i] = (len(s) - 1, *loss)
    return out


def test_scores_match_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(40)]
    texts = [*AWKWARD[:6], *(" ".join(rng.choices(vocab, k=rng.randrange(1, 60))) for _ in range(80))]
    rows = list(enumerate(texts, 1))
    target = {i for i, _ in rows if i % 3 == 0}
    ids = spark.createDataFrame([(i,) for i in [*target, 999, None]], "doc_id long")
    out = lm_score.score(docs(spark, texts), ids, chunk_chars=2000).collect()
    want = _brute(rows, target)
    assert len(out) == len(rows)
    for r in out:
        n, a, b = want[r.doc_id]
        assert r.n_tokens == n and abs(r.target_loss - a) < 1e-9 and abs(r.background_loss - b) < 1e-9
        assert abs(r.score - (a - b)) < 1e-9


def test_target_documents_score_low(spark):
    rng = random.Random(3)
    a, b = [f"a{k}" for k in range(50)], [f"b{k}" for k in range(50)]
    texts = [" ".join(rng.choices(a if i % 2 else b, k=40)) for i in range(1, 101)]
    ids = spark.createDataFrame([(i,) for i in range(1, 60, 2)], "doc_id long")
    out = {r.doc_id: r.score for r in lm_score.score(docs(spark, texts), ids).collect()}
    assert max(out[i] for i in range(61, 101, 2)) < min(out[i] for i in range(62, 101, 2))
    assert lm_score.score(docs(spark, []), ids).count() == 0
    assert lm_score.score(docs(spark, ["x", "x"], [None, None]), ids).count() == 2


def _table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "k") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")


def test_search_reaches_its_recall_and_scores_are_exact(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(30, 16))
    x = centers[rng.integers(0, 30, 6000)] + 0.4 * rng.normal(size=(6000, 16))
    x[100:400] = x[100]  # one very common vector
    table = _table(spark, x)
    out = vector_tree.search(table, table.filter("vec_id % 20 = 0"), k=10, recall=0.95, leaf_rows=64).collect()
    exact = x @ x.T
    found = {}
    for r in out:
        assert abs(r.score - exact[r.query_id, r.vec_id]) < 1e-9 and r.vec_id != r.query_id
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q in range(0, 6000, 20):
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 11))
        assert got == sorted(got, key=lambda g: (-g[2], g[1]))
        order = np.lexsort((np.arange(6000), -exact[q]))
        true = [v for v in order if v != q][:10]
        edge = exact[q, true[-1]]
        hits += sum(s >= edge - 1e-12 for _, _, s in got)
        total += 10
    assert hits / total >= 0.9


def test_default_recall_without_structure(spark):
    x = np.random.default_rng(8).normal(size=(4000, 12))
    table = _table(spark, x)
    out = vector_tree.search(table, table.filter("vec_id % 5 = 0"), leaf_rows=32).collect()
    exact = x @ x.T
    np.fill_diagonal(exact, -np.inf)
    edge = np.sort(exact, 1)[:, -20]
    hits = sum(r.score >= edge[r.query_id] - 1e-12 for r in out)
    assert len(out) == 800 * 20 and hits / len(out) >= 0.96


def test_queries_beside_small_leaves_get_all_their_rows(spark, monkeypatch):
    x = np.repeat(np.eye(3) * 10, (400, 400, 5), axis=0) + 0.01 * np.random.default_rng(1).normal(size=(805, 3))
    centers = np.vstack((np.zeros(4), np.eye(4)[:3] * 10))
    none = np.empty(0, np.int64)
    tree = vector_tree.Tree(centers, [np.array([1, 2, 3]), none, none, none], np.array([-1, 0, 1, 2]))
    monkeypatch.setattr(vector_tree, "fit", lambda *_: tree)
    table = _table(spark, x)
    out = vector_tree.search(table, table.filter("vec_id % 20 = 0")).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in out} == dict.fromkeys(range(0, 805, 20), 20)


def test_equal_vectors_tie_by_id_in_all_leaves(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(9000, 24))
    x[1000:8000] = x[1000]
    table = _table(spark, x)
    out = vector_tree.search(table, table.filter("vec_id % 20 = 0"), leaf_rows=64).collect()
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q, rows in found.items():
        rows = sorted(rows)
        tied = [v for _, v, _ in rows if 1000 <= v < 8000]
        assert tied == [v for v in range(1000, 8000) if v != q][: len(tied)]
        assert len({s for _, v, s in rows if 1000 <= v < 8000}) <= 1
        assert [r[1] for r in rows] == [r[1] for r in sorted(rows, key=lambda r: (-r[2], r[1]))]


def test_products_do_not_depend_on_their_company():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(500, 64)), rng.normal(size=(500, 64))
    whole = vector_tree.products(a, b)
    assert all(vector_tree.products(a[k : k + 1], b[k : k + 1])[0] == whole[k] for k in range(500))


def test_lengths_that_differ_take_no_part(spark):
    table = _table(spark, [[1, 0], [0, 1], [1, 1, 1], [2, 0], [1]], [1, 2, 3, 4, 5])
    out = {(r.query_id, r["rank"], r.vec_id) for r in vector_tree.search(table, table, k=2).collect()}
    assert out == {(1, 1, 4), (1, 2, 2), (2, 1, 1), (2, 2, 4), (4, 1, 1), (4, 2, 2)}


def test_repeated_and_null_ids_count_as_documents(spark):
    texts, ids = ["a b c", "a b d", "a b", "x y", "x y z"], [7, 7, None, None, 3]
    target = spark.createDataFrame([(7,)], "doc_id long")
    got = sorted((r.n_tokens, round(r.target_loss, 9), round(r.background_loss, 9)) for r in lm_score.score(docs(spark, texts, ids), target).collect())
    named = list(zip([1, 2, 3, 4, 5], texts, strict=True))
    want = _brute(named, {1, 2})
    assert got == sorted((n, round(a, 9), round(b, 9)) for n, a, b in want.values())


def test_groups_of_leaves():
    group, parts = vector_tree.grouped(np.array([3, 2, 0, 6, 25, 1]), most=10)
    assert group.tolist() == [0, 0, 0, 1, 2, 3] and parts.tolist() == [1, 1, 3, 1]


def test_awkward_vectors(spark):
    bad = [None, [0.0] * 3, [1.0, None, 2.0], [float("nan"), 1, 2], [float("inf"), 0, 0]]
    table = _table(spark, [*bad, [1, 2, 3], [1, 2, 3], [3, 2, 1], [1, 0, 0]], [1, 2, 3, 4, 5, 20, 7, 8, None])
    out = vector_tree.search(table, table)
    rows = {q: [(r.rank, r.vec_id, r.score) for r in sorted(out.filter(f"query_id = {q}").collect(), key=lambda r: r.rank)] for q in (20, 7, 8)}
    assert rows == {20: [(1, 7, 14.0), (2, 8, 10.0)], 7: [(1, 20, 14.0), (2, 8, 10.0)], 8: [(1, 7, 10.0), (2, 20, 10.0)]}
    assert vector_tree.search(_table(spark, []), _table(spark, [])).count() == 0
    assert vector_tree.search(table, table.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1e160, 1e150, 1e-170])
def test_vectors_of_any_magnitude_take_part(spark, scale):
    x = np.random.default_rng(7).normal(size=(200, 8)) * scale
    vectors = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = vector_tree.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20, recall=1.0, leaf_rows=20).collect()
    assert len(got) == 10 * 20
    with np.errstate(over="ignore", invalid="ignore"):
        for q in range(0, 200, 20):
            score = vector_tree.products(np.repeat(x[q : q + 1], 200, 0), x)
            others = [k for k in range(200) if k != q and not np.isnan(score[k])]
            want = sorted(others, key=lambda k: (-score[k], k))[:20]
            assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want


def test_products_beyond_a_doubles_range_are_infinite_and_tie(spark):
    big = np.array([[1e200, 1e200], [1e200, -1e200], [1e200, -2e200], [1e200, -1e200], [3.0, 4.0]])
    other = np.array([[1e200, 1e200], [1e200, -1e200], [1e200, 1e200], [1e200, 1e200], [0.1, 0.7]])
    assert vector_tree.products(big, other).tolist() == [np.inf, np.inf, -np.inf, 0.0, 3.0 * 0.1 + 4.0 * 0.7]
    # All products of the one query are beyond the range, so the least ids are nearest, in whatever leaf.
    x = -np.abs(np.random.default_rng(3).normal(size=(300, 4))) * 1e200
    x[0] = -x[0]
    vectors = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = vector_tree.search(vectors, vectors.filter("vec_id = 0"), recall=1.0, leaf_rows=20).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(k, k, -np.inf) for k in range(1, 21)]
