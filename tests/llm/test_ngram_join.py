import random
from fractions import Fraction

import numpy as np
import pytest

from cellgrid.llm import ngram_join

from .cases import AWKWARD, docs


def _brute(rows, words, threshold):
    sets, ids = [], [i for i, _ in rows]
    for _, t in rows:
        w = (t or "").encode().lower().split()
        grams = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        sets.append(grams)
    least = list(range(len(rows)))

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and threshold.denominator * both >= threshold.numerator * len(sets[a] | sets[b]):
                least[root(a)] = root(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(ids[k])
    return {ids[k]: (len(sets[k]), min(groups[root(k)])) for k in range(len(rows))}


def _texts(seed, n, families=6):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    shared = rng.choices(vocab, k=60)
    bases = [rng.choices(vocab, k=rng.randint(20, 120)) for _ in range(families)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.7:
            w = list(rng.choice(bases))
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 5))):
                at = rng.randrange(len(w))
                what = rng.random()
                if what < 0.5:
                    w[at] = rng.choice(vocab).upper()
                elif what < 0.75:
                    del w[at]
                else:
                    w = w[: max(3, at)] if at > 0.85 * len(w) else w
        elif kind < 0.85:
            w = rng.choices(vocab, k=rng.randint(0, 80)) + shared
        else:
            w = rng.choices(vocab, k=rng.randint(0, 5))
        out.append(rng.choice((" ", "\n", " \t ")).join(w))
    return out


@pytest.mark.parametrize(("group_classes", "group_tokens"), [(4096, 10**7), (12, 10**7), (4096, 600)])
def test_components_match_brute_force(spark, group_classes, group_tokens):
    texts = [*AWKWARD, *_texts(1, 260)]
    rng = random.Random(9)
    ids = rng.sample(range(10_000), len(texts))
    for words, threshold in ((4, Fraction(85, 100)), (5, Fraction(4, 5))):
        out = ngram_join.jaccard_components(docs(spark, texts, ids), words, threshold, group_classes=group_classes, group_tokens=group_tokens)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
        assert got == _brute(list(zip(ids, texts, strict=True)), words, threshold)


def test_long_chain_of_revisions(spark):
    # Each text shares two rare words with the one before and two with the next, and those alone stand in the prefixes.
    common = [f"c{k}" for k in range(20)]
    texts = [" ".join([f"p{i}", f"q{i}", f"p{i + 1}", f"q{i + 1}", *common]) for i in range(300)]
    ids = random.Random(7).sample(range(10_000), 300)
    out = ngram_join.jaccard_components(docs(spark, texts, ids), words=1, threshold=Fraction(84, 100)).collect()
    assert {(r.n_shingles, r.component_id) for r in out} == {(24, min(ids))} and len(out) == 300


def test_components_of_long_chains(spark):
    names = random.Random(3).sample(range(100_000), 1000)
    pairs = [(names[k], names[k + 1]) for k in range(799)] + [(k, k + 1) for k in range(200_000, 200_400)] + [(names[900], names[900])]
    edges = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "a long, b long")
    got = {r.node: r.label for r in ngram_join.components(edges).collect()}
    want = dict.fromkeys(names[:800], min(names[:800])) | dict.fromkeys(range(200_000, 200_401), 200_000) | {names[900]: names[900]}
    assert got == want


def test_overlaps_sum_over_fragments():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 120))) for _ in range(700)]
    seen = 0
    for a, b, both in ngram_join.overlaps(sets, fragment=16):
        for x, y in rng.integers(0, both.shape, (60, 2)):
            assert both[x, y] == len(np.intersect1d(sets[a + x], sets[b + y]))
            seen += 1
    assert seen > 100


def test_repeated_rows_null_ids_and_empty(spark):
    text = "one two three four five six"
    out = ngram_join.jaccard_components(docs(spark, [text, text, text, "other"], [7, None, 7, None])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in out) == [(0, 1, 0), (0, 2, 7), (7, 2, 7), (7, 2, 7)]
    assert ngram_join.jaccard_components(docs(spark, [])).count() == 0


def test_keep_one_keeps_clashing_columns(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(7, text, "a"), (3, text, "b"), (5, "something else entirely here now", "c"), (None, text, "d"), (9, None, "e")], "doc_id long, text string, stays string")
    got = sorted(((r.doc_id, r.stays) for r in ngram_join.keep_one(df).collect()), key=str)
    assert got == [(3, "b"), (5, "c"), (9, "e")] and ngram_join.keep_one(df).columns == df.columns
    assert ngram_join.keep_one(df.limit(0)).count() == 0


def test_packets_do_not_grow_with_texts(spark):
    """A task's texts reach a shard in one packet, however many parts they are hashed in."""
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(50)) for _ in range(300)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["id", "text"])
    asked = [row for out in _asked(batch, parts=3000) for row in out.to_pylist()]
    whole = [row for out in _asked(batch, parts=10**9) for row in out.to_pylist()]
    assert len(asked) == len(whole) == 8 + 1
    assert {(r["shard"], len(r["hashes"])) for r in asked} == {(r["shard"], len(r["hashes"])) for r in whole}


def _asked(batch, parts):
    from unittest import mock

    import pyspark

    with mock.patch.object(ngram_join, "PART_CHARS", parts), mock.patch.object(pyspark.TaskContext, "get", return_value=mock.Mock(partitionId=lambda: 0)):
        return list(ngram_join._ask(4, 8)(iter([batch])))
