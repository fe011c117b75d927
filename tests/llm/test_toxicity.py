import random

import numpy as np
from pyspark.sql import functions as F

from cellgrid.llm import toxicity

from .cases import AWKWARD, docs

WORDS = [f"word{k}" for k in range(200)]
BAD = ["vile", "nasty", "rotten", "horrid"]


def _corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        toxic, junk = rng.random() < 0.2, rng.random() < 0.3
        words = rng.choices(WORDS, k=60) + (rng.choices(BAD, k=3) if toxic else []) + (["###"] * 5 + ["spam"] if junk else [])
        rng.shuffle(words)
        rows.append((" ".join(words), int(not junk), int(toxic)))
    return rows


def test_chain_catches_held_out_rows(spark):
    rows = _corpus(500, 1)
    table = docs(spark, [r[0] for r in rows])
    labels = spark.createDataFrame([(i, q, t) for i, (_, q, t) in enumerate(rows[:350], 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(table, labels)
    assert chain.categories == ("quality", "toxic") and chain.earlier[1, 0] != 0
    got = {r.doc_id: r.rejected for r in toxicity.classify(table, chain).collect()}
    held = range(351, 501)
    right = sum(got[i] == bool(rows[i - 1][2]) for i in held)
    assert right >= 0.97 * len(held)


def test_awkward_rows(spark):
    rows = _corpus(200, 2)
    features = [toxicity.doc_features(r[0], toxicity._Features().__getitem__) for r in rows]
    chain = toxicity.fit(features, {"quality": np.array([r[1] for r in rows]), "toxic": np.array([r[2] for r in rows])}, "toxic")
    out = toxicity.classify(docs(spark, AWKWARD), chain)
    assert out.count() == len(AWKWARD) and out.filter(F.col("p_toxic").isNull()).count() == 0
    assert toxicity.classify(docs(spark, []), chain).count() == 0
    assert toxicity.classify(docs(spark, ["a", "a"], [None, 1]), chain).count() == 2


def test_without_labels_nothing_is_rejected(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs(spark, ["vile a"]), labels)
    assert not any(r.rejected for r in toxicity.classify(docs(spark, ["vile a", None]), chain).collect())


def test_threshold_sits_in_the_best_gap():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0])) == 0.5


def test_accept_keeps_clashing_columns(spark):
    rows = _corpus(200, 3)
    features = [toxicity.doc_features(r[0], toxicity._Features().__getitem__) for r in rows]
    chain = toxicity.fit(features, {"quality": np.array([r[1] for r in rows]), "toxic": np.array([r[2] for r in rows])}, "toxic")
    df = spark.createDataFrame([(k, r[0], k, 0.5, "x") for k, r in enumerate(rows)], "doc_id long, text string, rejected int, p_toxic double, _p_quality string")
    kept = toxicity.accept(df, chain)
    assert kept.columns == df.columns
    flags = {r.doc_id: r.rejected for r in toxicity.classify(df, chain).collect()}
    assert {r.doc_id: r.rejected for r in kept.collect()} == {k: k for k, f in flags.items() if not f}
    assert toxicity.accept(df.limit(0), chain).count() == 0
