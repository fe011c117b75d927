import random
from fractions import Fraction

import pytest

from cellgrid.llm import line_dedup, ngram_join, pii, queries

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with toxic rows, common lines, near copies and personal data."""
    rng = random.Random(4)
    vocab = [f"word{k}" for k in range(300)]
    common = "this line stands in very many of the documents of this corpus"
    docs, labels = [], []
    base = None
    for i in range(1, 301):
        words = rng.choices(vocab, k=80)
        toxic = i % 9 == 0
        if toxic:
            words[::16] = ["vile"] * 5
        elif i % 7 == 0 and base:
            words = list(base)
            words[3] = "changed"
        else:
            base = words
        text = " ".join(words)
        if i % 5 == 0:
            text += "\n" + common
        if i % 11 == 0:
            text += f"\nwrite to user{i}@mail.example.com"
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(301, None, None, None, None), (302, "", "en", "s", 0)]
    where = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return str(where), docs


def test_stages_take_effect(spark, tables):
    where, rows = tables
    docs = spark.read.parquet(f"{where}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, where).checkpoint()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic = {i for i, t, *_ in rows if t and "vile" in t}
    clean = {r[0] for r in rows} - toxic
    assert toxic.isdisjoint(kept["toxicity"])
    assert len(clean - set(kept["toxicity"])) <= 0.01 * len(clean)  # the classifier is trained on 300 rows
    lines = kept["line dedup"]
    assert set(lines) == set(kept["toxicity"])
    assert sum("this line stands" in (t or "") for t in lines.values()) == 1
    ids = list(lines)
    sets = {i: set(map(tuple, zip(*[(lines[i] or "").split()[k:] for k in range(5)]))) for i in ids}
    stays = kept["n-gram Jaccard join"]
    for i in ids:
        linked = [j for j in ids if j < i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
        assert (i in stays) == (not linked)
    assert len(stays) < len(lines)
    clean = kept["personal data"]
    assert set(clean) == set(stays) and not any("@" in (t or "") for t in clean.values())
    assert any("[EMAIL]" in (t or "") for t in clean.values())


def test_stages_bear_any_rows_and_columns(spark, tables):
    """Columns named like the operators' own, a dotted name, null ids, repeated rows, and no rows at all."""
    where, rows = tables
    line = "a line that stands in more than five of these documents here"
    schema = "doc_id long, text string, n_chars long, n_lines string, N_Dropped int, kept_text string, own_n_lines int, `a.b` string, chunk int, rejected int"
    texts = [None, "", line, *[f"{line}\nword{k} and {k} more of them" for k in range(6)], "one two three " * 3000]
    some = [(k or None, t, 1, "x", 5, "y", 6, "z", 7, 8) for k, t in enumerate(texts)] + [(3, texts[3], 1, "x", 5, "y", 6, "z", 7, 8)]
    for given in (some, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, where).checkpoint()
            assert docs.columns == spark.createDataFrame([], schema).columns, name
            assert {tuple(r)[3:] for r in docs.collect()} <= {("x", 5, "y", 6, "z", 7, 8)}, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, where).count() >= (len(given) and 2)
    docs = spark.createDataFrame(some, schema)
    assert [r.doc_id for r in corpus_pipeline.STAGES[1][1](spark, docs, where).collect() if line in r.text] == [8]
    stays = [r.doc_id for r in corpus_pipeline.STAGES[2][1](spark, docs, where).collect()]
    assert sorted(stays, key=str) == [1, 2, 3, 3, 4, 5, 6, 7, 8, 9, None]


def test_run_packs_what_is_left(spark, tables):
    out = corpus_pipeline.run(spark, tables[0])
    ids = {r.doc_id for r in out.collect()}
    assert 301 in ids and 9 not in ids and out.columns[0] == "doc_id"


def test_mask_and_helpers():
    assert pii.mask("a x@y.zz b", [(2, 8, "email")]) == "a [EMAIL] b"
    assert pii.mask("12345", [(0, 3, "card"), (2, 4, "phone")]) == "[CARD]5"
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert line_dedup.dedup_lines and ngram_join.keep_one and Fraction(4, 5)
