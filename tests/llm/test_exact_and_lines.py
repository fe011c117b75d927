import hashlib
import random
from collections import defaultdict

import numpy as np

from cellgrid.llm import exact_dedup, line_dedup

from .cases import AWKWARD, LONG, docs


def test_cuckoo_index_inserts_deletes_and_resizes():
    rng = random.Random(1)
    index, live = exact_dedup.CuckooIndex(buckets=2), {}
    for _ in range(5000):
        key = hashlib.sha256(str(rng.randrange(1500)).encode()).digest() + bytes(8)
        if key in live and rng.random() < 0.4:
            assert index.delete(key)
            del live[key]
        elif key not in live:
            live[key] = rng.randrange(99)
            index.insert(key, live[key])
    assert index.resizes > 0 and len(live) == index.size
    assert dict(index.entries()) == live
    assert not index.delete(b"\0" * 40)


def test_exact_dedup_matches_brute_force(spark):
    rng = random.Random(2)
    texts = [rng.choice([*AWKWARD, *map(str, range(30))]) for _ in range(400)]
    got = {r.doc_id: r for r in exact_dedup.dedup(docs(spark, texts)).collect()}
    groups = defaultdict(list)
    for i, t in enumerate(texts, 1):
        groups[t or ""].append(i)
    assert len(got) == 400
    for t, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_dedup_null_ids_and_empty(spark):
    got = exact_dedup.dedup(docs(spark, ["a", "a", "b"], [None, 4, None])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(None, None, True), (None, 4, False), (4, 4, True)}
    assert exact_dedup.dedup(docs(spark, [])).count() == 0


def test_minimal_perfect_hash_is_a_bijection():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 20_000, dtype=np.uint64))
    mph = line_dedup.MinimalPerfectHash(keys)
    assert len(mph) == len(keys) and sorted(mph.index(keys)) == list(range(len(keys)))
    assert len(line_dedup.MinimalPerfectHash(np.empty(0, np.uint64))) == 0


def _brute(rows, min_chars, min_docs):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: x.strip(strip).encode().lower().decode()
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(4)
    lines = [LONG + str(k) for k in range(12)] + [LONG.upper() + "3", "  " + LONG + "4\t", "short", "", "É" * 45]
    texts = [rng.choice([None, "", "\n".join(rng.choices(lines, k=rng.randrange(1, 7)))]) for _ in range(120)]
    rows = list(enumerate(texts, 1))
    done = line_dedup.dedup_lines(docs(spark, texts), chunk_chars=3000)
    assert "keys" in done.columns
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in done.collect()}
    assert got == _brute(rows, 40, 5)
    assert any(v[1] for v in got.values())
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_keeps_clashing_columns_and_large_numbers(spark):
    line = LONG + "shared"
    rows = [(k, line if k < 7 else "own", k, f"c{k}", 2**60 + k if k % 2 else None) for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _chunk int, kept_text string, n long")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "_chunk", "n", "kept_text", "n_lines", "n_dropped"]
    for r in out.collect():
        assert (r["_chunk"], r.n) == (r.doc_id, 2**60 + r.doc_id if r.doc_id % 2 else None)
        assert r.kept_text == ("" if r.doc_id < 6 else rows[r.doc_id][1]) and r.n_dropped == int(r.doc_id < 6)


def test_line_dedup_null_and_repeated_ids(spark):
    line = LONG + "shared"
    got = line_dedup.dedup_lines(docs(spark, [line] * 6, [None, 1, 2, 9, 9, None])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 1), (0, 1), (1, 1), (2, 1), (9, 0), (9, 0)]
