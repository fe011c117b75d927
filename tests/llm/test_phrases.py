"""Collocations against plain Python, and automata against counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellgrid.llm import phrases as ph


def _brute(docs, least, most_words=4, cover=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most_words + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= cover * a for b in longer):
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, n[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


SCHEMA = "doc_id long, lang string, text string, phrase string, f string, `a.b` int, n string"


def _corpus(rng):
    vocab = [rng.choice(("ab", "CD", "é", "x9", "\x1c", "\x85q", "日本")) + rng.choice(("", "a", "b", "-c")) for _ in range(25)]
    docs = [(None, None), ("en", ""), ("", "a b a b a b a b"), ("en", "."), (None, "a b c d " * 60), ("und", "A B\tC  d!x " * 20), ("t\tb", "one two three. " * 40), ("en", "same " * 50)]
    for k in range(120):
        words = rng.choices(vocab, k=rng.randint(0, 80))
        for at in range(0, len(words) - 4, 9):
            words[at : at + 4] = ["Strong", "fixed", "phrase", rng.choice(("here", "there"))]
        docs.append((rng.choice(("en", "de", None)), "".join(w + rng.choice((" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!?", "\r\n", "\x0b")) for w in words)))
    return docs + docs[-3:]


@pytest.mark.parametrize(("known", "top", "shard"), [(10**6, 2000, 10**7), (0, 2000, 500), (60, 3, 2000)])
def test_phrases_equal_plain_python(spark, monkeypatch, known, top, shard):
    docs = _corpus(random.Random(8))
    monkeypatch.setattr(ph, "SHARD_CHARS", shard)
    frame = spark.createDataFrame([(k % 50 or None, lang, text, "p", None, 1, "n") for k, (lang, text) in enumerate(docs)], SCHEMA).repartition(3)
    got = ph.collocations(frame, least=6, top=top, most_known=known)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == _brute(docs, 6, top=top)


def test_empty_tables_and_other_lengths(spark):
    assert ph.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = _corpus(random.Random(2))
    frame = spark.createDataFrame([(1, lang, text, None, None, None, None) for lang, text in docs], SCHEMA)
    assert ph.collocations(frame, least=10**9).count() == 0
    for most in (2, 3, 5):
        assert sorted(map(tuple, ph.collocations(frame, least=8, most_words=most, cover=60).collect())) == _brute(docs, 8, most, 60)


def test_endpos_counts_and_links():
    rng = np.random.default_rng(6)
    ids = rng.integers(0, 5, 3000)
    levels = ph.automaton(ids, 4)
    want = Counter(tuple(ids[i : i + k].tolist()) for k in range(1, 5) for i in range(len(ids) - k + 1) if ids[i : i + k].all())

    def words(k, node):
        return (node,) if k == 1 else (*words(k - 1, int(levels[k - 1].prefix[node])), int(levels[k - 1].last[node]))

    got = {}
    for k, level in enumerate(levels, 1):
        for node in range(1, len(level.link)):
            got[words(k, node)] = int(level.count[node])
            if k > 1:
                assert words(k - 1, int(level.link[node])) == words(k, node)[1:]
    assert got == dict(want)
