import itertools

import numpy as np
import pytest

from cellgrid.llm import pii

from .cases import AWKWARD, docs


@pytest.fixture(scope="module")
def model():
    return pii.fit(pii.labelled_examples())


def test_base_patterns():
    text = "a.b@c.example.com, 1.2.3.4 1.2.3.400 4111 1111 1111 1111 4111111111111112 +1 (234) 555-1234 +12 x"
    assert [(k, text[a:b]) for a, b, k in pii.base_spans(text)] == [
        ("email", "a.b@c.example.com"), ("ip", "1.2.3.4"), ("phone", "+1 (234) 555-1234"),
    ]
    assert pii.base_spans("4111-1111-1111-1111") == [(0, 19, "card")]
    assert pii.base_spans("+12345") == [] and pii.base_spans("") == []


def _slow_decode(model, emit):
    """Viterbi over the whole sequence, the outside tag before and after."""
    moves = model.moves
    score, back = moves[0] + emit[:, 0], []
    for t in range(1, emit.shape[1]):
        ways = score[:, None] + moves
        back.append(ways.argmax(0))
        score = ways.max(0) + emit[:, t]
    tag = int((score + moves[:, 0]).argmax())
    path = [tag]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    out, at = [], 0
    for tag, run in itertools.groupby(path):
        n = len(list(run))
        if tag:
            out.append((at, at + n, pii.TAGS[tag]))
        at += n
    return out


def test_decode_is_exact_viterbi(model):
    rng = np.random.default_rng(1)
    for scale in (0.5, 2.0, 5.0):
        sizes = [1, 7, 300, 40, 900]
        emit = rng.normal(0, scale, (5, sum(sizes))).astype(np.float32)
        emit[0] += scale
        borders = np.concatenate(([0], np.cumsum(sizes)))
        want = [(a + b, a + e, k) for a, z in itertools.pairwise(borders) for b, e, k in _slow_decode(model, emit[:, a:z].astype(float))]
        assert pii.decode(model, emit, borders[:-1]) == want


def test_held_out_spans_are_found(model):
    held = pii.labelled_examples(200, seed=99)
    coded = [pii.classes(t) for t, _ in held]
    borders = np.concatenate(([0], np.cumsum([len(x) for x in coded])))
    got = set(pii.decode(model, pii.text_emissions(model, coded), borders[:-1]))
    want = {(borders[i] + a, borders[i] + b, k) for i, (_, s) in enumerate(held) for a, b, k in s}
    assert len(got & want) > 0.85 * len(want) and len(got & want) > 0.85 * len(got)


def test_windows_agree_with_one_pass(model):
    text = "word " * 300 + "write to ab.cd@mail.example.com or call (212) 555-0100 now " + "more " * 300
    spans = pii.finder(model)([text])[0]
    assert ("email", "ab.cd@mail.example.com") in [(k, text[a:b]) for a, b, k in spans]
    assert "(212) 555-0100" in [text[a:b] for a, b, k in spans if k == "phone"]


def test_find_pii_keeps_rows_and_base(spark, model):
    texts = [*AWKWARD, "mail a@b.co " * 4000, "😀 x@y.zz", "plain words only " * 50]
    rows = pii.find_pii(docs(spark, texts), model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = [(s.start, s.end, s.kind) for s in r.base]
        assert base == pii.base_spans(texts[r.doc_id - 1] or "")
        assert set(base) <= {(s.start, s.end, s.kind) for s in r.spans}
    assert [r.spans for r in rows if r.doc_id == len(texts)] == [[]]
    assert pii.find_pii(docs(spark, []), model).count() == 0
    assert len(pii.find_pii(docs(spark, ["a@b.co", "a@b.co"], [None, 3]), model).collect()) == 2
