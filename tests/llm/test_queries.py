"""The registered queries on a small fixture, held against plain Python that shares no code with the operators."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from cellgrid.llm import queries

public_tokenizers = pytest.importorskip("public_tokenizers")


def _sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def _card(rng):
    body = "".join(rng.choices("0123456789", k=15))
    for last in "0123456789":
        if _luhn(body + last):
            return body + last


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    vocab = [f"{a}{b}" for a in ("lor", "ip", "do", "sit", "ame", "con") for b in ("em", "sum", "lor", "et", "ct", "u")]
    texts = [None, "", " \n", "0" * 5000 + ".1.1.1 and " + "9" * 5000, "x" * 30_000 + "@a.b", "😀 a@b.co é token: geheim99 AKIA" + "B" * 18 + " ab" * 30]
    base = None
    for k in range(70):
        words = rng.choices(vocab, k=rng.randint(3, 90))
        if k % 4 == 1 and base:
            words = list(base)
            words[rng.randrange(len(words))] = "CHANGED"
        base = words
        for extra in (f"mail me.{k}@host-{k}.example.org.", f"{k}.2.3.4 300.1.2.3", _card(rng), "4111 1111 1111 1112", f"+1 (212) 555-{1000 + k}", "(212) 555-0100",
                      f"api_key = '{k}secretvalue'", "PASSWORD: \"abc\"", "deadbeef" * 4, "AKIA" + "A1" * 9, "1234 5678 9012 3456 7890 1"):
            if rng.random() < 0.25:
                words.insert(rng.randrange(len(words) + 1), extra)
        texts.append(rng.choice((" ", "\n")).join(words))
    texts += [texts[9], texts[9]]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts, 100)]
    rng.shuffle(rows)
    where = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 2), int(r[0] % 5 == 0)) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    x = np.random.default_rng(3).normal(size=(400, 8)).astype(np.float32)
    x[50:90] = x[50]
    vectors = [(k, [float(v) for v in row], 0) for k, row in enumerate(x)] + [(900, None, 0), (920, [0.0] * 8, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{where}/embeddings.parquet")
    return where, {r[0]: r[1] or "" for r in rows}, x.astype(float)


def _rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def _listed(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


def test_op1(spark, corpus):
    where, texts, _ = corpus
    out = queries.op1_pii(spark, where)
    assert [t for _, t in out.dtypes] == ["bigint"] * 5 + ["string"] * 2
    got = _rows(out)
    assert set(got) == set(texts)
    kinds = ("email", "ip", "card", "phone")
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for i, text in texts.items():
        spans = []
        for order, (kind, pattern) in enumerate(zip(kinds, patterns, strict=True)):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
                good = {"email": True, "ip": kind == "ip" and all(len(p) < 4 and int(p) < 256 for p in parts), "card": 14 <= len(digits) <= 19 and _luhn(digits), "phone": 10 <= len(digits) <= 15}
                if good[kind]:
                    spans.append((m.start(), order, m.end(), kind))
        r = got[i]
        assert r.base_sha256 == _sha(_listed(spans)), text[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in kinds]
        assert {x for x in _listed(spans).split(",") if x} <= set(r.spans.split(","))
    assert any("(212) 555-0100" in t and f"phone:{t.index('(212) 555-0100')}:" in got[i].spans for i, t in texts.items())


def test_op2(spark, corpus):
    where, texts, _ = corpus
    got = _rows(queries.op2_toxicity(spark, where))
    assert set(got) == set(texts) and not got[100].rejected
    assert all(0 <= r.p_quality <= 1 and 0 <= r.p_toxic <= 1 for r in got.values())
    same = defaultdict(set)
    for i, t in texts.items():
        same[t].add((got[i].p_toxic, got[i].rejected))
    assert all(len(v) == 1 for v in same.values())
    shown = [r.p_toxic for r in got.values() if r.rejected]
    assert not shown or min(shown) > max((r.p_toxic for r in got.values() if not r.rejected and texts[r.doc_id].strip()), default=0)


def test_op4(spark, corpus):
    where, texts, _ = corpus
    ranks = {}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        import base64

        for line in f:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    model = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = _rows(queries.op4_byte_bpe(spark, where))
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = model.encode_ordinary(text)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), _sha(" ".join(map(str, ids))), _sha(text))


def test_op7(spark, corpus):
    where, texts, _ = corpus
    got = _rows(queries.op7_secrets(spark, where))
    assert set(got) == set(texts)
    base = (("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))
    seen = 0
    for i, text in texts.items():
        spans = [(m.start(), o, m.end(), kind) for o, (kind, p, g, least) in enumerate(base) for m in re.finditer(p, text) if len(m[g]) >= least]
        seen += len(spans)
        assert got[i].base_sha256 == _sha(_listed(spans)), text[:80]
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(s[3] == k for s in spans) for k, *_ in base]
        assert {x for x in _listed(spans).split(",") if x} <= set(got[i].spans.split(","))
    assert seen > 20


def test_op8(spark, corpus):
    where, _, x = corpus
    out = queries.op8_vector_tree(spark, where)
    assert dict(out.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    found = defaultdict(list)
    for r in out.collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(range(0, 400, 20))
    hits = 0
    for q, rows in found.items():
        scores = x @ x[q]
        order = [v for v in sorted(range(400), key=lambda v: (-round(scores[v], 9), v)) if v != q][:20]
        rows = sorted(rows)
        assert [r[0] for r in rows] == list(range(1, 21))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in rows)
        hits += len(set(order) & {v for _, v, _ in rows})
    assert hits >= 0.9 * 20 * len(found)


def test_op9(spark, corpus):
    where, texts, _ = corpus
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in queries.op9_packing(spark, where).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array([*model.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096


def test_op10(spark, corpus):
    where, texts, _ = corpus
    got = _rows(queries.op10_ngram_join(spark, where))
    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else ({tuple(w)} if w else set())
    least = {i: i for i in texts}
    for _ in range(len(texts)):
        for i in texts:
            for j in texts:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                    least[i] = min(least[i], least[j])
        if all(least[least[i]] == least[i] for i in texts):
            break
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), least[i]) for i in texts}
    assert any(least[i] != i for i in texts)
