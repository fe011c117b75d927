import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from cellgrid.llm import byte_bpe, packing

from .cases import AWKWARD, LONG, docs

ODD = " \t\n\r\x0b\x0c\x1c\x1d\x85\xa0  　.,!'?sdltrevmABCabc019½²éßΣİσ日本𝒳😀️-_"


def _texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randrange(0, 60))) for _ in range(n)]


def test_byte_bpe_equals_tiktoken_and_round_trips(spark):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN
    texts = [*AWKWARD, *_texts(600, 5), "ababab" * 3000, "<|endoftext|>"]
    rows = byte_bpe.decode(byte_bpe.encode(docs(spark, texts), ranks), ranks).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id - 1] or ""
        assert r.ids == whole.encode_ordinary(text), repr(text[:80])
        assert bytes(r.decoded) == text.encode()
    assert byte_bpe.encode(docs(spark, []), ranks).count() == 0
    assert sorted(r.doc_id or 0 for r in byte_bpe.encode(docs(spark, ["a", "a"], [None, 7]), ranks).collect()) == [0, 7]


def test_many_trees_at_once_equal_one():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(12)
    pieces = [bytes(rng.choices(b"abcdehilnorst \xc3\xa9ABC", k=rng.randint(1, 64))) for _ in range(800)] + [b"a" * k for k in range(1, 65)]
    table, byte_ids = byte_bpe.PairTable(ranks), np.array([ranks[bytes([b])] for b in range(256)])
    many = byte_bpe.merge_many(pieces, ranks, table, byte_ids)
    assert [np.frombuffer(m, np.int32).tolist() for m in many] == [_plain(p, ranks) for p in pieces]


def _plain(piece, ranks):
    """Byte-pair merging by search: the leftmost pair of least rank, again and again."""
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_words_encode_as_whole_texts():
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        spec = f.read()
    model, (encode, _) = Tokenizer.from_str(spec), packing.word_encoder(spec, 2)
    texts = [*(t or "" for t in AWKWARD), *_texts(1500, 6), "The THE the. the.. È été ÉTÉ. naïve! n\u0303. ok.' it's' a.b (x) x) <|endoftext|>. ˈa ªb"]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == [*model.encode(text, add_special_tokens=False).ids, 2], repr(text[:80])


def test_other_tokenizers_take_whole_texts():
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    assert not packing.splits_words(spec) and packing.splits_words(open(public_tokenizers.path("word_bpe_49k.json")).read())
    model, (encode, _) = Tokenizer.from_str(spec), packing.word_encoder(spec, 2)
    texts = ["Two  words, Here\n  and more", "", "x " * 50]
    assert [e.tolist() for e in encode(texts)] == [[*model.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def _least(at, penalty, window):
    cost = [0] + [10**12] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            size = at[j] - at[i]
            if size <= window:
                pad = 0 if size & (size - 1) == 0 else window - size
                cost[j] = min(cost[j], cost[i] + pad + penalty[j] + packing.PER_WINDOW)
    return cost[-1]


def test_cuts_are_optimal():
    rng = random.Random(7)
    for _ in range(60):
        at = np.array(sorted({0, *rng.sample(range(1, 160), 50)} | set(range(0, 160, 8))))
        penalty = np.array([0, *rng.choices([0, 2, 24], k=len(at) - 1)])
        chosen = packing.cuts(at, penalty, 32)
        place = {p: k for k, p in enumerate(at.tolist())}
        cost = 0
        for a, b in zip(chosen, chosen[1:]):
            assert 0 < b - a <= 32
            cost += (0 if (b - a) & (b - a - 1) == 0 else 32 - (b - a)) + penalty[place[b]] + packing.PER_WINDOW
        assert cost == _least(at, penalty, 32)


def test_packing_pieces_cover_every_id_once(spark):
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        spec = f.read()
    texts = [*AWKWARD, LONG * 900, "word " * 9000, *_texts(200, 8)]
    model = Tokenizer.from_str(spec)
    ids = {i: np.array([*model.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for i, t in enumerate(texts, 1)}
    for block in (5_000, 2_000_000):
        rows = packing.pack(docs(spark, texts).coalesce(2), spec, block_ids=block).collect()
        pieces, windows = defaultdict(list), defaultdict(list)
        for r in rows:
            pieces[r.doc_id].append(r)
            windows[r.sequence_id].append(r)
            assert r.doc_tokens == len(ids[r.doc_id])
            assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        for i, x in ids.items():
            at = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert r.start == at and r.length > 0
                at += r.length
            assert at == len(x)
        padding = 0
        for rs in windows.values():
            at = 0
            for r in sorted(rs, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= 4096
            padding += 0 if at & (at - 1) == 0 else 4096 - at
        assert padding <= 0.02 * sum(map(len, ids.values()))
    assert packing.pack(docs(spark, []), spec).count() == 0
