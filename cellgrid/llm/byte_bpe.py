"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

Each pre-token starts as single bytes. The leaves of a segment tree hold the rank of the pair that starts at each byte
position; an inner node holds the smallest (rank, position) below it, so the root is always the leftmost pair of least
rank. A merge updates three leaves - the merged pair, its left neighbour and the position that died - in logarithmic time.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm.packed import column, list_array, map_texts, slices

#: Pre-tokens as the GPT-2 style rank files expect them (fixed value, the public pattern).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space (Unicode property White_Space): a pre-token never spans the place between a non-blank and a blank.
BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"
NONE = 1 << 62
#: Bounds of a task's memory of spans and of their characters (one slice of texts may exceed them), characters of a slice.
CACHED, CACHED_CHARS, SLICE_CHARS = 500_000, 20_000_000, 1_000_000
#: Signs that may end a span of letters (no apostrophe: it makes pre-tokens of its own).
SIGNS = "!#$%&()*+,-./:;<=>?@[]^_`{|}~\""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a tiktoken rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    size = 1 << (n - 1).bit_length()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    # A node's value is rank * size + position: the least is the leftmost of the least rank.
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * size + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b

    def put(at: int, value: int) -> None:
        k = size + at
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            a = a if a <= b else b
            if tree[k] == a:
                return
            tree[k] = a
            k >>= 1

    def pair(i: int) -> int:
        j = after[i]
        rank = ranks.get(piece[i : after[j]]) if j < n else None
        return NONE if rank is None else rank * size + i

    while tree[1] != NONE:
        i = tree[1] % size
        dead = after[i]
        k = after[i] = after[dead]
        if k < n:
            before[k] = i
        put(dead, NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class PairTable:
    """Rank of the token that two tokens make together, for arrays of pairs: every split of every token, sorted."""

    def __init__(self, ranks: dict[bytes, int]):
        of = ranks.get
        found = [(a << 32 | b, r) for t, r in ranks.items() for k in range(1, len(t)) if (a := of(t[:k])) is not None and (b := of(t[k:])) is not None]
        pairs = np.array(found or [(-1, 0)], dtype=np.int64)
        order = np.argsort(pairs[:, 0])
        self.keys, self.ranks = pairs[order, 0], pairs[order, 1]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


def merge_many(pieces: list[bytes], ranks: dict[bytes, int], table: PairTable, byte_ids: np.ndarray) -> list[bytes]:
    """merge() for pieces of at most 64 bytes, one segment tree for each: every step merges the root's pair of all pieces
    that have one and updates the three leaves' paths in all of their trees at once. Ids come as 32-bit numbers."""
    none = np.int32(2**31 - 1)
    out: list = [None] * len(pieces)
    sizes = np.array([len(p) for p in pieces])
    for size in (2, 4, 8, 16, 32, 64):
        picked = np.flatnonzero((sizes <= size) & (sizes > (size // 2 if size > 2 else 0)))
        if not len(picked):
            continue
        m, n = len(picked), sizes[picked]
        tok = np.zeros((m, size + 2), dtype=np.int32)
        flat = np.frombuffer(b"".join(pieces[k] for k in picked), dtype=np.uint8)
        place = np.arange(size + 2)[None] < n[:, None]
        tok[place] = byte_ids[flat]
        after = np.tile(np.arange(1, size + 3, dtype=np.int32), (m, 1))
        before = np.tile(np.arange(-1, size + 1, dtype=np.int32), (m, 1))
        live = place.copy()
        tree = np.full((m, 2 * size), none, dtype=np.int32)
        row, at = np.nonzero(place[:, 1 : size + 1])  # leaves with a right neighbour
        rank = table(tok[row, at], tok[row, at + 1])
        tree[row, size + at] = np.where(rank < 0, none, rank * size + at)
        low = size
        while low > 1:
            tree[:, low // 2 : low] = np.minimum(tree[:, low : 2 * low : 2], tree[:, low + 1 : 2 * low : 2])
            low //= 2
        now = np.flatnonzero(tree[:, 1] != none)
        while len(now):
            root = tree[now, 1]
            i = root % size
            dead = after[now, i]
            k = after[now, dead]
            tok[now, i], after[now, i], before[now, k], live[now, dead] = root // size, k, i, False
            p = before[now, i]
            has_right, has_left = k < n[now], p >= 0
            tree[now, size + dead] = none
            rank = table(tok[now, i], tok[now, np.minimum(k, size)])
            tree[now, size + i] = np.where(has_right & (rank >= 0), rank * size + i, none)
            left = np.maximum(p, 0)
            rank = table(tok[now, left], tok[now, i])
            own = np.where(has_left, left, i)
            tree[now, size + own] = np.where(has_left, np.where(rank >= 0, rank * size + left, none), tree[now, size + i])
            for leaf in (dead, i, own):
                node = (size + leaf) >> 1
                while node[0]:
                    tree[now, node] = np.minimum(tree[now, 2 * node], tree[now, 2 * node + 1])
                    node >>= 1
            now = now[tree[now, 1] != none]
        raw, ends = tok[live].tobytes(), (4 * np.cumsum(live.sum(1))).tolist()
        for k, a, b in zip(picked.tolist(), [0, *ends], ends, strict=False):
            out[k] = raw[a:b]
    return out


def text_encoder(ranks: dict[bytes, int], pattern: str = PATTERN) -> Callable[[list[str]], list[np.ndarray]]:
    """A function from texts to their ids. Spans from one blank run to the next are independent, and so are pre-tokens:
    both are remembered, and the new pre-tokens of all texts are merged together."""
    import regex

    split, spans = regex.compile(pattern).findall, re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+").findall
    table, byte_ids = PairTable(ranks), np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
    known: dict[str, bytes] = {}
    tokens: dict[str, bytes] = {}
    size = [0]

    def learn(new: set[str]) -> None:
        parts = {}
        for span in new:
            core = span.rstrip(SIGNS)
            # A blank, letters, then signs: two pre-tokens at most, whatever follows.
            if core[:1] == " " and core[1:].isalpha():
                parts[span] = (core, span[len(core) :]) if len(core) < len(span) else (core,)
            else:
                parts[span] = split(span)
        rest = {m for found in parts.values() for m in found if m not in tokens}
        raw = [(m, m.encode()) for m in rest]
        many = []
        for m, piece in raw:
            whole = ranks.get(piece)
            if whole is not None:
                tokens[m] = np.array([whole], dtype=np.int32).tobytes()
            elif len(piece) <= 64:
                many.append((m, piece))
            else:
                tokens[m] = np.array(merge(piece, ranks), dtype=np.int32).tobytes()
        for lo in range(0, len(many), 8192):
            some = many[lo : lo + 8192]
            made = merge_many([p for _, p in some], ranks, table, byte_ids)
            tokens.update((m, ids) for (m, _), ids in zip(some, made, strict=True))
        known.update((span, tokens[found[0]] if len(found) == 1 else b"".join([tokens[m] for m in found])) for span, found in parts.items())

    def encode(texts: list[str]) -> list[np.ndarray]:
        if len(known) > CACHED or size[0] > CACHED_CHARS:
            size[0] = 0
            known.clear()
            tokens.clear()
        cut = [spans(text) for text in texts]
        new = set().union(*cut).difference(known)
        size[0] += sum(map(len, new))
        learn(new)
        return [np.frombuffer(b"".join(map(known.__getitem__, found)), dtype=np.int32) for found in cut]

    return encode


def encode(
    docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """id_col and ids (array<int>) of each row's whole text, without special tokens.

    Null and empty texts have no ids; null and repeated ids stay as they are, one row each; an empty table gives no rows;
    other columns play no part. The ranks are a fixed vocabulary, so they are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        some = text_encoder(shared.value, pattern)
        return lambda texts: [list_array([ids for lo, hi in slices(texts, SLICE_CHARS) for ids in some(texts[lo:hi])], np.int32)]

    return map_texts(docs, make, "ids array<int>", id_col, text_col)


def decode(
    encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded"
) -> DataFrame:
    """All columns of encoded with out_col (binary): the bytes that the ids stand for. Null ids give null; an id outside
    the vocabulary raises KeyError."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    rest = [c for c in encoded.columns if c != out_col]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name in rest)

    def run(batches):
        table = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            ids = batch.column(rest.index(ids_col))
            made = [None if x is None else b"".join(map(table.__getitem__, x.values.to_numpy().tolist())) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*rest, out_col])

    return encoded.select(*[f"`{c}`" for c in rest]).mapInArrow(run, f"{fields}, `{out_col}` binary")


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 from the ids and the decoded bytes."""
    return decoded.select(
        column(decoded, id_col),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
