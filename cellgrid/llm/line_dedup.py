"""Line deduplication with sharded minimal perfect hashes.

Chunks send the distinct hashes of their lines, with document counts and the largest id, to shards: one row for each hash
of a chunk, so that what is sent is in proportion to the input however many chunks and shards there are, and a line that
every document holds is one row a chunk. A shard merges them, builds a minimal perfect hash over its distinct line hashes
and lays fingerprints, counts and largest ids out in compact arrays in its order. The chunks' hashes then probe those
arrays, and each chunk gets back the few that are to be dropped. Lines themselves are never joined or shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from cellgrid.llm.packed import add_chunk, chunk_count, column, mix, text_chars

#: Stripped from both ends of a line before it is compared.
BLANK = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)
#: Distinct lines that a task holds before it deals them out.
HELD_LINES = 300_000


class MinimalPerfectHash:
    """Maps n distinct 64-bit keys to 0..n-1: each level keeps the keys that are alone at their bit, the rest go on."""

    def __init__(self, keys: np.ndarray, gamma: float = 2.0, max_levels: int = 40):
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.bits: list[int] = []
        placed, left = 0, np.asarray(keys, dtype=np.uint64)
        for level in range(max_levels):
            if not len(left):
                break
            bits = max(64, -(-int(gamma * len(left)) // 64) * 64)
            at = (mix(left, level) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits)
            words = np.packbits(alone == 1, bitorder="little").view(np.uint64)
            ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))))
            self.words.append(words)
            self.before.append(ranks[:-1] + placed)
            self.bits.append(bits)
            placed += int(ranks[-1])
            left = left[alone[at] != 1]
        self.rest, self.placed = np.sort(left), placed

    def __len__(self) -> int:
        return self.placed + len(self.rest)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; keys outside the built set get some number or -1, which a fingerprint tells apart."""
        keys = np.asarray(keys, dtype=np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (words, before, bits) in enumerate(zip(self.words, self.before, self.bits, strict=True)):
            at = mix(keys[open_], level) % np.uint64(bits)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (before[word] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            same = self.rest[at] == keys[open_]
            out[open_[same]] = self.placed + at[same]
        return out


def line_hashes(text: str, min_chars: int) -> list[tuple[int, bytes | None]]:
    """(position, 12 bytes of hash) of each line whose key is long enough."""
    out = []
    for k, line in enumerate(text.split("\n")):
        key = line.strip(BLANK)
        if len(key) >= min_chars:
            out.append((k, xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())[:12]))
    return out


#: What is added to the rows.
NEW = ("kept_text", "n_lines", "n_dropped")
PRINT = np.dtype([("h", "<u8"), ("fp", "<u4")])


def _asked(places: tuple[int, int, int], min_chars: int, shards: int):
    """The distinct line hashes of each chunk: in how many of its documents, and the largest id of those.

    Rows of one chunk lie in one task; batches of them are merged before they are dealt to shards."""

    def flush(chunk: int, found: dict[bytes, list[int]]) -> pa.RecordBatch:
        raw = np.frombuffer(b"".join(found), dtype=PRINT)
        h, fp = np.ascontiguousarray(raw["h"]), np.ascontiguousarray(raw["fp"])
        n, last = np.array(list(found.values()), dtype=np.int64).reshape(-1, 2).T
        columns = [(mix(h, 77) % np.uint64(shards)).astype(np.int32), np.full(len(h), chunk, np.int32), h.view(np.int64), fp.view(np.int32), n.astype(np.int32), last]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["shard", "chunk", "h", "fp", "n", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[bytes, list[int]]] = {}
        size = 0
        for batch in batches:
            for chunk, doc, text in zip(*(batch.column(k).to_pylist() for k in places), strict=True):
                found, doc = held.setdefault(chunk, {}), NO_ID if doc is None else doc
                for h in {h for _, h in line_hashes(text or "", min_chars)}:
                    entry = found.get(h)
                    if entry is None:
                        found[h] = [1, doc]
                        size += 1
                    else:
                        entry[0] += 1
                        entry[1] = max(entry[1], doc)
            if size > HELD_LINES:
                yield from (flush(c, f) for c, f in held.items() if f)
                held, size = {}, 0
        yield from (flush(c, f) for c, f in held.items() if f)

    return run


def _probed(min_docs: int):
    """Builds a shard's arrays over its distinct line hashes; answers each chunk with its lines to drop."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h, fp = pdf["h"].to_numpy(np.int64).view(np.uint64), pdf["fp"].to_numpy(np.int32).view(np.uint32)
        order = np.lexsort((fp, h))
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (fp[order][1:] != fp[order][:-1])
        starts = np.flatnonzero(new)
        docs = np.add.reduceat(pdf["n"].to_numpy(np.int64)[order], starts)
        last = np.maximum.reduceat(pdf["last"].to_numpy(np.int64)[order], starts)
        # Two lines of one 64-bit hash and other fingerprints are told apart by folding the fingerprint into the key.
        keys = h ^ (fp.astype(np.uint64) << np.uint64(17))
        distinct = keys[order][starts]
        mph = MinimalPerfectHash(distinct)
        at = mph.index(distinct)
        prints, counts, lasts = (np.zeros(len(mph), dtype=t) for t in (np.uint32, np.int64, np.int64))
        prints[at], counts[at], lasts[at] = fp[order][starts], docs, last
        k = mph.index(keys)
        drop = (k >= 0) & (prints[k] == fp) & (counts[k] >= min_docs)
        gone = pdf.loc[drop, ["chunk", "h", "fp"]]
        return gone.assign(last=lasts[k[drop]])

    return run


def _rewritten(id_at: int, text_at: int, min_chars: int):
    """The chunk's rows (without the last column, the chunk's number), the kept text, and its lines before and dropped."""

    def run(docs: pa.Table, drops: pa.Table) -> pa.Table:
        prints = np.empty(drops.num_rows, dtype=PRINT)
        prints["h"], prints["fp"] = drops.column(1).to_numpy().view(np.uint64), drops.column(2).to_numpy().view(np.uint32)
        keys = prints.tobytes()
        last = {keys[12 * k : 12 * k + 12]: d for k, d in enumerate(drops.column(3).to_pylist())}
        texts, n_lines, n_dropped = [], [], []
        for doc, text in zip(docs.column(id_at).to_pylist(), docs.column(text_at).to_pylist(), strict=True):
            doc, text = NO_ID if doc is None else doc, text or ""
            gone = {k for k, h in line_hashes(text, min_chars) if h in last and last[h] != doc} if last else ()
            lines = text.split("\n")
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
            texts.append("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text)
        kept = docs.columns[: docs.num_columns - 1]
        made = [pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        return pa.Table.from_arrays([*kept, *made], [*docs.column_names[: len(kept)], *NEW])

    return run


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
    chunk_chars: int = 8_000_000,
) -> DataFrame:
    """All columns of docs, with kept_text, n_lines and n_dropped (which replace columns of those names).

    Lines split at \\n; a line's key is the line stripped of blanks with A-Z lower-cased. Keys of min_chars code points or
    more that min_docs rows hold lose their lines everywhere but in rows of the largest id holding them. Null text is one
    empty line; a null id is smaller than any other; rows repeated with one id count as that many documents and keep
    their lines alike. An empty table gives no rows.
    """
    columns = [c for c in docs.columns if c.lower() not in NEW]
    own = [f"_c{k}" for k in range(len(columns))]  # a map's input may have no dotted names
    docs = docs.select(*[column(docs, c).alias(o) for c, o in zip(columns, own, strict=True)])
    places = (len(columns), columns.index(id_col), columns.index(text_col))
    id_col, text_col, name = own[places[1]], own[places[2]], "chunk"
    chunks = chunk_count(text_chars(docs, text_col), chunk_chars)
    dealt = add_chunk(docs, chunks, id_col, text_col, name)
    # Over all columns, as the rewriting below: one exchange serves both.
    asked = dealt.mapInArrow(_asked(places, min_chars, chunks), "shard int, chunk int, h long, fp int, n int, last long")
    drops = asked.repartition(chunks, "shard").groupBy("shard").applyInPandas(_probed(min_docs), "chunk int, h long, fp int, last long")
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "kept_text string", "n_lines long", "n_dropped long"])
    pairs = dealt.groupBy(name).cogroup(drops.repartition(chunks, "chunk").groupBy("chunk"))
    return pairs.applyInArrow(_rewritten(*places[1:], min_chars), fields).toDF(*columns, *NEW)
