"""Packed exchanges between document chunks and key shards.

Corpus-wide statistics follow one pattern here: every chunk of documents sends its distinct keys, already counted,
to the shards that own them; a shard answers each chunk about the keys that the chunk sent. Keys travel as packed
little-endian arrays, a few bytes each. A key that every document holds is one entry a chunk, so no shard meets a hot key
more than once a chunk, and nothing passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of text that one chunk holds on average.
CHUNK_CHARS = 8_000_000


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return df[f"`{name}`"]


def free_name(name: str, taken: list[str]) -> str:
    """name, with underscores before it until no column has it (Spark's names don't tell capitals from small letters)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns id (long) and text (null as empty) only, so that other columns cannot clash."""
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    return docs.select(column(docs, id_col).cast("long").alias("id"), text.alias("text"))


def slices(texts: list[str], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters, so that a batch of very long texts is worked off in parts."""
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def map_texts(docs: DataFrame, make: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and the columns of schema, one row for each row of docs: make() gives a task its function from a list of
    texts to a list of Arrow arrays. Runs where the rows lie, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                made = work(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *made], names)

    names = [id_col, *(part.split()[0] for part in schema.split(", "))]
    return id_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, {schema}")


def map_columns(docs: DataFrame, make: Callable, schema: str, text_col: str = "text") -> DataFrame:
    """All columns of docs and those of schema, which replace columns of their names: make() gives a task its function
    from a list of texts (null as empty) to a list of Arrow arrays. Runs where the rows lie, without a shuffle."""
    new = [part.split()[0] for part in schema.split(", ")]
    rest = [f for f in docs.schema.fields if f.name not in new]
    order = [f.name for f in docs.schema.fields] + [n for n in new if n not in docs.columns]
    own = [f"_c{k}" for k in range(len(rest))]  # a map's input may have no dotted names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = batch.column(len(rest)).to_pylist()
            for lo, hi in slices(texts):
                kept = [batch.column(k).slice(lo, hi - lo) for k in range(len(rest))]
                yield pa.RecordBatch.from_arrays([*kept, *work(texts[lo:hi])], [*own, *new])

    text = F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("_text_")
    fields = ", ".join([*(f"{o} {f.dataType.simpleString()}" for o, f in zip(own, rest, strict=True)), schema])
    made = docs.select(*[column(docs, f.name).alias(o) for o, f in zip(own, rest, strict=True)], text).mapInArrow(run, fields)
    return made.toDF(*[f.name for f in rest], *new).select(*[f"`{c}`" for c in order])


def list_array(parts: list[np.ndarray], dtype) -> pa.Array:
    """One Arrow list for each numpy array."""
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(dtype, copy=False)))


def text_chars(docs: DataFrame, text_col: str = "text") -> int:
    """Characters in the whole column; one scan, one number to the driver."""
    return docs.agg(F.sum(F.length(column(docs, text_col))).alias("n")).first()["n"] or 0


def add_chunk(docs: DataFrame, chunks: int, id_col: str, text_col: str, name: str = "_chunk") -> DataFrame:
    """Deals rows to chunks by their id and text, so that neither a hot source nor repeated ids meet in one chunk."""
    key = F.xxhash64(column(docs, id_col), F.length(column(docs, text_col)))
    return docs.withColumn(name, F.pmod(key, F.lit(chunks)).cast("int")).repartition(chunks, name)


def chunk_count(chars: int, per_chunk: int = CHUNK_CHARS) -> int:
    return max(1, math.ceil(chars / per_chunk))


def mix(h: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal outputs, other seeds give independent ones."""
    h = h ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers in few bytes: the bytes of one weight stand together, then zstd."""
    import zstandard

    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def expand(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 32-bit numbers, by their differences."""
    return squeeze(np.diff(values, prepend=np.zeros(1, values.dtype)))


def expand_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(expand(packed), dtype=np.uint64).astype(np.uint32)
