"""Compression of vectors to short codes, a byte a part, with an annulus search for the nearest codebook entry.

Components become integers, vectors are cut into equal parts, and each part position has a codebook of its own, trained by
rounds of Lloyd's method in exact integer arithmetic. A round is one pass over the rows: every task assigns its parts and
adds them up, a few sums for each entry go through Spark's aggregation, and only the codebooks reach the driver.

To find the nearest entry its part's codebook is sorted by norm. The entry whose norm is next to the part's own gives a
first distance d; as |x - c| >= ||x| - |c||, only entries whose norms lie within d of the part's norm can be as near. These
are found by binary search, both ends included, and measured exactly; what they gain narrows the rest.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm.packed import column

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Bits of one piece of a sum on its way through Spark: sums of any size add up exactly, piece by piece.
PIECE_BITS = 48
#: Rows that are assigned at a time.
SLICE_ROWS = 8192


@dataclass
class Codebook:
    """The entries of one part position (integers), in order of their norms too. Wide entries are Python integers."""

    entries: np.ndarray
    order: np.ndarray
    norms: list

    @staticmethod
    def of(entries: np.ndarray) -> Codebook:
        squares = [sum(int(v) ** 2 for v in e) for e in entries]
        order = np.array(sorted(range(len(squares)), key=lambda k: (squares[k], k)), dtype=np.int64)
        return Codebook(entries, order, [math.isqrt(squares[k]) for k in order])


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles: 64-bit where that holds them and the squared distances, else Python integers."""
    with np.errstate(over="ignore"):
        y = np.floor(x * float(scale))
    if not y.size or np.abs(y).max() < 2.0**48:
        return y.astype(np.int64)
    whole = [[_floor(v, scale) for v in row] for row in x.tolist()]
    return np.array(whole, dtype=object).reshape(x.shape)


def _floor(v: float, scale: int) -> int:
    up, down = v.as_integer_ratio()
    return scale * up // down


def _fits(x: np.ndarray, entries: np.ndarray) -> bool:
    """Whether 64 bits hold the squared distances."""
    if object in (x.dtype, entries.dtype) or not x.size or not entries.size:
        return object not in (x.dtype, entries.dtype)
    return (int(np.abs(x).max()) + int(np.abs(entries).max())) ** 2 * x.shape[1] < 2**62


def nearest(x: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """The index of each row's nearest entry (ties to the lower index) and the squared distance, by annuli of norms."""
    if not _fits(x, book.entries):
        found = [_nearest_one([int(v) for v in row], book) for row in x]
        return np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], dtype=object)
    norm = np.sqrt((x * x).sum(1).astype(np.float64))
    entries = book.entries[book.order].astype(np.int64)
    own = np.sqrt((entries * entries).sum(1).astype(np.float64))
    at = np.clip(np.searchsorted(own, norm), 0, len(own) - 1)
    down = np.maximum(at - 1, 0)
    at = np.where(norm - own[down] < own[at] - norm, down, at)
    best = ((x - entries[at]) ** 2).sum(1)
    index = book.order[at]
    slack = 1e-9 * (norm + own[-1]) + 1e-9  # the roots' last bits; the distances themselves are exact
    reach = np.sqrt(best.astype(np.float64)) + slack
    low, high = np.searchsorted(own, norm - reach, "left"), np.searchsorted(own, norm + reach, "right")
    for k in range(len(own)):
        gap = np.abs(own[k] - norm) - slack
        rows = np.flatnonzero((low <= k) & (k < high) & (at != k) & ((gap <= 0) | (gap * gap <= best)))
        if not len(rows):
            continue
        d = ((x[rows] - entries[k]) ** 2).sum(1)
        better = (d < best[rows]) | ((d == best[rows]) & (book.order[k] < index[rows]))
        best[rows[better]], index[rows[better]] = d[better], book.order[k]
    return index, best


def _nearest_one(x: list[int], book: Codebook) -> tuple[int, int]:
    """The same for one part, with integers of any size."""

    def far(k: int) -> tuple[int, int]:
        e = int(book.order[k])
        return sum((a - int(b)) ** 2 for a, b in zip(x, book.entries[e], strict=True)), e

    norm = math.isqrt(sum(v * v for v in x))
    at = min(bisect_left(book.norms, norm), len(book.norms) - 1)
    best = far(at)
    reach = math.isqrt(best[0]) + 2  # whole roots: each may be one short
    for k in range(bisect_left(book.norms, norm - reach), bisect_right(book.norms, norm + reach)):
        best = min(best, far(k))
    return best[1], best[0]


def kept_vectors(rows: DataFrame, vec_col: str) -> DataFrame:
    """The rows whose vector is there and finite throughout."""
    vec = column(rows, vec_col).cast("array<double>")
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.filter(vec.isNotNull() & ~bad)


def _matrix(values: pa.Array, size: int) -> np.ndarray:
    """One row for each list, with zeros behind until it has size components."""
    lengths = np.diff(values.offsets.to_numpy()) if isinstance(values, pa.ListArray) else np.array([len(v) for v in values])
    x = np.zeros((len(values), size))
    x[np.arange(size)[None] < lengths[:, None]] = values.flatten().to_numpy(zero_copy_only=False)
    return x


def _assigned(values: pa.Array, size: int, parts: int, scale: int, books: list[Codebook]) -> Iterator[tuple]:
    """For slices of a batch: first row, the integer parts by position, their entries and their squared distances."""
    width = size // parts
    for lo in range(0, len(values), SLICE_ROWS):
        own = integers(_matrix(values.slice(lo, SLICE_ROWS), size), scale)
        cut = [own[:, p * width : (p + 1) * width] for p in range(parts)]
        found = [nearest(c, b) for c, b in zip(cut, books, strict=True)]
        yield lo, cut, [f[0] for f in found], [f[1] for f in found]


def _pieces(total: int) -> Iterator[tuple[int, int]]:
    """A number as pieces of PIECE_BITS bits, the last with its sign."""
    k = 0
    while total >> (PIECE_BITS * (k + 1)) not in (0, -1):
        yield k, (total >> (PIECE_BITS * k)) & ((1 << PIECE_BITS) - 1)
        k += 1
    yield k, total >> (PIECE_BITS * k)


def _sums(size: int, parts: int, scale: int, shared):
    """One row a task for each entry, component and piece: how many parts the entry has there, and what they add up to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        width = size // parts
        count = [np.zeros(len(b.entries), np.int64) for b in books]
        total = [[[0] * width for _ in b.entries] for b in books]
        for batch in batches:
            for _, cut, index, _ in _assigned(batch.column(0), size, parts, scale, books):
                for p in range(parts):
                    count[p] += np.bincount(index[p], minlength=len(count[p]))
                    for e in np.unique(index[p]):
                        for j, v in enumerate(cut[p][index[p] == e].sum(0)):
                            total[p][e][j] += int(v)
        rows = []
        for p in range(parts):
            for e, n in enumerate(count[p].tolist()):
                if n:
                    rows.append((p, e, -1, 0, n))
                    rows += [(p, e, j, k, v) for j in range(width) for k, v in _pieces(total[p][e][j])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["part", "entry", "place", "piece", "value"])

    return run


def _entries(rows: list[list[int]], width: int) -> np.ndarray:
    small = all(abs(v) < 2**62 for row in rows for v in row)
    return np.array(rows, dtype=np.int64 if small else object).reshape(len(rows), width)


def train(rows: DataFrame, size: int, parts: int, entries: int, rounds: int, scale: int, id_col: str, vec_col: str) -> list[Codebook]:
    """Codebooks that start as the parts of the smallest ids and are moved so many rounds; size is a multiple of parts."""
    width = size // parts
    vec = column(rows, vec_col).cast("array<double>")
    first = rows.select(column(rows, id_col).cast("long").alias("id"), vec.alias("vec")).orderBy(F.asc_nulls_last("id"), "vec").limit(entries).collect()
    start = [[_floor(v, scale) for v in r["vec"]] + [0] * (size - len(r["vec"])) for r in first]
    books = [Codebook.of(_entries([s[p * width : (p + 1) * width] for s in start], width)) for p in range(parts)]
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(books)
        sums = rows.select(vec.alias("vec")).mapInArrow(_sums(size, parts, scale, shared), "part int, entry int, place int, piece int, value long")
        counts: dict[tuple[int, int], int] = {}
        totals: dict[tuple[int, int], list[int]] = {}
        for p, e, j, k, v in sums.groupBy("part", "entry", "place", "piece").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect():
            if j < 0:
                counts[p, e] = int(v)
            else:
                totals.setdefault((p, e), [0] * width)[j] += int(v) << (PIECE_BITS * k)
        moved = [
            [[t // counts[p, e] for t in totals.get((p, e), [])] if (p, e) in counts else [int(v) for v in old] for e, old in enumerate(book.entries)]
            for p, book in enumerate(books)
        ]
        shared.unpersist()
        books = [Codebook.of(_entries(m, width)) for m in moved]
    return books


def digest(books: list[Codebook]) -> str:
    """SHA-256 of all entries' components, by part, entry and place, in decimal and joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for e in b.entries for v in e).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """id_col, code (two hex digits a part), error (squared distances to the code's entries, summed over the parts),
    label_error (errors summed over the rows of one label, nulls together), codebooks_sha256; one row for each kept row.

    Rows whose vector is null or holds null or non-finite components are left out; zero vectors are vectors like others,
    and so are rows of one id or without an id. The codebooks start with the smallest ids, null ids last, equal ids by
    their vectors; fewer rows than entries make smaller codebooks. Vectors shorter than the longest, or of a length that
    is no multiple of parts, count as if zeros followed. Integers are exact at any magnitude; an error that 64 bits do not
    hold is null, and so is the sum over its label. An empty table gives no rows; other columns play no part. entries is
    256 at most.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code's byte tells up to 256 entries apart")
    spark = vectors.sparkSession
    rows = kept_vectors(vectors, vec_col)
    out = f"`{id_col}` long, code string, error long, label_error long, codebooks_sha256 string"
    longest = rows.agg(F.max(F.size(column(rows, vec_col)))).first()[0]
    if longest is None:
        return spark.createDataFrame([], out)
    size = math.ceil(longest / parts) * parts
    books = train(rows, size, parts, entries, rounds, scale, id_col, vec_col)
    shared = spark.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, index, far in _assigned(batch.column(2), size, parts, scale, shared.value):
                n = len(index[0])
                codes = [row.tobytes().hex() for row in np.column_stack(index).astype(np.uint8)]
                errors = [e if e < 2**63 else None for e in map(int, sum(f.astype(object) for f in far))]
                kept = [batch.column(k).slice(lo, n) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["id", "label", "code", "error"])

    label = column(rows, label_col)
    kind = rows.schema[label_col].dataType.simpleString()
    coded = rows.select(column(rows, id_col).cast("long").alias("id"), label.alias("label"), column(rows, vec_col).cast("array<double>").alias("vec"))
    coded = coded.mapInArrow(encode, f"id long, label {kind}, code string, error long").checkpoint()
    whole = F.sum(F.col("error").cast("decimal(20,0)"))
    whole = F.when((F.count("error") == F.count("*")) & (whole <= 2**63 - 1), whole.cast("long"))
    by_label = coded.groupBy(F.col("label").alias("own")).agg(whole.alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("own")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def decode(code: str, books: list[Codebook], scale: int = SCALE) -> list[float]:
    """The vector that a code stands for, in the original scale."""
    return [int(v) / scale for b, k in zip(books, bytes.fromhex(code), strict=True) for v in b.entries[k]]
