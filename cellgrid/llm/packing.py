"""Packing documents into fixed windows by order-preserving dynamic programming.

Documents keep their order. Within a block of documents every document end, sentence end and (in long sentences) every
few ids is a place where a window may end. The cost of a window is its padding, plus a penalty for the kind of cut at its
end, plus a small charge that keeps windows few. As padding is linear in the window's length, the best start for each end
is the minimum of one quantity over a sliding range of places, which a monotone queue gives in constant time.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellgrid.llm.packed import id_text, slices

#: Penalties of a cut, in ids of padding: between documents, after a sentence, elsewhere.
AT_DOCUMENT, AT_SENTENCE, AT_ID = 0, 2, 24
#: Charge for each window, so that short windows of a power of two are used only where they save padding.
PER_WINDOW = 6
#: Ids between two places inside a long sentence.
STRIDE = 32
#: Ids of a block, which is planned as a whole.
BLOCK_IDS = 2_000_000
#: Characters of texts whose words are encoded together.
SLICE_CHARS = 1_000_000
#: Bounds of a task's memory of words; signs that a word may end in (no apostrophe: it makes pieces of its own).
CACHED, CACHED_CHARS = 500_000, 40
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # the pattern whose pieces are known (fixed value)
SIGNS = "!#$%&()*+,-./:;<=>?@[]^_`{|}~\""


def _byte_table() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: its own sign where that is visible, else the next
    code point from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(rest)) for b in range(256)]


BYTE_LETTERS = str.maketrans(dict(enumerate(_byte_table())))


def byte_letters(text: str) -> str:
    return text.encode().decode("latin-1").translate(BYTE_LETTERS)


@lru_cache(maxsize=1)
def tokenizer(spec: str):
    """The tokenizer of a JSON document, kept in a worker: reading it takes longer than a small task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


def splits_words(spec: str) -> bool:
    """Whether a tokenizer treats the words between blanks one by one, as the shortcut below assumes: small letters, white
    space as one blank, and pieces by a pattern that never matches white space."""
    made = json.loads(spec)
    normal = [(p["type"], p.get("content")) for p in (made.get("normalizer") or {}).get("normalizers", [])]
    before = [(p["type"], (p.get("pattern") or {}).get("Regex")) for p in (made.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    suffix = made.get("model", {}).get("end_of_word_suffix")
    return normal == [("NFC", None), ("Replace", " "), ("Lowercase", None)] and before == [("Split", PIECES), ("ByteLevel", None)] and suffix == "</w>"


def word_encoder(spec: str, end_id: int, cached: int = CACHED) -> tuple[Callable[[list[str]], list[np.ndarray]], np.ndarray]:
    """A function from texts to their ids, each with end_id, and a table that marks ids ending a sentence.

    If the vocabulary drops white space and never joins over it, the words between blanks are encoded one by one and at most
    so many remembered; else whole texts are encoded. A new word of letters and then signs is two pieces, which go to the
    vocabulary's merges directly. The memory belongs to one task."""
    model = tokenizer(spec)
    vocab = model.get_vocab()
    size = max([*vocab.values(), end_id]) + 1
    ends = np.zeros(size, dtype=bool)
    ends[[i for token, i in vocab.items() if token.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
    last = np.array([end_id], dtype="<u4").tobytes()
    known: dict[str, bytes] = {"": b""}
    letters: dict[str, bytes] = {"": b""}

    merged = model.model.tokenize

    def alone(word: str) -> bytes:
        return array("I", model.encode(word, add_special_tokens=False).ids).tobytes()

    def piece(text: str) -> bytes:
        return array("I", [t.id for t in merged(text if text.isascii() else byte_letters(text))]).tobytes()

    def learn(words: set[str]) -> None:
        for word in words:
            core = word.rstrip(SIGNS)
            # Capitals beyond ASCII, marks and digits are left to the whole tokenizer.
            if core.isascii():
                plain = core.isalpha() or not core
                core = core.lower()
            else:
                plain = core.isalpha() and core == core.lower() and is_normalized("NFC", core)
            if not plain or len(word) > CACHED_CHARS:
                known[word] = alone(word)
                continue
            ids = letters.get(core)
            if ids is None:
                ids = letters[core] = piece(core)
            signs = word[len(core) :]
            if signs:
                if signs not in letters:
                    letters[signs] = piece(signs)
                ids += letters[signs]
            known[word] = ids

    def encode(texts: list[str]) -> list[np.ndarray]:
        for memory in (known, letters):
            if len(memory) > cached:
                memory.clear()
                memory[""] = b""
        split = [text.replace("\n", " ").split(" ") for text in texts]
        learn(set().union(*split).difference(known))
        return [np.frombuffer(b"".join(map(known.__getitem__, words)) + last, dtype="<u4") for words in split]

    def encode_whole(texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(alone(text) + last, dtype="<u4") for text in texts]

    return encode if splits_words(spec) else encode_whole, ends


def places(sizes: np.ndarray, sentence_ends: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Places where windows may end, ascending from 0, and the penalty of each: documents of these sizes lie end to end;
    sentence_ends are positions in the whole."""
    total = int(sizes.sum())
    kind = np.zeros(total + 1, dtype=np.int8)
    kind[sentence_ends] = 2
    kind[np.cumsum(sizes)] = 1
    kind[0] = 1
    soft = np.flatnonzero(kind)
    more = np.maximum(0, (np.diff(soft) - 1) // stride)
    step = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
    kind[np.repeat(soft[:-1], more) + step * stride] = 3
    at = np.flatnonzero(kind)
    penalty = np.array([0, AT_DOCUMENT, AT_SENTENCE, AT_ID])[kind[at]]
    penalty[0] = 0
    return at, penalty


def power_starts(at: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """For each place the numbers of the places that lie a power of two (below the window) before it: where the numbers
    for each place begin, and the numbers."""
    number = np.full(int(at[-1]) + 1, -1, dtype=np.int64)
    number[at] = np.arange(len(at))
    ends, starts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for power in (1 << k for k in range(window.bit_length()) if 1 << k < window):
        first = int(np.searchsorted(at, power))
        found = number[at[first:] - power]
        hit = np.flatnonzero(found >= 0)
        ends.append(hit + first)
        starts.append(found[hit])
    end, start = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(end, kind="stable")
    return np.searchsorted(end[order], np.arange(len(at) + 1)).tolist(), start[order].tolist()


def cuts(at: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """The chosen ends, first 0 and last at[-1], of least padding plus penalties.

    A window that holds a power of two of ids needs no padding; such starts are looked up besides the queue's."""
    first, powers = power_starts(at, window)
    at, charge = at.tolist(), (penalty + PER_WINDOW).tolist()
    n = len(at)
    # cost of the best plan up to a place, and that plus the place: what the queue is ordered by, rising from its head.
    cost, value, start, queue, head, upto = [0] * n, [0] * n, [0] * n, [0], 0, first[1]
    for j in range(1, n):
        p = at[j]
        while at[queue[head]] < p - window:
            head += 1
        i = queue[head]
        best = value[i] + window - p
        begin, upto = upto, first[j + 1]
        if begin < upto:
            for k in powers[begin:upto]:
                if cost[k] < best:
                    best, i = cost[k], k
        cost[j] = best = best + charge[j]
        start[j] = i
        value[j] = best = best + p
        while len(queue) > head and value[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    out = [n - 1]
    while out[-1]:
        out.append(start[out[-1]])
    return [at[k] for k in reversed(out)]


def with_powers(at: np.ndarray, penalty: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Adds places near the end from which what is left falls into windows of powers of two."""
    total = int(at[-1])
    more, base = [], total
    for k in range(window.bit_length()):
        base -= 1 << k
        more += [p for p in (base, total - (1 << k)) if p > 0]
    low = max(0, total - 2 * window)
    rest = total - low
    p = total
    for k in range(rest.bit_length()):
        if rest >> k & 1:
            p -= 1 << k
            more.append(p)
    more = np.setdiff1d(np.array(more, dtype=np.int64), at)
    more = more[more > 0]
    every = np.concatenate([at, more])
    order = np.argsort(every, kind="stable")
    return every[order], np.concatenate([penalty, np.full(len(more), AT_ID)])[order]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _planned(ids: list, docs: list[np.ndarray], ends: np.ndarray, window: int, first: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of one block, and the number of its windows."""
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    flat = np.concatenate(docs)
    at, penalty = with_powers(*places(sizes, np.flatnonzero(ends[flat]) + 1), window)
    chosen = np.array(cuts(at, penalty, window), dtype=np.int64)
    doc_ends = np.cumsum(sizes)
    borders = np.unique(np.concatenate((chosen, doc_ends)))
    left, right = borders[:-1], borders[1:]
    doc = np.searchsorted(doc_ends, left, side="right")
    seq = np.searchsorted(chosen, left, side="right") - 1
    raw = flat.astype("<u4").tobytes()
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    columns = [
        pa.array([ids[k] for k in doc.tolist()], pa.int64()),
        *(pa.array(x, pa.int64()) for x in (left - (doc_ends - sizes)[doc], right - left, crc, sizes[doc], seq + first, left - chosen[seq])),
    ]
    names = [part.split()[0] for part in PIECE.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names), len(chosen) - 1


def pack(
    docs: DataFrame, spec: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS, cached_words: int = CACHED,
) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    spec is the tokenizer's JSON; end_id closes each document. Blocks of at most about block_ids ids (a longer document is
    a block of its own) are planned one after another where the rows lie: no shuffle. A null or empty text is its end_id
    alone; null and repeated ids stay as they are, each row a document; an empty table gives no rows. sequence_id holds
    the number of the partition in its upper bits. A task remembers at most cached_words words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, ends = word_encoder(shared.value, end_id, cached_words)
        first = TaskContext.get().partitionId() << 40
        ids, held, size = [], [], 0
        for batch in batches:
            texts, names = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for lo, hi in slices(texts, SLICE_CHARS):
                for doc, one in zip(names[lo:hi], encode(texts[lo:hi]), strict=True):
                    ids.append(doc)
                    held.append(one)
                    size += len(one)
                    if size >= block_ids:
                        made, windows = _planned(ids, held, ends, window, first)
                        first += windows
                        yield made
                        ids, held, size = [], [], 0
        if ids:
            yield _planned(ids, held, ends, window, first)[0]

    return id_text(docs, id_col, text_col).mapInArrow(run, PIECE)
