"""Language-model scoring by cross-entropy difference.

A target model (n-grams of the target documents) and a background model (n-grams of all documents) have the same order,
smoothing and vocabulary. A document's score is the mean over its tokens of the target loss less the background loss: low
for documents that look like the target. Counts are taken over every document. Chunks of documents send their distinct
n-grams with counts to shards and get the corpus counts back; a document's own counts are left out of the models that
hold it, so that documents of the target are not scored by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm.packed import (
    CHUNK_CHARS,
    chunk_count,
    column,
    expand,
    expand_sorted,
    id_text,
    mix,
    squeeze,
    squeeze_sorted,
    text_chars,
)

NO_ID = -(2**63)
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Stands before the first and after the last word.
EDGE = np.uint64(0x5851F42D4C957F2D)
#: Pseudo-counts: of a unigram, and of the unigram model behind a bigram.
ALPHA, MU = 0.5, 50.0
CACHED, CACHED_CHARS = 300_000, 40


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[word] = h
        return h


def _keys(texts: list[str], shards: int, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in a row: the unigram key of each predicted token, the bigram key, and the tokens of each text.

    A key is shard << 32 | remainder; the lowest bit of the remainder tells unigrams (1) from bigrams (0)."""
    uni, bi, sizes = [], [], []
    for text in texts:
        parts = text.encode("utf-8", "surrogatepass").lower().split()
        h = np.empty(len(parts) + 2, dtype=np.uint64)
        h[0] = h[-1] = EDGE
        h[1:-1] = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        uni.append(h[1:])
        bi.append(h[:-1] * PRIME + h[1:])
        sizes.append(len(parts) + 1)

    def place(h: np.ndarray, unigram: bool) -> np.ndarray:
        h = mix(h, 5 + unigram)
        rest = (h >> np.uint64(32)) & np.uint64(0xFFFFFFFE) | np.uint64(unigram)
        return (h & np.uint64(0xFFFFFFFF)) % np.uint64(shards) << np.uint64(32) | rest

    empty = [np.empty(0, np.uint64)]
    return place(np.concatenate(uni or empty), True), place(np.concatenate(bi or empty), False), np.array(sizes, dtype=np.int64)


def _texts(pdf: pd.DataFrame) -> list[str]:
    return [x if isinstance(x, str) else "" for x in pdf["text"]]


def _asked(shards: int):
    def run(docs: pd.DataFrame, target: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"shard": [], "chunk": [], "keys": [], "counts": []})
        uni, bi, sizes = _keys(_texts(docs), shards, _Words())
        wanted = np.repeat(np.isin(docs["key"].to_numpy(np.int64), target["target"].to_numpy(np.int64)), sizes)
        keys, place = np.unique(np.concatenate((uni, bi)), return_inverse=True)
        counts = np.empty((2, len(keys)), dtype=np.uint32)
        counts[0] = np.bincount(place[np.concatenate((wanted, wanted))], minlength=len(keys))
        counts[1] = np.bincount(place, minlength=len(keys))
        owner = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(owner, np.arange(shards + 1))
        rest, chunk = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), int(docs["chunk"].iloc[0])
        rows = [(s, chunk, squeeze_sorted(rest[a:b]), squeeze(counts[:, a:b].ravel())) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pd.DataFrame(rows, columns=["shard", "chunk", "keys", "counts"])

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums the counts of each key over chunks and answers each chunk in the order of its question.

    One row has the shard's totals instead: distinct unigrams, their target and background counts."""
    asked = [expand_sorted(k) for k in pdf["keys"]]
    counts = [expand(c).reshape(2, -1) for c in pdf["counts"]]
    keys, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.stack([np.bincount(place, weights=np.concatenate([c[k] for c in counts]), minlength=len(keys)) for k in range(2)])
    rows, at, shard = [], 0, int(pdf["shard"].iloc[0])
    for chunk, k in zip(pdf["chunk"], asked, strict=True):
        own = place[at : at + len(k)]
        at += len(k)
        rows.append((int(chunk), shard, squeeze(total[:, own].ravel()), None))
    uni = keys & np.uint32(1) == 1
    rows.append((-1, shard, None, [float(uni.sum()), *total[:, uni].sum(1).tolist()]))
    return pd.DataFrame(rows, columns=["chunk", "shard", "counts", "totals"])


def _scored(shards: int, words: float, tokens: tuple[float, float]):
    def run(docs: pd.DataFrame, answers: pd.DataFrame, target: set[int]) -> Iterator[tuple]:
        uni, bi, sizes = _keys(_texts(docs), shards, _Words())
        keys, place = np.unique(np.concatenate((uni, bi)), return_inverse=True)
        parts = [expand(c).reshape(2, -1) for c in answers.sort_values("shard")["counts"]]
        counts = np.concatenate(parts, axis=1).astype(np.float64)
        assert counts.shape[1] == len(keys)
        at_uni, at_bi = place[: len(uni)], place[len(uni) :]
        start = 0
        for doc, size in zip(docs["key"].tolist(), sizes.tolist(), strict=True):
            word, pair = at_uni[start : start + size], at_bi[start : start + size]
            start += size
            context = np.concatenate((word[-1:], word[:-1]))  # the edge sign, then all words but the last token
            own_word, own_pair = (_own(x) for x in (word, pair))
            own_context = np.concatenate((own_word[-1:], own_word[:-1]))
            loss = []
            for side in range(2):
                out = 1.0 if side == 1 or doc in target else 0.0
                whole = tokens[side] - out * size
                one = (counts[side, word] - out * own_word + ALPHA) / (whole + ALPHA * words)
                two = (counts[side, pair] - out * own_pair + MU * one) / (counts[side, context] - out * own_context + MU)
                loss.append(-np.log(two))
            yield size, float(loss[0].mean()), float(loss[1].mean())

    def frame(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"key": [], "n_tokens": [], "target_loss": [], "background_loss": []})
        mine = answers[answers["counts"].notna()]
        target = set(answers.loc[answers["counts"].isna(), "key"].astype(np.int64).tolist())
        made = list(run(docs, mine, target))
        return pd.DataFrame({"key": docs["key"], **dict(zip(("n_tokens", "target_loss", "background_loss"), map(list, zip(*made, strict=True)), strict=True))})

    return frame


def _own(x: np.ndarray) -> np.ndarray:
    """How often each value occurs in x, for each place."""
    _, inverse, n = np.unique(x, return_inverse=True, return_counts=True)
    return n[inverse].astype(np.float64)


def score(
    docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """id_col, n_tokens, target_loss, background_loss, score (their difference) for each row.

    target_ids holds the ids (column id_col) of the target documents; ids that docs lacks, nulls and repeats play no part.
    Words are what stands between ASCII blanks, A-Z lower-cased; the end of a text is a token too, so a null or empty text
    has one. Rows of one id count as that many documents, target or not alike; null ids are background. Without target
    documents the target model is uniform. An empty table gives no rows. The answered counts go to the checkpoint folder.
    """
    chunks = chunk_count(text_chars(docs, text_col), chunk_chars)
    key = F.coalesce("id", F.lit(NO_ID))
    # Dealt by id and text, so that an id that very many rows share is no hot chunk; target ids go to the chunks that hold them.
    rows = id_text(docs, id_col, text_col).select(F.pmod(F.xxhash64(key, "text"), F.lit(chunks)).cast("int").alias("chunk"), key.alias("key"), "text")
    wanted = target_ids.select(column(target_ids, id_col).cast("long").alias("key")).dropna().distinct()
    target = rows.select("chunk", "key").distinct().join(wanted, "key").select(F.col("chunk").alias("at"), F.col("key").alias("target"))
    # One partition a chunk, one a shard: what a task reads stays the same however large the input.
    rows, target = rows.repartition(chunks, "chunk"), target.repartition(chunks, "at")
    asked = rows.groupBy("chunk").cogroup(target.groupBy("at")).applyInPandas(_asked(chunks), "shard int, chunk int, keys binary, counts binary")
    answered = asked.repartition(chunks, "shard").groupBy("shard").applyInPandas(_answer, "chunk int, shard int, counts binary, totals array<double>").checkpoint()
    totals = answered.filter("chunk < 0").select(*[F.sum(F.col("totals")[k]).alias(f"t{k}") for k in range(3)]).first()
    words, *tokens = (x or 0.0 for x in totals)
    told = answered.filter("chunk >= 0").select("chunk", "shard", "counts", F.lit(None).cast("long").alias("key"))
    told = told.unionByName(target.select(F.col("at").alias("chunk"), F.lit(-1).alias("shard"), F.lit(None).cast("binary").alias("counts"), F.col("target").alias("key")))
    done = rows.groupBy("chunk").cogroup(told.repartition(chunks, "chunk").groupBy("chunk")).applyInPandas(
        _scored(chunks, words, tuple(tokens)), "key long, n_tokens long, target_loss double, background_loss double"
    )
    return done.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias(id_col), "n_tokens", "target_loss", "background_loss",
        (F.col("target_loss") - F.col("background_loss")).alias("score"),
    )
