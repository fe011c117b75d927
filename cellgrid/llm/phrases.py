"""Collocations: phrases of a few words that occur together more often than their parts, mined by suffix automata.

Documents are cut into shards. A shard's words become numbers, pieces of text end at a barrier, and a generalised suffix
automaton of bounded depth is grown over them, a level of phrase lengths at a time: every phrase is a node with a suffix
link to itself without its first word and an edge from itself without its last. Each place counts once, at the longest
phrase that ends there; sums along the suffix links give the endpos counts. Spark adds up the shards' counts.

A phrase is only as frequent as its parts, so lengths come one after the other, and automata grow over frequent words and
frequent shorter phrases only. Links lead from a phrase to the phrases inside it, which it may subsume.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellgrid.llm.packed import column, expand, mix, slices, squeeze
from cellgrid.session import shared_folder

#: What ends a piece; blanks and tabs part words.
ENDS = b".,;:!?\n\x0b\x0c\r"
#: A byte that no UTF-8 text has stands for the end of a piece while words are cut.
BARRIER = b"\xff"
TO_BARRIER = bytes(0xFF if c in ENDS else c for c in range(256))
#: Characters of a shard.
SHARD_CHARS = 8_000_000
#: Frequent phrases of one length whose hashes (8 bytes each) may be broadcast; with more of them all of that length may grow.
MOST_KNOWN = 4_000_000
PRIME = np.uint64(0x9E3779B97F4A7C15)


class _Ids(dict):
    """Numbers of one language's words, from the shard's list of words."""

    def __init__(self, lang: str, words: list[str]):
        self.lang, self.words = lang, words
        self[BARRIER] = 0

    def __missing__(self, word: bytes) -> int:
        self.words.append(f"{self.lang}\t{word.decode()}")
        self[word] = len(self.words)
        return len(self.words)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (words, counts, ids) from batches of (lang, text): words are "lang<tab>word", ids number them from 1, in the
    order of the text, with 0 between pieces."""
    words: list[str] = []
    known: dict[str, _Ids] = {}
    parts: list[np.ndarray] = []
    size = 0

    def made() -> pa.RecordBatch:
        ids = np.concatenate(parts)
        counts = np.bincount(ids, minlength=len(words) + 1)[1:]
        return pa.RecordBatch.from_arrays(
            [pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())), pa.array([squeeze(ids)], pa.binary())], ["words", "counts", "ids"]
        )

    for batch in batches:
        langs, texts = (batch.column(k).to_pylist() for k in range(2))
        for lo, hi in slices(texts, 1_000_000):
            for lang, text in zip(langs[lo:hi], texts[lo:hi], strict=True):
                ids = known.get(lang)
                if ids is None:
                    ids = known[lang] = _Ids(lang, words)
                cut = text.encode().translate(TO_BARRIER).lower().replace(BARRIER, b" \xff ").split()
                parts.append(np.fromiter(map(ids.__getitem__, cut), np.uint32, len(cut)))
                parts.append(np.zeros(1, np.uint32))
                size += len(text)
            if size >= SHARD_CHARS:
                yield made()
                words, known, parts, size = [], {}, [], 0
    if words:
        yield made()


@dataclass
class Level:
    """Phrases of one length: the node without the last word, the last word, the suffix link, and the endpos count."""

    prefix: np.ndarray
    last: np.ndarray
    link: np.ndarray
    count: np.ndarray


def automaton(ids: np.ndarray, depth: int, keep=None) -> list[Level]:
    """Levels 1 to depth of the suffix automaton of the pieces in ids (0 ends a piece). Nodes are numbered from 1 at each
    level. keep(length, prefix, last) tells which new nodes stay; a phrase needs both phrases it is made of."""
    at = ids.astype(np.int64)
    words = int(at.max(initial=0))
    none = np.zeros(words + 1, np.int64)
    levels = [Level(none, np.arange(words + 1), none, none)]
    deepest, where = np.where(at > 0, 1, 0), [at]
    for length in range(2, depth + 1):
        end = np.flatnonzero((at[:-1] > 0) & (at[1:] > 0)) + 1
        pair = at[end - 1] * (words + 1) + ids[end]
        names, first, node = np.unique(pair, return_index=True, return_inverse=True)
        prefix, last, link = names // (words + 1), names % (words + 1), at[end[first]]
        stays = np.ones(len(names), bool) if keep is None else keep(length, prefix, last)
        number = np.where(stays, np.cumsum(stays), 0)
        at = np.zeros(len(ids), np.int64)
        at[end] = number[node]
        deepest[at > 0] = length
        where.append(at)
        levels.append(Level(*(np.concatenate(([0], v[stays])) for v in (prefix, last, link)), np.zeros(int(stays.sum()) + 1, np.int64)))
    for k in range(depth, 0, -1):
        level = levels[k - 1]
        level.count = level.count + np.bincount(where[k - 1][deepest == k], minlength=len(level.link))
        if k > 1:
            below = levels[k - 2]
            below.count = below.count + np.bincount(level.link, weights=level.count, minlength=len(below.link)).astype(np.int64)
    return levels


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * PRIME + b, 5)


def _within(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
    return known[at] == hashes if len(known) else np.zeros(len(hashes), bool)


def _phrases(length: int, known: list, hashed: bool = False):
    """Rows (phrase, f) of a shard's phrases of so many words, or of their hashes. known: from one word on, the broadcast
    hashes of the phrases that may be frequent (None: all of them), up to one word less or to the length itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names, ids = batch.column(0)[row].values, expand(batch.column(1)[row].as_py()).astype(np.int64)
                words = np.concatenate((np.zeros(1, np.uint64), _hashes(names.to_pylist())))
                hashes = [words]  # of the nodes of each level
                if known[0] is not None:
                    often = _within(words, known[0].value)
                    often[0] = False
                    ids = np.where(often[ids], ids, 0)  # a rare word ends a piece

                def keep(of: int, prefix: np.ndarray, last: np.ndarray, words=words, hashes=hashes) -> np.ndarray:
                    own = _paired(hashes[of - 2][prefix], words[last])
                    stays = np.ones(len(own), bool) if of > len(known) or known[of - 1] is None else _within(own, known[of - 1].value)
                    hashes.append(np.concatenate((np.zeros(1, np.uint64), own[stays])))
                    return stays

                levels = automaton(ids, length, keep)
                if hashed:
                    own, times = hashes[-1][1:].view(np.int64), levels[-1].count[1:]
                    for lo in range(0, len(own), 100_000):
                        yield pa.RecordBatch.from_arrays([pa.array(own[lo : lo + 100_000]), pa.array(times[lo : lo + 100_000])], ["phrase", "f"])
                    continue
                bare = pc.replace_substring_regex(names, r"^(?s:.*)\t", "")
                text = names
                for level in levels[1:]:
                    text = pc.binary_join_element_wise(text.take(pa.array(level.prefix[1:] - 1)), bare.take(pa.array(level.last[1:] - 1)), " ")
                for lo in range(0, len(text), 100_000):
                    f = pa.array(levels[-1].count[1:][lo : lo + 100_000])
                    yield pa.RecordBatch.from_arrays([text.slice(lo, 100_000), f], ["phrase", "f"])

    return run


def _known(frequent: DataFrame, most: int):
    """The hashes of frequent phrases of one length (given as phrases or as hashes), sorted and broadcast; None if there are
    more of them than most."""
    if frequent.count() > most:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.schema.field(0).type == pa.int64():
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()], pa.binary())], ["hashes"])
                continue
            lang, _, words = zip(*(t.rpartition("\t") for t in batch.column(0).to_pylist()), strict=True) if batch.num_rows else ((), (), ())
            split = [w.split(" ") for w in words]
            own = np.empty(0, np.uint64)
            for k in range(len(split[0]) if split else 0):
                word = _hashes([f"{a}\t{w[k]}" for a, w in zip(lang, split, strict=True)])
                own = word if k == 0 else _paired(own, word)
            yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], ["hashes"])

    found = [np.frombuffer(r[0], np.uint64) for r in frequent.select("phrase").mapInArrow(run, "hashes binary").collect()]
    return frequent.sparkSession.sparkContext.broadcast(np.sort(np.concatenate([np.empty(0, np.uint64), *found])))


def _stored(frame: DataFrame, where: str) -> DataFrame:
    frame.write.parquet(where)
    return frame.sparkSession.read.parquet(where)


def _summed(rows: DataFrame) -> DataFrame:
    """phrase, f: shards hold a phrase once each, so rows go to their phrase's task before they are added up; a map of all that
    a task has would take more memory than it saves."""
    return rows.repartition("phrase").groupBy("phrase").agg(F.sum("f").alias("f"))


def counted(docs: DataFrame, least: int, most_words: int, lang_col: str, text_col: str, most_known: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n): words of each language; (lang, phrase, f): all phrases of up to most_words words found least times or
    more, as "lang<tab>words"."""
    where = f"{shared_folder(docs.sparkSession)}/phrases-{uuid.uuid4().hex}"
    lang, text = (F.coalesce(column(docs, c).cast("string"), F.lit(or_)) for c, or_ in ((lang_col, "und"), (text_col, "")))
    shards = docs.select(lang.alias("lang"), text.alias("text")).mapInArrow(_shards, "words array<string>, counts array<bigint>, ids binary")
    shards = _stored(shards, f"{where}/shards")
    words = shards.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select(F.col("w.words").alias("phrase"), F.col("w.counts").alias("f"))
    words = _stored(words.groupBy("phrase").agg(F.sum("f").alias("f")), f"{where}/words")
    of_lang = F.expr(r"substring(phrase, 1, length(phrase) - length(substring_index(phrase, '\t', -1)) - 1)")
    n = words.groupBy(of_lang.alias("lang")).agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= least)
    shards = shards.select("words", "ids")
    known = [_known(frequent, most_known)]
    for length in range(2, most_words + 1):
        own = []
        if length == 2:  # nearly all pairs are rare: sums by hash tell which may be frequent before any text is sent
            sums = _summed(shards.mapInArrow(_phrases(2, known, hashed=True), "phrase long, f long"))
            own = [_known(_stored(sums.filter(F.col("f") >= least), f"{where}/pairs"), most_known)]
        level = _summed(shards.mapInArrow(_phrases(length, known + own), "phrase string, f long")).filter(F.col("f") >= least)
        level = _stored(level, f"{where}/{length}")
        frequent = frequent.unionByName(level)
        if length < most_words:
            known.append(_known(level, most_known))
    return n, frequent.select(of_lang.alias("lang"), "phrase", "f")


def collocations(
    docs: DataFrame, least: int = 30, most_words: int = 4, cover: int = 80, top: int | None = 2000, scale: int = 2_000_000,
    lang_col: str = "lang", text_col: str = "text", most_known: int = MOST_KNOWN,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to most_words words of each language.

    Texts are lower-cased (A-Z) and cut into pieces at .,;:!? and line ends, pieces into words at blanks and tabs. a is how
    often a phrase occurs within pieces, overlaps included; n counts the language's words. A cut after some word gives l and
    r, the counts of both parts, and the score floor(scale * a / (l + r)); the lowest counts, ties to the earliest cut. A
    phrase goes if a longer one that holds it is found in cover percent of its places or more. The top ones stay (None: all
    of them) by score, then a, then the phrase's bytes.

    A null text is empty, a null language is "und"; ids play no part, so repeated rows count again. An empty table, or none
    frequent enough, gives no rows; other columns play no part.
    """
    n, counts = counted(docs, least, most_words, lang_col, text_col, most_known)
    key = lambda words: F.concat("lang", F.lit("\t"), F.array_join(words, " "))
    words = F.split(F.substring_index("phrase", "\t", -1), " ")
    found = counts.withColumn("w", words).filter(F.size("w") > 1).withColumnRenamed("f", "a")
    cuts = found.withColumn("k", F.explode(F.expr("sequence(1, size(w) - 1)")))
    cuts = cuts.select("phrase", "a", "k", key(F.expr("slice(w, 1, k)")).alias("first"), key(F.expr("slice(w, k + 1, size(w))")).alias("rest"))
    one = lambda name, f: counts.select(F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(one("first", "l"), "first").join(one("rest", "r"), "rest")
    score = F.expr(f"(cast(a as decimal(20,0)) * cast({scale} as decimal(10,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.groupBy("phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))

    # Following links and edges from a phrase meets every phrase inside it.
    inside = found.filter("size(w) > 2").withColumn("size", F.explode(F.expr("sequence(2, size(w) - 1)")))
    inside = inside.withColumn("start", F.explode(F.expr("sequence(1, size(w) - size + 1)")))
    longer = inside.groupBy(key(F.expr("slice(w, start, size)")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = found.join(longer, "phrase", "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover))
    kept = kept.join(best, "phrase").select("lang", F.array_join("w", " ").alias("phrase"), "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
