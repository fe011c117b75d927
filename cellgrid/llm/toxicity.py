"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another: each model sees hashed word features and the probabilities of the categories
before it. While training, those earlier probabilities are out-of-fold predictions, so that a later model learns from
probabilities of the kind it will see. The decision threshold is set on out-of-fold probabilities too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm.packed import column, free_name, id_text, list_array, map_columns, map_texts

#: Hashed features: a word, and the first letters of longer ones.
BITS = 18
PREFIXES = (3, 4, 5, 7)
FOLDS = 5
#: Bound of a task's memory of words.
CACHED, CACHED_CHARS = 100_000, 40
#: Signs that are dropped at the ends of words.
SIGNS = ".,;:!?\"'()[]{}<>|#$%&*-_=+/\\~`^"


def word_features(word: str) -> list[int]:
    """Hashed features of one blank-delimited word; none if it consists of signs."""
    word = word.strip(SIGNS).lower()
    if not word:
        return []
    names = [word, *(f"{n}:{word[:n]}" for n in PREFIXES if len(word) > n)]
    return [xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass")) >> (64 - BITS) for n in names]


@dataclass
class Chain:
    """weights: categories x features; bias; earlier: categories x categories, the weights of earlier probabilities."""

    categories: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    earlier: np.ndarray
    threshold: float = 0.5
    out_of_fold: dict = field(default_factory=dict)

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """documents x categories from the normalised sums of feature weights, documents x categories."""
        out = np.zeros_like(sums)
        for k in range(len(self.categories)):
            out[:, k] = _logistic(sums[:, k] + self.bias[k] + out[:, :k] @ self.earlier[k, :k])
        return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def doc_features(text: str, known: Callable[[str], tuple]) -> np.ndarray:
    """The distinct features of a text's distinct words."""
    return np.unique(np.array([f for w in set(text.split()) for f in known(w)], dtype=np.int32))


def _spread(size) -> float:
    """What a document's sum of feature weights is divided by: less than a mean would, so that a few words of a long text
    keep their say."""
    return np.maximum(1, size) ** 0.25


def _linear(docs: list[np.ndarray], more: np.ndarray, y: np.ndarray, rounds: int, l2: float) -> tuple[np.ndarray, float, np.ndarray]:
    """Logistic regression by Adam over all rows: weights of features and of the columns of more, and a bias.

    A feature counts by its rarity among the rows, which its weight holds in the end."""
    sizes = np.array([max(1, len(d)) for d in docs])
    flat = np.concatenate([d if len(d) else np.zeros(1, np.int32) for d in docs])
    row = np.repeat(np.arange(len(docs)), sizes)
    used, flat, held = np.unique(flat, return_inverse=True, return_counts=True)
    rarity = np.log(len(docs) / held) / 3
    scale = (1 / _spread(sizes))[row] * rarity[flat]
    w, m, v = (np.zeros(len(used) + more.shape[1] + 1) for _ in range(3))
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    n = len(used)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for step in range(1, rounds + 1):
        p = _logistic(np.add.reduceat(w[flat] * scale, starts) + more @ w[n:-1] + w[-1])
        err = (p - y) * share
        grad = np.concatenate((np.bincount(flat, weights=err[row] * scale, minlength=n), err @ more, [err.sum()])) + l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.35 * (1 - 0.9 * step / rounds) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    full = np.zeros(1 << BITS)
    full[used] = w[:n] * rarity
    return full, w[-1], w[n:-1]


def _sums(docs: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    return np.array([weights[d].sum() / _spread(len(d)) for d in docs])


def fit(
    docs: list[np.ndarray], labels: dict[str, np.ndarray], target: str, rounds: int = 60, l2: float = 1e-4, folds: int = FOLDS
) -> Chain:
    """Trains on the features of a bounded set of rows; labels: 0/1 by category, in chain order, target among them.

    With no rows, or rows of one class only, a category's probability stays on one side and nothing is rejected."""
    names = tuple(labels)
    rows = len(docs)
    fold = np.random.default_rng(7).permutation(rows) % folds
    chain = Chain(names, np.zeros((len(names), 1 << BITS), np.float32), np.full(len(names), -30.0), np.zeros((len(names),) * 2), 1.1)
    earlier = np.zeros((rows, 0))
    for k, name in enumerate(names):
        y = np.asarray(labels[name], dtype=float)
        held = np.zeros(rows)
        if 0 < y.sum() < rows:
            for f in range(folds):
                train, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                w, bias, own = _linear([docs[i] for i in train], earlier[train], y[train], rounds, l2)
                held[test] = _logistic(_sums([docs[i] for i in test], w) + earlier[test] @ own + bias)
            w, bias, own = _linear(docs, earlier, y, rounds, l2)
            chain.weights[k], chain.bias[k], chain.earlier[k, :k] = w, bias, own
            if name == target:
                chain.threshold = best_threshold(held, y)
        chain.out_of_fold[name] = held
        earlier = np.column_stack((earlier, held))
    return chain


def best_threshold(p: np.ndarray, y: np.ndarray, beta: float = 0.5) -> float:
    """The middle of the gap between two probabilities at which F-beta is best; below 1, beta spares clean rows."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    score = (1 + beta**2) * hits / (np.arange(1, len(y) + 1) + beta**2 * y.sum())
    at = int(score.argmax())
    low = p[order[at + 1]] if at + 1 < len(y) else 0.0
    return float((p[order[at]] + low) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, most: int, categories: Sequence[str], id_col: str, text_col: str):
    """Features and labels of at most so many labelled rows, those whose ids hash lowest; only these reach the driver."""
    picked = (
        labels.select(column(labels, id_col).cast("long").alias("id"), *[column(labels, c).cast("int").alias(f"y_{c}") for c in categories])
        .dropna()
        .dropDuplicates(["id"])
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    texts = id_text(docs, id_col, text_col).join(F.broadcast(picked), "id").dropDuplicates(["id"])

    def make():
        known = _Features()
        return lambda batch: [list_array([doc_features(t, known.__getitem__) for t in batch], np.int32)]

    found = map_texts(texts, make, "features array<int>", "id", "text").join(F.broadcast(picked), "id").orderBy("id").toPandas()
    return [np.asarray(f, dtype=np.int32) for f in found["features"]], {c: found[f"y_{c}"].to_numpy() for c in categories}


class _Features(dict):
    def __missing__(self, word: str) -> list[int]:
        made = word_features(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[word] = made
        return made


def train(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("quality", "toxic"), target: str = "toxic",
    most_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text",
) -> Chain:
    """Trains the chain on at most most_rows labelled rows (0/1 columns of labels named by categories, in chain order)."""
    features, known = training_rows(docs, labels, most_rows, categories, id_col, text_col)
    return fit(features, known, target)


def classify(docs: DataFrame, chain: Chain, target: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, p_<category> for each category, and rejected, one row for each row: the whole text counts.

    A text without features that training has seen, such as a null or empty one, is not rejected; null and repeated ids and
    repeated rows stay as they are; an empty table gives no rows; other columns play no part. The chain has a fixed size, so
    it is broadcast.
    """
    return map_texts(docs, *_classifier(docs, chain, target), id_col, text_col)


def accept(docs: DataFrame, chain: Chain, target: str = "toxic", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that the chain doesn't reject."""
    make, _ = _classifier(docs, chain, target)
    flag = free_name("rejected", docs.columns)

    def make_flag():
        work = make()
        return lambda texts: work(texts)[-1:]

    judged = map_columns(docs, make_flag, f"{flag} boolean", text_col)
    return judged.filter(~F.col(flag)).drop(flag)


def _classifier(docs: DataFrame, chain: Chain, target: str) -> tuple[Callable, str]:
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = chain.categories.index(target)

    def make():
        model, known = shared.value, _Features()

        def work(texts: list[str]) -> list[pa.Array]:
            sums, some = np.zeros((len(texts), len(model.categories))), np.zeros(len(texts), dtype=bool)
            for k, text in enumerate(texts):
                found = doc_features(text, known.__getitem__)
                some[k] = model.weights[at, found].any()
                sums[k] = model.weights[:, found].sum(1, dtype=np.float64) / _spread(len(found))
            p = model.probabilities(sums)
            return [*(pa.array(p[:, k]) for k in range(p.shape[1])), pa.array((p[:, at] >= model.threshold) & some)]

        return work

    return make, ", ".join([*(f"p_{c} double" for c in chain.categories), "rejected boolean"])
