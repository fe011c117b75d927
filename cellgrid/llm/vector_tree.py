"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample; every vector is then dealt to a leaf. Inner products become distances by one more
component that brings every vector to one length. A query walks the tree with a priority queue, nearest centre first, and
takes leaves in the order in which it meets them. How many leaves a query takes is widened until the neighbours of a set
of calibration queries, known from comparing these with every vector, are found to the wanted share.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellgrid.llm.packed import column, list_array

#: Bounds of the sample that fits the tree and of the queries that calibrate the search.
SAMPLE_ROWS, CALIBRATION_QUERIES = 20_000, 200
#: Children of a node, vectors that a leaf should hold, leaves at most, vectors of one group of leaves (or part of a leaf).
#: Groups of leaves keep a query's partial results few: vectors without much structure make it visit many leaves.
BRANCHES, LEAF_ROWS, MOST_LEAVES, PART_ROWS = 8, 256, 4096, 4096


@dataclass
class Tree:
    """centers: of all nodes; children: of inner nodes, by node; leaf: number of a leaf, -1 at inner nodes."""

    centers: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, level by level."""
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(self.leaf[node] < 0)
            if not len(open_):
                return self.leaf[node]
            for at in np.unique(node[open_]):
                rows = open_[node[open_] == at]
                kids = self.children[at]
                node[rows] = kids[_distances(x[rows], self.centers[kids]).argmin(1)]

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
                continue
            kids = self.children[node]
            for d, kid in zip(_distances(q[None], self.centers[kids])[0].tolist(), kids.tolist(), strict=True):
                heapq.heappush(queue, (d, kid))


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (centers * centers).sum(1)[None] - 2 * x @ centers.T


def lift(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component: then nearest and largest inner product are the same for queries with a zero there."""
    return np.column_stack((x, np.sqrt(np.maximum(0, longest * longest - (x * x).sum(1)))))


def fit(sample: np.ndarray, leaves: int, seed: int = 3, rounds: int = 8) -> Tree:
    """A tree with about so many leaves over the sample (lifted vectors)."""
    rng = np.random.default_rng(seed)
    most = max(1, math.ceil(len(sample) / max(1, leaves)))
    centers, children, leaf, made = [sample.mean(0) if len(sample) else np.zeros(sample.shape[1])], [np.empty(0, np.int64)], [-1], 0
    stack = [(0, np.arange(len(sample)))]
    while stack:
        node, rows = stack.pop()
        groups = _kmeans(sample[rows], min(BRANCHES, max(2, len(rows) // most)), rng, rounds) if len(rows) > most else []
        if len(groups) < 2:
            leaf[node], made = made, made + 1
            continue
        first = len(centers)
        for center, own in groups:
            centers.append(center)
            children.append(np.empty(0, np.int64))
            leaf.append(-1)
            stack.append((len(centers) - 1, rows[own]))
        children[node] = np.arange(first, len(centers))
    return Tree(np.array(centers), children, np.array(leaf))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int) -> list[tuple[np.ndarray, np.ndarray]]:
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _distances(x, centers).argmin(1)
        used = np.unique(own)
        centers = np.array([x[own == c].mean(0) for c in used])
    own = _distances(x, centers).argmin(1)
    return [(centers[c], np.flatnonzero(own == c)) for c in np.unique(own)]


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec (array<double>) of the rows whose vector is there, not zero, and finite throughout."""
    vec = column(rows, vec_col).cast("array<double>")
    made = rows.select(column(rows, id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return made.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda v: v != 0))


def _stacked(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name))
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: largest score, then smallest id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def _best_rows(scores: np.ndarray, ids: np.ndarray, k: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of all finite scores of each row that reach its k-th best less the row's slack; in no order."""
    keep = np.isfinite(scores)
    if scores.shape[1] > k:
        keep &= scores >= np.partition(scores, scores.shape[1] - k, axis=1)[:, [scores.shape[1] - k]] - slack[:, None]
    return np.nonzero(keep)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two tables, summed component by component: a pair's product does not depend on what
    else is multiplied with it, as a matrix product's last bits do, so equal vectors tie wherever they lie. Sums that leave
    a double's range on their way are taken again on vectors brought near 1 by powers of two, which rounds nothing away: they
    are infinite only where the product is beyond that range, and never NaN."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = _summed(a, b)
        beyond = np.flatnonzero(~np.isfinite(out))
        if len(beyond):
            (a, e), (b, f) = _near_one(a[beyond]), _near_one(b[beyond])
            out[beyond] = np.ldexp(_summed(a, b), e + f)
    return out


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a))
    for c in range(a.shape[1]):
        out += a[:, c] * b[:, c]
    return out


def _near_one(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with their largest components between 1/2 and 1, and the powers of two they were divided by."""
    power = np.frexp(np.abs(x).max(1, initial=0.0))[1]
    return np.ldexp(x, -power[:, None]), power


def _unscaled(scores: np.ndarray, own_scale: np.ndarray, scale: float) -> np.ndarray:
    """Products of scaled queries (rows) and vectors as those of the original ones: equal where those are, for being beyond a
    double's range or below its least number."""
    (m, e), (n, f) = np.frexp(own_scale), np.frexp(scale)
    with np.errstate(over="ignore"):
        return np.ldexp(scores * (m * n)[:, None], (e + f)[:, None])


def _size(rows: DataFrame) -> int:
    """The vectors' most frequent length (the larger of equally frequent ones); 0 for none."""
    first = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def _longest(rows: DataFrame) -> tuple[int, float, float]:
    """Rows, the largest component, and the longest norm in units of it, in which no square overflows."""
    n, scale = rows.agg(F.count("*"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v))))).first()
    if not n:
        return 0, 1.0, 0.0
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + (v / scale) * (v / scale)))
    return n, scale, rows.agg(F.max(norm)).first()[0]


def _scales(q: np.ndarray, scale: float) -> np.ndarray:
    """What queries are divided by: the table's scale, or their own largest component if that is larger."""
    return np.maximum(scale, np.abs(q).max(1, initial=0.0))


def _exact_leaves(rows: DataFrame, queries: np.ndarray, own_scale: np.ndarray, ids: np.ndarray, tree: Tree, scale: float, longest: float, k: int) -> list[list[int]]:
    """The leaves of the true neighbours of a bounded set of (scaled) queries: every task keeps k of each, which are then
    merged."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast((queries, own_scale, ids, tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qs, scales, own, model = shared.value
        best: list = [None] * len(qs)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, vec_ids = _stacked(batch, "vec") / scale, batch.column(0).to_numpy()
            leaf = model.assign(lift(x, longest))
            scores = _unscaled(qs @ x.T, scales, scale)
            for q in range(len(qs)):
                others = np.flatnonzero(vec_ids != own[q])
                at = others[_top(scores[q, others], vec_ids[others], k)]
                new = (scores[q, at], vec_ids[at], leaf[at])
                if best[q] is not None:
                    new = tuple(np.concatenate(p) for p in zip(best[q], new, strict=True))
                    at = _top(new[0], new[1], k)
                    new = tuple(p[at] for p in new)
                best[q] = new
        if best and best[0] is not None:
            q = np.repeat(np.arange(len(qs)), [len(b[0]) for b in best])
            cols = [q, *(np.concatenate([b[j] for b in best]) for j in range(3))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["q", "score", "vec_id", "leaf"])

    found = rows.select("vec_id", "vec").mapInArrow(run, "q long, score double, vec_id long, leaf long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("q", "leaf").collect()
    out: list[list[int]] = [[] for _ in queries]
    for q, leaf in best:
        out[q].append(leaf)
    return out


def calibrate(tree: Tree, queries: np.ndarray, leaves: list[list[int]], recall: float) -> int:
    """The fewest leaf visits for which the neighbours of the queries are found to this share on average."""
    ranks = []
    for q, own in zip(queries, leaves, strict=True):
        if own:
            order = {leaf: k for k, leaf in enumerate(tree.visit(q))}
            ranks.append(np.array([order[leaf] for leaf in own]))
    for visits in range(1, tree.leaves + 1):
        if not ranks or np.mean([(r < visits).mean() for r in ranks]) >= recall:
            return visits
    return tree.leaves


def taken(tree: Tree, q: np.ndarray, visits: int, sizes: np.ndarray, least: int) -> np.ndarray:
    """Leaves, best bin first, until there are so many visits and they hold at least so many vectors."""
    way, held = [], 0
    for leaf in tree.visit(q):
        if len(way) >= visits and held >= least:
            break
        way.append(leaf)
        held += int(sizes[leaf])
    return np.array(way, dtype=np.int64)


def grouped(sizes: np.ndarray, most: int = PART_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The group of each leaf and the parts of each group: leaves side by side share a group while they hold at most so
    many vectors; a larger leaf is a group of its own, in parts."""
    group, held = np.zeros(len(sizes), np.int64), []
    for leaf, n in enumerate(sizes.tolist()):
        if held and held[-1] + n <= most:
            held[-1] += n
        else:
            held.append(n)
        group[leaf] = len(held) - 1
    return group, np.maximum(1, -(-np.array(held, dtype=np.int64) // most))


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.97, id_col: str = "vec_id", vec_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k found vectors of largest inner product, ties to the
    smaller id; vectors of the query's own id are left out.

    The tree is fitted on at most sample_rows vectors, those whose ids hash lowest; all vectors are indexed. recall is what
    the leaf visits are widened to on at most CALIBRATION_QUERIES queries. Vectors null, zero, or with null or non-finite
    components take no part, nor do those of another length than most, nor null ids; repeated ids are vectors of their own;
    of repeated query ids one counts. Equal scores go by id, also where equal vectors lie in several leaves. Any finite
    magnitudes take part; products beyond a double's range are infinite, hence equal. An empty table gives no rows; other
    columns play no part.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    size = _size(rows)
    rows = rows.filter(F.size("vec") == size)
    asked = usable(queries, id_col, vec_col).filter(F.size("vec") == size).dropDuplicates(["vec_id"])
    n, scale, longest = _longest(rows)
    out = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], out)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()
    leaves = max(1, min(MOST_LEAVES, n // leaf_rows, len(picked) // 4))
    tree = fit(lift(np.stack(picked["vec"].to_numpy()) / scale, longest), leaves)
    trial = asked.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(CALIBRATION_QUERIES).toPandas()
    if not len(trial):
        return spark.createDataFrame([], out)
    known = np.stack(trial["vec"].to_numpy())
    known_scale = _scales(known, scale)
    known = known / known_scale[:, None]
    flat = np.column_stack((known, np.zeros(len(known))))
    truth = _exact_leaves(rows, known, known_scale, trial["vec_id"].to_numpy(), tree, scale, longest, k)
    visits = calibrate(tree, flat, truth, recall)
    shared = spark.sparkContext.broadcast(tree)

    def to_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(lift(_stacked(batch, "vec") / scale, longest)) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), *batch.columns], ["leaf", "vec_id", "vec"])

    dealt = rows.select("vec_id", "vec").mapInArrow(to_leaf, "leaf long, vec_id long, vec array<double>")
    sizes = np.zeros(tree.leaves, np.int64)
    for leaf, count in dealt.groupBy("leaf").count().collect():  # one row for each leaf: MOST_LEAVES and a few more at most
        sizes[leaf] = count
    group, parts = grouped(sizes)
    groups = spark.createDataFrame(list(zip(range(len(group)), group.tolist(), parts[group].tolist(), strict=True)), "leaf long, grp long, parts long")
    part = F.pmod(F.xxhash64("vec_id", "vec"), F.col("parts"))
    dealt = dealt.join(F.broadcast(groups), "leaf").select("grp", part.alias("part"), "leaf", "vec_id", "vec")

    def to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _stacked(batch, "vec") if batch.num_rows else np.empty((0, size))
            x = x / _scales(x, scale)[:, None]
            at, grp, ways = [], [], []
            for j, (q, same) in enumerate(zip(x, batch.column(2).to_pylist(), strict=True)):
                way = taken(shared.value, np.append(q, 0.0), visits, sizes, k + same)
                for g in np.unique(group[way]):
                    at.append(j)
                    grp.append(g)
                    ways.append(way[group[way] == g])
            asked_ = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:2]]
            more = [pa.array(grp, pa.int64()), pa.array(parts[grp] if grp else [], pa.int64()), list_array(ways, np.int64)]
            yield pa.RecordBatch.from_arrays([*asked_, *more], ["query_id", "q", "grp", "parts", "leaves"])

    own = rows.groupBy("vec_id").agg(F.count("*").alias("same"))  # vectors of a query's own id do not count for its k
    asked = asked.join(own, "vec_id", "left").select("vec_id", "vec", F.coalesce("same", F.lit(0)).alias("same"))
    asking = asked.mapInArrow(to_groups, "query_id long, q array<double>, grp long, parts long, leaves array<bigint>")
    asking = asking.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")

    def best(asks: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(have):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, x, leaf = have["vec_id"].to_numpy(), np.stack(have["vec"].to_numpy()), have["leaf"].to_numpy()
        near = x / scale
        own = {n: np.flatnonzero(leaf == n) for n in np.unique(leaf)}
        found = []
        for lo in range(0, len(asks), 256):
            some = asks.iloc[lo : lo + 256]
            q, vec = some["query_id"].to_numpy(), np.stack(some["q"].to_numpy())
            asker, way = np.repeat(np.arange(len(some)), some["leaves"].map(len)), np.concatenate(some["leaves"].to_list())
            own_scale = _scales(vec, scale)
            far = vec / own_scale[:, None]
            # Beyond most a product of the original vectors is infinite, and so equal to all others there; least is how far
            # apart such products may lie and be equal for being rounded to a double's smallest numbers.
            with np.errstate(over="ignore"):
                most = np.finfo(np.float64).max / own_scale / scale
            least = size * np.finfo(np.float64).smallest_subnormal / scale / own_scale
            scores = np.full((len(some), len(ids)), -np.inf)
            for n, at in own.items():
                row = asker[way == n]
                if len(row):
                    scores[row[:, None], at] = np.clip(far[row] @ near[at].T, -most[row][:, None], most[row][:, None])
            scores[q[:, None] == ids[None]] = -np.inf
            # Matrix products choose, with room for their last bits; the chosen are scored again in one fixed order.
            slack = 4e-16 * (size + 1) * longest * np.sqrt((far * far).sum(1)) + least + 1e-300
            row, at = _best_rows(scores, ids, k, slack)
            exact = np.concatenate([np.empty(0), *(products(vec[row[s : s + 65536]], x[at[s : s + 65536]]) for s in range(0, len(row), 65536))])
            order = np.lexsort((ids[at], -exact, row))
            row, at, exact = row[order], at[order], exact[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, at, exact = (v[place < k] for v in (row, at, exact))
            found.append(pd.DataFrame({"query_id": q[row], "vec_id": ids[at], "score": exact}))
        return pd.concat(found)

    pairs = asking.groupBy("grp", "part").cogroup(dealt.groupBy("grp", "part")).applyInPandas(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
