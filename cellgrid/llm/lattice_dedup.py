"""Near duplicates of embeddings by lattice hashing: random projections decoded to E8 points, in several tables.

1. Equal vectors of a label become one class. A table projects a class's unit vector to a few blocks of eight numbers and
   decodes each to the nearest point of the E8 lattice; the points are the class's home cell. It also visits the neighbouring
   cells that lie nearest (a minimal vector away in one block or several). Tables are added until pairs drawn at exactly the
   threshold meet to the wanted share; two classes meet where one is at home and the other at home or on a visit.
2. A crowded home cell of the first table has a ball: the classes within half the threshold's angle of one of them, its hub.
   They all link with each other, so they are counted by arithmetic and tied to one of them, and never compared.
3. Cells in which nobody can meet are dropped by keys alone. What is left is compared cell by cell, large cells in tiles over
   many tasks. A pair that meets several times is counted at the first table and cell where it meets, which both vectors'
   own keys tell, so no pairs are written or sorted: a tile gives sums and a spanning forest.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellgrid.llm.ngram_join import _unite
from cellgrid.llm.packed import column, mix
from cellgrid.llm.vector_tree import _size, _stacked
from cellgrid.operators.graph import components

#: Width of a lattice cell (random projections of unit vectors have a deviation of 1), visits of a table, most tables: loose
#: thresholds would ask for more than that.
WIDTH, VISITS, MOST_TABLES = 2.2, 8, 64
#: Random pairs that share a block's point, and classes that may share a cell by chance: these give the blocks.
BLOCK_SHARE, BY_CHANCE = 0.0065, 4
#: Pairs drawn to set the number of tables.
TRIALS = 4000
#: Classes of one home cell from which on it has a ball; rows of a tile's side; rows of a task.
BALL_LEAST, TILE_ROWS, TASK_ROWS = 64, 1024, 16_384
#: Pairs looked up at a time, and how near the threshold a cosine is worked out again in one fixed order.
PAIRS, CLOSE = 50_000, 1e-9


@cache
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minus signs."""
    pairs = [[a if k == i else b if k == j else 0 for k in range(8)] for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    halves = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(v < 0 for v in s) % 2 == 0]
    return np.array(pairs + halves, dtype=np.float64)


def _nearest_d8(z: np.ndarray) -> np.ndarray:
    """Nearest integer points whose sum is even: where it is odd, the worst rounding goes the other way."""
    near = np.rint(z)
    gap = z - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(gap[odd]).argmax(1)
    near[odd, worst] += np.where(gap[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(z: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is D8 and D8 moved by 1/2 everywhere."""
    whole, half = _nearest_d8(z), _nearest_d8(z - 0.5) + 0.5
    nearer = ((z - whole) ** 2).sum(1) <= ((z - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows are scaled by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _times(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """x @ m summed in one fixed order: a row's result does not depend on the rows beside it."""
    out = np.zeros((len(x), m.shape[1]))
    for c in range(x.shape[1]):
        out += x[:, c, None] * m[c]
    return out


@lru_cache(maxsize=2 * MOST_TABLES)
def _projected(size: int, width: int, seed: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """A table's random projection, and where its lattices are moved to."""
    rng = np.random.default_rng((seed, table))
    return rng.normal(size=(size, width)), rng.random(width) * 2


@dataclass
class Lattices:
    """Tables of projections for vectors of one size; the same seed gives the same tables everywhere."""

    size: int
    blocks: int
    tables: int
    visits: int = VISITS
    width: float = WIDTH
    seed: int = 11

    def keys(self, units: np.ndarray, labels: np.ndarray, tables: range | None = None) -> np.ndarray:
        """(row, table, 1 + visits) keys: the home cell first, then the cells visited, the nearest first."""
        made = [self._table(units, labels, t) for t in (range(self.tables) if tables is None else tables)]
        return np.stack(made, 1)

    def _table(self, units: np.ndarray, labels: np.ndarray, table: int) -> np.ndarray:
        projection, offset = _projected(self.size, 8 * self.blocks, self.seed, table)
        z = _times(units, projection / self.width) + offset
        n, most = len(units), self.visits + 1
        hashes, cost = mix(labels.astype(np.uint64), table + 1)[:, None], np.zeros((n, 1))
        for b in range(self.blocks):
            own = z[:, 8 * b : 8 * b + 8]
            home = decode(own)
            steps = minimal_vectors()
            far = 2 - 2 * _times(own - home, steps.T)  # how much farther the neighbour lies, squared
            near = np.argpartition(far, self.visits, axis=1)[:, : self.visits]
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1)
            far = np.concatenate((np.zeros((n, 1)), np.take_along_axis(far, near, 1)), 1)
            points = np.concatenate((home[:, None], home[:, None] + steps[near]), 1)
            cell = np.full(points.shape[:2], 7, np.uint64)
            for c in range(8):
                cell = mix(cell ^ np.rint(2 * points[:, :, c]).astype(np.int64).view(np.uint64), c)
            total = (cost[:, :, None] + far[:, None]).reshape(n, -1)
            best = np.argsort(total, axis=1, kind="stable")[:, :most]
            cost = np.take_along_axis(total, best, 1)
            before, step = best // far.shape[1], best % far.shape[1]
            hashes = mix(np.take_along_axis(hashes, before, 1) + np.take_along_axis(cell, step, 1), 17 + b)
        return hashes

    def first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The key where each pair of keys' rows first meets; of two cells of one table the lesser key, 0 for none."""
        out, open_ = np.zeros(len(a), np.uint64), np.arange(len(a))
        for t in range(self.tables):
            x, y = a[open_, t], b[open_, t]
            at_x, at_y = (y == x[:, :1]).any(1), (x == y[:, :1]).any(1)
            x, y = x[:, 0], y[:, 0]
            out[open_] = np.where(at_x & at_y, np.minimum(x, y), np.where(at_x, x, np.where(at_y, y, 0)))
            open_ = open_[~(at_x | at_y)]
        return out


def fitted(size: int, classes: int, threshold: float, share: float) -> Lattices:
    """Blocks for so many classes, and tables until drawn pairs of exactly the threshold's cosine meet to this share."""
    blocks = 1
    while classes * BLOCK_SHARE**blocks > BY_CHANCE:
        blocks += 1
    rng = np.random.default_rng(5)
    x = unit(rng.normal(size=(TRIALS, size)))
    y = rng.normal(size=(TRIALS, size))
    y -= (x * y).sum(1, keepdims=True) * x
    across = np.sqrt((y * y).sum(1, keepdims=True))
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * y / np.where(across > 0, across, 1)
    same, apart = np.zeros(TRIALS, np.uint64), np.ones(TRIALS, bool)
    for tables in range(1, MOST_TABLES + 1):
        made = Lattices(size, blocks, tables)
        a, b = (made.keys(v, same, range(tables - 1, tables))[:, 0] for v in (x, y))
        apart &= ~((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1))
        if apart.mean() <= 1 - share:
            break
    return made


def _cells(made: Lattices, home_only: bool):
    """Rows of (node, ball, key, home) from batches of (node, ball, label hash, vec); a ball of 0 is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                keys = made.keys(unit(_stacked(some, "vec").astype(np.float64)), some.column(2).to_numpy(), range(1) if home_only else None)
                keys = keys[:, :, :1] if home_only else keys
                times = keys.shape[1] * keys.shape[2]
                at = pa.array(np.repeat(np.arange(some.num_rows), times))
                home = np.broadcast_to(np.arange(keys.shape[2]) == 0, keys.shape).ravel()
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(at), some.column(1).take(at), pa.array(keys.ravel().view(np.int64)), pa.array(home.astype(np.int32))], ["node", "ball", "key", "home"]
                )

    return run


def _in_ball(threshold: float):
    """The ball of each class: its home cell's key, if it lies within half the threshold's angle of the hub."""
    half = math.acos(threshold) / 2 - 1e-7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = (unit(_stacked(batch, "vec").astype(np.float64)) * unit(_stacked(batch, "hub").astype(np.float64))).sum(1)
            inside = pa.array(near >= math.cos(half) if half > 0 else np.zeros(len(near), bool))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(inside), batch.column(1).filter(inside)], ["node", "ball"])

    return run


def _linked(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of rows whose cosine reaches the threshold."""
    cos = a @ b.T
    i, j = np.nonzero(cos >= threshold - CLOSE)
    doubt = np.flatnonzero(cos[i, j] < threshold + CLOSE)
    exact = np.zeros(len(doubt))
    for c in range(a.shape[1]):
        exact += a[i[doubt], c] * b[j[doubt], c]
    keep = np.ones(len(i), bool)
    keep[doubt] = exact >= threshold
    return i[keep], j[keep]


def _compared(made: Lattices, threshold: float):
    """For a task's rows (tile, side, key, home, node, mult, ball, label, lab, vec): node, links, root (null: none)."""

    def linked(rows: np.ndarray, of: dict[str, np.ndarray], units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the linked pairs of one tile that may meet there."""
        side = of["side"][rows]
        left, right = rows[side == 0], rows[side == (1 if side.any() else 0)]
        i, j = _linked(units[left], units[right], threshold)
        i, j = left[i], right[j]
        keep = (of["node"][i] != of["node"][j]) & (of["label"][i] == of["label"][j]) & (of["home"][i] + of["home"][j] > 0)
        keep &= (of["ball"][i] != of["ball"][j]) | (of["ball"][i] == 0)
        return (i[keep], j[keep]) if side.any() else (i[keep & (i < j)], j[keep & (i < j)])

    def counted(i: np.ndarray, j: np.ndarray, of: dict[str, np.ndarray], units: np.ndarray) -> pd.DataFrame:
        """Sums and a spanning forest of the pairs that first meet in the cell of their rows."""
        node, row, place = np.unique(of["node"][np.concatenate((i, j))], return_index=True, return_inverse=True)
        row = np.concatenate((i, j))[row]
        keys = np.concatenate([made.keys(units[row[k : k + 1024]], of["lab"][row[k : k + 1024]]) for k in range(0, len(row), 1024)])
        x, y, here = place[: len(i)], place[len(i) :], of["key"][i].astype(np.uint64)
        ours = np.concatenate([made.first(keys[x[k : k + PAIRS]], keys[y[k : k + PAIRS]]) == here[k : k + PAIRS] for k in range(0, len(x), PAIRS)])
        x, y, mult = x[ours], y[ours], of["mult"][row]
        links = np.zeros(len(node), np.int64)
        np.add.at(links, x, mult[y])
        np.add.at(links, y, mult[x])
        some = links > 0
        return pd.DataFrame({"node": node[some], "links": links[some], "root": node[_unite(len(node), x, y)][some]})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        units = unit(np.stack(pdf["vec"].to_numpy()).astype(np.float64))
        of = {c: pdf[c].to_numpy() for c in ("side", "key", "home", "node", "mult", "ball", "label", "lab")}
        out, pairs, held = [], [], 0
        for rows in pdf.groupby("tile", sort=False).indices.values():
            if len(rows) > 1:
                pairs.append(linked(rows, of, units))
                held += len(pairs[-1][0])
            if held >= 10 * PAIRS:
                out.append(counted(*(np.concatenate(p) for p in zip(*pairs, strict=True)), of, units))
                pairs, held = [], 0
        if held:
            out.append(counted(*(np.concatenate(p) for p in zip(*pairs, strict=True)), of, units))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []}, dtype=np.int64)

    return run


def _tiles(cells: DataFrame, tasks: int) -> DataFrame:
    """node, key, home, tile, side, task for every cell where a class at home can meet another: a small cell is one tile of
    side 0; a large one is cut into blocks of one kind (at home or visiting, of one ball or of none), and two blocks are a
    tile unless both visit or both are of one ball."""
    meets = cells.groupBy("key").agg(F.sum("home").alias("homes"), F.count("*").alias("n")).filter("homes > 0 and n > 1")
    alive = cells.join(meets.select("key", "n"), "key")
    small = alive.filter(F.col("n") <= TILE_ROWS).select("node", "key", "home", F.col("key").alias("tile"), F.lit(0).alias("side"), F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task"))
    large = alive.filter(F.col("n") > TILE_ROWS)
    kinds = large.groupBy("key", "home", "ball").agg(F.count("*").alias("c"))
    kinds = kinds.withColumn("kind", F.when(F.col("c") >= BALL_LEAST, F.col("ball")).otherwise(0))  # small balls go with those of none
    held = kinds.groupBy("key", "home", "kind").agg(F.sum("c").alias("c")).withColumn("parts", F.ceil(F.col("c") / TILE_ROWS).cast("int")).checkpoint()
    block = held.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select("key", F.struct("home", "kind", "part").alias("b"))
    pairs = block.select("key", F.col("b").alias("x")).join(block.select("key", F.col("b").alias("y")), "key")
    pairs = pairs.filter("x <= y and (x.home = 1 or y.home = 1) and (x.kind <> y.kind or x.kind = 0)")
    pairs = pairs.withColumn("tile", F.xxhash64("key", "x", "y"))
    sides = F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("b"), F.lit(0).alias("side"))))
    sides = sides.otherwise(F.array(F.struct(F.col("x").alias("b"), F.lit(0).alias("side")), F.struct(F.col("y").alias("b"), F.lit(1).alias("side"))))
    sent = pairs.select("key", "tile", F.explode(sides).alias("s")).select("key", "tile", "s.side", "s.b.home", "s.b.kind", "s.b.part")
    own = large.join(kinds.select("key", "home", "ball", "kind"), ["key", "home", "ball"]).join(held.select("key", "home", "kind", "parts"), ["key", "home", "kind"])
    own = own.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = own.join(sent, ["key", "home", "kind", "part"]).select("node", "key", "home", "tile", "side", F.col("tile").alias("task"))
    return small.unionByName(dealt)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, share: float = 0.998, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """id_col, n_links (other rows linked directly), component_id (smallest id reachable), kept (it is the own id); one row for
    each row of vectors.

    Rows of one label link when their cosine, in double precision, reaches the threshold; of pairs just at it the given share
    is found, of nearer pairs more. A row links with nothing if its label or vector is null, or the vector is zero, holds
    null or non-finite components, or has another length than most. Equal vectors link, rows of one id too; a null id is
    larger than any other, so component_id is null only where no id is known. Any finite magnitudes will do. An empty table
    gives no rows; other columns play no part.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vec_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vec = column(vectors, vec_col).cast("array<float>" if single else "array<double>")
    rows = vectors.select(column(vectors, id_col).cast("long").alias("id"), column(vectors, label_col).alias("label"), vec.alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda v: v != 0)
    usable = F.coalesce(usable, F.lit(False))
    size = _size(rows.filter(usable))
    usable = usable & (F.size("vec") == size)
    same = rows.filter(usable).groupBy("label", "vec").agg(F.count("*").alias("mult"), F.min("id").alias("least"))
    classes = same.withColumn("node", F.monotonically_increasing_id()).withColumn("lab", F.xxhash64("label")).checkpoint()
    made = fitted(max(size, 1), classes.count(), threshold, share)

    bare = classes.select("node", F.lit(0).cast("long").alias("ball"), "lab", "vec")
    schema = "node long, ball long, key long, home int"
    first = bare.mapInArrow(_cells(made, True), schema).select("node", F.when(F.col("key") == 0, 1).otherwise(F.col("key")).alias("key"))
    placed = classes.join(first, "node")
    hubs = placed.groupBy("key", "label").agg(F.count("*").alias("n"), F.min_by("vec", F.xxhash64("node")).alias("hub")).filter(F.col("n") >= BALL_LEAST).checkpoint()
    balls = placed.join(hubs, ["key", "label"]).select("node", F.col("key").alias("ball"), "vec", "hub").mapInArrow(_in_ball(threshold), "node long, ball long")
    nodes = classes.join(balls, "node", "left").select("node", F.coalesce("ball", F.lit(0)).alias("ball"), "lab", F.col("label").cast("string").alias("label"), "mult", "vec").checkpoint()

    cells = nodes.select("node", "ball", "lab", "vec").mapInArrow(_cells(made, False), schema)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(nodes.count() * made.tables * (1 + VISITS) / TASK_ROWS))
    tiles = _tiles(cells, tasks).join(nodes, "node")
    found = tiles.groupBy("task").applyInPandas(_compared(made, threshold), "node long, links long, root long").checkpoint()

    inside = nodes.filter("ball <> 0").groupBy("ball", "label").agg(F.sum("mult").alias("held"), F.min("node").alias("root"))
    tied = nodes.join(inside, ["ball", "label"]).select("node", (F.col("held") - F.col("mult")).alias("links"), "root")
    every = found.unionByName(tied)
    links = every.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(every.filter("node <> root").select("node", "root"), "node", "root").withColumnRenamed("label", "root")
    ties = classes.select("node", "least").join(label, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = ties.groupBy("root").agg(F.min("least").alias("component"))
    done = ties.join(least, "root").join(links, "node", "left").select("node", "component", F.coalesce("links", F.lit(0)).alias("links"))
    done = classes.select("node", "label", "vec", "mult").join(done, "node").select("label", "vec", (F.col("links") + F.col("mult") - 1).alias("links"), "component")
    part = rows.filter(usable).join(done, ["label", "vec"]).select("id", "links", "component")
    alone = rows.filter(~usable).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    out = part.unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
