"""Near-duplicate join on word n-grams by exact Jaccard similarity, with vertical partitioning.

1. Every text becomes its set of distinct n-gram hashes. Blocks of documents deal their hashes to shards; a shard answers
   how many of each document's n-grams some other document has too. A document that could reach the threshold with
   nobody is alone. Equal sets become one class, so copies are compared once.
2. The n-grams of the remaining classes get a global order, rarest first. Two classes that are similar enough share one
   of their first few n-grams (prefix filter); classes connected through such n-grams form a group, and all links lie
   within groups.
3. In a group the order is cut into fragments. Each fragment's overlaps of all pairs of a tile are counted by themselves
   and summed for each pair; the sums decide exactly. Groups too large for one task first compare all classes with one
   hub, which settles the classes linked to it and those that its counts rule out; only what is left is tiled over tasks,
   and only tiles whose distances to the hub and whose sizes allow a link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm.packed import CHUNK_CHARS, column, free_name, id_text, list_array, mix, text_chars

NO_ID = -(2**63)
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Characters hashed at a time, characters and documents of a block, bytes of packets that are handed over at a time.
PART_CHARS, BLOCK_CHARS, BLOCK_DOCS, PACKET_BYTES = 2_000_000, 24_000_000, 200_000, 4_000_000
#: Rows of a tile, n-grams of a fragment.
TILE, FRAGMENT = 512, 2048
#: Classes, and n-grams of these, that one task compares; larger groups go over several tasks.
GROUP_CLASSES, GROUP_TOKENS = 512, 1_500_000
#: Parts of the classes that share a frequent n-gram.
SALTS = 16
#: Cells of the distance to a hub in one link's reach.
CELLS = 4
#: Documents whose ids may be broadcast; beyond that the join is a shuffle.
BROADCAST_IDS = 500_000
CACHED, CACHED_CHARS = 150_000, 40


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[word] = h
        return h


def shingles(text: str, words: int, known: dict) -> np.ndarray:
    """Sorted distinct hashes of the n-grams: words between ASCII blanks, A-Z lower-cased; a shorter text is one n-gram."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=words)], dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
    n = len(h) - words + 1
    out = h[:n].copy()
    for k in range(1, words):
        out *= PRIME
        out += h[k : k + n]
    out = np.sort(mix(out, 3))
    return out[np.concatenate(([True], out[1:] != out[:-1]))] if n > 1 else out


def signature(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


# --- 1: shared n-grams ------------------------------------------------------------------------------------------------

DOC = np.dtype([("id", "<i8"), ("n", "<u4"), ("sig", "V16")])
ASKED = "shard int, block long, hashes binary, docs binary"


def _ask(words: int, shards: int):
    """Deals a block's n-grams to shards: hash remainders of 32 bits, and the document of each (its place in the block).

    Texts are hashed and sorted by shard a few million characters at a time; a block holds many such parts, so that a
    shard gets one packet from a task's part of the input and not one from every few texts."""

    def dealt(found: list, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = np.concatenate(found)
        doc = np.repeat(np.arange(first, first + len(found), dtype=np.uint32), [len(f) for f in found])
        owner = (flat % np.uint64(shards)).astype(np.int32)
        order = np.argsort(owner, kind="stable")
        rest = ((flat // np.uint64(shards)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[order]
        return rest, doc[order], np.searchsorted(owner[order], np.arange(shards + 1))

    def flush(block: int, docs: list, parts: list) -> Iterator[pa.RecordBatch]:
        rows = [(shards + block % shards, np.array(docs, dtype=DOC).tobytes(), b"")]
        size = 0
        for s in range(shards):
            own = [(rest[cuts[s] : cuts[s + 1]], doc[cuts[s] : cuts[s + 1]]) for rest, doc, cuts in parts]
            if any(len(r) for r, _ in own):
                rows.append((s, np.concatenate([r for r, _ in own]).tobytes(), np.concatenate([d for _, d in own]).tobytes()))
                size += len(rows[-1][1])
            if rows and (size > PACKET_BYTES or s + 1 == shards):
                arrays = [pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))]
                yield pa.RecordBatch.from_arrays(arrays, ["shard", "block", "hashes", "docs"])
                rows, size = [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, known = TaskContext.get().partitionId() << 32, _Words()
        docs, parts, found, size, held = [], [], [], 0, 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.append(shingles(text, words, known))
                docs.append((NO_ID if doc is None else doc, len(found[-1]), signature(found[-1])))
                size += len(text)
                if size >= PART_CHARS:
                    parts.append(dealt(found, len(docs) - len(found)))
                    held += size
                    found, size = [], 0
                if held >= BLOCK_CHARS or len(docs) >= BLOCK_DOCS:
                    if found:
                        parts.append(dealt(found, len(docs) - len(found)))
                    yield from flush(block, docs, parts)
                    block, docs, parts, found, size, held = block + 1, [], [], [], 0, 0
        if docs:
            if found:
                parts.append(dealt(found, len(docs) - len(found)))
            yield from flush(block, docs, parts)

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each block how many of each document's n-grams occur more than once in the shard; documents pass through."""
    rows = []
    own = [(b, np.frombuffer(h, np.uint32), np.frombuffer(d, np.uint32)) for b, h, d in zip(pdf["block"], pdf["hashes"], pdf["docs"], strict=True) if len(d)]
    for b, h, d in zip(pdf["block"], pdf["hashes"], pdf["docs"], strict=True):
        if not len(d):
            rows.append((b, h, None))
    if own:
        every = np.sort(np.concatenate([h for _, h, _ in own]))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        for b, h, d in own:
            at = np.minimum(np.searchsorted(twice, h), max(0, len(twice) - 1))
            shared = twice[at] == h if len(twice) else np.zeros(len(h), bool)
            if shared.any():
                doc, n = np.unique(d[shared], return_counts=True)
                rows.append((b, None, np.column_stack((doc, n.astype(np.uint32))).tobytes()))
    return pd.DataFrame(rows, columns=["block", "docs", "shared"])


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    docs = np.frombuffer(next(d for d in pdf["docs"] if d is not None), dtype=DOC)
    shared = np.zeros(len(docs), dtype=np.int64)
    for s in pdf["shared"]:
        if s is not None:
            doc, n = np.frombuffer(s, np.uint32).reshape(-1, 2).T
            shared[doc] += n
    sig = [bytes(x) for x in docs["sig"]]
    return pd.DataFrame({"key": docs["id"], "n": docs["n"].astype(np.int64), "sig": sig, "shared": shared})


# --- 3: exact links within groups -------------------------------------------------------------------------------------


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _unite(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member of the component of each of count nodes."""
    label = np.arange(count)
    while len(left):
        # Roots are hooked, not the nodes: edges settled before hold their ends by the root.
        a, b = label[left], label[right]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = _roots(label)
        open_ = label[left] != label[right]
        left, right = left[open_], right[open_]
    return label


def overlaps(docs: list[np.ndarray], fragment: int = FRAGMENT):
    """Yields (first row, first column, shared n-grams of each pair) for tiles of documents.

    The order is by number of documents, then hash; it is cut into fragments. A tile's partial overlaps are counted in
    each fragment that both sides reach, as a product of 0/1 matrices, and summed."""
    sizes = np.array([len(d) for d in docs])
    flat = np.concatenate(docs) if docs else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(docs)), sizes)
    names, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.lexsort((names, times))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names)) - int((times == 1).sum())
    place = rank[place]
    common = place >= 0
    row, place = row[common], place[common]
    frag = place // fragment
    tiles = -(-len(docs) // TILE)
    parts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    key = (row // TILE) * (int(frag.max()) + 1 if len(frag) else 1) + frag
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    reached: list[list[int]] = [[] for _ in range(tiles)]
    for part in np.split(order, cuts) if len(order) else ():
        t, f = int(row[part[0]] // TILE), int(frag[part[0]])
        parts[t, f] = (row[part] % TILE, place[part] % fragment)
        reached[t].append(f)

    def matrix(t: int, f: int) -> np.ndarray:
        made = np.zeros((min(TILE, len(docs) - t * TILE), fragment), dtype=np.float32)
        made[parts[t, f]] = 1
        return made

    # One fragment at a time: two matrices and the sums of one row of tiles are held, however many fragments there are.
    for a in range(tiles):
        total: dict[int, np.ndarray] = {}
        for f in reached[a]:
            own = matrix(a, f)
            for b in range(a, tiles):
                if (b, f) in parts:
                    both = own @ (own if a == b else matrix(b, f)).T
                    if b in total:
                        total[b] += both
                    else:
                        total[b] = both
        for b in sorted(total):
            yield a * TILE, b * TILE, total.pop(b)


def links(sizes: np.ndarray, docs: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of documents with den * intersection >= num * union; sizes count all n-grams, docs hold the shared ones."""
    left, right = [], []
    for a, b, both in overlaps(docs):
        union = sizes[a : a + both.shape[0], None] + sizes[None, b : b + both.shape[1]] - both
        x, y = np.nonzero((den * both >= num * union) & (both > 0))
        x, y = x + a, y + b
        ahead = x < y
        left.append(x[ahead])
        right.append(y[ahead])
    none = [np.empty(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _joined(num: int, den: int):
    """Splits what a task got into groups and gives each class the least class of its component (within the task)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby(["label", "tile"], sort=False):
            part = part.drop_duplicates("node").sort_values(["n", "node"])
            node = part["node"].to_numpy()
            a, b = links(part["n"].to_numpy(np.int64), list(part["tokens"]), num, den)
            by_id = np.argsort(node)
            rank = np.empty(len(node), np.int64)
            rank[by_id] = np.arange(len(node))
            root = _unite(len(node), rank[a], rank[b])
            out.append(pd.DataFrame({"node": node, "root": node[by_id][root[rank]]}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "root": []}, dtype=np.int64)

    return run


def components(edges: DataFrame, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """node, label: the least node of each component of an edge table; an edge may stand either way round, or as a loop.

    Large star and small star in turn: each node first hands the least of its neighbours to the higher ones, then to the
    lower ones, until every node hangs on the least of its component. Rounds grow with the logarithm of a chain (the
    proven bound is its square), so there is no cap."""
    a, b = names
    nodes = edges.select(F.explode(F.array(a, b)).alias("node")).distinct()
    edges = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct().checkpoint()
    while True:
        around = edges.select("high", "low").unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = around.groupBy(F.col("high").alias("_u")).agg(F.least("_u", F.min("low")).alias("_m"))
        large = edges.join(least, F.col("low") == F.col("_u")).select("high", F.col("_m").alias("low")).distinct().checkpoint()
        least = large.groupBy(F.col("high").alias("_u")).agg(F.min("low").alias("_m"))
        down = large.join(least, F.col("high") == F.col("_u")).filter("low <> _m").select(F.col("low").alias("high"), F.col("_m").alias("low"))
        edges = down.unionByName(least.select(F.col("_u").alias("high"), F.col("_m").alias("low"))).distinct().checkpoint()
        ends = edges.select(F.explode(F.array(F.struct(F.col("high").alias("node"), F.lit(1).alias("up")), F.struct(F.col("low").alias("node"), F.lit(0).alias("up")))).alias("e"))
        open_ = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("n")).filter("up > 0 and n > 1")
        if not open_.limit(1).count():
            return nodes.join(edges, F.col("node") == F.col("high"), "left").select("node", F.coalesce("low", "node").alias("label"))


# --- the operator -----------------------------------------------------------------------------------------------------


def document_classes(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """key, n, sig, shared for each document: its n-grams, a digest of them, how many may occur elsewhere too."""
    shards = max(1, math.ceil(text_chars(docs, text_col) / CHUNK_CHARS))
    asked = id_text(docs, id_col, text_col).mapInArrow(_ask(words, shards), ASKED)
    answered = asked.repartition(shards, "shard").groupBy("shard").applyInPandas(_answer, "block long, docs binary, shared binary")
    return answered.repartition(shards, "block").groupBy("block").applyInPandas(_count, "key long, n long, sig binary, shared long").checkpoint()


def _tokens(docs: DataFrame, classes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """node, n, token: the n-grams of one document of each class."""
    wanted = classes.select("key", "node", "sig")
    wanted = F.broadcast(wanted) if classes.count() <= BROADCAST_IDS else wanted
    texts = id_text(docs, id_col, text_col).withColumn("key", F.coalesce("id", F.lit(NO_ID))).join(wanted, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            nodes, sets = [], []
            for node, sig, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                found = shingles(text, words, known)
                if signature(found) == sig:
                    nodes.append(node)
                    sets.append(found.view(np.int64))
            sizes = pa.array([len(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), sizes, list_array(sets, np.int64)], ["node", "n", "hashes"])

    found = texts.select("node", "sig", "text").mapInArrow(run, "node long, n long, hashes array<bigint>")
    return found.dropDuplicates(["node"]).select("node", "n", F.explode("hashes").alias("token"))


def jaccard_components(
    docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text",
    group_classes: int = GROUP_CLASSES, group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """id_col, n_shingles, component_id for each row: links join texts whose n-gram sets reach the Jaccard threshold.

    Words are what stands between ASCII blanks, A-Z lower-cased; a text of fewer words is one n-gram; a null or blank text
    is an empty set, linked with nothing. component_id is the smallest id reachable, null where no id there is known
    (a null id is larger than any other). Repeated rows link as copies do. An empty table gives no rows; other columns
    play no part. Intermediate tables go to the session's checkpoint folder.
    """
    num, den = threshold.numerator, threshold.denominator
    every = document_classes(docs, words, id_col, text_col)
    # den * shared >= num * n is needed for any link; copies have all their n-grams elsewhere too.
    alive = every.filter((F.col("n") > 0) & (den * F.col("shared") >= num * F.col("n")))
    node = F.conv(F.substring(F.hex("sig"), 1, 15), 16, 10).cast("long")
    known = F.when(F.col("key") != NO_ID, F.col("key"))
    classes = alive.groupBy("sig").agg(F.min("key").alias("key"), F.min(known).alias("least"), F.first("n").alias("n")).withColumn("node", node).checkpoint()

    tokens = _tokens(docs, classes, words, id_col, text_col).checkpoint()
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = tokens.join(shared, "token").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("order"))
    # Of n n-grams, those that no other class has come first in the order; the rest of the prefix is what can match.
    needed = F.ceil(F.col("n") * num / F.lit(den)).cast("int")
    sets = (
        ordered.withColumn("prefix", F.size("order") - needed + 1)
        .filter("prefix > 0")
        .select("node", "n", F.col("order.token").alias("tokens"), "prefix")
        .checkpoint()
    )
    heads = sets.select("node", F.explode(F.slice("tokens", F.lit(1), F.col("prefix"))).alias("token"))
    found = _group_links(sets.join(_groups(heads), "node").checkpoint(), num, den, group_classes, group_tokens)
    joined = classes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    result = joined.join(least, "root").select("sig", "component_id")
    own = F.when(F.col("key") != NO_ID, F.col("key"))
    return every.join(result, "sig", "left").select(
        own.alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", own).alias("component_id")
    )


def keep_one(docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that are alone or have the smallest id of their component.

    Rows of one id go or stay together; of rows without an id, those linked with an id go."""
    found = jaccard_components(docs, words, threshold, id_col, text_col)
    name = free_name("stays", docs.columns)
    stays = found.filter(column(found, id_col).eqNullSafe(F.col("component_id"))).select(column(found, id_col).alias(name)).distinct()
    return docs.join(stays, column(docs, id_col).cast("long").eqNullSafe(F.col(name)), "left_semi")


def _groups(heads: DataFrame) -> DataFrame:
    """node, label: classes connected through the n-grams of their prefixes get one label, the least node."""
    heads = heads.checkpoint()
    # Each n-gram ties its classes to the least of them: within salted parts first, so that a frequent one is no hot key,
    # then the parts' least classes to each other.
    salted = heads.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy("token", "salt").agg(F.min("node").alias("low"), F.count("*").alias("c"))
    least = parts.groupBy("token").agg(F.min("low").alias("least"), F.count("*").alias("n")).filter("n > 1").select("token", "least")
    ties = salted.join(parts.filter("c > 1").select("token", "salt", "low"), ["token", "salt"]).select("node", "low")
    ties = ties.unionByName(parts.join(least, "token").select(F.col("low").alias("node"), F.col("least").alias("low"))).filter("node <> low").distinct()
    label = components(ties, ("node", "low"))
    return heads.select("node").distinct().join(label, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _group_links(sets: DataFrame, num: int, den: int, group_classes: int, group_tokens: int) -> DataFrame:
    """node, root from node, n, tokens, label."""
    schema = "node long, root long"
    size = F.size("tokens").cast("long")
    sized = sets.groupBy("label").agg(F.count("*").alias("classes"), F.sum(size).alias("held")).filter("classes > 1").checkpoint()
    partitions = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits = (F.col("classes") <= group_classes) & (F.col("held") <= group_tokens)
    total = sized.filter(fits).agg(F.sum("classes"), F.sum("held")).first()
    tasks = max(partitions, math.ceil((total[0] or 0) / group_classes), math.ceil((total[1] or 0) / group_tokens))
    small = sets.join(sized.filter(fits), "label").withColumn("tile", F.lit(0))
    small = small.withColumn("task", F.pmod(F.xxhash64("label"), F.lit(tasks)))
    found = small.groupBy("task").applyInPandas(_joined(num, den), schema)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("classes") * 2 / group_classes), F.ceil(F.col("held") * 2 / group_tokens)).cast("int")
    large = sized.filter(~fits).select("label", blocks.alias("blocks"))
    if not large.limit(1).count():
        return found
    return found.unionByName(_large_groups(sets.join(large, "label"), num, den, group_classes, group_tokens))


def _large_groups(sets: DataFrame, num: int, den: int, group_classes: int, group_tokens: int) -> DataFrame:
    """Groups beyond one task, dealt over blocks: compare with a hub, drop what that settles, tile the rest over tasks.

    Jaccard distance is a metric, so two classes can only link if their distances to the hub differ by a link's reach at
    most, and only if their sizes do not differ by more than the threshold allows: a tile is made for two blocks of cells
    (of distance and size) that lie that near."""
    hub = sets.groupBy("label").agg(F.max_by(F.struct("node", "n", "tokens", "blocks"), F.struct(F.size("tokens"), F.col("node"))).alias("hub"))
    hub = hub.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("hub.blocks") - 1)))
    sets = sets.withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    union = F.col("n") + F.col("hub.n") - F.col("both")
    bound = ((F.size("tokens")) * (den + num) / num - F.col("n")).alias("bound")
    seen = (
        sets.join(hub, ["label", "part"])
        .withColumn("both", F.size(F.array_intersect("tokens", "hub.tokens")))
        .select("label", "node", "n", "tokens", F.col("hub.node").alias("hub"), (den * F.col("both") >= num * union).alias("linked"), bound,
                (1 - F.col("both") / union).alias("far"))
        .checkpoint()
    )
    linked = seen.filter("linked").select("node", F.col("hub").alias("root"))
    # A class not linked to the hub can link to one of n-grams between num/den of its own and the bound that the n-grams
    # it shares with anybody leave; classes linked to the hub need not meet each other.
    limits = seen.groupBy("label").agg(
        F.max(F.when(~F.col("linked"), F.col("bound"))).alias("most"),
        F.min(F.when(~F.col("linked"), F.col("n") * num / den)).alias("least"),
        F.min("n").alias("smallest"),
    )
    can = "if(linked, n <= most and n >= least, bound >= smallest)"
    reach = 1 - num / den
    cell = F.floor(F.col("far") * CELLS / max(reach, 1e-6)).cast("int").alias("cell")
    tall = F.floor(F.log("n") / max(-math.log(num / den), 1e-6)).cast("int").alias("tall")
    rest = seen.join(limits, "label").filter(can).select("label", "node", "n", "tokens", "linked", cell, tall).checkpoint()
    where = ["label", "linked", "cell", "tall"]
    held = rest.groupBy(*where).agg(F.count("*").alias("c"), F.sum(F.size("tokens").cast("long")).alias("h"))
    blocks = F.greatest(F.ceil(F.col("c") * 2 / group_classes), F.ceil(F.col("h") * 2 / group_tokens)).cast("int")
    held = held.withColumn("blocks", blocks).checkpoint()
    # Pairs of cells, then of their blocks: the open side's number first; linked classes only meet open ones.
    left, right = (held.select("label", *[F.col(c).alias(f"{c}_{k}") for c in (*where[1:], "blocks")]) for k in "ab")
    # A cell is a reach / CELLS wide, and a step of rounding is allowed for; sizes in one ratio of the threshold are a step apart.
    near = "not linked_a and abs(cell_a - cell_b) <= %d and abs(tall_a - tall_b) <= 2" % (CELLS + 1)
    once = "(linked_b or struct(cell_a, tall_a) <= struct(cell_b, tall_b))"
    pairs = left.join(right, "label").filter(f"{near} and {once}")
    pairs = pairs.withColumn("x", F.explode(F.expr("sequence(0, blocks_a - 1)"))).withColumn("y", F.explode(F.expr("sequence(0, blocks_b - 1)")))
    own = "linked_b or cell_a <> cell_b or tall_a <> tall_b or x <= y"
    pairs = pairs.filter(own).withColumn("task", F.xxhash64("label", "cell_a", "tall_a", "x", "linked_b", "cell_b", "tall_b", "y")).checkpoint()
    sides = [F.struct(*[F.col(f"{c}_{k}").alias(c) for c in where[1:]], F.col(b).alias("block")) for k, b in (("a", "x"), ("b", "y"))]
    sent = pairs.select("label", "task", F.explode(F.array(*sides)).alias("s")).select("label", "task", "s.*").distinct()
    dealt = rest.join(held, where).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = dealt.join(sent, [*where, "block"]).select("label", F.col("task").alias("tile"), "task", "node", "n", "tokens")
    links_ = tiles.groupBy("task").applyInPandas(_joined(num, den), "node long, root long")
    edges = linked.unionByName(links_.filter("node <> root"))
    return components(edges, ("node", "root")).select("node", F.col("label").alias("root"))
