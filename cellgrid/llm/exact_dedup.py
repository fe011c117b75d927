"""Exact deduplication through cuckoo-filter indexes of live digests.

Every text becomes one content key (SHA-256 and byte length). Each task first reduces its rows to one entry a key, so a
text that makes up a third of the corpus reaches its shard once a task. A shard feeds its entries to a cuckoo index: a
lookup finds candidate slots by fingerprint, a hit is verified against the full key kept in that bucket, an entry with a
larger id deletes the live one and takes its place, and an overfull table is doubled and refilled from its stored keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm.packed import column

#: Bytes of a content key: digest and length.
KEY = 40
#: Stands for a null id; any real id is larger.
NO_ID = -(2**63)
#: Rows that one shard stands for at most, so that an index stays small however large the table.
SHARD_ROWS = 500_000


class CuckooIndex:
    """A cuckoo filter of 16-bit fingerprints whose buckets also hold the live keys and their payloads."""

    def __init__(self, buckets: int = 64, slots: int = 4, max_kicks: int = 200):
        self.slots, self.max_kicks, self.resizes = slots, max_kicks, 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints: list[list[int]] = [[] for _ in range(buckets)]
        self.content: list[list[tuple]] = [[] for _ in range(buckets)]
        self.size = 0

    @staticmethod
    def _print(key: bytes) -> int:
        return int.from_bytes(key[8:10], "little") or 1

    def _other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & self.mask

    def _places(self, key: bytes) -> tuple[int, int, int]:
        fingerprint = self._print(key)
        first = int.from_bytes(key[:8], "little") & self.mask
        return fingerprint, first, self._other(first, fingerprint)

    def find(self, key: bytes) -> tuple[int, int] | None:
        """Bucket and slot of a live key: fingerprints select, the stored key decides."""
        fingerprint, first, second = self._places(key)
        for bucket in (first, second) if first != second else (first,):
            prints = self.prints[bucket]
            if fingerprint in prints:
                for slot, entry in enumerate(self.content[bucket]):
                    if prints[slot] == fingerprint and entry[0] == key:
                        return bucket, slot
        return None

    def get(self, key: bytes) -> tuple | None:
        at = self.find(key)
        return self.content[at[0]][at[1]] if at else None

    def delete(self, key: bytes) -> bool:
        at = self.find(key)
        if at is None:
            return False
        del self.prints[at[0]][at[1]], self.content[at[0]][at[1]]
        self.size -= 1
        return True

    def insert(self, key: bytes, *payload) -> None:
        """Adds a key that isn't live; kicks residents to their other bucket, and doubles the table when that fails."""
        entry, (fingerprint, bucket, second) = (key, *payload), self._places(key)
        if len(self.prints[bucket]) >= self.slots and len(self.prints[second]) < self.slots:
            bucket = second
        for kick in range(self.max_kicks):
            if len(self.prints[bucket]) < self.slots:
                self.prints[bucket].append(fingerprint)
                self.content[bucket].append(entry)
                self.size += 1
                return
            slot = kick % self.slots
            self.prints[bucket][slot], fingerprint = fingerprint, self.prints[bucket][slot]
            self.content[bucket][slot], entry = entry, self.content[bucket][slot]
            bucket = self._other(bucket, fingerprint)
        live = [*self.entries(), entry]
        self.resizes += 1
        self._clear(2 * (self.mask + 1))
        for e in live:
            self.insert(*e)

    def entries(self) -> Iterator[tuple]:
        for bucket in self.content:
            yield from bucket


def _counted(shards: int):
    """One entry for each key that a task has seen: its largest id and its rows. Flushed when it holds many keys."""

    def flush(seen: dict) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(seen), dtype=np.uint8).reshape(-1, KEY)
        ids, counts = np.array(list(seen.values()), dtype=np.int64).reshape(-1, 2).T
        shard = keys[:, 16:24].copy().view(np.uint64)[:, 0] % np.uint64(shards)
        rows = []
        for s in np.unique(shard):
            at = shard == s
            rows.append((int(s), keys[at].tobytes(), ids[at].tobytes(), counts[at].tobytes()))
        return pd.DataFrame(rows, columns=["shard", "keys", "ids", "counts"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, list[int]] = {}
        for pdf in batches:
            for key, doc in zip(pdf["key"], pdf["id"].to_numpy(np.int64), strict=True):
                entry = seen.setdefault(bytes(key), [NO_ID, 0])
                entry[0] = max(entry[0], int(doc))
                entry[1] += 1
            if len(seen) > 200_000:
                yield flush(seen)
                seen = {}
        if seen:
            yield flush(seen)

    return run


def _index_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """Feeds a shard's entries to a cuckoo index; returns the keys that more than one row has."""
    index = CuckooIndex()
    for keys, ids, counts in zip(pdf["keys"], pdf["ids"], pdf["counts"], strict=True):
        ids, counts = np.frombuffer(ids, dtype=np.int64).tolist(), np.frombuffer(counts, dtype=np.int64).tolist()
        for k, (doc, count) in enumerate(zip(ids, counts, strict=True)):
            key = keys[k * KEY : (k + 1) * KEY]
            live = index.get(key)
            if live is not None:
                index.delete(key)
                doc, count = max(doc, live[1]), count + live[2]
            index.insert(key, doc, count)
    many = [e for e in index.entries() if e[2] > 1]
    return pd.DataFrame(many, columns=["key", "keep_id", "group_size"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """One row for each input row: id_col, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Of equal texts the largest id is kept; a null id is smaller than any other, and keep_id is
    null where a group has null ids only. Rows repeated with one id and one text are one document: they are marked
    alike. An empty table gives no rows; other columns of docs play no part, whatever their names.
    """
    spark = docs.sparkSession
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // SHARD_ROWS))
    text = F.coalesce(column(docs, text_col), F.lit(""))
    keyed = docs.select(
        column(docs, id_col).cast("long").alias("id"),
        F.concat(F.unhex(F.sha2(text, 256)), F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))).alias("key"),
    )
    entries = keyed.select("key", F.coalesce("id", F.lit(NO_ID)).alias("id")).mapInPandas(
        _counted(shards), "shard int, keys binary, ids binary, counts binary"
    )
    groups = entries.groupBy("shard").applyInPandas(_index_shard, "key binary, keep_id long, group_size long")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).when(F.col("keep_id") != NO_ID, F.col("keep_id"))
    return keyed.join(groups, "key", "left").select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256"),
    )
