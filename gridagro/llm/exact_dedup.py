"""Exact duplicates through a sharded cuckoo-filter index of live text digests.

The index is a table with one shard per slice of the digest space. A shard holds the stored keys
(SHA-256 digest of the whole text, the row that stays, the number of rows) and the cuckoo filter
over their digests. Inserting looks a digest up in the filter first: a miss is new, a hit is
verified against the stored keys of the same bucket, that is against the full digest of the text.
Deleting verifies in the same way and then takes the fingerprint out. When an insertion finds no
free slot, the filter is built anew at twice the size from the stored keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridagro.llm.common import join_groups, read, stored, unused

#: Stored keys per shard when the index is first laid out.
SHARD_KEYS = 2048
#: Keys that a map task gathers before it hands them on.
LOCAL_KEYS = 50_000

KEYS = "sha string, doc_id long, uid long, size long"
INDEX = "shard int, sha string, doc_id long, uid long, size long, filter binary"

_SLOTS, _KICKS = 4, 200


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each digest may lie in either of two buckets."""

    def __init__(self, buckets: int = 16, table: bytes | None = None):
        self.buckets = buckets if table is None else len(table) // (2 * _SLOTS)
        self.table = np.zeros(self.buckets * _SLOTS, np.uint16) if table is None else np.frombuffer(table, np.uint16).copy()
        self.turn = 0

    def _places(self, sha: str) -> tuple[int, int, int]:
        value = int(sha[-16:], 16)
        mark = (value & 0xFFFF) or 1
        first = (value >> 16) & (self.buckets - 1)
        return mark, first, self._other(mark, first)

    def _other(self, mark: int, bucket: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 7) & (self.buckets - 1))

    def bucket(self, sha: str) -> int:
        """The lower of the two buckets of a digest; it stays the same wherever the fingerprint lies."""
        _, a, b = self._places(sha)
        return min(a, b)

    def _slot(self, bucket: int, mark: int) -> int:
        for k in range(bucket * _SLOTS, bucket * _SLOTS + _SLOTS):
            if self.table[k] == mark:
                return k
        return -1

    def __contains__(self, sha: str) -> bool:
        mark, a, b = self._places(sha)
        return self._slot(a, mark) >= 0 or self._slot(b, mark) >= 0

    def insert(self, sha: str) -> bool:
        """False if no slot could be freed; the filter is then incomplete and must be built anew."""
        mark, a, b = self._places(sha)
        for bucket in (a, b):
            if (k := self._slot(bucket, 0)) >= 0:
                self.table[k] = mark
                return True
        bucket = a
        for _ in range(_KICKS):
            self.turn = (self.turn + 1) % _SLOTS
            k = bucket * _SLOTS + self.turn
            mark, self.table[k] = int(self.table[k]), mark
            bucket = self._other(mark, bucket)
            if (k := self._slot(bucket, 0)) >= 0:
                self.table[k] = mark
                return True
        return False

    def delete(self, sha: str) -> bool:
        """Only for digests that were inserted; callers verify that first."""
        mark, a, b = self._places(sha)
        for bucket in (a, b):
            if (k := self._slot(bucket, mark)) >= 0:
                self.table[k] = 0
                return True
        return False


class Shard:
    """A filter and the stored keys that it stands for, by bucket."""

    def __init__(self, table: bytes | None = None):
        self.filter = CuckooFilter(table=table) if table else CuckooFilter()
        self.stored: dict[int, list[list]] = {}
        self.keys = 0

    def load(self, sha: str, doc_id, uid: int, size: int) -> None:
        self.stored.setdefault(self.filter.bucket(sha), []).append([sha, doc_id, uid, size])
        self.keys += 1

    def find(self, sha: str) -> list | None:
        if sha not in self.filter:
            return None
        return next((key for key in self.stored.get(self.filter.bucket(sha), ()) if key[0] == sha), None)

    def insert(self, sha: str, doc_id, uid: int, size: int) -> None:
        if (key := self.find(sha)) is not None:
            if _later(doc_id, uid, key[1], key[2]):
                key[1], key[2] = doc_id, uid
            key[3] += size
            return
        self.load(sha, doc_id, uid, size)
        if not self.filter.insert(sha):
            self.resize()

    def delete(self, sha: str) -> bool:
        if (key := self.find(sha)) is None:
            return False
        self.stored[self.filter.bucket(sha)].remove(key)
        self.keys -= 1
        return self.filter.delete(sha)

    def resize(self) -> None:
        keys, buckets = list(self.rows()), self.filter.buckets
        while True:
            buckets *= 2
            self.filter, self.stored, self.keys = CuckooFilter(buckets), {}, 0
            for key in keys:
                self.load(*key)
            if all(self.filter.insert(key[0]) for key in keys):
                return

    def rows(self) -> Iterator[list]:
        for keys in self.stored.values():
            yield from keys


def _later(doc_id, uid, other_id, other_uid) -> bool:
    """A null doc_id comes before every other."""
    return (doc_id is not None, doc_id or 0, uid) > (other_id is not None, other_id or 0, other_uid)


def _plain(frame: pd.DataFrame) -> Iterator[tuple]:
    ids = [None if pd.isna(x) else int(x) for x in frame["doc_id"].astype(object)]
    return zip(frame["sha"], ids, frame["uid"].astype(int), frame["size"].astype(int), strict=True)


def _frame(rows: list) -> pd.DataFrame:
    sha, doc_id, uid, size = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pd.DataFrame({"sha": pd.Series(sha, dtype=object), "doc_id": pd.array(doc_id, "Int64"), "uid": pd.array(uid, "int64"), "size": pd.array(size, "int64")})


def digests(docs: DataFrame) -> DataFrame:
    """(sha, doc_id, uid, size) of every row: the digest of the whole text in UTF-8, null as empty.

    ``uid`` tells rows apart that share their doc_id. The table is written once, so it stays as it is.
    """
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")).cast("binary"), 256)
    rows = docs.select(sha.alias("sha"), docs["doc_id"].cast("long").alias("doc_id"))
    return stored(rows.select("sha", "doc_id", F.monotonically_increasing_id().alias("uid"), F.lit(1).cast("long").alias("size")), "digests")


def _locally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shard = Shard()
    for batch in batches:
        for row in _plain(batch):
            shard.insert(*row)
            if shard.keys >= LOCAL_KEYS:
                yield _frame(list(shard.rows()))
                shard = Shard()
    yield _frame(list(shard.rows()))


def _shard_of(shards: int):
    return F.pmod(F.conv(F.substring("sha", 1, 12), 16, 10).cast("long"), F.lit(shards)).cast("int")


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.range(0).selectExpr(*[f"cast(null as {kind}) as {name}" for name, kind in (x.rsplit(" ", 1) for x in INDEX.split(", "))])


def update(index: DataFrame, inserts: DataFrame, deletes: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """The index after taking out the digests of ``deletes`` and putting in the rows of ``inserts``.

    ``inserts`` has the columns of ``digests``; ``deletes`` a column sha; its digests that are not
    stored are ignored. ``shards`` must be that of the index if the index is not empty. Equal digests
    are gathered in each map task before they are sent, so a text with any number of copies reaches
    its shard as one row per task.
    """
    if shards is None:
        shards = max(1, -(-inserts.count() // SHARD_KEYS))

    def change(key, held: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        tables = held.loc[held["sha"].isna(), "filter"].tolist()
        shard = Shard(bytes(tables[0]) if tables else None)
        for row in _plain(held[held["sha"].notna()]):
            shard.load(*row)
        gone = new["size"] < 0
        for sha in new.loc[gone, "sha"]:
            shard.delete(sha)
        for row in _plain(new[~gone]):
            shard.insert(*row)
        out = _frame(list(shard.rows()))
        out["filter"] = None
        table = pd.DataFrame({"sha": [None], "doc_id": pd.array([None], "Int64"), "uid": [0], "size": [0], "filter": [shard.filter.table.tobytes()]})
        out = pd.concat([out, table], ignore_index=True) if len(out) else table
        out["shard"] = int(key[0])
        return out[[x.split(" ")[0] for x in INDEX.split(", ")]]

    changes = inserts.mapInPandas(_locally, KEYS)
    if deletes is not None:
        changes = changes.unionByName(deletes.select("sha", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("uid"), F.lit(-1).cast("long").alias("size")).distinct())
    changes = changes.withColumn("shard", _shard_of(shards))
    return index.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, INDEX)


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: sha, doc_id, uid, keep_id, group_size and kept.

    Of equal texts the row with the largest doc_id stays; a null doc_id is the smallest, and of rows
    that share the largest doc_id exactly one stays. A null text equals the empty one.
    """
    rows = digests(docs)
    index = update(empty_index(docs.sparkSession), rows)
    groups = index.filter("sha is not null").select("sha", F.col("doc_id").alias("keep_id"), F.col("uid").alias("keep_uid"), F.col("size").alias("group_size"))
    groups = stored(groups, "exact-index")
    joined = join_groups(rows.drop("size"), groups.filter("group_size > 1"), "sha", "group_size", rows.count())
    alone = F.col("group_size").isNull()
    return joined.select(
        "sha", "doc_id", "uid",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without exact copies, with all their columns."""
    groups = exact_groups(docs).filter("group_size > 1")
    digest, sha, doc_id = unused(docs, "digest", "sha", "id")
    rows = groups.groupBy(F.col("sha").alias(sha), F.col("doc_id").alias(doc_id)).agg(F.max("kept").alias("kept"))
    going = rows.filter("not kept").drop("kept")
    shown = docs.withColumn(digest, F.sha2(F.coalesce(docs["text"], F.lit("")).cast("binary"), 256))
    same = (F.col(digest) == F.col(sha)) & F.col("doc_id").eqNullSafe(F.col(doc_id))
    # what is left of a group of copies are rows of one doc_id, of which one stays
    return shown.join(going, same, "left_anti").dropDuplicates([digest, "doc_id"]).drop(digest)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
