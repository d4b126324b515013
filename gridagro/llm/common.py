"""Shared pieces: tables of an input folder, row keys, and joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridagro.sources.sinks import stored

__all__ = ["HOT_KEYS", "WORD", "a_z", "join_groups", "read", "row_key", "stored", "unused"]

#: A key is hot from a 1/HOT_KEYS share of all rows on, so there are at most HOT_KEYS hot keys to broadcast.
HOT_KEYS = 1000

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def a_z(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have in any spelling."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        out.append(name)
        have.add(name.lower())
    return out


def row_key(docs: DataFrame, *more: str) -> Column:
    """One key per (doc_id, text) and ``more`` columns; rows that share it are interchangeable."""
    return F.xxhash64(docs["doc_id"], docs["text"], *[docs[c] for c in more])


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of rows with one row per key, where a key may hold any share of the rows.

    ``size`` is the column of ``groups`` with the number of rows of the key and ``total`` the number
    of all rows. Keys above total / HOT_KEYS rows, at most HOT_KEYS of them, are broadcast and their
    rows stay where they are; the rows of the others are shuffled, with a bounded share for each key.
    """
    least = total / HOT_KEYS
    hot = groups.filter(F.col(size) > least)
    cold = groups.filter(F.col(size) <= least)
    values = [c for c in groups.columns if c != key]
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    there = marked.filter("_hot").drop("_hot")
    rest = marked.filter("_hot is null").drop("_hot", *values).join(cold, key, "left")
    return there.unionByName(rest)
