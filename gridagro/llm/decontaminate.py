"""Benchmark decontamination by winnowing.

Of each window of consecutive words only the smallest k-gram hash is kept as fingerprint. A shared
window has the same smallest k-gram on both sides, so joining the fingerprints of documents and
benchmark finds every shared span of at least a window; hits are then extended to whole windows.

The benchmark goes to the tasks in blocks of a bounded number of words, each against all documents.
Usually there is one block; a larger benchmark means more passes, not a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridagro.llm.common import a_z, read, row_key
from gridagro.llm.text import ALPHANUMERIC, Words, slices, sliding_least, windows

#: Words of a window and of a fingerprint.
WINDOW, GRAM = 10, 5
#: Benchmark words of one pass; as hashes and positions about 40 bytes each in every task.
BLOCK_WORDS = 1_000_000

HITS = "doc_id long, key long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _words(texts: pa.Array) -> Words:
    return Words(texts, ALPHANUMERIC, lower=True)


def _fingerprints(words: Words, window: int, gram: int) -> np.ndarray:
    """First words of the k-grams that are the smallest of some window that lies in one text."""
    grams, _ = windows(words, gram)
    _, whole = windows(words, window)
    if not whole.any():
        return np.zeros(0, np.int64)
    picked = np.zeros(len(grams), bool)
    picked[sliding_least(grams, window - gram + 1)[whole]] = True
    return np.flatnonzero(picked)


@dataclass
class Block:
    """Windows of some benchmark items, and the fingerprints of the full ones."""

    window: int
    gram: int
    prints: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    #: For each window length: sorted hashes, and the items of each as a slice of ``items``.
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, names: list[str], texts: list[str], window: int, gram: int) -> Block:
        block = cls(window, gram, names=names)
        words = _words(pa.array(texts, pa.string()))
        sizes = np.diff(words.bounds)
        item = words.texts()
        for n in sorted({min(int(size), window) for size in sizes if size}):
            hashes, whole = windows(words, n)
            mine = whole & (sizes[item] >= window if n == window else sizes[item] == n)
            pairs = np.unique(np.stack([hashes[mine], item[mine].astype(np.uint64)]), axis=1)
            keys, first = np.unique(pairs[0], return_index=True)
            block.tables[n] = (keys, np.append(first, pairs.shape[1]), pairs[1].astype(np.int64))
        grams, _ = windows(words, gram)
        block.prints = np.unique(grams[_fingerprints(words, window, gram)])
        return block

    def matches(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, places): windows of n words that begin at ``starts`` and equal entry ``places`` of table n."""
        for n, (keys, _, _) in self.tables.items():
            hashes, whole = windows(words, n)
            if n == self.window:
                picked = _fingerprints(words, self.window, self.gram)
                picked = picked[_find(self.prints, windows(words, self.gram)[0][picked]) >= 0]
                # extend each hit to all windows that hold its k-gram
                reach = picked[:, None] - np.arange(self.window - self.gram + 1)[None, :]
                starts = np.unique(reach[reach >= 0])
            else:
                starts = np.arange(len(hashes))
            starts = starts[whole[starts]]
            places = _find(keys, hashes[starts])
            yield n, starts[places >= 0], places[places >= 0]

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], list[str]]]]:
        """Words per text, and for each text with a hit its spans of hit words and its items."""
        words = _words(texts)
        text = words.texts()
        covered = np.zeros(len(text) + 1, np.int64)
        items: dict[int, set[int]] = {}
        for n, starts, places in self.matches(words):
            np.add.at(covered, starts, 1)
            np.add.at(covered, starts + n, -1)
            _, first, members = self.tables[n]
            for t, place in np.unique(np.stack([text[starts], places]), axis=1).T if len(starts) else ():
                items.setdefault(int(t), set()).update(members[first[place] : first[place + 1]].tolist())
        hit = np.cumsum(covered[:-1]) > 0
        found = {}
        for t, which in items.items():
            a, b = words.bounds[t], words.bounds[t + 1]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit[a:b], [False]]).astype(np.int8)))
            found[t] = (list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), sorted({self.names[i] for i in which}))
        return np.diff(words.bounds), found


def _find(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted keys, -1 if it is not there."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def blocks_of(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_words`` words, one at a time. A null item_id counts as the empty name."""
    n_words = F.regexp_count(a_z(F.col("text")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text")).filter(n_words > 0).distinct()  # copies are one item
    total = items.agg(F.sum(n_words)).first()[0] or 0
    count = max(1, -(-total // block_words))
    for k in range(count):
        rows = items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == k).collect()
        if rows:
            yield Block.of([r["name"] for r in rows], [r["text"] for r in rows], window, gram)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, spans of hit words (first, after last) and items.

    Words are runs of a-z, 0-9 and everything beyond ASCII, after lower-casing A-Z. An item of fewer
    than ``window`` words, but not none, is one window. Null and empty texts have no words, no spans
    and no items, on either side. Repeated document rows are judged each; items that share an item_id
    count as one. An empty benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("key"), docs["text"])
    parts: list[DataFrame] = []
    blocks = blocks_of(benchmark, window, gram, block_words)
    for block in chain([next(blocks, Block(window, gram))], blocks):
        shared = spark.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], first: bool = not parts, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in slices(whole, 2)):
                sizes, found = shared.value.hits(batch.column(2))
                spans = [[{"start": a, "end": b} for a, b in found[t][0]] if t in found else [] for t in range(len(batch))]
                items = [found[t][1] if t in found else [] for t in range(len(batch))]
                out = pa.record_batch(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "key", "n_words", "spans", "items"],
                )
                # the first pass lists every document, the others only those that they hit
                yield out if first else out.take(pa.array(sorted(found), pa.int64()))

        parts.append(rows.mapInArrow(find, HITS))
    out = parts[0]
    if len(parts) > 1:
        more = parts[1]
        for part in parts[2:]:
            more = more.unionByName(part)
        more = more.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_set("items")).alias("more_items"))
        out = out.join(more, "key", "left").select(
            "doc_id", "n_words",
            F.concat("spans", F.coalesce("more_spans", F.expr("array()"))).alias("spans"),
            F.array_distinct(F.concat("items", F.coalesce("more_items", F.expr("array()")))).alias("items"),
        )
    return out.select("doc_id", "n_words", F.array_sort("spans").alias("spans"), F.array_sort("items").alias("items"))


def covered_words(spans: Column) -> Column:
    """Words in sorted spans; overlaps count once."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    more = lambda s, x: F.greatest(x["end"] - F.greatest(x["start"], s["upto"]), F.lit(0))
    return F.aggregate(spans, zero, lambda s, x: F.struct(F.greatest(s["upto"], x["end"]).alias("upto"), (s["n"] + more(s, x)).alias("n")))["n"]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any hit, with all their columns. Nothing is shuffled."""
    out = docs
    at = docs.columns.index("text")
    for block in blocks_of(benchmark, window, gram, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in slices(whole, at)):
                _, found = shared.value.hits(batch.column(at))
                yield batch.filter(pa.array([t not in found for t in range(len(batch))], pa.bool_()))

        out = out.mapInArrow(keep, docs.schema)
    return out


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    hit = covered_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
bk AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bw),
ns AS (SELECT DISTINCT n FROM bk),
dw AS (SELECT uid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, ns WHERE len(w) >= n),
hits AS (SELECT uid, i, dw.n, item_id FROM dw JOIN bk ON bk.n = dw.n AND bk.k = array_to_string(w[i:i + dw.n - 1], ' ')),
words AS (SELECT uid, count(DISTINCT j) AS n_hit FROM (SELECT uid, unnest(generate_series(i, i + n - 1)) AS j FROM hits) GROUP BY uid),
items AS (SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT uid, item_id::VARCHAR AS item FROM hits) GROUP BY uid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (uid) LEFT JOIN items USING (uid)
"""
