"""Near duplicates: MinHash with tensored banding, verified on full sets.

A table key of banded MinHash is made of several minhashes. Here keys are pairs: one band from each
of two small collections. With 12 bands in the first and 8 in the second there are 96 tables from 20
bands, so 52 minhashes do the work of 480. Two documents are candidates if they share any band of the
first and any of the second collection. With bands of three and of two minhashes a pair of similarity
0.8 is missed with a probability of 0.488**12 + 0.36**8 < 0.0005, one of 0.9 of 2e-6.

Equal sets are one node from the start. Candidates are verified against one node of their tables, a
few times another one; what the links found so far leave apart in a table is then verified pair by
pair, after a bound from bit maps that drops pairs which cannot be similar. So no link between
components of a table is lost, and a large group of near copies costs a few pairs for each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridagro.llm.common import join_groups, read, row_key, stored, unused
from gridagro.llm.components import components
from gridagro.llm.text import SPACED, Words, mixed, slices, windows

#: Bands of the two collections and minhashes per band.
FIRST, SECOND = (12, 3), (8, 2)
#: Rounds in which each node is compared with one other at most, before the rest is compared pair by pair.
TURNS = 4
#: Longs of the bit map of a set that is compared before the sets are.
MAP = 32
#: Words of a shingle and the least similarity in percent, of the general operator.
SHINGLE, PERCENT = 5, 80
#: Words that are hashed at a time.
CHUNK = 1 << 16

_HASHES = FIRST[0] * FIRST[1] + SECOND[0] * SECOND[1]
_RANDOM = np.random.default_rng(11).integers(0, 2**63, (2, _HASHES), dtype=np.uint64)
_FACTORS, _FLIPS = _RANDOM[0] * np.uint64(2) + np.uint64(1), _RANDOM[1] * np.uint64(2)
_SHORT = 0x5851F42D4C957F2D

SIGNATURES = "doc_id long, key long, n long, set_a long, set_b long, first array<long>, second array<long>"


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and the bounds of each.

    A text of fewer than n words has its whole sequence as the only shingle; one without words has none.
    """
    words = Words(texts, SPACED, lower=True)
    hashes, fits = windows(words, n)
    sizes = np.diff(words.bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    for size in np.unique(sizes[short]):
        whole, _ = windows(words, int(size))
        at = words.bounds[short[sizes[short] == size]]
        hashes[at], fits[at] = mixed(whole[at] ^ np.uint64(_SHORT * int(size) % 2**64)), True
    text = words.texts()[fits]
    hashes = hashes[fits]
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[new], hashes[new]
    return hashes, np.searchsorted(text, np.arange(words.size + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def bands(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bands of the first and the second collection; rows of empty sets mean nothing."""
    texts = len(bounds) - 1
    least = np.zeros((texts, _HASHES), np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    at = 0
    while at < len(full):
        to = max(at + 1, int(np.searchsorted(bounds[full], bounds[full[at]] + CHUNK)))
        some = full[at:to]
        values = hashes[bounds[some[0]] : bounds[some[-1] + 1]]
        starts = bounds[some] - bounds[some[0]]
        for k in range(_HASHES):
            least[some, k] = np.minimum.reduceat((values ^ _FLIPS[k]) * _FACTORS[k], starts)
        at = to
    out = []
    base = 0
    for count, rows in (FIRST, SECOND):
        band = least[:, base : base + count].copy()
        for r in range(1, rows):
            band = mixed(band * _FACTORS[0] + least[:, base + r * count : base + (r + 1) * count])
        out.append(mixed(band + np.arange(count, dtype=np.uint64)))
        base += count * rows
    return out[0], out[1]


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """Per document: size and 128-bit hash of its shingle set, and its bands. Written once."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            hashes, bounds = shingle_sets(batch.column(2), shingle)
            first, second = bands(hashes, bounds)
            lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), x.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1), pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(_sums(mixed(hashes), bounds).view(np.int64)), pa.array(_sums(mixed(hashes ^ np.uint64(_SHORT)), bounds).view(np.int64)),
                    lists(first), lists(second),
                ],
                [x.split(" ")[0] for x in SIGNATURES.split(", ")],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("key"), docs["text"])
    return stored(rows.mapInArrow(sign, SIGNATURES), "signatures")


def _sets_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, near, set, bits) for the rows (node, near) of ``wanted``: the full set of document ``node`` and its bit map."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            hashes, bounds = shingle_sets(batch.column(2), shingle)
            data = pa.py_buffer(hashes.tobytes())
            offsets = pa.py_buffer((bounds * 8).astype(np.int64).tobytes())
            sets = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, offsets, data]).cast(pa.binary())
            bits = np.zeros((len(batch), 64 * MAP), bool)
            bits[np.repeat(np.arange(len(batch)), np.diff(bounds)), (hashes % np.uint64(64 * MAP)).astype(np.int64)] = True
            bits = pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(bits, axis=1).view(np.int64).ravel()), MAP).cast(pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0), batch.column(1), sets, bits], ["node", "near", "set", "bits"])

    texts = docs.select(docs["doc_id"].cast("long").alias("node"), docs["text"])
    rows = texts.join(wanted, "node").select("node", "near", "text")
    return stored(rows.mapInArrow(cut, "node long, near long, set binary, bits array<long>"), "sets")


def _linked(pairs: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) among the pairs (a, b, set_a, set_b), by their full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            linked = pa.array(linked, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(linked), batch.column(1).filter(linked)], ["a", "b"])

    return stored(pairs.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long"), "linked")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, key (see ``row_key``), n_shingles and component_id.

    Documents are linked if their sets of distinct shingles, of A-Z in lower case, have a similarity
    of ``percent`` or more; component_id is the smallest doc_id that can be reached. A text without
    words has an empty set and is linked with nothing; so is a row without doc_id, whose component_id
    is null. Rows are judged by their own text even if they share a doc_id.
    """
    rows = signatures(docs, shingle)
    total = rows.count()
    linkable = rows.filter("n > 0 and doc_id is not null").withColumn("set", F.struct("set_a", "set_b"))
    nodes = linkable.groupBy("set").agg(F.min("doc_id").alias("node"), F.count("*").alias("size"), F.first("n").alias("n"), F.first("first").alias("first"), F.first("second").alias("second"))
    nodes = stored(nodes, "nodes")

    tables = nodes.select("node", F.posexplode("first").alias("i", "x"), "second").select("node", "i", "x", F.posexplode("second").alias("j", "y"))
    tables = tables.select("node", "i", "j", F.xxhash64("i", "x", "j", "y").alias("table"))
    shared = tables.groupBy("table").agg(F.min("node").alias("near"), F.max("node").alias("last")).filter("near < last").drop("last")
    members = stored(tables.join(shared, "table"), "members")

    # every candidate meets the smallest node of its tables
    chosen = members.groupBy("node").agg(F.min("near").alias("near"))
    sets = _sets_of(docs, chosen, shingle)
    centres = sets.select(F.col("node").alias("near"), F.col("set").alias("set_b"))
    pairs = sets.filter("node <> near").join(centres, "near").select(F.col("node").alias("a"), F.col("near").alias("b"), F.col("set").alias("set_a"), "set_b")
    labels = _merged(sets.select("node", F.col("node").alias("label")), _linked(pairs, percent))

    # then another node of its tables, as long as that finds links
    sized = sets.select("node", "bits").join(nodes.select("node", "n", _short("first"), _short("second")), "node")
    for turn in range(1, TURNS):
        links = _linked(_with_sets(_centred(_open(members, labels), sized, percent, turn), sets), percent)
        if links.isEmpty():
            break
        labels = _merged(labels, links)

    # and what is still apart in a table meets pair by pair
    more = _apart(_open(members, labels), sized, percent)
    labels = _merged(labels, _linked(_with_sets(more, sets), percent))

    reached = nodes.join(labels, "node", "left").select("set", "size", "node", F.coalesce("label", "node").alias("component"))
    groups = reached.filter("size > 1 or component <> node").select("set", "size", "component")
    keyed = rows.withColumn("set", F.when(F.col("n") > 0, F.struct("set_a", "set_b"))).select("doc_id", "key", "n", "set")
    joined = join_groups(keyed, groups, "set", "size", total)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "key", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _short(bands: str):
    """Bands as 32 bits, enough to see which of them two nodes share."""
    return F.transform(bands, lambda x: F.xxhash64(x).bitwiseAND(0x7FFFFFFF).cast("int")).alias(bands)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    full = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    return pairs.join(full, "a").join(full.select(F.col("a").alias("b"), F.col("set_a").alias("set_b")), "b")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after the components that ``links`` (a, b) join have become one."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
    joined = links.join(of("a"), "a").join(of("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    new = components(joined).select(F.col("node").alias("label"), F.col("label").alias("least"))
    return stored(labels.join(new, "label", "left").select("node", F.coalesce("least", "label").alias("label")), "labels")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(table, i, j, node, label) of the tables whose nodes are still in several components."""
    labelled = members.select("table", "i", "j", "node").join(labels, "node")
    split = labelled.groupBy("table").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("table")
    return stored(labelled.join(split, "table", "left_semi"), "open")


def _may_link(percent: int):
    """Whether the sets of a and b can be similar, by their sizes and bit maps.

    Each place of the bit maps that differs stands for a shingle that only one of the sets has.
    """
    differing = sum((F.bit_count(F.col("a.bits")[k].bitwiseXOR(F.col("b.bits")[k])) for k in range(1, MAP)), F.bit_count(F.col("a.bits")[0].bitwiseXOR(F.col("b.bits")[0])))
    sizes = 100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    return sizes & (differing * (100 + percent) <= (F.col("a.n") + F.col("b.n")) * (100 - percent))


def _centred(rows: DataFrame, sized: DataFrame, percent: int, turn: int) -> DataFrame:
    """One pair (a, b) for each node: of the nodes that are the first of a table in the order of ``turn`` and
    belong to another component, the one that it shares most tables with."""
    order = lambda x: F.xxhash64(x, F.lit(turn))
    first = rows.groupBy("table").agg(F.min(F.struct(order("node").alias("at"), F.col("node").alias("b"), F.col("label").alias("other"))).alias("c"))
    met = rows.join(first, "table").filter("label <> c.other").groupBy(F.col("node").alias("a"), F.col("c.at").alias("at"), F.col("c.b").alias("b")).count()
    pairs = met.groupBy("a").agg(F.max(F.struct("count", "at", "b")).alias("c")).select("a", F.col("c.b").alias("b"))
    a, b = sized.select("node", "n", "bits").alias("a"), sized.select("node", "n", "bits").alias("b")
    kept = pairs.join(a, pairs["a"] == F.col("a.node")).join(b, pairs["b"] == F.col("b.node")).filter(_may_link(percent))
    return kept.select(pairs["a"], pairs["b"])


def _apart(rows: DataFrame, sized: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share a table, are not in one component and may still be similar.

    A pair is only made in the first of its tables.
    """
    rows = stored(rows.join(sized, "node"), "apart")
    a, b = rows.alias("a"), rows.alias("b")
    same = lambda c: F.zip_with(F.col(f"a.{c}"), F.col(f"b.{c}"), lambda x, y: x == y)
    condition = (
        (F.col("a.table") == F.col("b.table"))
        & (F.col("a.node") > F.col("b.node"))
        & (F.col("a.label") != F.col("b.label"))
        & _may_link(percent)
        & (F.array_position(same("first"), True) == F.col("a.i") + 1)
        & (F.array_position(same("second"), True) == F.col("a.j") + 1)
    )
    return stored(a.join(b, condition).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")), "pairs")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id, with all columns.

    Rows without doc_id and documents without words stay, and so do all rows of the smallest doc_id.
    """
    (going,) = unused(docs, "going")
    rows = near_groups(docs, shingle, percent).filter("doc_id <> component_id").select(F.col("key").alias(going)).distinct()
    return docs.join(rows, row_key(docs) == F.col(going), "left_anti")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(read(spark, sf_dir, "documents"), shingle=2)
    return groups.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, least(len(w), 1)))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON a = doc_id
"""
