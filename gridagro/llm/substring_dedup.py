"""Repeated passages by level-wise doubling.

Only windows that repeat at one length are extended to twice that length. The first level has windows
of half the length that is asked for, and nothing but their hashes and places is sent. Of the half
windows inside each full window the one with the smallest hash stands for it, the same one in every
copy of the window, so about two of nine places are sent instead of all. The places that repeat go
back to their texts, where alone the full windows around them are hashed, and these are compared in
the second level. ``longer_repeats`` goes on from there, to twice, four times and so on, until no
candidate survives; which words are covered by repeated windows does not change beyond the second
level, so ``without_repeats`` ends with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridagro.llm.common import HOT_KEYS, read, stored
from gridagro.llm.text import Words, slices, sliding_least, windows

#: Words of a window.
LENGTH = 13
#: One document in so many is looked at to learn which halves are hot; that decides where rows go, not what is found.
LOOK = 64

#: Bytes of text in a batch of results.
BATCH = 4 << 20

_LAST = (1 << 63) - 1
#: Bits of a number of consecutive windows with one half, beside their first word in a long; there are fewer than ``length`` of them.
_NUMBER = 16
#: Bits of a window's hash that go beside its first word, to be compared with those of the text that the place has come to.
_CHECK = 32
HALVES = "half long, doc long, place long, n int"
FULL = "name long, doc long, place long"


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, tag, text): the doc_id, a null one after all others, and 20 bits of the text.

    Texts of one doc_id may agree in the tag. They then get one another's places as well, so whatever
    is done at a place asks first whether this text has the window there.
    """
    doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(_LAST))
    return docs.select(doc.alias("doc"), F.shiftrightunsigned(F.xxhash64(docs["text"]), 44).alias("tag"), docs["text"])


@dataclass
class Windows:
    """The full windows of some texts: first word, half that stands for it, hash of all its words."""

    starts: np.ndarray
    middle: np.ndarray
    half: np.ndarray
    full: np.ndarray
    text: np.ndarray
    #: The first word counted from the start of the text.
    at: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, length: int) -> Windows:
        words = Words(texts)
        halves, _ = windows(words, length // 2)
        full, whole = windows(words, length)
        starts = np.flatnonzero(whole)
        middle = sliding_least(halves, length - length // 2 + 1)[starts]
        text = words.texts()[starts]
        return cls(starts, middle, halves[middle], full[starts], text, starts - words.bounds[text])

    def some(self, mask: np.ndarray) -> Windows:
        return Windows(*[x[mask] for x in (self.starts, self.middle, self.half, self.full, self.text, self.at)])


@dataclass
class Hot:
    """Halves that a noticeable part of all documents has, and of their windows the commonest with the first document of each."""

    halves: np.ndarray
    windows: np.ndarray
    first: np.ndarray


_COLD = Hot(*[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64))


def _halves(rows: DataFrame, length: int, hot: Hot = _COLD) -> DataFrame:
    """A row per half that stands for consecutive full windows: its hash, document, the first window, and their number.

    A window of a hot half is a row of its own under its full hash; the commonest of them are left out.
    """
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in (part for whole in batches for part in slices(whole, 2)):
            w = Windows.of(batch.column(2), length)
            alone = np.isin(w.half, hot.halves)
            if alone.any():
                stays = ~(alone & np.isin(w.full, hot.windows))
                w, alone = w.some(stays), alone[stays]
            new = np.ones(len(w.starts), bool)
            new[1:] = (w.middle[1:] != w.middle[:-1]) | (w.starts[1:] != w.starts[:-1] + 1) | alone[1:]
            first = np.flatnonzero(new)
            keys = np.where(alone[first], w.full[first], w.half[first]).view(np.int64)
            places = (np.asarray(batch.column(1))[w.text[first]] << 40) | w.at[first]
            times = np.diff(np.append(first, len(new))).astype(np.int32)
            yield pa.record_batch([pa.array(keys), pa.array(np.asarray(batch.column(0))[w.text[first]]), pa.array(places), pa.array(times)], ["half", "doc", "place", "n"])

    return rows.mapInArrow(cut, HALVES)


def _hot(rows: DataFrame, length: int, least: int = 8) -> Hot:
    """Hot halves are those with at least a 1/HOT_KEYS share of the rows of some documents, at most HOT_KEYS.

    Their windows are then counted over all documents, and the HOT_KEYS commonest are kept.
    """
    some = stored(_halves(rows.filter(F.pmod(F.xxhash64("doc"), F.lit(LOOK)) == 0), length).groupBy("half").count().filter(F.col("count") > least), "hot")
    total = some.agg(F.sum("count")).first()[0] or 0
    found = some.filter(F.col("count") * HOT_KEYS >= total).orderBy(F.desc("count"), "half").limit(HOT_KEYS).collect()
    if not found:
        return _COLD
    halves = np.array([r["half"] for r in found], np.int64).view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(halves)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            w = Windows.of(batch.column(2), length)
            w = w.some(np.isin(w.half, shared.value))
            doc = np.asarray(batch.column(0))[w.text]
            order = np.lexsort((doc, w.full))
            names, first = np.unique(w.full[order], return_index=True)
            last = np.append(first[1:], len(order))
            doc = doc[order]
            yield pa.record_batch([pa.array(names.view(np.int64)), pa.array(doc[first]), pa.array(doc[last - 1] if len(last) and len(doc) else doc), pa.array(last - first if len(names) else first)], ["name", "low", "high", "n"])

    counted = rows.mapInArrow(count, "name long, low long, high long, n long").groupBy("name").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    top = counted.filter("low < high").orderBy(F.desc("n"), "name").limit(HOT_KEYS).collect()
    top = sorted((int(np.int64(r["name"]).view(np.uint64)), r["low"]) for r in top)
    return Hot(halves, np.array([t[0] for t in top], np.uint64), np.array([t[1] for t in top], np.int64))


def _row(place: Column) -> tuple[Column, Column]:
    """The tag and the first word of a place."""
    return F.shiftrightunsigned(place, 40), place.bitwiseAND((1 << 40) - 1)


def _cold_windows(rows: DataFrame, packed: DataFrame, length: int, hot: Hot) -> DataFrame:
    """(name, doc, place, first) of the windows in several documents, but for the commonest ones; the name is the window's hash."""
    together = Window.partitionBy("half")
    shared = _halves(rows, length, hot).withColumn("low", F.min("doc").over(together)).withColumn("high", F.max("doc").over(together)).filter("low < high")
    tag, start = _row(F.col("place"))
    wanted = shared.groupBy("doc", tag.alias("tag")).agg(F.collect_list(F.shiftleft(start, _NUMBER).bitwiseOR(F.col("n").cast("long"))).alias("candidates"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, docs, places = [], [], []
            for doc, tag, text, candidates in zip(*[batch.column(i) for i in range(4)], strict=True):
                if not candidates.is_valid:
                    continue
                w = Windows.of(pa.array([zstandard.decompress(text.as_py()).decode()]), length)
                both = np.asarray(candidates.values)
                start, n = both >> _NUMBER, both & ((1 << _NUMBER) - 1)
                at = np.unique(np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum()))
                at = at[at < len(w.full)]
                names.append(w.full[at].view(np.int64))
                docs.append(np.full(len(at), doc.as_py()))
                places.append(tag.as_py() << 40 | at)
            if names:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (names, docs, places)], ["name", "doc", "place"])

    # a left join, as that of the results, so that both have the same exchange of the texts and Spark makes it once
    full = packed.join(wanted, ["doc", "tag"], "left").select("doc", "tag", "packed", "candidates").mapInArrow(extend, FULL)
    together = Window.partitionBy("name")
    found = full.withColumn("first", F.min("doc").over(together)).withColumn("last", F.max("doc").over(together)).filter("first < last")
    return found.select("name", "doc", "place", "first")


def _hot_windows(rows: DataFrame, length: int, hot: Hot) -> DataFrame:
    """(doc, tag, windows) of the documents with any of the commonest windows; their name, first word and first document."""
    shared = rows.sparkSession.sparkContext.broadcast(hot)
    kind = pa.list_(pa.struct([("name", pa.int64()), ("start", pa.int32()), ("first", pa.int64())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in (part for whole in batches for part in slices(whole, 2)):
            w = Windows.of(batch.column(2), length)
            w = w.some(np.isin(w.half, hot.halves) & np.isin(w.full, hot.windows))
            first = hot.first[np.searchsorted(hot.windows, w.full)]
            texts, edges = np.unique(w.text, return_index=True)
            values = pa.StructArray.from_arrays([pa.array(w.full.view(np.int64)), pa.array(w.at.astype(np.int32)), pa.array(first)], fields=list(kind.value_type))
            lists = pa.ListArray.from_arrays(pa.array(np.append(edges, len(w.text)), pa.int32()), values, type=kind)
            yield pa.record_batch([batch.column(0).take(pa.array(texts)), batch.column(1).take(pa.array(texts)), lists], ["doc", "tag", "windows"])

    return rows.mapInArrow(mark, "doc long, tag long, windows array<struct<name:long,start:int,first:long>>")


def _packed(rows: DataFrame) -> DataFrame:
    """(doc, tag, packed): each text compressed by itself, a third smaller than texts in a compressed shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in slices(whole, 2)):
            texts = [packer.compress((text.as_py() or "").encode()) for text in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["doc", "tag", "packed"])

    return rows.mapInArrow(pack, "doc long, tag long, packed binary")


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(name, doc, place, first) of every window of ``length`` words that occurs in several documents.

    ``name`` stands for its words, ``first`` is the smallest doc_id with them. ``place`` is the first
    word, plus the document's tag times 2**40.
    """
    rows = _documents(docs)
    hot = _hot(rows, length)
    found = _cold_windows(rows, _packed(rows), length, hot)
    if len(hot.windows):
        marked = _hot_windows(rows, length, hot).select("doc", "tag", F.explode("windows").alias("w"))
        place = F.shiftleft("tag", 40).bitwiseOR(F.col("w.start").cast("long"))
        found = found.unionByName(marked.select(F.col("w.name").alias("name"), "doc", place.alias("place"), F.col("w.first").alias("first")))
    return found


def longer_repeats(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, place, words) of the longest windows of ``length`` times a power of two that occur in several documents.

    ``found`` is the result of ``repeated_windows``. A window of twice the length is a candidate if
    both its halves repeat; the loop ends when no candidate does.
    """
    level = stored(found.select("doc", "place", "name"), "level")
    out = level.select("doc", "place", F.lit(length).alias("words"))
    while not level.isEmpty():
        later = level.select("doc", (F.col("place") - length).alias("place"), F.col("name").alias("then"))
        pairs = level.join(later, ["doc", "place"]).select("doc", "place", F.xxhash64("name", "then").alias("name"))
        names = pairs.groupBy("name").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("name")
        level = stored(pairs.join(names, "name").select("doc", "place", "name"), "level")
        length *= 2
        out = out.unionByName(level.select("doc", "place", F.lit(length).alias("words")))
    return out.groupBy("doc", "place").agg(F.max("words").alias("words"))


def _going(start: Column, name: Column) -> Column:
    """The first word of a window and the last bits of its hash, in one long."""
    return F.shiftleft(start, _CHECK).bitwiseOR(name.bitwiseAND((1 << _CHECK) - 1))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept, the words that stay, joined by one space.

    Words are runs without ASCII white space. A word goes if a window of ``length`` words covers it
    that also starts in a document with a smaller doc_id; windows are judged on the input. A null
    doc_id comes after all others. Null and empty texts have no words; texts shorter than a window keep
    all; rows that share a doc_id do not take words from one another, however many they are. Texts are
    worked on whole; only doc_id and text are read; an empty table gives no rows.
    """
    rows = _documents(docs)
    packed = _packed(rows)
    hot = _hot(rows, length)
    later = _cold_windows(rows, packed, length, hot).filter("doc > first")
    tag, start = _row(F.col("place"))
    going = later.select("doc", tag.alias("tag"), _going(start, F.col("name")).alias("going")).groupBy("doc", "tag").agg(F.collect_list("going").alias("going"))
    own = F.transform(F.filter("windows", lambda w: w["first"] < F.col("doc")), lambda w: _going(w["start"].cast("long"), w["name"]))
    common = _hot_windows(rows, length, hot).select("doc", "tag", own.alias("own")).groupBy("doc", "tag").agg(F.flatten(F.collect_list("own")).alias("common"))
    left = packed.join(going, ["doc", "tag"], "left").join(common, ["doc", "tag"], "left")
    left = left.select(F.nullif("doc", F.lit(_LAST)).alias("doc_id"), "packed", "going", "common")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept, room = [], [], [], BATCH
            for text, *lists in zip(*[batch.column(i) for i in (1, 2, 3)], strict=True):
                text = zstandard.decompress(text.as_py())
                words = text.split()
                sizes.append(len(words))
                both = np.concatenate([np.zeros(0, np.int64), *[np.asarray(going.values) for going in lists if going.is_valid]])
                if len(both):
                    full = Windows.of(pa.array([text.decode()]), length).full
                    both = both[both >> _CHECK < len(full)]
                    at = both >> _CHECK
                    at = at[full[at] & np.uint64((1 << _CHECK) - 1) == (both & ((1 << _CHECK) - 1)).view(np.uint64)]  # another text of this doc_id may have sent the place
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                    stay = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
                    removed.append(len(words) - len(stay))
                    words = [words[i] for i in stay]
                else:
                    removed.append(0)
                kept.append(b" ".join(words).decode())
                room -= len(kept[-1])
                if room < 0 or len(sizes) == len(batch):
                    ids = batch.column(0).slice(len(sizes) - len(kept), len(kept))
                    yield pa.record_batch([ids, *[pa.array(x[-len(kept) :], pa.int64()) for x in (sizes, removed)], pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
                    kept, room = [], BATCH

    return left.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT uid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT uid, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
r AS (SELECT uid, i FROM (SELECT uid, doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM s) WHERE doc_id > first),
g AS (SELECT DISTINCT uid, unnest(generate_series(i, i + 12)) AS j FROM r),
words AS (SELECT uid, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
kept AS (SELECT uid, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM words ANTI JOIN g USING (uid, j) GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (uid)
"""
