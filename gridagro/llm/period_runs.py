"""Periodic runs of words, found on a grammar of each text.

Re-Pair replaces a pair of neighbours that is more frequent in its text than the pairs that it
overlaps by a new symbol, again and again, until no pair of a text repeats; what is left is put
together two by two. A run, at least four times its period, lies across the boundary between the two
halves of the smallest symbol that holds all of it, and two periods of it lie on one side of that
boundary. So each symbol is looked at once, at its first place: squares that touch its boundary are
extended to the ends of the symbol. What is found holds at every place where the symbol is derived;
pieces of one run that come from smaller symbols are merged into the longest.

A batch of texts is worked on together, in arrays over its words. Words are numbered, not hashed;
hashes only propose squares, which are compared word by word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridagro.llm.common import WORD, read
from gridagro.llm.text import mixed, slices

#: A run has at least so many words and so many times its period.
SHORTEST, TIMES = 6, 4
#: Bytes of text that are worked on together; a longer text is worked on alone.
AT_ONCE = 1 << 22

RUN = "start:bigint,length:bigint,period:bigint"
RUNS = f"doc_id long, runs array<struct<{RUN}>>, collapsed string"


class Symbols(NamedTuple):
    """Symbols of a grammar: first place in the text, boundary between the halves, end."""

    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray


class Places(NamedTuple):
    """All places in the derivation: the symbol and where it starts."""

    symbol: np.ndarray
    start: np.ndarray


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key how often it occurs, and a number for it."""
    _, number, times = np.unique(key, return_inverse=True, return_counts=True)
    return times[number], number


def grammar(words: np.ndarray, bounds: np.ndarray) -> tuple[Symbols, Places]:
    """Re-Pair of the texts ``words[bounds[i]:bounds[i + 1]]``, and pairwise symbols over what it leaves.

    In a round all pairs go that are more frequent than both pairs they overlap (of equally frequent
    ones the higher number; within a row of one symbol every second). Texts without a repeated pair
    drop out. Every replacement is a place of its symbol in the derivation, also inside others.
    """
    n = len(words)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, symbol = np.arange(n), words
    size = np.ones(n, np.int64)
    fresh = int(words.max(initial=0)) + 1
    symbols, places, left = [], [], []
    made = 0
    while len(at):
        beside = text[1:] == text[:-1]
        # numbers of (symbol, symbol) first, so that the key of (text, pair) fits 64 bits
        pair = symbol[:-1].astype(np.int64) * fresh + symbol[1:]
        _, pair = _ranked(pair)
        times, key = _ranked(text[:-1] * (len(at) + 1) + pair)
        times = np.where(beside, times, 0)
        going = np.zeros(len(text), bool)
        live = np.unique(text[:-1][times > 1])
        going[np.isin(text, live)] = True
        left.append((at[~going], size[~going]))
        if not len(live):
            break
        weight = np.where(beside & (times > 1), times * (len(at) + 1) + key, -1)
        before, after = np.append(-1, weight[:-1]), np.append(weight[1:], -1)
        chosen = (weight >= 0) & (weight >= before) & (weight >= after)
        # a row of equal pairs, as in a a a a: every second one counts
        fresh_row = chosen & ~(np.append(False, chosen[:-1]) & (weight == before))
        row_start = np.maximum.accumulate(np.where(fresh_row, np.arange(len(chosen)), 0))
        chosen &= (np.arange(len(chosen)) - row_start) % 2 == 0
        i = np.flatnonzero(chosen)
        _, first, number = np.unique(key[i], return_index=True, return_inverse=True)
        at_first = i[first]
        symbols.append((at[at_first], at[at_first] + size[at_first], at[at_first + 1] + size[at_first + 1]))
        places.append((made + number, at[i]))
        made += len(first)
        # a pair that comes back in a later round gets another symbol; its runs are found again and merged
        symbol = symbol.copy()
        size = size.copy()
        symbol[i] = fresh + number
        fresh += len(first)
        size[i] += size[i + 1]
        keep = going
        keep[i + 1] = False
        at, symbol, size, text = at[keep], symbol[keep], size[keep], text[keep]
    at = np.concatenate([a for a, _ in left] or [at])
    size = np.concatenate([s for _, s in left] or [size])
    order = np.argsort(at)
    at, size = at[order], size[order]
    text = np.searchsorted(bounds, at, "right")
    while len(at) > 1:  # pairs of what is left, pairs of those, ...; each symbol has one place
        place = np.arange(len(at)) - np.searchsorted(text, text)
        i = np.flatnonzero((place[:-1] % 2 == 0) & (text[1:] == text[:-1]))
        if not len(i):
            break
        symbols.append((at[i], at[i + 1], at[i + 1] + size[i + 1]))
        places.append((made + np.arange(len(i)), at[i]))
        made += len(i)
        size[i] += size[i + 1]
        keep = np.ones(len(at), bool)
        keep[i + 1] = False
        at, size, text = at[keep], size[keep], text[keep]
    none = np.zeros(0, np.int64)
    return (
        Symbols(*(np.concatenate([none, *x]) for x in zip(*symbols, strict=True))) if symbols else Symbols(none, none, none),
        Places(*(np.concatenate([none, *x]) for x in zip(*places, strict=True))) if places else Places(none, none),
    )


class _Squares:
    """Squares of words at given places: proposed by hashes of prefixes, then compared."""

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words)
        self.power = np.multiply.accumulate(np.append(np.ones(1, np.uint64), np.full(n, 0x9E3779B97F4A7C15, np.uint64)))
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(words.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.total[1:])
        # places of each word in order, and the rank of each place among those of its word
        self.order = np.argsort(words, kind="stable")
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)

    def alike(self, a: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether words a to a + q probably equal those from a + q to a + 2 q."""
        t = self.total
        return (t[a + q] - t[a]) * self.power[q] == t[a + 2 * q] - t[a + q]

    def __call__(self, anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which anchor, other place) of all places from ``first`` to ``last`` with the anchor's word."""
        words, order = self.words, self.order
        # the places of a word are ascending in ``order``: the range is found by bisection on (word, place)
        key = words[order].astype(np.int64) * (len(words) + 1) + order
        base = words[anchor].astype(np.int64) * (len(words) + 1)
        low, high = np.searchsorted(key, base + first), np.searchsorted(key, base + last, "right")
        times = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(anchor)), times)
        return which, order[np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]


def _reach(words: np.ndarray, at: int, q: int, stop: int, step: int) -> int:
    """From ``at`` on in steps of +1 or -1 up to ``stop``: how many words equal the word q places on."""
    have, block = 0, 64
    most = (stop - at) * step
    while have < most:
        take = min(block, most - have)
        a = at + step * have
        one = words[a : a + take] if step > 0 else words[a - take + 1 : a + 1][::-1]
        two = words[a + q : a + q + take] if step > 0 else words[a + q - take + 1 : a + q + 1][::-1]
        differ = np.flatnonzero(one != two)
        if len(differ):
            return have + int(differ[0])
        have, block = have + take, block * 2
    return most


def crossing(words: np.ndarray, symbols: Symbols) -> list[tuple[int, int, int, int]]:
    """(symbol, start, end, period) of the runs across each symbol's boundary, inside the symbol, at its first place."""
    squares = _Squares(words)
    s, m, e = symbols
    which, there = squares(m, m + 1, m + (e - m) // 2)  # two periods after the boundary
    q = there - m[which]
    good = squares.alike(m[which], q)
    after = (which[good], q[good])
    which, there = squares(m - 1, m - 1 - (m - s) // 2, m - 2)  # two periods before it
    q = m[which] - 1 - there
    good = squares.alike(m[which] - 2 * q, q)
    before = (which[good], q[good])
    found = []
    for side, (which, q) in ((1, after), (-1, before)):
        order = np.lexsort((q, which))
        last, known = -1, []
        for k, period in zip(which[order].tolist(), q[order].tolist(), strict=True):
            if k != last:
                last, known = k, []
            start, middle, end = int(s[k]), int(m[k]), int(e[k])
            a, b = (middle, middle + 2 * period) if side > 0 else (middle - 2 * period, middle)
            if any(period % p == 0 and x <= a and b <= y for x, y, p in known):
                continue  # a multiple of a period found before
            if not np.array_equal(words[a : a + period], words[a + period : b]):
                continue
            x = a - _reach(words, a - 1, period, start - 1, -1)
            y = b + _reach(words, b - period, period, end - period, 1)
            known.append((x, y, period))
            if y - x >= max(SHORTEST, TIMES * period):
                found.append((k, x, y, period))
    return found


def runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of the texts, by start and then period; starts count over all texts."""
    none = np.zeros(0, np.int64)
    symbols, places = grammar(words, bounds)
    found = crossing(words, symbols)
    if not found:
        return none, none, none
    symbol, start, end, period = (np.array(x) for x in zip(*found, strict=True))
    # the runs of a symbol at all its places
    order = np.argsort(places.symbol, kind="stable")
    by = places.symbol[order]
    low, times = np.searchsorted(by, symbol), np.searchsorted(by, symbol, "right") - np.searchsorted(by, symbol)
    shift = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
    moved = places.start[order][shift] - np.repeat(symbols.start[symbol], times)
    start, end, period = np.repeat(start, times) + moved, np.repeat(end, times) + moved, np.repeat(period, times)
    # pieces of one run share at least a period's words, different runs of one period share fewer, and texts share none
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    reach = np.maximum.accumulate(period * (len(words) + 1) + end) - period * (len(words) + 1)  # rises with the period, so it begins anew at each
    begins = np.append(True, (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1]))
    first = np.flatnonzero(begins)
    start, period, end = start[first], period[first], np.maximum.reduceat(end, first)
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words is outside all runs but for their first periods."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, its runs (start, length, period) by start and period, and the collapsed text.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch of at least
    max(6, 4 q) words with smallest period q that neither neighbour extends. The collapsed text is the
    words, joined by one space, without those that a run contains after its first period. Texts are
    read whole, however long; a null or empty text has no words, no run and an empty collapsed text.
    Only doc_id and text are read; rows that repeat are reported each; an empty table gives no rows.
    A task holds one batch of texts, or one long text, with some hundred bytes for each of its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, AT_ONCE):
                texts = [text.encode().split() if text else [] for text in part.column(1).to_pylist()]
                bounds = np.cumsum([0, *map(len, texts)])
                number: defaultdict[bytes, int] = defaultdict(count().__next__)
                words = np.fromiter((number[w] for text in texts for w in text), np.int64, bounds[-1])
                start, length, period = runs(words, bounds)
                owner = np.searchsorted(bounds, start, "right") - 1
                found: dict[int, list] = defaultdict(list)
                for i, *one in zip(owner.tolist(), (start - bounds[owner]).tolist(), length.tolist(), period.tolist(), strict=True):
                    found[i].append(tuple(one))
                collapsed = [b" ".join(w for w, keep in zip(text, _kept(len(text), found[i]).tolist(), strict=True) if keep) if i in found else b" ".join(text) for i, text in enumerate(texts)]
                rows = [[dict(zip(("start", "length", "period"), one, strict=True)) for one in found.get(i, [])] for i in range(len(texts))]
                kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
                yield pa.record_batch([part.column(0), pa.array(rows, kind), pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, RUNS)


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the end of every tenth document, by a hash of its doc_id, repeats a stretch of its words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))

    def ended(word: Column, i: Column) -> Column:
        return F.when(i < F.col("a"), word).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))

    marked = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    marked = marked.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    return marked.select("doc_id", F.when(n > 0, F.array_join(F.transform("words", ended), " ")).otherwise(F.col("text")).alias("text"))


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_ends(read(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]), F.lit("\n")))
    # the longest; of equals the first, as runs are in order
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
