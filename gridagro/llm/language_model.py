"""Scoring documents with a word model: smoothed counts, and a gated recurrent network over classes.

All training words are counted. The network predicts the class of the next word, then the word inside
its class. Classes are slices of the most frequent words of about equal weight, one class holds all
other words. A class of several words is a tree of nodes of at most 8 members, each with weights of
its own, and every frequent word has an input row that is added to that of its class. The number of
frequent words grows with the square root of the training words. In the class of other words a word
has its share of the counts, so the network needs those only as a sum per document, which a join delivers.

Each task trains a copy of the network on its documents, all from the same start, and the copies are
averaged; rows of words and nodes by the words that each copy learned them from, so that a task sends
only the rows that it met. Documents are read in windows; the state is carried from window to window through the whole
text, and gradients go back to the start of a window (truncated backpropagation).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridagro.llm.common import read, stored
from gridagro.llm.text import Words, slices

#: Frequent words at least, and for each square root of the training words; classes of about equal weight they are put in.
FREQUENT, GROWTH, CLASSES = 32_768, 8, 64
#: Size of the state, members of a node, words of a window.
STATE, SMALL, SPAN = 24, 8, 32
#: Documents trained side by side, the step size, and that of rows of words and nodes.
SIDE, RATE, ROW_RATE = 256, 0.01, 0.05
#: Words of a node or row that are added up one by one; sums of more are products.
MANY = 6
#: Words of a node that are multiplied by its weights at once.
PACK = 16
#: Rows of words and of nodes that are averaged together.
BLOCKS = {0: 128, 4: 32}

_END = np.uint64(0x2545F4914F6CDD1D)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: the CRC-32 of the doc_id as text leaves 1 when divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _documents(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, out, text); the tag, a hash of 64 bits, tells apart texts of one doc_id."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("tag"), held_out(docs["doc_id"]).alias("out"), docs["text"])


def count_words(rows: DataFrame) -> DataFrame:
    """(word, n): hashes of the words of all training documents and how often they occur, the end of a text included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 3, 16 << 20)):
            batch = batch.filter(pa.array(~np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)))
            if len(batch):
                words, n = np.unique(Words(batch.column(3), lower=True).hashes, return_counts=True)
                words, n = np.append(words, _END), np.append(n, len(batch))
                yield pa.record_batch([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return stored(rows.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


@dataclass
class Vocabulary:
    """Frequent words, sorted by hash, and what is known of each; ids are places in that order."""

    words: np.ndarray
    counts: np.ndarray
    tokens: int
    kinds: int

    def __post_init__(self) -> None:
        weight = self.counts + 0.5
        order = np.lexsort((self.words, -self.counts))
        before = np.concatenate([[0.0], np.cumsum(weight[order])[:-1]])
        slot = np.unique((before / weight.sum() * CLASSES).astype(int), return_inverse=True)[1]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = slot
        self.groups = int(slot.max()) + 2  # and the class of all other words
        sizes = np.bincount(slot, minlength=self.groups)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # an input row of its own for each word, after them those of the classes
        self.inputs = len(order) + self.groups
        self.above = np.concatenate([len(order) + self.group, np.arange(len(order), self.inputs)])
        totals = np.bincount(self.group, weight, self.groups)
        # the nodes on the way to each word and its places in them, -1 below its last node
        inside = rank - np.concatenate([[0], np.cumsum(sizes)])[self.group]
        depth = np.zeros(self.groups, np.int64)
        while (deeper := SMALL**depth < sizes).any():
            depth += deeper
        self.small = np.full(self.groups, -1)
        self.nodes, self.places, starts, made = [], [], [], 0
        for level in range(int(depth.max())):
            on = np.flatnonzero(depth[self.group] > level)
            below = SMALL ** (depth[self.group[on]] - level - 1)
            names, which = np.unique(self.group[on] << 40 | inside[on] // below // SMALL, return_inverse=True)
            node, place = np.full(len(order), -1), np.full(len(order), -1)
            node[on], place[on] = made + which, inside[on] // below % SMALL
            share = np.bincount(which * SMALL + place[on], weight[on], len(names) * SMALL).reshape(-1, SMALL)
            with np.errstate(divide="ignore"):
                starts.append(np.maximum(np.log(share / share.sum(axis=1, keepdims=True)), -1e9))
            if level == 0:
                self.small[names >> 40] = np.arange(len(names))
            self.nodes.append(node)
            self.places.append(place)
            made += len(names)
        self.start = np.concatenate([np.zeros((0, SMALL)), *starts]).astype(np.float32)
        # for each level the place in the table of nodes, -1 below the last node and for words that are not frequent
        self.way = np.full((len(self.nodes), len(order) + 1), -1, np.int32)
        self.step = np.full(self.way.shape, -1, np.int32)
        for level, (node, place) in enumerate(zip(self.nodes, self.places, strict=True)):
            self.way[level, :-1], self.step[level, :-1] = node, place
        # words are found by their first bits: where those with the same bits begin, and the most that share them
        self.shift = np.uint64(64 - max(1, (2 * len(order)).bit_length()))
        self.begin = np.searchsorted(self.words >> self.shift, np.arange((1 << 64 - int(self.shift)) + 1, dtype=np.uint64)).astype(np.int32)
        self.alike = int(np.diff(self.begin).max())
        rest = max(0.0, self.tokens - self.counts.sum())
        self.rest = rest + 0.5 * (max(0, self.kinds - (self.counts > 0).sum()) + 1)
        self.prior = np.log(np.append(totals[:-1], self.rest) / (totals.sum() + self.rest)).astype(np.float32)

    def ways(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each level: which of the words have a node there, the nodes, and the places in them."""
        for nodes, places in zip(self.nodes, self.places, strict=True):
            node = np.where(ids >= 0, nodes[ids], -1)
            some = np.flatnonzero(node >= 0)
            if len(some):
                yield some, node[some], places[ids[some]]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of words, -1 for words that are not frequent."""
        if self.alike > 8:  # not spread by a hash
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            return np.where(self.words[at] == hashes, at, -1)
        bits = (hashes >> self.shift).astype(np.int64)
        at, end = self.begin.take(bits), self.begin.take(bits + 1)
        out = np.full(len(hashes), -1, np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            found = self.words.take(here) == hashes[left]
            out[left[found]] = here[found]
            left = left[~found]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def vocabulary(counts: DataFrame, frequent: int | None = None) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count("*")).first()
    if frequent is None:
        frequent = max(FREQUENT, GROWTH * isqrt(total[0] or 0))
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    words = top.column("word").to_numpy().view(np.uint64)
    n = top.column("n").to_numpy()
    if _END not in words:
        words, n = np.append(words, _END), np.append(n, 0)
    order = np.argsort(words)
    return Vocabulary(words[order], n[order], int(total[0] or 0), int(total[1]))


class Network:
    """A gated recurrent unit whose inputs are rows of a table, and two softmax layers."""

    NAMES = ("inputs", "inner", "classes", "prior", "words", "shares")

    def __init__(self, vocabulary: Vocabulary, parameters: list[np.ndarray] | None = None):
        self.v = vocabulary
        random = np.random.default_rng(3)
        small = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
        self.p = parameters or [
            np.concatenate([np.zeros((len(vocabulary.words), 3 * STATE), np.float32), small(vocabulary.groups, 3 * STATE)]), small(STATE, 3 * STATE) * 2,
            small(STATE, vocabulary.groups) * 0.1, vocabulary.prior.copy(), small(len(vocabulary.start), SMALL, STATE) * 0.1, vocabulary.start.copy(),
        ]
        #: Whether the row of a word has that of its class added already, as for scoring.
        self.summed = False
        #: Words that each row of words or nodes was learned from.
        self.seen = {k: np.zeros(len(self.p[k]), np.int64) for k in BLOCKS}

    def with_sums(self) -> list[np.ndarray]:
        """The parameters for scoring, in which the row of a word has that of its class added."""
        return [self.p[0] + self.p[0][self.v.above], *self.p[1:]]

    def run(self, h: np.ndarray, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each of the inputs x (steps, texts), from the states h; ``keep`` gets what backpropagation needs.

        Inside, texts are the last axis: the planes of the gates are then in one piece and are worked on in place.
        """
        table, inner, h = self.p[0], self.p[1].T, np.ascontiguousarray(h.T)
        kind, steps = self.p[1].dtype, len(x)
        out = np.empty((steps, *h.shape), kind)
        gates = np.empty((steps if keep is not None else 1, 3 * STATE, h.shape[1]), kind)
        held = np.empty((len(gates), *h.shape), kind)
        start, above = h, self.v.above[x]
        for t in range(steps):
            gate, inward = gates[t % len(gates)], held[t % len(gates)]
            from_input = table.take(x[t], axis=0)
            if not self.summed:
                from_input += table.take(above[t], axis=0)
            gate[:] = from_input.T
            from_state = inner @ h
            both, new = gate[: 2 * STATE], gate[2 * STATE :]
            both += from_state[: 2 * STATE]
            np.exp(np.negative(both, out=both), out=both)
            both += 1
            np.reciprocal(both, out=both)
            inward[:] = from_state[2 * STATE :]
            new += both[STATE:] * inward
            np.tanh(new, out=new)
            np.subtract(h, new, out=out[t])
            out[t] *= both[:STATE]
            out[t] += new
            h = out[t]
        if keep is not None:
            keep.extend((np.concatenate([start[None], out[:-1]]), gates[:, :STATE], gates[:, STATE : 2 * STATE], gates[:, 2 * STATE :], held))
        return out.transpose(0, 2, 1)

    def log_softmax(self, h: np.ndarray) -> np.ndarray:
        logits = self._class_scores(h)
        return logits - np.log(_total(np.exp(logits)))

    def _class_scores(self, h: np.ndarray) -> np.ndarray:
        """What the classes have each, less the largest of all texts, or of each text where that is far below it."""
        logits = h @ self.p[2]
        logits += self.p[3]
        logits -= logits.max(initial=-np.inf)
        if logits.size and logits.min() < -60:
            logits -= logits.max(axis=1, keepdims=True)
        return logits

    def inside(self, h: np.ndarray, small: np.ndarray) -> np.ndarray:
        logits = self._scores(h, small, self.p[4][small])
        return logits - np.log(_total(np.exp(logits)))

    def _scores(self, h: np.ndarray, small: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the members of a node have each, less the largest."""
        logits = np.matmul(weights, h[:, :, None])[:, :, 0] + self.p[5][small]
        logits -= _largest(logits)
        return logits

    def log_probability(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural logarithm for each word; for words that are not frequent only that of their class."""
        group = np.where(ids >= 0, self.v.group[ids], self.v.groups - 1)
        logits = self._class_scores(h)
        out = logits[np.arange(len(ids)), group].astype(float)
        np.exp(logits, out=logits)
        out -= np.log(_total(logits))[:, 0]
        visits = Visits(self.v, ids)
        logits = visits.scores(h, self.p[4], self.p[5])
        own = logits[np.arange(len(logits)), visits.place]
        np.exp(logits, out=logits)
        visits.add(out, own - np.log(_total(logits))[:, 0])
        return out

    def gradient(self, h: np.ndarray, x: np.ndarray, ids: np.ndarray, there: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Gradient of the mean loss of one window, and the states after it."""
        grads, rows, h = self.sparse_gradient(h, x, ids, there)
        grads = {k: g if g is not None else np.zeros_like(self.p[k]) for k, g in enumerate(grads)}
        for k, parts in rows.items():
            for which, _, values in parts:
                for j, g in zip((k, 5), values, strict=False):
                    grads[j][which] += g.reshape(len(which), *grads[j].shape[1:])
        return list(grads.values()), h

    def sparse_gradient(self, h: np.ndarray, x: np.ndarray, ids: np.ndarray, there: np.ndarray) -> tuple[list, dict[int, list], np.ndarray]:
        """The same, but for the tables of words and nodes only the rows that are not zero: which, how many words each has, and values."""
        keep: list = []
        states = self.run(h, x, keep)
        flat, words = states[there], ids[there]
        n = len(words)
        group = np.where(words >= 0, self.v.group[words], self.v.groups - 1)
        d_logits = self._class_scores(flat)
        np.exp(d_logits, out=d_logits)
        d_logits /= n * _total(d_logits)
        d_logits[np.arange(n), group] -= 1 / n
        d_flat = d_logits @ self.p[2].T
        grads = [None, np.zeros_like(self.p[1]), flat.T @ d_logits, np.ones(n, d_logits.dtype) @ d_logits, None, None]
        rows: dict[int, list] = {0: [], 4: []}
        visits = Visits(self.v, words)
        if len(visits.node):
            d = visits.scores(flat, self.p[4], self.p[5])
            np.exp(d, out=d)
            d /= n * _total(d)
            d[np.arange(len(d)), visits.place] -= 1 / n
            towards, sums = visits.backwards(d)
            visits.add(d_flat, towards)
            rows[4].append(sums)
        d_states = np.zeros(states.shape, flat.dtype)
        d_states[there] = d_flat
        d_states = np.ascontiguousarray(d_states.transpose(0, 2, 1))
        before, z, r, new, from_state = keep
        # what the gradient of a state is multiplied by, for all steps at once: towards the inputs, and towards the state before
        kind, inner = flat.dtype, self.p[1]
        factors = np.empty((len(x), 3, *d_states.shape[1:]), kind)
        np.multiply(1 - z, 1 - new * new, out=factors[:, 2])
        np.multiply((before - new) * z, 1 - z, out=factors[:, 0])
        np.multiply(factors[:, 2] * from_state * r, 1 - r, out=factors[:, 1])
        d_inputs = np.empty((*x.shape, 3 * STATE), kind)
        inward = np.empty_like(factors)
        d_h = np.zeros(d_states.shape[1:], kind)
        for t in range(len(x) - 1, -1, -1):
            d_h += d_states[t]
            np.multiply(factors[t], d_h, out=inward[t])
            d_inputs[t] = inward[t].reshape(3 * STATE, -1).T
            inward[t, 2] *= r[t]
            d_h *= z[t]
            d_h += inner @ inward[t].reshape(3 * STATE, -1)
        grads[1] = np.matmul(before, inward.reshape(len(x), 3 * STATE, -1).transpose(0, 2, 1)).sum(axis=0)
        row = np.where(there, x, -1).ravel()
        used = np.flatnonzero(row >= 0)
        order = _sorted(row[used], self.v.inputs)
        d_inputs = d_inputs.reshape(-1, 3 * STATE).take(used[order], axis=0)
        # words first, then their classes from the sums of the words
        word, times, by_word = _sums(row[used[order]], d_inputs)
        order = _sorted(self.v.above[word], self.v.inputs)
        above, _, by_class = _sums(self.v.above[word][order], by_word[order])
        met = np.add.reduceat(times[order], np.searchsorted(self.v.above[word][order], above))
        own = word < len(self.v.words)  # the class of all other words is an input of its own
        if not own[-1]:
            by_class[-1] += by_word[-1]
            met[-1] += times[-1]
        rows[0].append((np.concatenate([word[own], above]), np.concatenate([times[own], met]), [np.concatenate([by_word[own], by_class])]))
        return grads, rows, states[-1]


def _largest(values: np.ndarray) -> np.ndarray:
    """The largest of each row of a narrow table, column by column."""
    out = values[:, 0].copy()
    for k in range(1, values.shape[1]):
        np.maximum(out, values[:, k], out=out)
    return out[:, None]


def _total(values: np.ndarray) -> np.ndarray:
    """The sum of each row of a narrow table."""
    return (values @ np.ones(values.shape[1], values.dtype))[:, None]


def _sorted(keys: np.ndarray, most: int) -> np.ndarray:
    """The order of keys below ``most``, equal ones as they come; keys of 16 bits are sorted by counting."""
    return np.argsort(keys.astype(np.uint16) if most <= 1 << 16 else keys, kind="stable")


def _runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal rows begin, and their lengths."""
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return first, np.diff(np.append(first, len(rows)))


def _sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ones of sorted rows, how often each occurs, and the sums of its values; short runs are added up side by side."""
    first, times = _runs(rows)
    out = values.take(first, axis=0)
    for k in np.flatnonzero(times > MANY):
        out[k] = np.ones(times[k], values.dtype) @ values[first[k] : first[k] + times[k]]
    for j in range(1, MANY):
        some = np.flatnonzero((times > j) & (times <= MANY))
        out[some] += values[first[some] + j]
    return rows[first], times, out


def _node_sums(node: np.ndarray, d: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """``_sums`` of the products of d and h, and of d; nodes with many words are multiplied at once."""
    first, times = _runs(node)
    weights = d[first][:, :, None] * h[first][:, None, :]
    for k in np.flatnonzero(times > MANY):
        np.matmul(d[first[k] : first[k] + times[k]].T, h[first[k] : first[k] + times[k]], out=weights[k])
    for j in range(1, MANY):
        some = np.flatnonzero((times > j) & (times <= MANY))
        at = first[some] + j
        weights[some] += d[at][:, :, None] * h[at][:, None, :]
    return node[first], times, [weights, np.add.reduceat(d, first, axis=0)]


class Visits:
    """The nodes on the ways of some words, those of all levels at once: nodes with many words first, both parts by node.

    The words of a node with many are put in packs of ``PACK``, so that its weights are read and multiplied once
    for a pack; places of a pack that no word takes stay zero. The others are worked on word by word.
    """

    def __init__(self, v: Vocabulary, ids: np.ndarray):
        way = v.way.take(ids, axis=1, mode="wrap")
        on = np.flatnonzero(way.ravel() >= 0)
        node, some = way.ravel().take(on), on % max(len(ids), 1)
        place = v.step.ravel().take(on // max(len(ids), 1) * v.step.shape[1] + ids.take(some))
        edges = np.searchsorted(on, np.arange(1, len(way)) * len(ids))
        self.levels = np.split(some, edges) if len(way) else []
        total = len(v.start)
        few = np.bincount(node, minlength=total) <= MANY
        self.order = _sorted(np.where(few, np.arange(total) + total, np.arange(total)).take(node), 2 * total)
        self.some, self.node, self.place = some[self.order], node[self.order], place[self.order]
        self.busy = len(node) - int(few[node].sum())
        self.first, self.times = _runs(self.node[: self.busy]) if self.busy else (np.zeros(0, np.int64),) * 2
        packs = -(-self.times // PACK)
        self.packs = np.cumsum(packs) - packs
        self.packed = np.repeat(self.node[self.first], packs)
        self.slots = np.arange(self.busy) + np.repeat(self.packs * PACK - self.first, self.times)

    def pack(self, values: np.ndarray) -> np.ndarray:
        """Values of the words of busy nodes in their packs."""
        out = np.zeros((len(self.packed) * PACK, values.shape[1]), values.dtype)
        out[self.slots] = values
        return out.reshape(-1, PACK, values.shape[1])

    def scores(self, h: np.ndarray, weights: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """What the members of the node of each visit have each, less the largest; keeps what ``backwards`` needs."""
        here, rest = h.take(self.some, axis=0), self.node[self.busy :]
        self.here, self.of_packs, self.of_rest = here[self.busy :], weights.take(self.packed, axis=0), weights.take(rest, axis=0)
        self.states = self.pack(here[: self.busy])
        logits = shares.take(self.node, axis=0)
        logits[: self.busy] += np.matmul(self.states, self.of_packs.transpose(0, 2, 1)).reshape(-1, SMALL).take(self.slots, axis=0)
        logits[self.busy :] += np.matmul(self.of_rest, self.here[:, :, None])[:, :, 0]
        logits -= _largest(logits)
        return logits

    def backwards(self, d: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Gradients of the states of all visits, and for each node how many words it has and those of its weights and shares."""
        towards = np.empty((len(d), STATE), d.dtype)
        packs = self.pack(d[: self.busy])
        towards[: self.busy] = np.matmul(packs, self.of_packs).reshape(-1, STATE).take(self.slots, axis=0)
        towards[self.busy :] = np.matmul(d[self.busy :, None, :], self.of_rest)[:, 0]
        parts = []
        if self.busy:
            by_pack = np.matmul(packs.transpose(0, 2, 1), self.states).reshape(-1, SMALL * STATE)
            weights = np.add.reduceat(by_pack, self.packs, axis=0).reshape(-1, SMALL, STATE)
            parts.append((self.node[self.first], self.times, weights, np.add.reduceat(d[: self.busy], self.first, axis=0)))
        if self.busy < len(d):
            names, times, sums = _node_sums(self.node[self.busy :], d[self.busy :], self.here)
            parts.append((names, times, *sums))
        names, times, weights, shares = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*parts, strict=True))
        return towards, (names, times, [weights, shares])

    def add(self, out: np.ndarray, values: np.ndarray) -> None:
        """Adds the values of all visits to those of their words."""
        by_level = np.empty_like(values)
        by_level[self.order] = values
        at = 0
        for some in self.levels:
            out[some] += by_level[at : at + len(some)]
            at += len(some)


@dataclass
class Texts:
    """The words of some texts as ids, each text ended, from the longest to the shortest."""

    ids: np.ndarray
    bounds: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, v: Vocabulary) -> Texts:
        words = Words(texts, lower=True)
        sizes = np.diff(words.bounds) + 1
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.full(bounds[-1], v.ids(np.array([_END]))[0])
        ids[np.arange(len(words.hashes)) + words.texts()] = v.ids(words.hashes)
        return cls(ids, bounds, np.argsort(-sizes, kind="stable"))

    def window(self, some: np.ndarray, at: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """(steps, texts): ids from place ``at`` on, and whether the text has a word there."""
        place = self.bounds[some][None, :] + at + np.arange(span)[:, None]
        there = place < self.bounds[some + 1][None, :]
        return self.ids[np.where(there, place, self.bounds[some + 1][None, :] - 1)], there

    def inputs(self, v: Vocabulary, ids: np.ndarray, some: np.ndarray, at: int) -> np.ndarray:
        """What goes before each word of a window: the word before it, the end of a text before the first."""
        first = self.ids[self.bounds[some] + at - 1] if at else np.full(len(some), v.ids(np.array([_END]))[0])
        before = np.concatenate([first[None, :], ids[:-1]])
        return np.where(before >= 0, before, v.inputs - 1)


def learned_from(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> tuple[Network, int]:
    """A network trained on every window of the training documents among some rows, and the number of words learned from."""
    net, learned, step = Network(v), 0, 0
    first, second = [np.zeros_like(p) for p in net.p[1:4]], [np.zeros_like(p) for p in net.p[1:4]]
    squares = {k: np.zeros(len(net.p[k]), np.float32) for k in (0, 4, 5)}
    for batch in (part for whole in batches for part in slices(whole, 3, 16 << 20)):
        batch = batch.filter(pa.array(~np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)))
        texts = Texts.of(batch.column(3), v)
        for k in range(0, len(batch), SIDE):
            some = texts.order[k : k + SIDE]
            sizes = texts.bounds[some + 1] - texts.bounds[some]
            h = np.zeros((len(some), STATE), np.float32)
            for at in range(0, int(sizes[0]), SPAN):
                going = int((sizes > at).sum())
                h = h[:going]
                ids, there = texts.window(some[:going], at, SPAN)
                x = texts.inputs(v, ids, some[:going], at)
                grads, rows, h = net.sparse_gradient(h, x, ids, there)
                learned, step = learned + int(there.sum()), step + 1
                for p, g, m, s in zip(net.p[1:4], grads[1:4], first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
                for k, parts in rows.items():
                    for which, times, values in parts:
                        net.seen[k][which] += times
                        for j, g in zip((k, 5), values, strict=False):
                            flat = g.reshape(len(g), -1)
                            squared = squares[j][which] + np.vecdot(flat, flat) / flat.shape[1]
                            squares[j][which] = squared
                            flat *= (ROW_RATE / (np.sqrt(squared) + 1e-9))[:, None]
                            net.p[j][which] -= g
    return net, learned


def train(rows: DataFrame, v: Vocabulary) -> Network:
    """The average of the networks that the partitions of the training documents arrive at, by words learned from."""
    shared = rows.sparkSession.sparkContext.broadcast(v)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, learned = learned_from(batches, shared.value)
        if learned:
            yield part(["dense"], [np.zeros(1, int)], [np.array([learned])], [np.concatenate([p.ravel() for p in net.p[1:4]])[None, :]])
        for k, size in BLOCKS.items():
            met = np.flatnonzero(net.seen[k])
            for some in np.split(met, np.flatnonzero(np.diff(met // (64 * size))) + 1) if len(met) else ():
                edges = np.flatnonzero(np.diff(some // size)) + 1
                blocks = np.split(some, edges)
                yield part([f"{k} {b[0] // size}" for b in blocks], blocks, [net.seen[k][b] for b in blocks], [net.p[0][b] if k == 0 else np.concatenate([net.p[4][b].reshape(len(b), -1), net.p[5][b]], axis=1) for b in blocks])

    def part(keys: list, rows: list, times: list, values: list) -> pa.RecordBatch:
        packed = [[x.astype(kind).tobytes() for x in some] for some, kind in ((rows, np.int64), (times, np.float64), (values, np.float32))]
        return pa.record_batch([pa.array(keys, pa.string()), *[pa.array(x, pa.binary()) for x in packed]], ["key", "rows", "times", "vectors"])

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(x, np.int64) for x in parts["rows"]]
        names = np.unique(np.concatenate(rows))
        n, total = np.zeros(len(names)), 0.0
        for which, times, vectors in zip(rows, parts["times"], parts["vectors"], strict=True):
            at, times = np.searchsorted(names, which), np.frombuffer(times)
            vectors = np.frombuffer(vectors, np.float32).reshape(len(which), -1)
            if not np.ndim(total):
                total = np.zeros((len(names), vectors.shape[1]))
            n[at] += times
            total[at] += times[:, None] * vectors
        return pd.DataFrame({"key": [key[0]], "rows": [names.tobytes()], "vectors": [(total / n[:, None]).astype(np.float32).tobytes()]})

    # each copy has all rows, so their number is bounded by the cores and not by the input
    most = 2 * rows.sparkSession.sparkContext.defaultParallelism
    copies = rows.coalesce(most).mapInArrow(learn, "key string, rows binary, times binary, vectors binary")
    net = Network(v)
    for r in copies.groupBy("key").applyInPandas(merge, "key string, rows binary, vectors binary").toLocalIterator():
        which = np.frombuffer(r["rows"], np.int64)
        vectors = np.frombuffer(r["vectors"], np.float32).reshape(len(which), -1)
        if r["key"] == "dense":
            ends = np.cumsum([p.size for p in net.p[1:4]])
            for p, values in zip(net.p[1:4], np.split(vectors[0], ends[:-1]), strict=True):
                p[:] = values.reshape(p.shape)
        elif r["key"].startswith("0 "):
            net.p[0][which] = vectors
        else:
            net.p[4][which], net.p[5][which] = vectors[:, :-SMALL].reshape(-1, SMALL, STATE), vectors[:, -SMALL:]
    return net


def score_documents(docs: DataFrame, frequent: int | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Words are runs without ASCII white space, A-Z in lower case; each text, a null one as an empty one,
    has one more token, its end. ``base_score`` adds up log10((c + 0.5) / (N + 0.5 (V + 1))) over the
    tokens, ``score`` is the log10 probability of the whole text under the network. Nothing is learned
    from documents that ``held_out`` names; a row without doc_id is learned from. Repeated rows are
    scored each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = _documents(docs)
    counts = count_words(rows)
    v = vocabulary(counts, frequent)
    shared = spark.sparkContext.broadcast((v, train(rows, v).with_sums()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, parameters = shared.value
        net = Network(v, parameters)
        net.summed = True
        logs = np.log10(v.counts + 0.5)
        for batch in (part for whole in batches for part in slices(whole, 3, 16 << 20)):
            texts = Texts.of(batch.column(3), v)
            total = np.zeros(len(batch))
            for k in range(0, len(batch), SIDE):
                side = texts.order[k : k + SIDE]
                sizes = texts.bounds[side + 1] - texts.bounds[side]
                h = np.zeros((len(side), STATE), np.float32)
                for at in range(0, int(sizes[0]), SPAN):
                    some = side[: int((sizes > at).sum())]
                    ids, there = texts.window(some, at, SPAN)
                    states = net.run(h[: len(some)], texts.inputs(v, ids, some, at))
                    h = states[-1]
                    which = np.broadcast_to(some, there.shape)[there]
                    total += np.bincount(which, net.log_probability(states[there], ids[there]), len(batch))
            text = np.repeat(np.arange(len(batch)), np.diff(texts.bounds))
            frequent = texts.ids >= 0
            known = np.bincount(text[frequent], v.counts[texts.ids[frequent]] > 0, len(batch)).astype(np.int64)
            base = np.bincount(text[frequent], logs[texts.ids[frequent]], len(batch))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(texts.bounds)), pa.array(np.bincount(text[~frequent], minlength=len(batch))), pa.array(known), pa.array(base), pa.array(total / np.log(10))],
                ["doc_id", "tag", "out", "n_tokens", "n_rare", "known", "base", "score"],
            )

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, _ = shared.value
        for batch in (part for whole in batches for part in slices(whole, 3)):
            words = Words(batch.column(3), lower=True)
            other = v.ids(words.hashes) < 0
            text, word = words.texts()[other], words.hashes[other]
            order = np.lexsort((word, text))
            text, word = text[order], word[order]
            first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (word[1:] != word[:-1])])[: len(text)])
            times = np.diff(np.append(first, len(text))).astype(np.int32)
            text, word = pa.array(text[first]), pa.array(word[first].view(np.int64))
            yield pa.record_batch([batch.column(0).take(text), batch.column(1).take(text), word, pa.array(times)], ["doc_id", "tag", "word", "times"])

    summary = stored(rows.mapInArrow(score, "doc_id long, tag long, out boolean, n_tokens long, n_rare long, known long, base double, score double"), "scores")
    listed = spark.sparkContext.broadcast(v.words.view(np.int64))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~np.isin(batch.column(0).to_numpy(), listed.value)))

    times = rows.mapInArrow(rare, "doc_id long, tag long, word long, times int").join(counts.mapInArrow(others, "word long, n long"), "word", "left")
    n = F.coalesce("n", F.lit(0))
    sums = times.groupBy("doc_id", "tag").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare_base"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    # rows that repeat have added up their sums
    alike = F.count("*").over(Window.partitionBy("doc_id", "tag"))
    joined = summary.withColumn("alike", alike).join(sums.withColumnsRenamed({"doc_id": "doc", "tag": "mark"}), F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("tag") == F.col("mark")), "left")
    more = F.coalesce(F.col("rare_base") / F.col("alike"), F.lit(0.0))
    n_known = F.col("known") + F.coalesce((F.col("rare_known") / F.col("alike")).cast("long"), F.lit(0))
    base = F.col("base") + more - F.col("n_tokens") * float(np.log10(v.tokens + 0.5 * (v.kinds + 1)))
    return joined.select(
        "doc_id", F.col("out").alias("held_out"), "n_tokens", n_known.alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("score") + more - F.col("n_rare") * float(np.log10(v.rest))).alias("score"),
    )


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
