"""Words and their hashes for whole Arrow batches of texts, without a Python loop over words.

A word is a run of bytes that are not separators. All separators are ASCII, so working on UTF-8
bytes gives the same words as working on code points. The hash of a word is a polynomial over
random byte values modulo 2**64; it depends on nothing but the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18

_BYTES = np.arange(256)
#: Bytes of words, for words split at ASCII white space and for words of ASCII letters and digits and everything beyond ASCII.
SPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
ALPHANUMERIC = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122))

_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


_POWERS = {n: (_powers(_STEP, n), _powers(_STEP_INVERSE, n)) for n in (BLOCK,)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal inputs give equal outputs."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def joined(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Hashes of two sequences that follow one another."""
    return mixed(first * _PAIR + then)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; a null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


class Words:
    """The words of a batch of texts.

    ``hashes`` and, if asked for, byte positions ``starts`` and ``ends`` of all words;
    the words of text i are those from ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, column: pa.Array, kind: np.ndarray = SPACED, lower: bool = False, places: bool = False):
        data, offsets = buffers(column)
        self.offsets = offsets
        values = np.array(_RANDOM)
        kind = np.array(kind)
        if lower:
            values[65:91], kind[65:91] = _RANDOM[97:123], kind[97:123]
        self.data, self.size = data, len(column)
        hashes, starts, ends = [], [], []
        at, stop = int(offsets[0]), int(offsets[-1])
        while at < stop:
            to = self._cut(data, kind, offsets, at, stop)
            h, s, e = self._block(data[at:to], kind, values, offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)] - at)
            hashes.append(h)
            starts.append(s + at)
            if places:
                ends.append(e + at)
            at = to
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        all_starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.bounds = np.searchsorted(all_starts, offsets)
        if places:
            self.starts = all_starts
            self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)

    @staticmethod
    def _cut(data, kind, offsets, at, stop) -> int:
        """End of a block of about BLOCK bytes, never inside a word."""
        to = at + BLOCK
        if to >= stop:
            return stop
        text = int(offsets[np.searchsorted(offsets, to, "right") - 1])
        if text > at:
            return text
        while to < stop:  # inside one long text
            gap = np.flatnonzero(~kind[data[to - BLOCK : to]])
            if len(gap) and to - BLOCK + gap[-1] > at:
                return int(to - BLOCK + gap[-1])
            to += BLOCK
            end = int(offsets[np.searchsorted(offsets, at, "right")])
            if end <= to:
                return end
        return stop

    @staticmethod
    def _block(data, kind, values, fresh):
        n = len(data)
        inside = kind[data]
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        before[fresh] = False
        starts = np.flatnonzero(inside & ~before[:n])
        after = np.zeros(n, bool)
        after[: n - 1] = inside[1:]
        after[fresh[fresh > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        if n not in _POWERS and n > BLOCK:
            power, inverse = _powers(_STEP, n), _powers(_STEP_INVERSE, n)
        else:
            power, inverse = _POWERS[BLOCK]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * power[:n], out=total[1:])
        return mixed((total[ends] - total[starts]) * inverse[starts]), starts, ends

    def texts(self) -> np.ndarray:
        """The number of its text for each word."""
        return np.repeat(np.arange(self.size), np.diff(self.bounds))


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, by first word, and whether the run ends inside its text."""
    h = words.hashes
    room = np.repeat(words.bounds[1:], np.diff(words.bounds)) - np.arange(len(h)) >= n
    out, have = None, 0  # binary powering: runs of 1, 2, 4, ... words are put together
    power, length = h, 1
    left = n
    while left:
        if left & 1:
            out = power if out is None else joined(out, _shifted(power, have))
            have += length
        left >>= 1
        if left:
            power = joined(power, _shifted(power, length))
            length *= 2
    return out, room


def _shifted(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(x)
    if n < len(x):
        out[: len(x) - n] = x[n:]
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the place of the smallest of the ``width`` values from there on, the first of equals."""
    top = np.iinfo(np.uint64).max
    least, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        later, later_place = np.full_like(least, top), np.zeros_like(place)
        later[: max(0, len(least) - step)] = least[step:]
        later_place[: max(0, len(place) - step)] = place[step:]
        take = later < least
        least, place, have = np.where(take, later, least), np.where(take, later_place, place), have + step
    return place


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, or one text; whole rows in the same order."""
    texts = batch.column(column)
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())) if len(texts) else np.zeros(0, np.int64)
    part = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(batch)]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)
