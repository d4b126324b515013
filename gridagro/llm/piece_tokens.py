"""SentencePiece ids of whole texts by an agenda of adjacent pairs, and the texts that the ids decode to.

A merge-type vocabulary scores its pieces. A text starts as single characters; the pair of neighbours
that makes the piece of the highest score (of equal ones the leftmost) is merged, until no pair makes
a piece. No pair can form across a character that is in no longer piece, nor before a space mark that
follows something else if no piece has one inside, so texts are cut there, each distinct segment goes
through its agenda once, and its ids are kept for the next time. The agenda of a long segment is a
heap. Those of all short segments of a batch lie side by side in one array, and the first entry of
each is taken at the same time.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridagro.llm.common import read
from gridagro.llm.text import slices

#: The mark that stands for a space in pieces: a fixed value of the library.
SPACE = "▁"
#: Segments whose ids a task keeps; beyond it begins anew, which changes its speed only.
KEPT_SEGMENTS = 1 << 19
#: Longest segment that goes through its agenda together with others; it changes the speed only.
SHORT = 64
#: Bytes of text that are worked on at a time; a longer text is worked on alone.
AT_ONCE = 1 << 22

TOKENS = "doc_id long, ids array<int>, decoded string, agrees boolean"

_NONE = np.iinfo(np.int64).max
_PLACE = 32
_PLACE_MASK = (1 << _PLACE) - 1


class Vocabulary:
    """Pieces of a merge-type model with byte fallback: ranks for the agenda, ids for what it leaves.

    Models without byte pieces, and those with pieces that are marked unused, are refused.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(sp.vocab_size())
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in every]
        self.ids = {sp.id_to_piece(i): i for i in every if not special[i]}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(sp.is_byte, self.bytes)):
            raise ValueError("the model has no byte pieces")
        if any(map(sp.is_unused, every)):
            raise ValueError("the model has unused pieces")
        scores = sorted({sp.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}
        self.ranks = {piece: place[sp.get_score(i)] for piece, i in self.ids.items()}
        self.cut = self._segments()
        self._characters = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self._characters[ord(piece)] = i
        pairs = {(self.ids[a], self.ids[b]): piece for piece in self.ids for k in range(1, len(piece)) if (a := piece[:k]) in self.ids and (b := piece[k:]) in self.ids}
        key = np.array([a << _PLACE | b for a, b in pairs] or [-1], np.int64)
        order = np.argsort(key)
        self._pairs = key[order]
        self._made = np.array([self.ids[p] for p in pairs.values()] or [0], np.int32)[order]
        self._ranks = np.array([self.ranks[p] for p in pairs.values()] or [0], np.int64)[order]

    def _segments(self) -> re.Pattern:
        """Pieces of text that no longer piece can reach across."""
        longer = [piece for piece in self.ids if len(piece) > 1]
        joining = "".join(sorted({c for piece in longer for c in piece}))
        if not joining:
            return re.compile("(?s:.)")
        if any(SPACE in piece.lstrip(SPACE) for piece in longer):
            return re.compile(f"[{re.escape(joining)}]+|(?s:.)")
        inner = re.escape(joining.replace(SPACE, ""))
        return re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|(?s:.)" if inner else f"{SPACE}+|(?s:.)")

    def merged(self, segment: str) -> list[str]:
        """The pieces that the agenda leaves of a segment, by a heap of rank and place."""
        ranks, symbols, n = self.ranks, list(segment), len(segment)
        rank = [ranks.get(segment[i : i + 2]) for i in range(n - 1)]
        agenda = [r << _PLACE | i for i, r in enumerate(rank) if r is not None]
        heapq.heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank.append(None)
        while agenda:
            top = heapq.heappop(agenda)
            i = top & _PLACE_MASK
            if rank[i] != top >> _PLACE:
                continue  # one of the two has been merged since
            j = after[i]
            symbols[i] += symbols[j]
            symbols[j] = rank[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for left, right in ((i, k), (before[i], i)):
                if left >= 0:
                    r = rank[left] = ranks.get(symbols[left] + symbols[right]) if right < n else None
                    if r is not None:
                        heapq.heappush(agenda, r << _PLACE | left)
        return [s for s in symbols if s is not None]

    def _entries(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the pairs are among those that make a piece; -1 for the others."""
        key = left.astype(np.int64) << _PLACE | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where((self._pairs[at] == key) & (left >= 0) & (right >= 0), at, -1)

    def short_ids(self, segments: list[str]) -> list[bytes]:
        """The ids of many short segments: the first entry of every agenda is merged in the same step."""
        symbol = self._characters[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        out: list[bytes] = [b""] * len(segments)
        entry = np.full(len(symbol), -1)
        entry[:-1] = np.where(owner[1:] == owner[:-1], self._entries(symbol[:-1], symbol[1:]), -1)
        while len(symbol):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            agenda = np.where(entry >= 0, self._ranks[entry] << _PLACE | np.arange(len(entry)), _NONE)
            least = np.minimum.reduceat(agenda, first)
            done = least == _NONE
            if done.any():
                last = np.append(first[1:], len(symbol))
                bad = np.logical_or.reduceat(symbol < 0, first)
                data = symbol.tobytes()
                for i, a, b, unknown in zip(owner[first[done]].tolist(), first[done].tolist(), last[done].tolist(), bad[done].tolist(), strict=True):
                    out[i] = self.segment_ids(segments[i]) if unknown else data[4 * a : 4 * b]
            at = least[~done] & _PLACE_MASK
            symbol[at] = self._made[entry[at]]
            keep = np.repeat(~done, np.diff(np.append(first, len(symbol))))
            keep[at + 1] = False
            entry[at] = -2  # the pairs on both sides of a merged one have changed
            symbol, owner, entry = symbol[keep], owner[keep], entry[keep]
            at = np.flatnonzero(entry == -2)
            entry[at] = -1
            at = np.concatenate([at, at[at > 0] - 1])
            at = at[at + 1 < len(symbol)]
            at = at[owner[at] == owner[at + 1]]
            entry[at] = self._entries(symbol[at], symbol[at + 1])
        return out

    def segment_ids(self, segment: str) -> bytes:
        """The ids of a segment as 32-bit numbers; a character that is no piece becomes its bytes."""
        out = array("i")
        for piece in self.merged(segment):
            own = self.ids.get(piece)
            if own is not None:
                out.append(own)
            else:
                out.extend(self.bytes[b] for b in piece.encode())
        return out.tobytes()


@lru_cache(1)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def encoded(texts: list[str], words: Vocabulary, known: dict[str, bytes]) -> list[bytes]:
    """The ids of each text, normalised as the model asks, as 32-bit numbers; ``known`` has ids by segment."""
    cut = [words.cut.findall(text) for text in words.library.normalize(texts)]
    if len(known) >= KEPT_SEGMENTS:
        known.clear()
    new = list(set().union(*cut).difference(known))
    short = [s for s in new if len(s) <= SHORT]
    known.update(zip(short, words.short_ids(short), strict=True))
    known.update((s, words.segment_ids(s)) for s in new if len(s) > SHORT)
    return [b"".join(map(known.__getitem__, segments)) for segments in cut]


def tokens(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """One row per document: doc_id, its ids, the text they decode to, and whether the library agrees.

    ``model`` is a file of the sentencepiece library with a merge-type vocabulary and byte pieces; the
    driver reads it and sends its bytes (half a megabyte for 32,000 pieces) to the tasks. With ``check``
    the library encodes each Arrow batch as well, and ``agrees`` tells of each text whether all ids are
    the same (else null). Texts are read whole, however long; a null text counts as empty and has no
    ids. Only doc_id and text are read; rows that repeat are encoded each; an empty table gives no rows.
    """
    with open(model, "rb") as file:
        proto = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = vocabulary(proto), {}
        library = words.library
        for batch in batches:
            for part in slices(batch, 1, AT_ONCE):
                texts = [text or "" for text in part.column(1).to_pylist()]
                ids = encoded(texts, words, known)
                decoded = library.decode([np.frombuffer(x, np.int32).tolist() for x in ids], num_threads=1)
                agrees = [array("i", theirs).tobytes() == own for own, theirs in zip(ids, library.encode(texts, num_threads=1), strict=True)] if check else [None] * len(ids)
                offsets = np.cumsum([0, *map(len, ids)]) // 4
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.record_batch([part.column(0), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], ["doc_id", "ids", "decoded", "agrees"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, TOKENS)


def op13_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")
