"""Secrets in texts: three fixed patterns, and strings that a tokenizer can only cut into crumbs.

A byte-pair vocabulary holds what is frequent in written text. A random string is not, so it takes
many tokens for its length. Long strings of letters and digits below a ratio of characters per token
are reported, unless they are digests of a known length or identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridagro.llm.common import read

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Characters per token up to which a string counts as random, and the shortest string that is looked at.
RATIO, SHORTEST = 2.0, 20

KINDS = ("assign", "access", "hex", "token")
FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, secrets array<string>"

_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
_LETTERS = re.compile(r"[A-Za-z]+")
#: MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hex; UUIDs; dotted, dashed or underscored names whose parts are words or numbers (if the token test takes the letters for words).
_DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})\Z")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_NAME = re.compile(r"(?:[A-Za-z]+|[0-9]+)(?:[-_/+=]+(?:[A-Za-z]+|[0-9]+))*[-_/+=]*\Z")


@lru_cache(1)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\s]+|\s+", mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns; each pattern's matches do not overlap."""
    spans = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    # a run is matched as a whole, so asking for its length in the pattern gives the same matches
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def random_spans(text: str, base: list[tuple[int, int, int]], vocabulary: str, ratio: float) -> list[tuple[int, int, int]]:
    """Strings of few characters per token that touch no span of ``base``. Strings without a letter are numbers or rules."""

    def crumbs(*parts: str) -> bool:
        return sum(map(len, parts)) <= ratio * sum(len(_encoding(vocabulary).encode_ordinary(part)) for part in parts)

    out = []
    for m in _CANDIDATE.finditer(text):
        word = m[0]
        letters = _LETTERS.findall(word)
        if not letters or _DIGEST.match(word) or _UUID.match(word) or _NAME.match(word) and not crumbs(*letters):
            continue
        if any(start < m.end() and m.start() < end for start, _, end in base):
            continue
        if crumbs(word):
            out.append((m.start(), 3, m.end()))
    return out


def find_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """One row per document: counts and digest of the pattern spans, all spans, and the secrets.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then in the order of
    KINDS. A null text counts as empty: no spans, the digest of the empty string. Only doc_id and
    text are read; rows that repeat are reported each. ``vocabulary`` is a tiktoken rank file that
    every worker can read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[list, list, list] = ([], [], [])
            digests, listed, secrets = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + random_spans(text, base, vocabulary, ratio))
                for kind in range(3):
                    counts[kind].append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest())
                listed.append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans))
                secrets.append([text[a:b] for a, _, b in spans])
            yield pa.record_batch(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(listed, pa.string()), pa.array(secrets, pa.list_(pa.string()))],
                [x.split(" ")[0] for x in FOUND.split(", ")],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(scan, FOUND)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents")).drop("secrets")
