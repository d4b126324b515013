"""Own encoding against the library, on written and on random text."""

import collections
import hashlib
import os
import random

import numpy as np
import pytest

from gridagro.llm import piece_tokens, queries

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def words():
    with open(MODEL, "rb") as file:
        return piece_tokens.vocabulary(file.read())


def ids(texts, words, known):
    return [np.frombuffer(x, np.int32).tolist() for x in piece_tokens.encoded(texts, words, known)]


@pytest.mark.parametrize("seed", range(6))
def test_random_texts_encode_as_in_the_library(words, seed):
    rnd = random.Random(seed)
    some = list(" ▁\n\t\0\r.,aeinoth<>s/x0A日本語é́ﬁ😀‍👩Ⅳ①١٢½'\"--==__##**　 ﻿")
    every = [chr(c) for c in range(1, 0x3000)]
    parts = [" ", "  ", "    ", "the", "ing", "er", "----", "====", "\n\n", "return", "1234", "<s>", "</s>", "<0x0A>", "<unk>"]
    texts = ["".join(rnd.choice(kind) for _ in range(rnd.randrange(60))) for kind in (some, every, parts) for _ in range(700)]
    assert ids(texts, words, {}) == words.library.encode(texts, num_threads=1)


def test_both_agendas_agree(words):
    rnd = random.Random(1)
    segments = ["".join(rnd.choice(["the", "in", "ing▁", "er", "---", "=", "1234", "e", "a", "th", "日", "͸"]) for _ in range(rnd.randrange(1, 50))) for _ in range(500)]
    assert words.short_ids(segments) == [words.segment_ids(s) for s in segments]
    assert words.short_ids([]) == []


def test_long_texts_and_few_kept_segments(words, monkeypatch):
    rnd = random.Random(2)
    long = "".join(rnd.choice("etaoinshr") for _ in range(200_000))
    prose = " ".join("".join(rnd.choice("etaoinshr") for _ in range(rnd.randrange(1, 9))) for _ in range(5000))
    monkeypatch.setattr(piece_tokens, "KEPT_SEGMENTS", 100)
    known = {}
    for texts in ([long, prose], [prose[::-1], ""], [prose]):
        assert ids(texts, words, known) == words.library.encode(texts, num_threads=1)


def test_unfit_models_are_refused(words, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_byte", lambda self, i: False)
    with open(MODEL, "rb") as file, pytest.raises(ValueError, match="byte"):
        piece_tokens.Vocabulary(file.read())


def test_odd_rows(spark, wide, nothing, words):
    assert piece_tokens.tokens(nothing, MODEL).count() == 0
    rows = [(1, None), (2, ""), (3, " "), (4, "one  two"), (4, "one  two"), (None, "x\n\t▁y"), (5, "a" * 70_000)]
    got = collections.Counter((r.doc_id, tuple(r.ids), r.decoded, r.agrees) for r in piece_tokens.tokens(spark.createDataFrame(rows, "doc_id long, text string"), MODEL).collect())
    sp = words.library
    assert got == collections.Counter((i, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or "")), True) for i, t in rows)
    out = piece_tokens.tokens(wide, MODEL, check=False)
    assert collections.Counter(r.doc_id for r in out.collect()) == collections.Counter(r.doc_id for r in wide.select("doc_id").collect())
    assert out.filter("agrees is not null").isEmpty()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_query_against_the_library(spark, words):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sp, want = words.library, []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        x = sp.encode(r.text or "")
        want.append((r.doc_id, len(x), sha(",".join(map(str, x))), sha(sp.decode(x)), True))
    got = queries.QUERIES["op13_piece_tokens"](spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
