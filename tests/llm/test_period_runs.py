"""Runs against all periods tried one by one, in random texts, odd rows and the driver's smallest table."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from gridagro.llm import period_runs, queries
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """All (start, length, period) by trying every period at every place."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def dropped(w, found):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found)]


def found_in(texts):
    bounds = np.cumsum([0, *map(len, texts)])
    start, length, period = period_runs.runs(np.array([x for t in texts for x in t], np.int64), bounds)
    out = [[] for _ in texts]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        k = int(np.searchsorted(bounds, s, "right")) - 1
        out[k].append((s - int(bounds[k]), n, q))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_random_texts(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        texts = []
        for _ in range(rnd.randrange(1, 8)):
            k, w = rnd.choice([1, 1, 2, 2, 3, 5, 20]), []
            for _ in range(rnd.randrange(8)):
                if rnd.random() < 0.5:
                    w += [rnd.randrange(k) for _ in range(rnd.randrange(12))]
                else:
                    part, m = [rnd.randrange(k) for _ in range(rnd.randrange(1, 9))], rnd.randrange(1, 60)
                    w += (part * m)[:m]
            texts.append(w)
        assert found_in(texts) == [brute(w) for w in texts]


def test_long_runs_and_grammars():
    assert found_in([[0] * 20_000, list(range(700)) * 28, ([0, 1] * 3 + [2]) * 3000, [], [1], [1] * 5, [1] * 6]) == [[(0, 20_000, 1)], [(0, 19_600, 700)], [(0, 21_000, 7)], [], [], [], [(0, 6, 1)]]
    words = np.array([1, 2, 3, 4, 1, 2, 3, 4, 1, 2, 3, 4, 9], np.int64)
    symbols, places = period_runs.grammar(words, np.array([0, len(words)]))
    # every place of a symbol reads as its first place does
    for k, at in zip(places.symbol.tolist(), places.start.tolist(), strict=True):
        size = symbols.end[k] - symbols.start[k]
        assert words[at : at + size].tolist() == words[symbols.start[k] : symbols.end[k]].tolist()
    assert len(places.symbol) == len(words) - 1 > len(symbols.start)  # a binary tree over the words; some symbols have several places


def test_hashes_only_propose(monkeypatch):
    monkeypatch.setattr(period_runs, "mixed", lambda x: x * np.uint64(0))  # every pair of stretches collides
    rnd = random.Random(3)
    texts = [[rnd.randrange(2) for _ in range(200)] for _ in range(5)]
    assert found_in(texts) == [brute(w) for w in texts]


def test_odd_rows(spark, wide, nothing):
    assert period_runs.periodic_runs(nothing).count() == 0
    assert period_runs.with_periodic_ends(nothing).count() == 0
    ids = collections.Counter(r.doc_id for r in wide.select("doc_id").collect())
    assert collections.Counter(r.doc_id for r in period_runs.periodic_runs(wide).collect()) == ids
    rows = [(1, "a b " * 5 + "c"), (2, None), (3, ""), (4, " \n\t"), (5, "é x " * 7), (6, "\x1cz " * 6), (1, "a b " * 5 + "c"), (None, "no no no no no no"), (7, prose(1, 3000) + " q w e" * 4000)]
    got = collections.defaultdict(list)
    for r in period_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].append(([tuple(x) for x in r.runs], r.collapsed))
    assert got[1] == [([(0, 10, 2)], "a b c")] * 2
    assert got[2] == got[3] == got[4] == [([], "")]
    assert got[5] == [([(0, 7, 1)], "é x")] and got[6] == [([(0, 6, 1)], "\x1cz")]
    assert got[None] == [([(0, 6, 1)], "no")]
    assert got[7] == [([(3000, 12_000, 3)], prose(1, 3000) + " q w e")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_query_against_brute_force(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = WORD.findall(r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        found = brute(w)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        want.append((r.doc_id, len(found), *best, found and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(dropped(w, found)))))
    got = queries.QUERIES["op11_period_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes[:6]} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[1] for r in want) > 0
