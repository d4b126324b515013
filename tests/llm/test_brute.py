"""Operators against brute force on a small corpus with all the odd rows."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridagro.llm import decontaminate, exact_dedup, language_model, mixing, near_dedup, substring_dedup
from tests.llm.conftest import prose, small_corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def test_exact_groups(corpus):
    groups = collections.defaultdict(list)
    for i, text, *_ in small_corpus():
        groups[text or ""].append(i)
    want = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    got = exact_dedup.exact_groups(corpus)
    assert bag(got.select("doc_id", "keep_id", "group_size", "sha").collect()) == want
    kept = got.filter("kept").groupBy("sha").count().collect()
    assert len(kept) == len(groups) and all(r["count"] == 1 for r in kept)
    assert got.filter("kept and not doc_id <=> keep_id").isEmpty()
    stays = exact_dedup.keep_one(corpus)
    assert stays.columns == corpus.columns
    assert collections.Counter(r.text or "" for r in stays.collect()) == {text: 1 for text in groups}


def sets(n):
    out = []
    for i, text, *_ in small_corpus():
        w = WORD.findall(lower(text))
        out.append((i, frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    return out


@pytest.mark.parametrize("n", [2, 5])
def test_near_groups(corpus, n):
    rows = sets(n)
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = rows[a][1], rows[b][1]
        if x and y and rows[a][0] is not None and rows[b][0] is not None and 100 * len(x & y) >= 80 * len(x | y):
            top[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), math.inf), math.inf if i is None else i)
    want = collections.Counter((i, len(s), None if i is None else least[find(k)]) for k, (i, s) in enumerate(rows))
    assert bag(near_dedup.near_groups(corpus, n).select("doc_id", "n_shingles", "component_id").collect()) == want


def test_near_copies_go(corpus):
    stays = near_dedup.keep_one(corpus)
    assert stays.columns == corpus.columns
    ids = {r.doc_id for r in stays.collect()}
    assert 7 in ids and not ids & set(range(200, 212)) and {400, 401, 402, 403, None} <= ids


def removed(length):
    docs = [(i, WORD.findall(t or "")) for i, t, *_ in small_corpus()]
    first = {}
    for i, w in docs:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    out = collections.Counter()
    for i, w in docs:
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < (math.inf if i is None else i):
                gone.update(range(k, k + length))
        out[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


@pytest.mark.parametrize("length", [5, 13])
@pytest.mark.parametrize("hot", [False, True])
def test_repeated_passages(corpus, length, hot, monkeypatch):
    if hot:  # a half of a few documents is hot, and a few windows are the commonest
        monkeypatch.setattr(substring_dedup, "LOOK", 1)
        monkeypatch.setattr(substring_dedup, "HOT_KEYS", 40)
        found = substring_dedup._hot(substring_dedup._documents(corpus), length)
        assert len(found.halves) > 3 and len(found.windows) == 40
    assert bag(substring_dedup.without_repeats(corpus, length).collect()) == removed(length)


def test_every_window_has_a_half_and_is_named_by_its_whole_hash(corpus):
    np = language_model.np
    rows = substring_dedup._documents(corpus)
    texts = substring_dedup.pa.array([r.text for r in rows.collect()], substring_dedup.pa.string())
    every = substring_dedup.Windows.of(texts, 13)
    sent = substring_dedup._halves(rows, 13).collect()
    assert sum(r.n for r in sent) == len(every.full) and {r.half for r in sent} == set(every.half.view(np.int64).tolist())
    found = {r.name for r in substring_dedup.repeated_windows(corpus, 13).collect()}
    assert found and found <= set(every.full.view(np.int64).tolist())


def test_longer_repeats(spark):
    shared = [f"s{i}" for i in range(30)]
    rows = [(1, " ".join(["a", *shared])), (2, " ".join(["b", "c", *shared, "d"])), (3, " ".join(shared[:7]))]
    found = substring_dedup.repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), 6)
    longest = substring_dedup.longer_repeats(found, 6)
    at = F.col("place").bitwiseAND((1 << 40) - 1)
    assert longest.filter((F.col("doc") == 1) & (at == 1)).first()["words"] == 24
    assert longest.filter(F.col("doc") == 3).agg(F.max("words")).first()[0] == 6


def test_contamination(corpus, benchmark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in benchmark.collect():
        w = word.findall(lower(text))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    want = collections.Counter()
    for i, text, *_ in small_corpus():
        w = word.findall(lower(text))
        hit, items = set(), set()
        for key, names in windows.items():
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k : k + len(key)]) == key:
                    hit.update(range(k, k + len(key)))
                    items |= names
        want[i, len(w), len(hit), ",".join(sorted(items))] += 1
    for block_words in (decontaminate.BLOCK_WORDS, 20):  # one block, and several
        got = decontaminate.contamination(corpus, benchmark, block_words=block_words)
        got = got.select("doc_id", "n_words", decontaminate.covered_words(F.col("spans")), F.concat_ws(",", "items"))
        assert bag(got.collect()) == want
        clean = decontaminate.clean(corpus, benchmark, block_words=block_words)
        assert clean.columns == corpus.columns
        assert clean.count() == sum(n for (_, _, hit, _), n in want.items() if not hit)


def test_mix(corpus):
    rows = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in corpus.collect()]
    got = mixing.mix(corpus).collect()
    assert collections.Counter((r.doc_id, r.source, r.size) for r in got) == collections.Counter(rows)
    sizes = collections.Counter()
    for _, source, n in rows:
        sizes[source] += n
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(sources)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 2 * sizes[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s], left = 2.0 * sizes[s], left - 2 * sizes[s]
        free -= full
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(v.words for v in r.visits)
        taken[r.source] += r.taken
    for s in sources:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(corpus.repartition(5)).collect()), key=str)


def test_positions_follow_the_demand(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "s") for i in range(200)], "doc_id long, text string, source string")
    got = mixing.training_order(docs, weights=(1.0,), curriculum=((0.5, 1.0, 1.5),)).collect()
    positions = [r.position for r in got]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    for t in (0.25, 0.5, 0.75):  # the running integral of 0.5 + t
        assert sum(p < t for p in positions) / len(positions) == pytest.approx(0.5 * t + t * t / 2, abs=0.01)


def test_base_scores(corpus):
    docs = [(i, [*WORD.findall(lower(t)), ""]) for i, t, *_ in small_corpus()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = collections.Counter(w for i, words in docs if not out(i) for w in words)
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((str(i), out(i), len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w), 6)) for i, w in docs)
    for frequent in (30, 1000):  # with and without rare words
        got = language_model.score_documents(corpus, frequent).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
        assert all(r.train_tokens == total and r.score < 0 for r in got)


def test_network_is_a_distribution_and_gradients_are_right():
    np = language_model.np
    random = np.random.default_rng(0)
    words = np.sort(random.integers(1, 2**63, 60, dtype=np.uint64))
    v = language_model.Vocabulary(np.append(words, language_model._END)[np.argsort(np.append(words, language_model._END))], random.integers(0, 50, 61), 2000, 80)
    net = language_model.Network(v)
    h = random.normal(0, 1, (1, language_model.STATE)).astype(np.float32)
    ids = np.arange(61)
    total = np.exp(net.log_probability(np.repeat(h, 61, 0), ids)).sum() + np.exp(net.log_probability(h, np.array([-1])))[0]
    assert total == pytest.approx(1, abs=1e-4)

    x, y, there = random.integers(0, v.inputs, (5, 3)), random.integers(-1, 61, (5, 3)), np.ones((5, 3), bool)
    there[3:, 2] = False
    h0 = random.normal(0, 0.5, (3, language_model.STATE))
    net = language_model.Network(v, [p.astype(np.float64) for p in net.p])
    large = v.small[np.where(y >= 0, v.group[y], v.groups - 1)]
    loss = lambda: -(net.log_probability(net.run(h0, x)[there], y[there])).mean()
    grads, _ = net.gradient(h0, x, y, there)
    assert (large >= 0).any()
    for p, g in zip(net.p, grads, strict=True):
        for k in random.choice(np.flatnonzero(np.abs(g).ravel() > 1e-6), 4):
            old = p.ravel()[k]
            p.ravel()[k] = old + 1e-3
            up = loss()
            p.ravel()[k] = old - 1e-3
            down = loss()
            p.ravel()[k] = old
            assert (up - down) / 2e-3 == pytest.approx(g.ravel()[k], rel=0.02, abs=1e-5)


def test_every_training_word_is_learned_from(spark, corpus):
    rows = language_model._documents(corpus)
    v = language_model.vocabulary(language_model.count_words(rows))
    net, learned = language_model.learned_from(iter(rows.toArrow().to_batches()), v)
    assert learned == v.tokens > 1000
    assert sum(len(WORD.findall(t or "")) + 1 for i, t, *_ in small_corpus() if i is None or zlib.crc32(str(i).encode()) % 5 != 1) == learned


def test_every_frequent_word_has_weights_and_an_input():
    np = language_model.np
    n = 6000
    v = language_model.Vocabulary(np.append(np.arange(1, n, dtype=np.uint64), language_model._END), np.maximum(40_000 // np.arange(1, n + 1), 1), 500_000, 9000)
    sizes = np.bincount(v.group, minlength=v.groups)
    assert sizes.max() > language_model.SMALL**2 and ((v.small >= 0) == (sizes > 1)).all()
    assert len({tuple(way) for way in np.stack([v.group, *v.nodes, *v.places]).T.tolist()}) == n
    net = language_model.Network(v)
    h = np.random.default_rng(0).normal(0, 1, (1, language_model.STATE)).astype(np.float32)
    before = net.log_probability(np.repeat(h, n, 0), np.arange(n))
    assert np.exp(before).sum() + np.exp(net.log_probability(h, np.array([-1])))[0] == pytest.approx(1, abs=1e-4)
    net.p[4][:] = np.random.default_rng(1).normal(0, 1, net.p[4].shape)
    after = net.log_probability(np.repeat(h, n, 0), np.arange(n))
    assert ((before != after) == (sizes[v.group] > 1)).all()
    assert len(np.unique(v.above[:n])) == v.groups - 1 and v.inputs == n + v.groups


def test_vocabulary_grows_with_the_training_words(spark):
    counts = spark.range(40_000).selectExpr("id AS word", "if(id < 100, 1000000L, 1L) AS n")
    assert len(language_model.vocabulary(counts, 30).words) == 31
    assert len(language_model.vocabulary(counts).words) == 40_001


def test_cuckoo_index_inserts_deletes_and_grows(spark):
    digest = lambda i: hashlib.sha256(str(i).encode()).hexdigest()
    shard = exact_dedup.Shard()
    for i in range(3000):
        shard.insert(digest(i % 2000), i, i, 1)
    assert shard.keys == 2000 and shard.filter.buckets > 16
    assert all(digest(i) in shard.filter and shard.find(digest(i)) for i in range(2000))
    assert shard.find(digest(500))[1:] == [2500, 2500, 2]
    wrong = sum(digest(i) in shard.filter for i in range(10_000, 30_000))
    assert wrong < 100 and not any(shard.find(digest(i)) for i in range(10_000, 11_000))
    for i in range(0, 2000, 2):
        assert shard.delete(digest(i))
    assert not shard.delete(digest(0)) and shard.keys == 1000
    assert all((shard.find(digest(i)) is not None) == (i % 2 == 1) for i in range(2000))

    rows = lambda ids: spark.createDataFrame([(digest(i), i, i, 1) for i in ids], exact_dedup.KEYS)
    index = exact_dedup.update(exact_dedup.empty_index(spark), rows(range(300)), shards=4)
    index = exact_dedup.update(index, rows([5, 300, 301]), rows([7, 8, 999]).select("sha"), shards=4)
    held = {r.sha: r.size for r in index.filter("sha is not null").collect()}
    assert held == {digest(i): 2 if i == 5 else 1 for i in range(302) if i not in (7, 8)}
    for r in index.filter("sha is null").collect():
        table = exact_dedup.CuckooFilter(table=bytes(r["filter"]))
        own = [x.sha for x in index.filter(f"shard = {r.shard} and sha is not null").collect()]
        assert all(sha in table for sha in own) and (table.table > 0).sum() == len(own)


def test_components(spark):
    from gridagro.llm.components import components

    links = [(i + 1, i) for i in range(60)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 201), (201, 200), (5, 5), (300, 301), (301, 302), (302, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 300: 300, 301: 300, 302: 300}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


@pytest.mark.parametrize("ids", ["null", "one"])
def test_repeats_of_many_texts_without_a_doc_id_of_their_own(spark, ids):
    """Thousands of texts share a doc_id, so some share what tells them apart on the way, too."""
    passage = prose(77, 20)
    rows = [(1, f"{passage} unlike {prose(78, 16)}")]
    rows += [(None if ids == "null" else 7, f"{passage} {prose(1000 + i, 5)}" if i % 2 else prose(20_000 + i, 16 + i % 21)) for i in range(6000)]
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = collections.Counter()
    for k, (doc, text) in enumerate(rows):
        words = text.split()
        gone = 20 if k and text.startswith(passage) else 0
        want[(doc, len(words), gone, " ".join(words[gone:]))] += 1
    assert got == want


def test_base_scores_of_many_texts_without_a_doc_id(spark):
    texts = [prose(50_000 + i, 3 + i % 4) for i in range(5000)]
    rows = [(None, t) for t in texts] + [(2, texts[0]), (2, "a b")]
    counts = collections.Counter(w for _, t in rows for w in [*t.lower().split(), None])  # neither null nor 2 is held out
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((len(t.split()) + 1, round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in [*t.lower().split(), None]), 6)) for _, t in rows)
    got = language_model.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), frequent=20).collect()
    assert sorted((r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total} and not any(r.held_out for r in got)
