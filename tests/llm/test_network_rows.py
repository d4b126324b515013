"""Sums of rows and the parameters for scoring of the network of op8."""

import numpy as np

from gridagro.llm import language_model as lm


def test_sums_of_rows_with_short_and_long_runs():
    random = np.random.default_rng(4)
    rows = np.sort(np.concatenate([random.integers(0, 400, 600), np.full(300, 7), np.full(lm.MANY, 500), np.full(lm.MANY + 1, 501)]))
    d, h = random.normal(size=(len(rows), lm.SMALL)), random.normal(size=(len(rows), lm.STATE))
    expected = np.zeros((502, lm.SMALL, lm.STATE))
    np.add.at(expected, rows, d[:, :, None] * h[:, None, :])
    names, times, (weights, shares) = lm._node_sums(rows, d, h)
    assert (times == np.bincount(rows)[names]).all() and np.allclose(weights, expected[names])
    again, _, plain = lm._sums(rows, d)
    assert (again == names).all() and np.allclose(plain, shares)


def test_scoring_with_sums_equals_two_lookups():
    random = np.random.default_rng(5)
    words = np.append(random.integers(1, 2**63, 300, dtype=np.uint64), lm._END)
    words.sort()
    v = lm.Vocabulary(words, random.integers(1, 90, 301), 20_000, 900)
    net = lm.Network(v)
    net.p[0][:] = random.normal(size=net.p[0].shape)
    scoring = lm.Network(v, net.with_sums())
    scoring.summed = True
    x = random.integers(0, v.inputs, (9, 4))
    x[2] = v.inputs - 1
    h = random.normal(size=(4, lm.STATE)).astype(np.float32)
    assert np.allclose(net.run(h, x, []), scoring.run(h, x), atol=1e-5)


def test_class_scores_of_far_texts():
    """A text whose scores are all far below those of another still has finite ones."""
    v = lm.Vocabulary(np.append(np.arange(1, 300, dtype=np.uint64), lm._END), np.ones(300, int), 500, 400)
    net = lm.Network(v)
    net.p[2][:] = 0
    net.p[2][0] = 200.0
    h = np.zeros((2, lm.STATE), np.float32)
    h[:, 0] = 1, -1
    logs = net.log_softmax(h)
    assert np.isfinite(logs).all() and np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)


def test_packs_of_nodes_equal_words_one_by_one():
    """Nodes with one word, some, a pack and more; the words of a text that are not frequent visit none."""
    random = np.random.default_rng(6)
    words = np.append(random.integers(1, 2**63, 900, dtype=np.uint64), lm._END)
    words.sort()
    v = lm.Vocabulary(words, random.integers(1, 90, 901) ** 2, 4_000_000, 2000)
    weights, shares = random.normal(size=(len(v.start), lm.SMALL, lm.STATE)), random.normal(size=(len(v.start), lm.SMALL))
    ids = np.concatenate([random.integers(-1, 901, 120), np.full(5 * lm.PACK + 1, 17), np.full(lm.PACK, 400), np.full(3, -1)])
    h = random.normal(size=(len(ids), lm.STATE))
    visits = lm.Visits(v, ids)
    scores = visits.scores(h, weights, shares)
    d = random.normal(size=scores.shape)
    towards, (names, times, (by_node, by_share)) = visits.backwards(d)
    assert 0 < visits.busy < len(d) and (v.ids(words[::-1]) == np.arange(901)[::-1]).all() and (v.ids(words + 1) == -1).all()
    plain = np.einsum("nij,nj->ni", weights[visits.node], h[visits.some]) + shares[visits.node]
    assert np.allclose(scores, plain - plain.max(axis=1, keepdims=True))
    assert np.allclose(towards, np.einsum("ni,nij->nj", d, weights[visits.node]))
    expected, plain_shares = np.zeros_like(weights), np.zeros_like(shares)
    np.add.at(expected, visits.node, d[:, :, None] * h[visits.some][:, None, :])
    np.add.at(plain_shares, visits.node, d)
    assert np.allclose(by_node, expected[names]) and np.allclose(by_share, plain_shares[names]) and (times == np.bincount(visits.node)[names]).all()
    out, summed = np.zeros_like(h), np.zeros_like(h)
    visits.add(out, towards)
    np.add.at(summed, visits.some, towards)
    assert np.allclose(out, summed)
    listed = sorted((i, n, p) for some, node, place in v.ways(ids) for i, n, p in zip(some, node, place))
    assert sorted(zip(visits.some, visits.node, visits.place)) == listed
    for few in (np.zeros(0, int), np.array([-1])):
        assert len(lm.Visits(v, few).scores(h[: len(few)], weights, shares)) == 0
