"""Eigenvectors and whitened vectors against a dense solver and exact whole numbers."""

import os

import numpy as np
import pytest

from gridagro.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, vec string"


def spectrum(kind, d):
    return {"flat": 1 + np.arange(d) / d / 10, "falling": 0.8 ** np.arange(d), "equal": np.ones(d), "low": np.r_[np.ones(min(d, 3)), np.zeros(max(0, d - 3))]}[kind]


@pytest.mark.parametrize("kind, d", [("flat", 64), ("falling", 64), ("equal", 64), ("low", 64), ("flat", 5), ("flat", 2), ("flat", 1), ("falling", 150)])
def test_leading_pairs_of_known_matrices(kind, d):
    q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    a = (q * spectrum(kind, d)) @ q.T * 50
    a = (a + a.T) / 2
    found = whitening.jacobi_davidson(lambda x: a @ x, d, 4)
    values = np.sort(np.linalg.eigvalsh(a))[::-1][: min(4, d)]
    assert np.allclose(found.values, values, rtol=0, atol=1e-12 * values[0])
    assert np.linalg.norm(a @ found.vectors - found.vectors * found.values, axis=0).max() < 1e-13 * values[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(values))).max() < 1e-14


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    a = (q * np.r_[-3, -1, np.linspace(0.5, 4, 10)]) @ q.T
    b = np.column_stack([rng.standard_normal(12), np.zeros(12), q[:, 0]])
    x = whitening.minres(lambda v: a @ v, b, 12)
    assert np.allclose(a @ x, b, atol=1e-9) and not x[:, 1].any()


def dense(vectors, k=4):
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - s).astype(object) ** 2).sum(axis=1), (x - s / n) @ u / np.sqrt(e), e / np.trace(v)


def check(rows, ids, vectors):
    n, deviation, white, explained = dense(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert sorted(got) == sorted(set(ids))
    signs = {}
    for i, v in enumerate(ids):
        assert sorted(got[v]) == [1, 2, 3, 4]
        for c in range(4):
            r = got[v][c + 1][0]
            assert (r.n, r.deviation) == (n, deviation[i]) and r.explained == pytest.approx(explained[c], rel=1e-10) and r.identity_error < 1e-10
            sign = signs.setdefault(c, np.sign(r.whitened * white[i, c]))
            assert r.whitened == pytest.approx(sign * white[i, c], abs=1e-8)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((60, 6)) * np.arange(1, 7)).astype(np.float32).tolist()
    rows = [(i, v, "own") for i, v in enumerate(vectors)]
    odd = [(100, None, ""), (101, [None, *vectors[0][1:]], ""), (102, [float("nan"), *vectors[0][1:]], ""), (103, [float("-inf"), *vectors[0][1:]], ""), (104, [], ""), (105, [1.0, 2.0], ""), (106, [*vectors[0], 1.0], "")]
    df = spark.createDataFrame([*rows, *odd, rows[3], rows[3], (200, vectors[4], "copy")], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    check(got, [*range(60), 200], [*vectors, vectors[4]])
    assert len(got) == 4 * 63 and len({r.identity_error for r in got}) == 1
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([rows[0], rows[0]], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame(odd[:5], SCHEMA)).count() == 0
    two = whitening.whiten(spark.createDataFrame([rows[0], rows[1], (None, vectors[1], "")], SCHEMA)).collect()
    assert [r.component for r in two] == [1] * 3 and {abs(round(r.whitened, 9)) for r in two} == {1.0} and [r.vec_id for r in two].count(None) == 1


def test_large_and_negative_entries(spark):
    rows = [(1, [1e30, -0.0]), (2, [-1e30, 0.001]), (3, [0.0, -0.001]), (4, [2e15, 5.0]), (5, [-3e15, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=2).collect()
    x = [[min(max(int(np.floor(256.0 * c)), -(2**63)), 2**63 - 1) for c in v] for _, v in rows]
    s = [sum(v[k] for v in x) for k in range(2)]
    exact = {i: min(sum((5 * v[k] - s[k]) ** 2 for k in range(2)), 2**63 - 1) for (i, _), v in zip(rows, x, strict=True)}
    assert {r.vec_id: r.deviation for r in got} == exact
    assert x[2] == [0, -1] and x[0][1] == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_query_against_a_dense_solver(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = queries.QUERIES["op12_whitening"](spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check(got.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])
