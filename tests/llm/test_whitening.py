"""Operator 13 against a dense eigendecomposition and exact integers."""

import math

import numpy as np
import pytest

from strata.llm import whitening


def brute_force(vectors, k):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, total, strict=True)] for v in x])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, deviation, centred @ u / np.sqrt(e), e / np.trace(cov)


@pytest.mark.parametrize("dim, n, k", [(12, 300, 12), (50, 400, 32), (5, 40, 3)])
def test_whitened_vectors(spark, dim, n, k):
    rng = np.random.default_rng(dim)
    vectors = (rng.standard_normal((n, dim)) * np.linspace(2, 0.5, dim)).round(3)
    vectors[7] = vectors[6]  # a repeated vector
    odd = [(1000, None, 0.0), (1001, [None] * dim, 0.0), (1002, [math.nan] * dim, 0.0), (1003, [math.inf] * dim, 0.0), (1004, [1.0], 0.0), (1005, [1e300] * dim, 0.0), (1006, [], 0.0)]
    rows = [(i, v.tolist(), 1.5) for i, v in enumerate(vectors)] + odd
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x double")
    got = whitening.whiten(df, k).orderBy("vec_id", "component").collect()
    count, deviation, whitened, explained = brute_force(vectors.tolist(), k)
    assert [(r.vec_id, r.component) for r in got] == [(i, c + 1) for i in range(n) for c in range(k)]
    assert {r.n for r in got} == {count}
    assert [r.deviation for r in got[::k]] == deviation
    w = np.array([r.whitened for r in got]).reshape(n, k)
    w *= np.sign((w * whitened).sum(axis=0))
    assert np.abs(w - whitened).max() < 1e-8
    assert np.abs(np.array([r.explained for r in got[:k]]) - explained).max() < 1e-12
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    # One direction only, and ids that are null or repeated.
    flat = [(None, [0.0, 1.0]), (3, [1.0, 1.0]), (3, [2.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(flat, schema)).collect()
    assert sorted((str(r.vec_id), r.component, r.deviation) for r in got) == [("3", 1, 0), ("3", 1, 192**2), ("None", 1, 192**2)]
    assert [r.explained for r in got] == pytest.approx([1.0] * 3)


@pytest.mark.parametrize("dim, wanted, kind", [(160, 32, "flat"), (160, 32, "falling"), (90, 4, "paired"), (70, 70, "flat")])
def test_jacobi_davidson_finds_the_largest_pairs(dim, wanted, kind):
    rng = np.random.default_rng(wanted)
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    e = {"flat": rng.uniform(50, 60, dim), "falling": np.geomspace(1e4, 1e-2, dim), "paired": np.repeat(np.linspace(9, 1, dim // 2), 2)}[kind]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    widest = []

    def product(block):
        widest.append(block.shape[1])
        return a @ block

    values, vectors = whitening.jacobi_davidson(product, dim, wanted)
    want = np.sort(e)[::-1][:wanted]
    assert np.abs(values - want).max() < 1e-12 * want[0]
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-11 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12
    assert max(widest) <= 2 * whitening.BLOCK


def test_minres_solves_every_column():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T  # indefinite
    b = np.column_stack([rng.standard_normal((30, 3)), np.zeros(30)])
    x = whitening.minres(lambda t: a @ t, b, 200, 1e-12)
    assert np.abs(a @ x - b).max() < 1e-8 and not x[:, 3].any()
