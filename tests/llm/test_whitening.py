"""Whitening against a dense solver, and its awkward inputs."""

import numpy as np
import pytest

from touchline.llm.op12_whitening import jacobi_davidson, minres, summed, whiten

SF001 = "/root/testdata/sf0.001"


def dense(vectors):
    """n, exact deviations, whitened rows and explained shares of the vectors that count."""
    x = np.floor(64 * np.array(vectors, float)).astype(object) + 1_000_000
    x = np.array([[int(e) for e in row] for row in x], object)
    n, s = len(x), x.sum(axis=0)
    z = x * n - s
    deviation = [int(d) for d in (z * z).sum(axis=1)]
    y = z.astype(float) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(32, len(e))
    return n, deviation, y @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v), v


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, x int, v int")


def check(got, ids, vectors):
    n, deviation, white, explained, _ = dense(vectors)
    k = white.shape[1]
    assert len(got) == len(ids) * k
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    found = np.array([[by[c + 1][i][0].whitened for c in range(k)] for i in ids])
    sign = np.sign((found * white).sum(axis=0))
    assert np.abs(found * sign - white).max() < 1e-8
    assert np.abs(np.array([by[c + 1][ids[0]][0].explained for c in range(k)]) / explained - 1).max() < 1e-9
    assert [by[1][i][0].deviation for i in ids] == deviation
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9


def test_query_equals_dense_solver(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = whiten(spark.read.parquet(f"{SF001}/embeddings.parquet")).collect()
    check(got, [r.vec_id for r in rows], [r.embedding for r in rows])


def test_awkward_vectors(spark):
    random = np.random.default_rng(3)
    good = [(i, random.normal(size=3).tolist()) for i in range(20)] + [(50, [0.5, -1.0, 2.0]), (51, [0.5, -1.0, 2.0])]
    bad = [(60, None), (61, [1.0, None, 2.0]), (62, [1.0, float("nan"), 0.0]), (63, [float("inf"), 0.0, 0.0]),
           (64, [1e300, 0.0, 0.0]), (65, [1.0, 2.0]), (66, [])]
    got = whiten(embeddings(spark, good + bad)).collect()
    check(got, [i for i, _ in good], [v for _, v in good])


def test_nothing_to_whiten(spark):
    assert whiten(embeddings(spark, [])).count() == 0
    assert whiten(embeddings(spark, [(1, None)])).count() == 0
    assert whiten(embeddings(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0      # no variance
    assert whiten(embeddings(spark, [(1, [1.0, 2.0]), (2, [3.0, 4.0])])).count() == 2       # one component


def test_sums_of_many_partitions(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("array(id, 2 * id) AS x").repartition(20)
    monkeypatch.setattr("touchline.llm.op12_whitening.SUMS_AT_ONCE", 4)
    assert summed(rows, lambda x: x.sum(axis=0)).tolist() == [2999 * 1500, 2999 * 3000]


@pytest.mark.parametrize("d, k", [(1, 1), (2, 2), (5, 2), (60, 7), (120, 32)])
def test_eigenvectors(d, k):
    random = np.random.default_rng(d)
    a = random.normal(size=(d, d))
    a = a @ a.T
    values, vectors = jacobi_davidson(lambda b: a @ b, d, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    assert np.abs(values - want).max() < 1e-12 * want[0]
    assert np.abs(a @ vectors - vectors * values).max() < 1e-11 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_repeated_and_zero_eigenvalues():
    a = np.zeros((40, 40))
    a[:4, :4] = np.diag([5, 5, 5, 1])
    values, vectors = jacobi_davidson(lambda b: a @ b, 40, 6)
    assert np.allclose(values, [5, 5, 5, 1, 0, 0], atol=1e-12)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12


def test_minres_solves_shifted_systems():
    random = np.random.default_rng(2)
    a = np.diag(np.arange(1.0, 31))
    fixed, right = np.eye(30)[:, -1:], random.normal(size=(30, 2))
    shifts = np.array([29.5, 40.0])
    got = minres(lambda b: a @ b, shifts, right, fixed, 60)
    for j in range(2):
        left = (a - shifts[j] * np.eye(30)) @ got[:, j] - right[:, j]
        assert np.linalg.norm(left[:-1]) < 1e-2 * np.linalg.norm(right) and abs(got[-1, j]) < 1e-12
