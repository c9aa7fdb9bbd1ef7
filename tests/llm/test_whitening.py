"""Whitening against numpy's eigensolver on plain lists; edge cases."""

import math

import numpy as np
import pytest

from conftest import SF001
from riskweave.llm import queries, whitening

ROWS = "vec_id long, embedding array<float>, n string, x string, component string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "n", "x", "c") for i, v in enumerate(vectors)], ROWS)


def brute(vectors):
    kept = {i: v for i, v in vectors.items()
            if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    x = {i: [math.floor(float(np.float32(c)) * 256) for c in v] for i, v in kept.items()}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], vectors.T[::-1]


def check(got, vectors):
    x, n, sums, values, components = brute(vectors)
    k = min(4, len(sums))
    assert sorted((r.vec_id, r.component) for r in got) == [(i, c + 1) for i in sorted(x) for c in range(k)]
    signs = {}
    for r in got:
        assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x[r.vec_id], sums))
        e = values[r.component - 1]
        want = np.dot([c - s / n for c, s in zip(x[r.vec_id], sums)], components[r.component - 1]) / math.sqrt(e)
        assert abs(abs(r.whitened) - abs(want)) < 1e-7
        if abs(want) > 1e-3:
            assert signs.setdefault(r.component, r.whitened * want > 0) == (r.whitened * want > 0)
        assert r.explained == pytest.approx(e / values.sum(), rel=1e-9) and 0 <= r.identity_error < 1e-9


def test_query_against_numpy(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    check(queries.QUERIES["op13_embedding_whitening"](spark, SF001).collect(), {r.vec_id: r.embedding for r in rows})


def test_rows_that_are_dropped_and_repeated(spark):
    r = np.random.default_rng(2)
    good = [r.normal(size=5).tolist() for _ in range(60)]
    vectors = [*good, *[good[0]] * 40, None, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5,
               [1.0, 2.0, float("inf"), 0.0, 0.0], [1e2, -1e2, 0.5, 0.0, 3.0]]
    check(whitening.whiten(spark, table(spark, vectors)).collect(), dict(enumerate(vectors)))
    odd = whitening.whiten(spark, table(spark, [*vectors, [1.0, 2.0], []])).collect()
    assert {x.vec_id for x in odd} == {i for i in range(len(vectors)) if i < 100 or i == 104}


def test_tables_without_variance(spark):
    for vectors in ([], [None], [[]], [[], []]):
        assert whitening.whiten(spark, table(spark, vectors)).collect() == []
    alike = whitening.whiten(spark, table(spark, [[1.0, 2.0], [1.0, 2.0]])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alike} == {(1, 0, None, 0.0, 0.0)}
    line = whitening.whiten(spark, table(spark, [[float(i), 2.0 * i, 0.0] for i in range(9)])).collect()
    assert {r.component for r in line if r.whitened is not None} == {1}
    huge = whitening.whiten(spark, table(spark, [[3e38, 1.0], [-3e38, 2.0], [0.0, 5.0]])).collect()
    assert len(huge) == 6 and all(r.deviation is None for r in huge if r.vec_id < 2)


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64, 150])
def test_eigenpairs(d):
    a = np.random.default_rng(d).standard_normal((3 * d, d))
    k = min(4, d)
    for m in (a.T @ a, np.eye(d), np.diag(np.arange(d) // 3 * 1.0), np.ones((d, d)), np.zeros((d, d))):
        values, vectors = whitening.leading_eigenpairs(m, k)
        size = max(1.0, np.abs(m).max() * d)
        assert np.allclose(values, np.linalg.eigvalsh(m)[::-1][:k], atol=1e-13 * size)
        assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-12)
        assert np.abs(m @ vectors.T - vectors.T * values).max() < 1e-12 * size
    diagonal, off, _ = whitening.tridiagonal(a.T @ a)
    at = np.linspace(-1, 4 * d, 7)
    assert whitening.sturm_count(diagonal, off, at).tolist() == [
        int((np.linalg.eigvalsh(a.T @ a) < x).sum()) for x in at]
