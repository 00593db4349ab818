from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from salesmart.llm import whitening
from salesmart.llm.whitening import leading_eigenvalues, principal_components, sturm_counts, tridiagonal, whiten


def frame(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")


def numbers(vectors, dims):
    x = [[np.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for v in vectors]
    return np.array(x).astype(np.int64)


def reference(x, k):
    off = (x * len(x) - x.sum(0)) / len(x)
    covariance = off.T @ off / len(x)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return off, covariance, values, vectors


def check(got, vectors, ids, dims, k=32):
    x = numbers(vectors, dims)
    off, covariance, values, components = reference(x, k)
    total, n = [int(v) for v in x.sum(0)], len(x)
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(rows) == len(got) == n * len(values)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    table = np.array([[rows[i, c + 1].whitened for c in range(len(values))] for i in ids])
    for c, e in enumerate(values):
        want = off @ components[:, c] / np.sqrt(e)
        assert np.allclose(table[:, c] * np.sign(table[:, c] @ want), want, atol=1e-6)
        assert all(abs(rows[i, c + 1].explained * np.trace(covariance) / e - 1) < 1e-9 for i in ids)
    for i, row in zip(ids, x.tolist(), strict=True):
        assert rows[i, 1].deviation == sum((n * a - s) ** 2 for a, s in zip(row, total, strict=True))
        assert rows[i, 1].n == n


def test_equals_plain_eigenvectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(1)
    vectors = (rng.normal(0, 1, (400, 40)) @ np.diag(np.linspace(6, 0.5, 40)) + 3).astype(np.float32).tolist()
    odd = [None, [1.0] * 39 + [None], [float("nan")] * 40, [float("-inf")] + [0.0] * 39]
    got = whiten(frame(spark, vectors + odd).repartition(5)).collect()
    check(got, vectors, range(400), 40)


def test_fewer_dimensions_repeated_and_short_vectors(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 4, (60, 6)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 100 + [vectors[1][:3], []]
    check(whiten(frame(spark, vectors)).collect(), vectors, range(len(vectors)), 6)


def test_components_without_variance_are_left_out(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 4, (5, 50)).astype(np.float32).tolist()
    got = whiten(frame(spark, vectors)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and len(got) == 20
    assert whiten(frame(spark, [[1.0, 2.0]])).collect() == []
    assert whiten(frame(spark, [[1.0, 2.0]] * 9)).collect() == []


def test_no_usable_vector(spark):
    none = frame(spark, [None, [float("nan")]])
    assert whiten(none).collect() == [] and whiten(none.limit(0)).collect() == []
    assert whiten(none).columns == whiten(frame(spark, [[1.0], [2.0]])).columns


def test_clashing_columns_and_null_ids(spark):
    df = frame(spark, [[1.0, 5.0], [2.0, 1.0], [4.0, 1.0]]).selectExpr("nullif(vec_id, 1) as vec_id", "embedding", "1 as n", "2 as deviation")
    got = whiten(df).collect()
    assert len(got) == 6 and sum(r.vec_id is None for r in got) == 2


def test_deviation_is_exact_or_null():
    total = [10**15 + 7, -(10**15) - 3]
    x = np.array([[10**6 + 5, 10**6 - 9]])
    off = whitening.centred(x, 10**9, total)
    assert [int(v) for v in off[0]] == [10**9 * int(a) - s for a, s in zip(x[0], total, strict=True)]


def test_entries_beyond_exact_sums_are_an_error(spark):
    with pytest.raises(Exception, match="beyond the range of exact sums"):
        whiten(frame(spark, [[1e30], [1.0]])).collect()


@pytest.mark.parametrize("kind", ["random", "equal", "diagonal", "pairs", "rank"])
def test_components_of_difficult_matrices(kind):
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    spectrum = {
        "random": np.sort(rng.uniform(0.1, 50, 64))[::-1], "equal": np.array([9.0] * 20 + [2.0] * 44),
        "diagonal": np.arange(64.0, 0, -1), "pairs": np.repeat(np.arange(32.0, 0, -1), 2) * (1 + 1e-13 * np.arange(64)),
        "rank": np.array([5.0, 4.0, 3.0] + [0.0] * 61),
    }[kind]
    matrix = np.diag(spectrum) if kind == "diagonal" else (q * spectrum) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = principal_components(matrix, 32)
    assert len(values) == (3 if kind == "rank" else 32)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][: len(values)], rtol=1e-12)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-11 * values[0]


def test_tridiagonal_form_and_sturm_counts():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    diagonal, off, reflections = tridiagonal(a)
    exact = np.linalg.eigvalsh(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(np.linalg.eigvalsh(t), exact) and len(reflections) == 28
    at = np.linspace(exact[0] - 1, exact[-1] + 1, 57)
    assert list(sturm_counts(diagonal, off, at)) == [(exact < x).sum() for x in at]
    assert np.allclose(leading_eigenvalues(diagonal, off, 30), exact[::-1], atol=1e-12)
    assert np.allclose(leading_eigenvalues(np.array([3.0]), np.array([]), 1), 3)
