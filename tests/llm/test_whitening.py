"""Whitening: the eigensolver and the whole operator against a dense solver, edge rows."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import whitening as W
from shelfwise.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def matrices():
    r = np.random.default_rng(4)
    q = np.linalg.qr(r.standard_normal((30, 30)))[0]
    yield from (x @ x.T for x in (r.standard_normal((n, n)) for n in (1, 2, 3, 9, 64)))
    yield np.zeros((5, 5))
    yield np.eye(12)
    yield np.diag([3.0, 3, 3, 2, 2, 1, 1, 1, 1, 0])
    yield 1e9 * np.outer(np.ones(11), np.ones(11))
    yield (lambda x: 1e-8 * x @ x.T)(r.standard_normal((40, 3)))
    yield q @ np.diag([5.0] * 6 + [1.0] * 24) @ q.T
    yield q @ np.diag(5 + 1e-9 * np.arange(30)) @ q.T
    yield np.diag(abs(np.arange(-10, 11.0))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)


@pytest.mark.parametrize("a", list(matrices()))
def test_leading_eigenpairs(a):
    values, vectors = W.leading_eigenpairs(a, 8)
    size, k = max(np.abs(a).max() * len(a), 1e-300), min(8, len(a))
    assert np.allclose(values / size, np.linalg.eigvalsh(a)[::-1][:k] / size, atol=1e-13)
    assert np.abs(a @ vectors - vectors * values).max() / size < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_sturm_counts_count_eigenvalues():
    r = np.random.default_rng(5)
    x = r.standard_normal((20, 20))
    d, e, _ = W.tridiagonal(x + x.T)
    at = np.linspace(-15, 15, 101)
    values = np.linalg.eigvalsh(x + x.T)
    assert W.sturm_counts(d, e, at).tolist() == [(values < p).sum() for p in at]


def expected(rows, k=8):
    """Usable rows, their deviations, whitened coordinates and shares by a dense solver."""
    ok = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    m = np.floor(1024 * np.array([v for _, v in ok], np.float32).astype(float)).astype(int) + 100_000
    n, s = len(m), m.sum(axis=0)
    dev = ((n * m.astype(object) - s.astype(object)) ** 2).sum(axis=1)
    e, u = np.linalg.eigh(np.cov(m.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    return [i for i, _ in ok], dev, (m - s / n) @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def sample(n, d, seed=0):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d)) * np.linspace(1, 3, d)
    return [(i, [float(np.float32(c)) for c in v], i % 3) for i, v in enumerate(x)]


def test_whitened_vectors_equal_a_dense_solver(spark, tmp_path):
    rows = sample(300, 12) + [(900, None, 1), (901, [None] + [0.0] * 11, 1), (902, [float("nan")] * 12, 1),
                              (903, [float("inf")] + [1.0] * 11, 1), (904, [], 1), (905, [1.0, 2.0], 1)]
    rows += [rows[5]] * 150                        # a third of all rows the same vector
    spark.createDataFrame(rows, VECTORS).repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = QUERIES["op12_whitening"](spark, str(tmp_path)).collect()
    ids, dev, white, share = expected([r for r in rows if r[0] != 905])
    assert len(out) == 8 * len(ids) and {r["component"] for r in out} == set(range(1, 9))
    assert all(r["n"] == len(ids) and r["identity_error"] < 1e-9 for r in out)
    by = {(r["vec_id"], r["component"]): r for r in out}
    for k in range(8):
        sign = np.sign(by[(0, k + 1)]["whitened"] * white[0, k])
        for i, x, w in zip(ids, dev, white):
            r = by[(i, k + 1)]
            assert r["deviation"] == x and abs(sign * r["whitened"] - w[k]) < 1e-8 and abs(r["explained"] - share[k]) < 1e-12


def test_exact_deviation_beyond_longs():
    m = np.array([[1 << 40, -(1 << 45)], [3, 5]], np.int64)
    sums = [int(x) for x in m.sum(axis=0) * (1 << 20)]
    n = 1 << 21
    assert [int(x) for x in W.deviations(m, n, sums)] == [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in m]


def test_tables_without_variance_or_rows(spark):
    assert W.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None, 1), (2, [None], 1)], VECTORS)).count() == 0
    same = W.whiten(spark.createDataFrame([(i, [1.0, 2.0, 3.0], 1) for i in range(9)], VECTORS)).collect()
    assert len(same) == 9 and all(r["whitened"] == [None] * 3 and r["explained"] == [0.0] * 3 and r["deviation"] == 0 for r in same)
    line = [(i, [float(i), 2.0 * i, 0.0], 1) for i in range(20)]
    out = W.whiten(spark.createDataFrame(line, VECTORS)).collect()
    assert all(r["whitened"][1:] == [None, None] and r["whitened"][0] is not None for r in out)
    assert abs(sum(r["whitened"][0] ** 2 for r in out) / 20 - 1) < 1e-9


def test_clashing_names(spark):
    df = spark.createDataFrame(sample(40, 4), VECTORS)
    names = ["x", "d", "c", "n", "deviation", "whitened", "explained", "identity_error", "i", "g", "row", "a.b"]
    out = W.whiten(df.withColumns({c: F.lit("z") for c in names}))
    assert out.count() == 40 and set(out.columns) == {"vec_id", "n", "deviation", "whitened", "explained", "identity_error"}


def test_equal_variances_stay_orthogonal(spark):
    r = random.Random(2)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(6)], 0) for i in range(500)]
    rows += [(i + 1000, [-c for c in v], 0) for i, v, _ in rows]
    out = W.whiten(spark.createDataFrame(rows, VECTORS), components=6).first()
    assert out["identity_error"] < 1e-9 and abs(sum(out["explained"]) - 1) < 1e-12
