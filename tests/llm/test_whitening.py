"""Whitening against a full eigendecomposition, and spectral splits of awkward matrices."""

from collections import defaultdict
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.llm import queries, whitening


def check(got, rows, components=4):
    """Rows of whiten() against whole-number and numpy arithmetic over (id, vector) rows."""
    rows = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and isfinite(c) for c in v)]
    scaled = [(i, tuple(floor(256 * float(c)) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in scaled})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    matrix = centred.T @ centred / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * max(values.sum(), 1e-300)).sum()))
    assert len(got) == k * len(rows)
    by_component = defaultdict(list)
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        by_component[r.component].append((r.vec_id, r.deviation, r.whitened))
    for c in range(1, k + 1):
        want = []
        for i, x in scaled:
            away = np.array([float(Fraction(n * v - s, n)) for v, s in zip(x, sums)])
            want.append((i, sum((n * v - s) ** 2 for v, s in zip(x, sums)), away @ vectors[:, c - 1] / np.sqrt(values[c - 1])))
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        found, want = sorted(by_component[c], key=key), sorted(want, key=key)
        assert [r[:2] for r in found] == [r[:2] for r in want]
        a, b = np.array([r[2] for r in found]), np.array([r[2] for r in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8 * max(1, np.abs(b).max())


def test_query_against_eigh(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(queries.op13_whitening(spark, sf).collect(), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25, 3.0]), (1, [0.5, -0.25, 3.0]), (2, [-0.0, 0.001, -0.001]), (None, [9.0, 8.0, -7.5]),
            (3, None), (4, [1.0, None, 2.0]), (5, [1.0, nan, 2.0]), (6, [1.0, -inf, 2.0]), (7, []),
            (8, [2.5, 1.25, 0.125]), (9, [400.0, -300.0, 5.0]), (10, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn(
        "n", F.lit("a")).withColumn("a.b", F.lit(2))
    check(whitening.whiten(df).collect(), rows)
    assert whitening.whiten(df.where("false")).collect() == []
    assert whitening.whiten(df.where("vec_id = 1")).collect() == []
    two = [r for r in rows if r[0] in (1, 8)]
    check(whitening.whiten(spark.createDataFrame(two, df.select("vec_id", "embedding").schema)).collect(), two)


def test_large_whole_numbers(spark):
    """Sums beyond doubles stay exact; a deviation beyond a long is null; a length that is rare is left out."""
    rows = [(i, [2.0 ** 40 + i, -3.0 * i, float(i % 2)]) for i in range(6)]
    df = spark.createDataFrame(rows + [(99, [1.0])], "vec_id long, embedding array<double>")
    model = whitening.fit_whitening(df, "embedding")
    assert model.sums == [sum(floor(256 * v[j]) for _, v in rows) for j in range(3)]
    check([r for r in whitening.whiten(df).collect()], rows)
    far = spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 1.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(far).collect()} == {None}


def matrices():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 12))
    turn = np.linalg.qr(rng.standard_normal((9, 9)))[0]
    yield "covariance", base.T @ base / 40
    yield "diagonal", np.diag([3.0, 1.0, 2.0, 2.0, 5.0])
    yield "identity", np.eye(6)
    yield "zero", np.zeros((4, 4))
    yield "one", np.array([[2.5]])
    yield "equal diagonal", np.full((5, 5), 0.5) + 0.5 * np.eye(5)
    yield "pairs", turn @ np.diag([4, 4, 4, 2, 2, 1, 1, 1, 1.0]) @ turn.T
    yield "wide range", turn @ np.diag([1e8, 1e4, 1, 1, 1e-3, 1e-6, 1e-9, 0, 0]) @ turn.T
    yield "close", turn @ np.diag([1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5, 0.2, 0.1, 0.05, 0.01]) @ turn.T
    yield "rank one", np.outer(np.arange(1, 8.0), np.arange(1, 8.0))


@pytest.mark.parametrize("name, matrix", list(matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_spectral_components(name, matrix):
    scale = max(np.linalg.norm(matrix), 1e-300)
    want = np.linalg.eigvalsh(matrix)[::-1]
    values, vectors = whitening.spectral_components(matrix)
    assert np.abs(values - want).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale
    few, some = whitening.spectral_components(matrix, 3)
    assert np.allclose(few, want[:3], atol=1e-13 * scale) and some.shape[1] == min(3, len(matrix))


def test_polar_factor():
    a = np.diag([3.0, -2.0, 1e-6, -1e-9])
    assert np.allclose(whitening.polar_factor(a), np.diag([1.0, -1, 1, -1]), atol=1e-10)
