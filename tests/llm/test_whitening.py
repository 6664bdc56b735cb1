"""Whitening against an eigendecomposition of the whole covariance, exact sums, degenerate and odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm.whitening import bidiagonalise, exact_sums, op12_whiten, whiten, whole_vectors


def direct(vectors):
    """Whole numbers, centred rows and falling eigenvalues with their vectors."""
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    centred = x - x.sum(0) / len(x)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return x, centred, values[::-1], axes[:, ::-1]


def compare(rows, ids, vectors, k):
    x, centred, values, axes = direct(vectors)
    n = len(x)
    found = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(found) == n * k
    got = np.array([[found[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-9
    deviation = ((n * x.astype(object) - x.sum(0).astype(object)) ** 2).sum(1)
    for i, exact in zip(ids, deviation):
        assert found[i, 1]["deviation"] == exact and found[i, 1]["n"] == n
    for c in range(k):
        assert found[ids[0], c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-10)
    assert rows[0]["identity_error"] < 1e-9


def test_query_on_a_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    compare(op12_whiten(spark, "/root/testdata/sf0.001").collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 8)


@pytest.fixture(scope="module")
def wide(spark):
    """300 dimensions of which few carry most of the variance."""
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((400, 300)) @ np.diag(0.8 ** np.arange(300) + 1e-4) * 40
    return rows, spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>").repartition(3)


def test_steps_end_before_all_dimensions(wide):
    rows, df = wide
    vectors = whole_vectors(df, "vec_id", "embedding")
    n, sums = exact_sums(vectors)
    fit = bidiagonalise(vectors, n, sums, 4)
    _, _, values, axes = direct(rows)
    assert fit.steps < 60
    assert np.allclose(fit.variances, values[:4], rtol=1e-12) and np.allclose(np.abs(np.sum(fit.vectors * axes[:, :4].T, 1)), 1, atol=1e-12)
    assert np.abs(fit.vectors @ fit.vectors.T - np.eye(4)).max() < 1e-14


def test_repeated_eigenvalues_and_flat_dimensions(spark):
    """A cross: two equal variances, one smaller, one dimension without any; each row twice."""
    points = [(s if d == 0 else 0, s if d == 1 else 0, s / 2 if d == 2 else 0, 5) for d in range(3) for s in (-3, 3) for _ in range(2)]
    df = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = whiten(df).collect()
    assert {r["component"] for r in found} == {1, 2, 3} and len(found) == 36
    assert max(r["identity_error"] for r in found) < 1e-12
    explained = sorted({(r["component"], round(r["explained"], 10)) for r in found})
    assert [e for _, e in explained] == [round(4 / 9, 10), round(4 / 9, 10), round(1 / 9, 10)]


def test_incomplete_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (8, [2.0, 5.0]),
            (None, [0.0, 1.0]), (8, [2.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "x", "n", "dim", "component")})
    found = whiten(df).collect()
    assert sorted((r["vec_id"] or 0) for r in found if r["component"] == 1) == [0, 1, 8, 8]
    assert {r["n"] for r in found} == {4} and max(r["identity_error"] for r in found) < 1e-10


def test_nothing_to_whiten(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    for table in (df, df.limit(0), df.withColumn("embedding", F.lit(None).cast("array<float>"))):
        found = whiten(table)
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert found.collect() == []


def test_deviation_is_exact_or_null(spark):
    rows = [(1, [0.0, 0.0]), (2, [500_000.0, 3.0]), (3, [2e9, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows], object)
    exact = [int(v) if v < 2 ** 63 else None for v in ((3 * x - x.sum(0)) ** 2).sum(1)]
    found = {r["vec_id"]: r["deviation"] for r in whiten(df).collect()}
    assert [found[i] for i in (1, 2, 3)] == exact and None in exact
