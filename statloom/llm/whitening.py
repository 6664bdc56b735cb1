"""Embedding whitening: components by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With the centred rows as the matrix X, the method alternates u = X v - beta u' and v = X'u - alpha v' until the leading
singular values of the small bidiagonal matrix have settled. A left vector has an entry per row of the table, so it is
never stored: u = X w for a short vector w that the driver knows, and every task forms its own entries anew. One step
is therefore one pass, in which each task multiplies its rows by w, and the result by its rows; the partial sums of
all tasks, one row per task and dimension, are added by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import staged

SCALE, SHIFT = 1024, 100_000  # an entry c becomes the whole number floor(SCALE * c) + SHIFT
COMPONENTS = 8
SETTLED = 1e-15  # residual of a wanted component, against the largest singular value, at which the steps end
NOTHING = 1e-13  # singular values below this share of the largest are rounding errors: such components do not exist
LONGEST = (1 << 63) - 1


def whole_vectors(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, x`` (array of long) of the rows whose vector is complete: as long as the longest, no null, NaN or infinity."""
    value = col(vector)
    fine = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    kept = rows.where(value.isNotNull() & (F.size(value) > 0) & fine)
    x = F.transform(value, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    made = staged(kept.select(col(id).alias("id"), x.cast("array<bigint>").alias("x")), "vectors")
    size = made.agg(F.max(F.size("x"))).first()[0] or 0
    return made.where(F.size("x") == size)


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of an array column, which all have one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def sums_by_dimension(partial: DataFrame) -> list:
    """Partial rows ``dim, ...`` of all tasks added up, in order of dimension: one row per dimension to the driver."""
    rest = [c for c in partial.columns if c != "dim"]
    found = partial.groupBy("dim").agg(*[F.sum(c).alias(c) for c in rest]).collect()
    return sorted(found, key=lambda r: r["dim"])


def exact_sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows and the exact sum of every dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sums = matrix(batch.column(0)).sum(0)
                yield pa.RecordBatch.from_pydict({"dim": np.arange(len(sums), dtype=np.int32), "s": sums,
                                                  "n": np.full(len(sums), batch.num_rows, np.int64)})
    found = sums_by_dimension(vectors.select("x").mapInArrow(add, "dim int, s long, n long"))
    return (found[0]["n"] if found else 0), np.array([r["s"] for r in found], np.int64)


@dataclass(frozen=True)
class Components:
    """``vectors`` has a unit eigenvector of the covariance per row, ``variances`` their eigenvalues, falling."""

    n: int
    sums: np.ndarray
    trace: float
    variances: np.ndarray
    vectors: np.ndarray
    steps: int


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """Full reorthogonalisation, twice, which is enough for machine precision."""
    if basis:
        known = np.array(basis)
        for _ in range(2):
            vector = vector - known.T @ (known @ vector)
    return vector


def bidiagonalise(vectors: DataFrame, n: int, sums: np.ndarray, k: int = COMPONENTS, settled: float = SETTLED) -> Components:
    """The first ``k`` components by Golub-Kahan-Lanczos steps with full reorthogonalisation on both sides.

    The state on the driver is a few short vectors per step (p numbers each, p the dimension): the right vectors v, the
    w of the left vectors u = X w, and X'u. Left vectors are made orthogonal through their inner products u_i'u =
    w_i'(X'u), which need no further pass. A step that meets an invariant subspace (repeated eigenvalues, fewer
    independent rows than dimensions) goes on from a new direction orthogonal to all before, so all p steps can be
    taken, and then the bidiagonal matrix is exact.
    """
    p, mean = len(sums), sums / max(n, 1)
    rng = np.random.default_rng(7)

    def product(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """X'(X w) and the sums of squares per dimension of the centred rows."""
        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, squares = np.zeros(p), np.zeros(p)
            for batch in batches:
                if batch.num_rows:
                    rows = matrix(batch.column(0)) - mean
                    total += rows.T @ (rows @ w)
                    squares += np.einsum("ij,ij->j", rows, rows)
            if total.any() or squares.any():
                yield pa.RecordBatch.from_pydict({"dim": np.arange(p, dtype=np.int32), "z": total, "q": squares})
        found = sums_by_dimension(vectors.select("x").mapInArrow(multiply, "dim int, z double, q double"))
        if not found:
            return np.zeros(p), np.zeros(p)
        return np.array([r["z"] for r in found]), np.array([r["q"] for r in found])

    def fresh(basis: list[np.ndarray]) -> np.ndarray:
        start = _orthogonal(rng.standard_normal(p), basis)
        return start / np.linalg.norm(start)

    right, left, back = [fresh([])], [], []  # v_j; w_j with u_j = X w_j; X'u_j
    alphas, betas, trace = [], [], 0.0
    while True:
        v = right[-1]
        w = v - betas[-1] * left[-1] if betas else v.copy()
        z, squares = product(w)  # the pass: u = X w and X'u at once
        trace = float(squares.sum())
        for _ in range(2):  # u against all left vectors before it, without a pass
            if left:
                amounts = np.array(left) @ z
                w, z = w - amounts @ np.array(left), z - amounts @ np.array(back)
        alpha = float(np.sqrt(max(w @ z, 0.0)))
        floor = NOTHING * max([alpha, *alphas, *betas])
        if alpha <= floor:  # X v lies in the span of the left vectors
            alpha, w, z = 0.0, np.zeros(p), np.zeros(p)
        else:
            w, z = w / alpha, z / alpha
        alphas.append(alpha)
        left.append(w)
        back.append(z)
        j = len(alphas)
        step = _orthogonal(z - alpha * v, right)
        beta = float(np.linalg.norm(step))
        small = np.diag(alphas) + np.diag(betas, 1)
        u, values, vt = np.linalg.svd(small)
        if j == p:
            break
        if beta <= floor:
            beta = 0.0
        # The residual of component i is beta times the last entry of its left vector; it counts only when no other
        # direction is left to be looked at, which a new start after beta = 0 tells.
        if beta and j > k and np.all(beta * np.abs(u[-1, :k]) <= settled * values[0]):
            break
        right.append(step / beta if beta else fresh(right))
        betas.append(beta)
    wanted = [i for i in range(min(k, len(values))) if values[i] > NOTHING * values[0]]
    found = vt[wanted] @ np.array(right)
    found = np.array([_orthogonal(c, list(found[:i])) for i, c in enumerate(found)]).reshape(len(wanted), p)
    found /= np.linalg.norm(found, axis=1, keepdims=True) if len(wanted) else 1.0
    return Components(n, sums, trace / n, values[wanted] ** 2 / n, found, j)


def _projection(fit: Components):
    """Whitened rows of a batch: a matrix product, each column divided by its deviation."""
    base, mean = (fit.vectors / np.sqrt(fit.variances)[:, None]).T, fit.sums / fit.n

    def project(rows: np.ndarray) -> np.ndarray:
        return (rows - mean) @ base
    return project


def identity_error(vectors: DataFrame, fit: Components) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity, measured on all rows.

    Two passes, so that rows are centred before they are multiplied: one for the mean, one for the products.
    """
    k, project = len(fit.variances), _projection(fit)

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({"dim": np.arange(k, dtype=np.int32), "s": project(matrix(batch.column(0))).sum(0)})

    mean = np.array([r["s"] for r in sums_by_dimension(vectors.select("x").mapInArrow(average, "dim int, s double"))]) / fit.n

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                rows = project(matrix(batch.column(0))) - mean
                total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"dim": np.arange(k * k, dtype=np.int32), "s": total.ravel()})

    found = sums_by_dimension(vectors.select("x").mapInArrow(multiply, "dim int, s double"))
    return float(np.abs(np.array([r["s"] for r in found]).reshape(k, k) / fit.n - np.eye(k)).max())


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: up to ``k`` rows per complete vector.

    Rows whose vector is null, empty, shorter than the longest, or holds a null, NaN or infinity are left out. Entries
    become the whole numbers floor(1024 c) + 100000 (as far as a long reaches). ``deviation`` is the exact sum over the
    dimensions of (n x - S)^2, null where it does not fit a long. Components have a variance above rounding error, so
    there are fewer than ``k`` in narrow or flat tables, and none, thus no rows, where all vectors are equal. Repeated
    rows and null ids stay and count each time, an empty table gives no rows, other columns are not read. Where
    eigenvalues are equal, any basis of their space may come out.
    """
    kind = rows.select(col(id)).schema[0].dataType.simpleString()
    names = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = whole_vectors(rows, id, vector)
    n, sums = exact_sums(vectors)
    fit = bidiagonalise(vectors, n, sums, k) if n else None
    if fit is None or not len(fit.variances):
        return vectors.limit(0).selectExpr("id", *[f"CAST(NULL AS {t}) AS {c}" for c, t in (
            p.split(" ") for p in names.split(", ")[1:])]).withColumnRenamed("id", id)
    error, project, count = identity_error(vectors, fit), _projection(fit), len(fit.variances)
    share, longest = fit.variances / fit.trace, LONGEST

    def deviations(x: np.ndarray) -> pa.Array:
        reach = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max())
        if reach <= longest and reach * reach * len(sums) <= longest:
            gap = x * n - sums
            return pa.array(np.einsum("ij,ij->i", gap, gap))
        gap = x.astype(object) * n - sums.astype(object)  # whole numbers without a limit
        if x.size and int(np.abs(gap).max()) <= 3_037_000_499 // int(np.ceil(np.sqrt(len(sums)))):
            gap = gap.astype(np.int64)
            return pa.array(np.einsum("ij,ij->i", gap, gap))
        exact = (gap * gap).sum(1)
        return pa.array([v if v <= longest else None for v in exact.tolist()], pa.int64())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            each = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0).take(pa.array(each)), "component": np.tile(np.arange(1, count + 1, dtype=np.int32), len(x)),
                "n": np.full(len(each), n, np.int64), "deviation": deviations(x).take(pa.array(each)),
                "whitened": project(x).ravel(), "explained": np.tile(share, len(x)),
                "identity_error": np.full(len(each), error)})

    return vectors.select("id", "x").mapInArrow(score, names).withColumnRenamed("id", id)


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES = {"op12_whiten": (op12_whiten, None)}
