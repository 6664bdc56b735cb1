"""Gaussian mixture on row-normalised columns.

Features that sum to 1 have a singular covariance. Directions in which the whole table does not vary are therefore left out
once, and the fit runs in the others, scaled to unit variance over all rows. There a component's variance never falls below
``FLOOR``, so that one on identical values stays a proper density and responsibilities do not hang on rounding noise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.moments import collect_moments, column_moments, complete_rows
from statloom.operators.split import SEED
from statloom.sources.tables import literal_rows

COMPONENT = "component"
FLOOR = 1e-6  # least variance of a component, as a share of that of all rows in the same direction
CONSTANT = 1e-10  # a direction with less than this share of the scaled variance does not vary
ROUNDING = 1e-13  # a deviation below this share of the mean is rounding noise
DRAWN = 5  # rows from which a component starts
PORTION = 65_536  # rows handled at a time


@dataclass(frozen=True)
class Space:
    """y = (x - mean) / deviation @ basis: uncorrelated, of unit variance, without constant directions."""

    mean: np.ndarray
    deviation: np.ndarray
    basis: np.ndarray
    back: np.ndarray  # y @ back = (x - mean) / deviation

    @classmethod
    def of(cls, mean: np.ndarray, covariance: np.ndarray) -> "Space":
        deviation = np.sqrt(np.diag(covariance))
        varies = deviation > ROUNDING * np.abs(mean)
        safe = np.where(varies, deviation, 1.0)
        values, vectors = np.linalg.eigh(np.where(np.outer(varies, varies), covariance, 0.0) / np.outer(safe, safe))
        used = values > CONSTANT * max(values.max(), CONSTANT)
        roots = np.sqrt(values[used])
        return cls(mean, safe, vectors[:, used] / roots, (vectors[:, used] * roots).T)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.deviation) @ self.basis


@dataclass(frozen=True)
class Gaussians:
    """Weights, means and covariances in a ``Space``."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    def logs(self, y: np.ndarray) -> np.ndarray:
        """Log of weight x density of every row under every component, less the constant of the dimension."""
        values, vectors = np.linalg.eigh(self.covariances)
        roots = vectors / np.sqrt(values)[:, None, :]
        level = np.log(np.maximum(self.weights, 1e-300)) - np.log(values).sum(1) / 2
        return np.column_stack([c - (((y - m) @ root) ** 2).sum(1) / 2 for c, m, root in zip(level, self.means, roots)])


def _floored(covariances: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(covariances)
    return (vectors * np.maximum(values, FLOOR)[:, None, :]) @ vectors.transpose(0, 2, 1)


def _shares(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Responsibilities, and the log-likelihood of each row."""
    top = logs.max(1, keepdims=True)
    p = np.exp(logs - top)
    total = p.sum(1, keepdims=True)
    return p / total, (np.log(total) + top)[:, 0]


def _expected(rows: DataFrame, space: Space, now: Gaussians) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """One pass: log-likelihood, and per component the weight, sums and products of its rows; a task emits a row per component."""
    k, r = now.means.shape
    first, second = np.triu_indices(r)
    names = ["component", "likelihood", "weight", *[f"s{i}" for i in range(r + len(first))]]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 2 + r + len(first)))
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            for at in range(0, len(values), PORTION):
                y, weight = space.apply(values[at:at + PORTION, :-1]), values[at:at + PORTION, -1]
                p, likelihood = _shares(now.logs(y))
                p *= weight[:, None]
                total[0, 0] += likelihood @ weight
                total[:, 1] += p.sum(0)
                total[:, 2:2 + r] += p.T @ y
                total[:, 2 + r:] += p.T @ (y[:, first] * y[:, second])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), *[pa.array(v) for v in total.T]], names=names)

    parts = rows.mapInArrow(per_task, ", ".join(["component long", *[f"{n} double" for n in names[1:]]]))
    merged = parts.groupBy("component").agg(*[F.sum(n).alias(n) for n in names[1:]]).orderBy("component").toPandas()
    total = merged[names[1:]].to_numpy(float)
    products = np.zeros((k, r, r))
    products[:, first, second] = products[:, second, first] = total[:, 2 + r:]
    return float(total[:, 0].sum()), total[:, 1], total[:, 2:2 + r], products


def _start(points: np.ndarray, k: int) -> Gaussians:
    """``DRAWN`` rows to each component: their mean, and their variances without covariances."""
    turns = [points[np.arange(c * DRAWN, (c + 1) * DRAWN) % len(points)] for c in range(k)]
    spread = np.stack([np.diag(t.var(0)) for t in turns])
    return Gaussians(np.full(k, 1 / k), np.stack([t.mean(0) for t in turns]), _floored(spread))


@dataclass(frozen=True)
class Mixture:
    columns: tuple[str, ...]
    scaled: tuple[Column, ...]  # the features, from the columns
    space: Space
    fitted: Gaussians
    iterations: int

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], k: int = 8, tol: float = 0.01, max_iter: int = 100,
            seed: int = SEED, scale: str | None = "l1") -> "Mixture":
        """Expectation maximisation until the log-likelihood of all rows changes by at most ``tol``, or ``max_iter`` steps.

        ``scale`` is that of ``feature_stages``; the fit itself does not depend on the scale of a column. Equal rows are counted first and then stand for all of them, which changes no sum. Starts are
        drawn by the hash of the values, so the fit does not depend on the layout but for the last digits of sums. What
        reaches the driver is a row per component and pass, and ``DRAWN`` rows per component once.
        """
        if k < 1:
            raise ValueError("k must be a whole number from 1 on")
        columns = tuple(columns)
        names = [f"x{i}" for i in range(len(columns))]
        rows = complete_rows(df, columns)
        scaled = _scaled(rows, columns, scale)
        rows = rows.select(*[v.alias(n) for v, n in zip(scaled, names)])
        found = collect_moments(rows, names).get(None)
        if found is None:
            raise ValueError("no row has all columns")
        space = Space.of(found.mean, found.scatter / found.n)
        rows = rows.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("weight"))
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            u = (F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
            wait = -F.log1p(-u) / F.col("weight")  # the first to come are a draw in proportion to the weights
            drawn = rows.orderBy(wait, *names).limit(k * DRAWN).select(*names).toPandas()
            now = _start(space.apply(drawn.to_numpy(float)), k)
            before, step = -np.inf, 0
            while step < max_iter:
                likelihood, weight, sums, products = _expected(rows, space, now)
                held = np.maximum(weight, 1e-300)[:, None]
                means = np.where(weight[:, None] > 0, sums / held, now.means)
                spread = products / held[:, :, None] - means[:, :, None] * means[:, None, :]
                spread = np.where((weight > 0)[:, None, None], _floored(spread), now.covariances)
                now, step = Gaussians(weight / weight.sum(), means, spread), step + 1
                if abs(likelihood - before) <= tol:
                    break
                before = likelihood
        finally:
            rows.unpersist()
        return cls(columns, scaled, space, now, step)

    def components(self, spark: SparkSession) -> DataFrame:
        """``component, weight, feature, mean``."""
        means = self.space.mean + (self.fitted.means @ self.space.back) * self.space.deviation
        rows = [(i, float(w), f, float(m)) for i, (w, line) in enumerate(zip(self.fitted.weights, means))
                for f, m in zip(self.columns, line)]
        return literal_rows(spark, rows, "component int, weight double, feature string, mean double")

    def covariances(self, spark: SparkSession) -> DataFrame:
        """``component, feature_x, feature_y, cov``."""
        wide = self.space.back * self.space.deviation
        rows = [(i, a, b, float(v)) for i, cov in enumerate(wide.T @ self.fitted.covariances @ wide)
                for a, line in zip(self.columns, (cov + cov.T) / 2) for b, v in zip(self.columns, line)]
        return literal_rows(spark, rows, "component int, feature_x string, feature_y string, cov double")

    def assign(self, df: DataFrame) -> DataFrame:
        """The complete rows with their likeliest component and the probability of each."""
        space, fitted = self.space, self.fitted

        @F.pandas_udf("component int, probability array<double>")
        def shares(*values: pd.Series) -> pd.DataFrame:
            x = np.column_stack([v.to_numpy(float) for v in values])
            p = _shares(fitted.logs(space.apply(x)))[0]
            return pd.DataFrame({"component": p.argmax(1).astype(np.int32), "probability": list(p)})

        found = complete_rows(df, self.columns).withColumn("__found", shares(*self.scaled))
        return found.withColumns({COMPONENT: F.col("__found.component"),
                                  "probability": F.col("__found.probability")}).drop("__found")


def _scaled(rows: DataFrame, columns: Sequence[str], scale: str | None) -> tuple[Column, ...]:
    values = [col(c).cast("double") for c in columns]
    if scale == "l1":
        total = sum((F.abs(v) for v in values), F.lit(0.0))
        return tuple(F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(v, total)) for v in values)
    if scale in ("sd", "z"):
        stats = column_moments(rows, columns)
        return tuple((v - F.lit(mean) if scale == "z" else v) / F.lit(deviation) if deviation else F.lit(0.0)
                     for v, (_, mean, deviation) in ((v, stats[c]) for v, c in zip(values, columns)))
    if scale is not None:
        raise ValueError(f"scale must be 'sd', 'z', 'l1' or None, not {scale!r}")
    return tuple(values)
