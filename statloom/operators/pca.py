"""Principal components of z-scored columns, from the correlation matrix of one moment pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from statloom.functions.products import with_products
from statloom.operators.moments import Moments, collect_moments
from statloom.sources.tables import literal_rows


@dataclass(frozen=True)
class Components:
    """All p components at once: any smaller number is a prefix of these."""

    columns: tuple[str, ...]
    mean: np.ndarray
    deviation: np.ndarray  # sample standard deviation
    loadings: np.ndarray  # one column per component; the loading of largest size is positive
    explained: np.ndarray  # share of the total variance, largest first

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], on_null: str = "drop") -> "Components":
        return cls.from_moments(collect_moments(df, columns, on_null=on_null).get(None))

    @classmethod
    def from_moments(cls, found: Moments | None) -> "Components":
        if found is None or found.n < 2:
            raise ValueError("at least two complete rows are needed")
        scale = np.sqrt(np.diag(found.scatter))
        if not np.all(scale > 0):
            raise ValueError("a column is constant")
        values, vectors = np.linalg.eigh(found.scatter / np.outer(scale, scale))
        order = np.argsort(values)[::-1]
        values, vectors = np.clip(values[order], 0.0, None), vectors[:, order]
        sizes = np.round(np.abs(vectors), 9)  # equal sizes must tie whatever the last bits are
        vectors = vectors * np.sign(vectors[np.argmax(sizes, axis=0), np.arange(len(values))])
        return cls(found.columns, found.mean, scale / np.sqrt(found.n - 1), vectors, values / values.sum())

    def _first(self, k: int | None) -> int:
        k = len(self.columns) if k is None else k
        if not 1 <= k <= len(self.columns):
            raise ValueError(f"k must lie between 1 and {len(self.columns)}, not {k}")
        return k

    def explained_variance(self, spark: SparkSession, k: int | None = None) -> DataFrame:
        rows = [(i + 1, float(v), float(c)) for i, (v, c) in
                enumerate(zip(self.explained, np.cumsum(self.explained)))][:self._first(k)]
        return literal_rows(spark, rows, "component int, explained double, cumulative double")

    def loading_table(self, spark: SparkSession, k: int | None = None) -> DataFrame:
        rows = [(i + 1, c, float(self.loadings[j, i])) for i in range(self._first(k))
                for j, c in enumerate(self.columns)]
        return literal_rows(spark, rows, "component int, feature string, loading double")

    def project(self, df: DataFrame, k: int | None = None, prefix: str = "pc") -> DataFrame:
        """Add the scores of the first k components as columns ``pc1..``: mean and deviation are folded into one matrix
        and an offset, and each Arrow batch is one matrix product. A row with a null has null scores. No shuffle."""
        k = self._first(k)
        matrix = self.loadings[:, :k] / self.deviation[:, None]
        return with_products(df, self.columns, matrix, -self.mean @ matrix, [f"{prefix}{i + 1}" for i in range(k)])
