"""k-means on scaled columns: assignment, cost, centres, per-cluster profile, and the sweep over k."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.lloyd import CentreFits, fit_centres
from statloom.operators.split import SEED

CLUSTER = "cluster"
# Settings of the k-means runs and range of the sweep.
MAX_ITER, TOLERANCE = 40, 1e-5
SWEEP = range(5, 91)


@dataclass(frozen=True)
class Clustering:
    """One k-means of ``fit_centres``: the same centres on any layout, and all points where there are at most k."""

    fits: CentreFits
    k: int
    cluster: str = CLUSTER

    @classmethod
    def fit(cls, df: DataFrame, predictors: Sequence[str], k: int, center: bool = True, seed: int = SEED,
            max_iter: int = MAX_ITER, tol: float = TOLERANCE, cluster: str = CLUSTER) -> "Clustering":
        return cls(fit_centres(df, predictors, [k], center=center, seed=seed, max_iter=max_iter, tol=tol), k, cluster)

    @property
    def predictors(self) -> tuple[str, ...]:
        return self.fits.predictors

    @property
    def cost(self) -> float:
        """Within-cluster sum of squares in scaled space, about the final centres."""
        return self.fits.cost[self.k]

    def assign(self, df: DataFrame) -> DataFrame:
        """The complete rows with their cluster number."""
        return self.fits.assign(df, self.k, self.cluster)

    def distances(self, df: DataFrame) -> DataFrame:
        """The assigned rows with ``distance`` (squared, scaled, to the own centre) and ``nearest`` (to any centre)."""
        return self.fits.distances(self.assign(df), self.k, self.cluster)

    def centres(self, spark: SparkSession) -> DataFrame:
        """``cluster, feature, value`` in scaled space."""
        return self.fits.centres(spark).select("cluster", "feature", "value")

    def profile(self, df: DataFrame, row_id: str) -> DataFrame:
        """Rows and averages of the unscaled features per cluster."""
        return cluster_profile(self.assign(df), row_id, self.predictors, self.cluster)


def cluster_profile(assigned: DataFrame, row_id: str, features: Sequence[str], cluster: str = CLUSTER) -> DataFrame:
    return assigned.groupBy(col(cluster)).agg(F.count(col(row_id)).alias(row_id),
                                              *[F.avg(col(f)).alias(f) for f in features])


def elbow(df: DataFrame, predictors: Sequence[str], ks: Sequence[int] = SWEEP, center: bool = True,
          seed: int = SEED, max_iter: int = MAX_ITER, tol: float = TOLERANCE, merge_equal_rows: bool = True,
          keys: Sequence[str] | None = None) -> DataFrame:
    """``k, cost`` for every k, all fitted in the same passes over the rows; see ``fit_centres``.

    ``merge_equal_rows`` replaces equal rows by one weighted row first. The costs are the same, and columns with few
    distinct values shrink to a small table; turn it off where hardly any rows are equal.
    """
    fits = fit_centres(df, predictors, ks, keys, center, seed=seed, max_iter=max_iter, tol=tol,
                       merge_equal_rows=merge_equal_rows)
    return fits.costs(df.sparkSession)
