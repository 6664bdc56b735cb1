"""Filter to one slice, cluster it, describe the clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.cluster import Clustering
from statloom.operators.split import SEED


@dataclass(frozen=True)
class ClusterRun:
    clustering: Clustering
    assigned: DataFrame
    profile: DataFrame
    centres: DataFrame


def slice_of(df: DataFrame, equals: Mapping[str, object]) -> DataFrame:
    """Rows whose columns equal the given values; reaches the parquet scan as pushed filters."""
    for name, value in equals.items():
        df = df.filter(col(name) == F.lit(value))
    return df


def run_clustering(df: DataFrame, predictors: Sequence[str], k: int, row_id: str,
                   equals: Mapping[str, object] | None = None, center: bool = True,
                   seed: int = SEED) -> ClusterRun:
    rows = slice_of(df, equals or {})
    found = Clustering.fit(rows, predictors, k, center, seed)
    return ClusterRun(found, found.assign(rows), found.profile(rows, row_id), found.centres(df.sparkSession))
