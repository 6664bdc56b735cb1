"""The feature study: which columns matter for a target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from statloom.functions.columns import col
from statloom.operators.association import covariance_table, report_on
from statloom.operators.moments import PAIR_FIELDS, moments_from_rows, pair_moments
from statloom.operators.pca import Components
from statloom.operators.split import SEED, hash_split
from statloom.operators.subsets import best_subset, winners
from statloom.operators.trees import forest_importance
from statloom.sources.tables import literal_rows


@dataclass(frozen=True)
class FeatureStudy:
    covariance: DataFrame
    correlation: DataFrame
    components: Components
    subsets: DataFrame
    best: DataFrame
    importance: DataFrame
    forest_size: DataFrame


def feature_study(df: DataFrame, target: str, predictors: Sequence[str], keys: Sequence[str] | None = None,
                  alpha: float = 0.05, test: str = "two-sided", seed: int = SEED) -> FeatureStudy:
    """Covariances, correlations and components come from one pass where no value is missing; otherwise the
    components, which need complete rows, take a second one."""
    columns = [target, *predictors]
    wanted = df.select(*[col(c) for c in dict.fromkeys([*(keys or []), *columns])])
    rows = pair_moments(wanted, columns).collect()
    if len({r["n"] for r in rows}) == 1:
        components = Components.from_moments(moments_from_rows(rows, predictors).get(None))
    else:
        components = Components.fit(wanted, predictors)
    pairs = literal_rows(df.sparkSession, [r for r in rows if r["col_x"] != r["col_y"]],
                         f"col_x string, col_y string, {PAIR_FIELDS}")
    subsets = best_subset(wanted, target, predictors, keys, seed=seed)
    training = hash_split(wanted, keys, seed=seed)[0]
    importance, size = forest_importance(training, target, predictors, seed)
    return FeatureStudy(covariance_table(pairs), report_on(pairs, alpha, test), components, subsets,
                        winners(subsets), importance, size)
