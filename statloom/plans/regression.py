"""Fit on one share of the rows, predict and evaluate on the other, for any of the regression models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from statloom.functions.columns import col
from statloom.operators.evaluate import evaluate
from statloom.operators.linear import cross_validate, fit_linear, moment_grid_search, prediction_name
from statloom.operators.moments import complete_rows
from statloom.operators.ols import LeastSquares
from statloom.operators.split import SEED, hash_split, random_split
from statloom.operators.trees import KINDS, fit_tree

MODELS = ("least_squares", "elastic_net", "linear", "tuned", *KINDS)


@dataclass(frozen=True)
class Trial:
    model: object
    metrics: DataFrame
    predictions: DataFrame  # test rows: identifiers, target, prediction, predictors


def run_regression(df: DataFrame, kind: str, target: str, predictors: Sequence[str],
                   keys: Sequence[str] | None = None, by: Sequence[str] = (),
                   weights: Sequence[float] = (0.7, 0.3), seed: int = SEED, split: str = "hash",
                   **settings) -> Trial:
    """``kind``: "linear" and "tuned" (cross-validated) fit with ``pyspark.ml``; "least_squares" and "elastic_net"
    do the same from one pass of moments; "tree", "forest" and "boosted" are the tree models. The models of
    ``pyspark.ml`` read the training share many times; it is kept (memory, then disk) while they fit.

    ``keys`` identify a row and decide its share; ``by`` adds one metrics row per slice.
    """
    if kind not in MODELS:
        raise ValueError(f"kind must be one of {MODELS}, not {kind!r}")
    rows = complete_rows(df, [*predictors, target])
    if split == "hash":
        training, testing = hash_split(rows, keys, weights, seed)
    elif split == "random":
        training, testing = random_split(rows, weights, seed)
    else:
        raise ValueError(f"split must be 'hash' or 'random', not {split!r}")
    prediction = prediction_name(target)
    if kind == "least_squares":
        model = LeastSquares.fit(training, target, predictors, **settings)
        scored = model.predict(testing, prediction)
    elif kind == "elastic_net":
        model = moment_grid_search(training, target, predictors, keys, seed=seed, **settings)
        scored = model.best.predict(testing, prediction)
    else:
        training = training.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kind == "linear":
                model = fit_linear(training, target, predictors, **settings)
            elif kind == "tuned":
                model = cross_validate(training, target, predictors, keys, seed=seed, **settings)
            else:
                model = fit_tree(training, kind, target, predictors, seed=seed, **settings)
        finally:
            training.unpersist()
        scored = model.transform(testing)
    shown = list(dict.fromkeys([*(keys or []), *by, target, prediction, *predictors]))
    predictions = scored.select(*[col(c) for c in shown])
    return Trial(model, evaluate(predictions, target, prediction, by), predictions)
