"""Tree regressions: single tree, random forest, gradient-boosted trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from statloom.functions.columns import col
from statloom.operators.features import feature_stages
from statloom.operators.linear import prediction_name
from statloom.operators.moments import complete_rows
from statloom.operators.split import SEED
from statloom.sources.tables import literal_rows

KINDS = {"tree": DecisionTreeRegressor, "forest": RandomForestRegressor, "boosted": GBTRegressor}
# Settings of the importance forest.
ROWS_A_TASK = 1_000_000  # of a training table; a task of a fit keeps its rows as objects
IMPORTANCE_FOREST = {"maxBins": 32, "maxDepth": 5, "numTrees": 20, "featureSubsetStrategy": "onethird"}


def tree_pipeline(kind: str, target: str, predictors: Sequence[str], scale: str | None = None,
                  prediction: str | None = None, seed: int | None = SEED, **settings) -> Pipeline:
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {sorted(KINDS)}, not {kind!r}")
    stages, features = feature_stages(predictors, scale)
    if seed is not None:
        settings["seed"] = seed
    return Pipeline(stages=[*stages, KINDS[kind](
        labelCol=target, featuresCol=features, predictionCol=prediction or prediction_name(target), **settings)])


def spread(rows: DataFrame, most: int | None = None) -> DataFrame:
    """The rows over so many tasks that none holds more than about ``most``; few rows stay as they lie.

    A few columns of a file split are many rows, and every pass of a tree fit reads them as objects.
    """
    tasks = -(-rows.count() // (most or ROWS_A_TASK))
    return rows.repartition(tasks) if tasks > 1 else rows


def fit_tree(df: DataFrame, kind: str, target: str, predictors: Sequence[str], **settings) -> PipelineModel:
    pipeline = tree_pipeline(kind, target, predictors, **settings)
    rows = complete_rows(df, [*predictors, target])
    return pipeline.fit(spread(rows.select(*[col(c) for c in dict.fromkeys([*predictors, target])])))


def importance_table(model: PipelineModel, predictors: Sequence[str], spark: SparkSession) -> DataFrame:
    """``predictor, score``, most important first."""
    scores = model.stages[-1].featureImportances.toArray()
    rows = sorted(((p, float(s)) for p, s in zip(predictors, scores)), key=lambda r: (-r[1], r[0]))
    return literal_rows(spark, rows, "predictor string, score double")


def forest_importance(df: DataFrame, target: str, predictors: Sequence[str], seed: int = SEED,
                      scale: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Importance scores of a forest, and the size of that forest."""
    model = fit_tree(df, "forest", target, predictors, scale=scale, seed=seed, **IMPORTANCE_FOREST)
    spark = df.sparkSession
    return importance_table(model, predictors, spark), tree_settings(model, spark)


def tree_settings(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Size and settings of a fitted tree model, as ``measure, value`` rows."""
    fitted = model.stages[-1]
    nodes = fitted.totalNumNodes if hasattr(fitted, "totalNumNodes") else fitted.numNodes
    rows = [("features", fitted.numFeatures), ("nodes", nodes)]
    for name in ("maxBins", "maxDepth", "numTrees", "maxIter", "stepSize", "subsamplingRate"):
        if fitted.hasParam(name):
            rows.append((name, fitted.getOrDefault(name)))
    rows += [(f"weight_{i}", w) for i, w in enumerate(getattr(fitted, "treeWeights", []))]
    return literal_rows(spark, [(k, float(v)) for k, v in rows], "measure string, value double")


def tree_text(model: PipelineModel) -> str:
    """The learned splits as indented text."""
    return model.stages[-1].toDebugString
