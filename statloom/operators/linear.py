"""Linear regression models: the ``pyspark.ml`` pipeline with its summary, and tuning by cross validation.

Two ways to tune. ``cross_validate`` refits for every grid point and fold. ``moment_grid_search`` needs one pass:
the elastic net depends on the data only through the moments of each fold, and moments of folds add up, so every
training set and every held-out error is known from ``folds`` small matrices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.features import feature_stages
from statloom.operators.moments import Moments, collect_moments, complete_rows
from statloom.operators.ols import INTERCEPT
from statloom.operators.split import SEED, hash_position, with_fold
from statloom.sources.tables import literal_rows

# The grid of the tuning run.
MAX_ITER, REG_PARAM, ELASTIC_NET = (10, 15), (0.0, 0.3), (0.0, 0.4)
FOLDS = 3


def prediction_name(target: str) -> str:
    return f"pred_{target}"


def linear_pipeline(target: str, predictors: Sequence[str], scale: str | None = "sd", max_iter: int = 100,
                    reg_param: float = 0.0, elastic_net: float = 0.0, standardization: bool = True,
                    prediction: str | None = None) -> Pipeline:
    stages, features = feature_stages(predictors, scale)
    return Pipeline(stages=[*stages, LinearRegression(
        labelCol=target, featuresCol=features, predictionCol=prediction or prediction_name(target),
        maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net, standardization=standardization)])


def fit_linear(df: DataFrame, target: str, predictors: Sequence[str], **settings) -> PipelineModel:
    return linear_pipeline(target, predictors, **settings).fit(complete_rows(df, [*predictors, target]))


def linear_stage(model: PipelineModel | CrossValidatorModel) -> LinearRegressionModel:
    return (model.bestModel if isinstance(model, CrossValidatorModel) else model).stages[-1]


def coefficient_summary(model: PipelineModel | CrossValidatorModel, predictors: Sequence[str],
                        spark: SparkSession) -> DataFrame:
    """``term, estimate, std_error, t_value, p_value`` in the units of the feature vector, intercept first.

    The tests are null where the model has an L1 penalty, for which they are not defined.
    """
    fitted = linear_stage(model)
    estimates = [fitted.intercept, *fitted.coefficients.toArray()]
    tests = [[None] * len(estimates)] * 3
    if fitted.hasSummary and not (fitted.getRegParam() > 0 and fitted.getElasticNetParam() > 0):
        summary = fitted.summary
        tests = [[v[-1], *v[:-1]] for v in (summary.coefficientStandardErrors, summary.tValues, summary.pValues)]
    rows = [(t, float(e), *[None if v[i] is None else float(v[i]) for v in tests])
            for i, (t, e) in enumerate(zip((INTERCEPT, *predictors), estimates))]
    return literal_rows(spark, rows, "term string, estimate double, std_error double, t_value double, "
                                       "p_value double")


def training_summary(model: PipelineModel | CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """What the training run reports, as ``measure, value`` rows."""
    fitted = linear_stage(model)
    summary = fitted.summary
    low, high = summary.devianceResiduals
    rows = [("rows", summary.numInstances), ("features", fitted.numFeatures),
            ("intercept", fitted.intercept), ("deviance_residual_min", low), ("deviance_residual_max", high),
            ("explained_variance", summary.explainedVariance), ("rsquared", summary.r2),
            ("rmse", summary.rootMeanSquaredError), ("mae", summary.meanAbsoluteError),
            ("mse", summary.meanSquaredError), ("iterations", summary.totalIterations)]
    rows += [(f"objective_{i}", value) for i, value in enumerate(summary.objectiveHistory)]
    return literal_rows(spark, [(k, float(v)) for k, v in rows], "measure string, value double")


def training_residuals(model: PipelineModel | CrossValidatorModel) -> DataFrame:
    return linear_stage(model).summary.residuals


# -- tuning by refits ------------------------------------------------------------------------------------------

def cross_validate(df: DataFrame, target: str, predictors: Sequence[str], keys: Sequence[str] | None = None,
                   max_iter: Sequence[int] = MAX_ITER, reg_param: Sequence[float] = REG_PARAM,
                   elastic_net: Sequence[float] = ELASTIC_NET, folds: int = FOLDS, metric: str = "rmse",
                   seed: int = SEED, parallelism: int = 4, scale: str | None = "sd") -> CrossValidatorModel:
    """Grid search with one fit per grid point and fold; folds depend on the row's key only."""
    columns = [*predictors, target]
    rows = with_fold(complete_rows(df, columns), keys, folds, seed).select(*[col(c) for c in columns], "fold")
    pipeline = linear_pipeline(target, predictors, scale)
    estimator = pipeline.getStages()[-1]
    grid = (ParamGridBuilder().addGrid(estimator.maxIter, list(max_iter))
            .addGrid(estimator.regParam, list(reg_param))
            .addGrid(estimator.elasticNetParam, list(elastic_net)).build())
    evaluator = RegressionEvaluator(labelCol=target, predictionCol=prediction_name(target), metricName=metric)
    return CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                          foldCol="fold", parallelism=parallelism).fit(rows)


def grid_report(model: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """One row per grid point with its averaged metric, best first by the metric's own direction."""
    names = ("maxIter", "regParam", "elasticNetParam")
    rows = []
    for settings, value in zip(model.getEstimatorParamMaps(), model.avgMetrics):
        named = {p.name: v for p, v in settings.items()}
        rows.append((*[float(named[n]) for n in names], float(value)))
    return _ranked(spark, rows, "max_iter double, reg_param double, elastic_net double, avg_metric double",
                   model.getEvaluator().isLargerBetter())


def parameter_docs(model: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """Name, description and chosen value of every tuned parameter."""
    better = max if model.getEvaluator().isLargerBetter() else min
    best = better(zip(model.avgMetrics, range(len(model.avgMetrics))))[1]
    rows = [(p.parent, p.name, p.doc, float(v)) for p, v in model.getEstimatorParamMaps()[best].items()]
    return literal_rows(spark, rows, "owner string, parameter string, description string, value double")


def _ranked(spark: SparkSession, rows: Sequence[tuple], schema: str, larger_is_better: bool) -> DataFrame:
    """One row per grid point with a ``rank``: 1 for the best metric, equal metrics share a rank."""
    values = [r[-1] for r in rows]
    rank = [1 + sum((o > v) if larger_is_better else (o < v) for o in values) for v in values]
    ordered = sorted(((*r, k) for r, k in zip(rows, rank)), key=lambda r: (r[-1], r))
    return literal_rows(spark, ordered, schema + ", rank int")


# -- tuning by moments -----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class ElasticNet:
    """Coefficients of one penalised fit, in the units of the columns."""

    target: str
    predictors: tuple[str, ...]
    intercept: float
    slopes: np.ndarray

    @classmethod
    def from_moments(cls, moments: Moments, target: str, predictors: Sequence[str], reg_param: float,
                     elastic_net: float) -> "ElasticNet":
        """Minimise squared error / (2 n) + reg_param (elastic_net |b|_1 + (1 - elastic_net) |b|^2 / 2).

        As in ``LinearRegression``, the penalty applies to standardised predictors and a standardised target.
        """
        x, y = moments.at(predictors), moments.at([target])[0]
        deviation = np.sqrt(np.diag(moments.scatter) / moments.n)
        if deviation[y] == 0:
            slopes = np.zeros(len(x))
        else:
            varies = [i for i in range(len(x)) if deviation[x[i]] > 0]
            keep = [x[i] for i in varies]
            scale = deviation[keep] * deviation[y] * moments.n
            inner = moments.scatter[np.ix_(keep, keep)] / np.outer(deviation[keep], deviation[keep]) / moments.n
            cross = moments.scatter[keep, y] / scale
            strength = reg_param / deviation[y]
            slopes = np.zeros(len(x))
            slopes[varies] = (_coordinate_descent(inner, cross, strength * elastic_net,
                                                  strength * (1 - elastic_net)) * deviation[y] / deviation[keep])
        return cls(target, tuple(predictors), float(moments.mean[y] - slopes @ moments.mean[x]), slopes)

    def mean_squared_error(self, moments: Moments) -> float:
        x, y = moments.at(self.predictors), moments.at([self.target])[0]
        contrast = np.zeros(len(moments.columns))
        contrast[y], contrast[x] = 1.0, -self.slopes
        offset = contrast @ moments.mean - self.intercept
        return max(float(contrast @ moments.scatter @ contrast), 0.0) / moments.n + float(offset * offset)

    @property
    def prediction(self) -> Column:
        value = F.lit(self.intercept)
        for b, name in zip(self.slopes, self.predictors):
            value = value + F.lit(float(b)) * col(name).cast("double")
        return value

    def predict(self, df: DataFrame, name: str | None = None) -> DataFrame:
        return df.withColumn(name or prediction_name(self.target), self.prediction)


def _coordinate_descent(inner: np.ndarray, cross: np.ndarray, l1: float, l2: float) -> np.ndarray:
    if l1 == 0.0:
        ridge = inner + l2 * np.eye(len(cross))
        return np.linalg.lstsq(ridge, cross, rcond=None)[0]
    b = np.zeros(len(cross))
    for _ in range(100_000):
        moved = 0.0
        for j in range(len(b)):
            pull = cross[j] - inner[j] @ b + inner[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (inner[j, j] + l2)
            moved = max(moved, abs(new - b[j]))
            b[j] = new
        if moved < 1e-13:
            return b
    raise ArithmeticError("coordinate descent did not converge")


@dataclass(frozen=True)
class GridSearch:
    """Result of ``moment_grid_search``."""

    rows: tuple[tuple[float, float, float], ...]  # reg_param, elastic_net, averaged metric
    larger_is_better: bool
    best: ElasticNet

    def report(self, spark: SparkSession) -> DataFrame:
        return _ranked(spark, self.rows, "reg_param double, elastic_net double, avg_metric double",
                       self.larger_is_better)


def moment_grid_search(df: DataFrame, target: str, predictors: Sequence[str], keys: Sequence[str] | None = None,
                       reg_param: Sequence[float] = REG_PARAM, elastic_net: Sequence[float] = ELASTIC_NET,
                       folds: int = FOLDS, metric: str = "rmse", seed: int = SEED) -> GridSearch:
    """Cross validation of the whole grid in one pass; each fit is run to convergence, so there is no ``maxIter``."""
    if metric not in ("rmse", "mse", "r2"):
        raise ValueError("moments give rmse, mse and r2; use cross_validate for other metrics")
    if folds < 2:
        raise ValueError("at least two folds are needed")
    number = (hash_position(keys or df.columns, seed + 1) % folds).cast("int")
    parts = collect_moments(df, [*predictors, target], by=number)
    if len(parts) < folds:
        raise ValueError(f"only {len(parts)} of {folds} folds hold rows")
    total = _sum(parts.values())
    rows = []
    for reg, mix in product(reg_param, elastic_net):
        scores = []
        for fold, held_out in parts.items():
            training = _sum(m for k, m in parts.items() if k != fold)
            mse = ElasticNet.from_moments(training, target, predictors, reg, mix).mean_squared_error(held_out)
            y = held_out.at([target])[0]
            scores.append({"mse": mse, "rmse": mse ** 0.5,
                           "r2": 1.0 - mse * held_out.n / held_out.scatter[y, y]}[metric])
        rows.append((float(reg), float(mix), float(np.mean(scores))))
    larger = metric == "r2"
    best = (max if larger else min)(rows, key=lambda r: r[2])
    return GridSearch(tuple(rows), larger, ElasticNet.from_moments(total, target, predictors, *best[:2]))


def _sum(parts) -> Moments:
    parts = list(parts)
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total
