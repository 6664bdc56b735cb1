"""The usual way to the same results - one Spark job per pair, per subset, per metric, per k - timed beside ours.

Run by ``BENCH_PATTERN=1 python bench.py``.
"""

from __future__ import annotations

import time
from itertools import combinations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from statloom.catalogue.common import LINE_PREDICTORS, lines
from statloom.operators.association import correlation_report
from statloom.operators.cluster import elbow
from statloom.operators.evaluate import evaluate
from statloom.operators.linear import cross_validate, moment_grid_search
from statloom.operators.ols import LeastSquares
from statloom.operators.pca import Components
from statloom.operators.subsets import best_subset, column_subsets

COLUMNS = ["net", *LINE_PREDICTORS]
GROUPED = ["l_quantity", "l_discount", "l_tax"]


def _scaled(df, columns, center):
    stages = [VectorAssembler(inputCols=columns, outputCol="raw"),
              StandardScaler(inputCol="raw", outputCol="x", withMean=center)]
    return stages, Pipeline(stages=stages).fit(df).transform(df)


def _metrics(scored, target, prediction):
    found = [RegressionEvaluator(labelCol=target, predictionCol=prediction, metricName=m).evaluate(scored)
             for m in ("r2", "rmse", "mae")]
    return [*found, scored.agg(F.avg(target)).head()[0]]


def _correlations(df):
    return [df.stat.corr(a, b) for a, b in combinations(COLUMNS, 2)], df.count()


def _components(df):
    _, scaled = _scaled(df, LINE_PREDICTORS, True)
    return [PCA(k=k, inputCol="x", outputCol="y").fit(scaled).explainedVariance
            for k in range(1, len(LINE_PREDICTORS) + 1)]


def _subsets(df):
    training, testing = df.randomSplit([0.7, 0.3], 1069)
    out = []
    for chosen in column_subsets(LINE_PREDICTORS):
        stages, _ = [VectorAssembler(inputCols=list(chosen), outputCol="raw"),
                     StandardScaler(inputCol="raw", outputCol="x", withMean=True)], None
        model = Pipeline(stages=[*stages, LinearRegression(labelCol="net", featuresCol="x", predictionCol="p")]
                         ).fit(training)
        out.append(_metrics(model.transform(testing), "net", "p")[:3])
    return out


def _least_squares(df):
    stages = [VectorAssembler(inputCols=LINE_PREDICTORS, outputCol="x"), LinearRegression(labelCol="net", featuresCol="x")]
    return Pipeline(stages=stages).fit(df).stages[-1].summary.tValues


def _elbow(df):
    costs = []
    for k in range(2, 7):
        _, scaled = _scaled(df, GROUPED, True)
        costs.append(KMeans(k=k, seed=1069, maxIter=40, tol=1e-5, featuresCol="x").fit(scaled).summary.trainingCost)
    return costs


def compare(spark, folder: str) -> dict[str, dict[str, float]]:
    df = lines(spark, folder, "l_orderkey")
    scored = df.withColumn("p", F.expr("l_extendedprice * 1.01"))
    pairs = {
        "correlation_report": (lambda: correlation_report(df, columns=COLUMNS).collect(), lambda: _correlations(df)),
        "components": (lambda: Components.fit(df, LINE_PREDICTORS), lambda: _components(df)),
        "best_subset": (lambda: best_subset(df, "net", LINE_PREDICTORS, ["l_orderkey"]).collect(), lambda: _subsets(df)),
        "least_squares": (lambda: LeastSquares.fit(df, "net", LINE_PREDICTORS).t_tests(spark).collect(),
                          lambda: _least_squares(df)),
        "metrics": (lambda: evaluate(scored, "net", "p").collect(), lambda: _metrics(scored, "net", "p")),
        "grid_search": (lambda: moment_grid_search(df, "net", LINE_PREDICTORS, ["l_orderkey"]),
                        lambda: cross_validate(df, "net", LINE_PREDICTORS, ["l_orderkey"])),
        "elbow": (lambda: elbow(df, GROUPED, range(2, 7)).collect(), lambda: _elbow(df)),
    }
    out = {}
    for name, (ours, usual) in pairs.items():
        taken = []
        for run in (ours, usual):
            start = time.perf_counter()
            run()
            taken.append(round(time.perf_counter() - start, 3))
        out[name] = {"ours": taken[0], "usual": taken[1], "ratio": round(taken[1] / taken[0], 2)}
    return out
