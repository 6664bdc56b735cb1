"""Regression metrics in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import col, ratio


def metric_columns(label: str, prediction: str) -> list[Column]:
    """count, rsquared, rmse, mse, mae and mtv (mean of the target) over the rows that have both values."""
    y, p = col(label).cast("double"), col(prediction).cast("double")
    error = y - p
    n = F.count(error)
    mse = F.avg(error * error)
    spread = F.var_pop(F.when(error.isNotNull(), y))
    return [n.alias("count"), (1.0 - ratio(mse, spread)).alias("rsquared"), F.sqrt(mse).alias("rmse"),
            mse.alias("mse"), F.avg(F.abs(error)).alias("mae"),
            F.avg(F.when(error.isNotNull(), y)).alias("mtv")]


def evaluate(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """One results row ``target, prediction, ..., rsquared, rmse, mae, mtv``, or one per slice with ``by``."""
    keys = [col(b) for b in by]
    measured = df.groupBy(*keys).agg(*metric_columns(label, prediction))
    return measured.select(F.lit(label).alias("target"), F.lit(prediction).alias("prediction"), *keys,
                           "count", "rsquared", "rmse", "mse", "mae", "mtv")


def with_residual(df: DataFrame, label: str, prediction: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, col(label) - col(prediction))
