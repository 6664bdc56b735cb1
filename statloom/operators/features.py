"""Feature scaling, as plain column expressions and as ``pyspark.ml`` stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Normalizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.moments import column_moments

RAW, SCALED = "raw_features", "scaled_features"


def standardize(df: DataFrame, columns: Sequence[str], center: bool = True, suffix: str = "_z") -> DataFrame:
    """Add each column divided by its sample standard deviation, after subtracting the mean if ``center``.

    A constant column becomes 0. The statistics are 2p numbers, so they enter the plan as literals and the
    scaling itself needs no shuffle.
    """
    stats = column_moments(df, columns)
    added = {}
    for name in columns:
        _, mean, deviation = stats[name]
        value = col(name).cast("double")
        if not deviation:
            added[name + suffix] = F.when(value.isNotNull(), F.lit(0.0))
        else:
            added[name + suffix] = (value - F.lit(mean) if center else value) / F.lit(deviation)
    return df.withColumns(added)


def normalize_l1(df: DataFrame, columns: Sequence[str], suffix: str = "_l1") -> DataFrame:
    """Add each column divided by the row's sum of absolute values; a row of zeros stays zero."""
    total = sum((F.abs(col(c).cast("double")) for c in columns), F.lit(0.0))
    return df.withColumns({c + suffix: F.when(total == 0, F.lit(0.0)).otherwise(
        F.try_divide(col(c).cast("double"), total)) for c in columns})


def vectors_from_array(df: DataFrame, array: str, name: str = RAW) -> DataFrame:
    return df.withColumn(name, array_to_vector(col(array).cast("array<double>")))


def feature_stages(columns: Sequence[str], scale: str | None = "sd", raw: str = RAW,
                   scaled: str = SCALED) -> tuple[list, str]:
    """Stages that turn columns into one feature vector, and the name of that vector.

    ``scale``: "sd" divides by the standard deviation, "z" also centres, "l1" normalises each row, None does
    nothing. Rows with nulls must be removed before (``complete_rows``); the assembler rejects them.
    """
    stages = [VectorAssembler(inputCols=list(columns), outputCol=raw, handleInvalid="error")]
    if scale is None:
        return stages, raw
    if scale in ("sd", "z"):
        stages.append(StandardScaler(inputCol=raw, outputCol=scaled, withStd=True, withMean=scale == "z"))
    elif scale == "l1":
        stages.append(Normalizer(inputCol=raw, outputCol=scaled, p=1.0))
    else:
        raise ValueError(f"scale must be 'sd', 'z', 'l1' or None, not {scale!r}")
    return stages, scaled


def fit_stages(df: DataFrame, stages: Sequence) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(df)
