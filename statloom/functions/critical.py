"""Critical values of Student's t: the published three-digit table, or exact quantiles."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.distributions import t_quantile
from statloom.sources.tables import literal_rows

# Probabilities of the published table, its last row, and its few entries that are not the
# exact quantile rounded to three digits.
PROBABILITIES = (0.9, 0.95, 0.975, 0.99, 0.995, 0.999)
LAST_DOF = 100
PUBLISHED_999 = {1: 318.313, 7: 4.782, 8: 4.499, 9: 4.296, 10: 4.143, 11: 4.024, 12: 3.929}

INFINITY_DOF = 0  # key of the row that serves every dof above LAST_DOF
TESTS = ("two-sided", "upper one-sided", "lower one-sided")


def test_probability(alpha: float, test: str) -> float:
    """Column of the table a test reads: 1 - alpha/2 for two sides, 1 - alpha for one side."""
    if test not in TESTS:
        raise ValueError(f"test must be one of {TESTS}, not {test!r}")
    if not 0.0 < alpha < 1.0:
        raise ValueError(f"alpha must lie between 0 and 1, not {alpha}")
    return round(1.0 - alpha / 2.0 if test == "two-sided" else 1.0 - alpha, 12)


def table_probability(prob: float) -> float:
    """The probability of the table equal to ``prob``."""
    for known in PROBABILITIES:
        if abs(known - prob) < 1e-9:
            return known
    raise ValueError(f"the critical value table holds {PROBABILITIES}; use mode='exact' for {prob}")


@lru_cache(maxsize=1024)
def published_value(dof: int, prob: float) -> float:
    if dof > LAST_DOF or dof == INFINITY_DOF:
        return round(t_quantile(prob, float("inf")), 3)
    if prob == 0.999 and dof in PUBLISHED_999:
        return PUBLISHED_999[dof]
    return round(t_quantile(prob, float(dof)), 3)


def critical_values(spark: SparkSession, probs=PROBABILITIES) -> DataFrame:
    """Long form ``(dof, prob, critical)``: at most 606 rows, whatever the data, so it is safe to broadcast.

    ``dof`` 0 stands for more than 100 degrees of freedom.
    """
    rows = [(d, p, published_value(d, p)) for d in range(0, LAST_DOF + 1) for p in map(table_probability, probs)]
    return literal_rows(spark, rows, "dof int, prob double, critical double")


def t_table(spark: SparkSession) -> DataFrame:
    """Wide form: one row per dof from 1 to 100, one column per probability, named like ``0.975``."""
    names = [str(p) for p in PROBABILITIES]
    rows = [(float(d), *[published_value(d, p) for p in PROBABILITIES]) for d in range(1, LAST_DOF + 1)]
    return literal_rows(spark, rows, "df double, " + ", ".join(f"`{n}` double" for n in names))


def table_dof(dof: Column) -> Column:
    """The key of the table for a count of degrees of freedom; null when there is none."""
    return F.when(dof > LAST_DOF, F.lit(INFINITY_DOF)).when(dof >= 1, dof.cast("int"))


def with_critical(df: DataFrame, dof: str, prob: float, name: str = "critical", mode: str = "table") -> DataFrame:
    """Add the critical value for each row's degrees of freedom (null below 1).

    ``mode="exact"`` computes the quantile of each distinct count of degrees of freedom, in tasks.
    """
    if mode == "table":
        values = F.broadcast(critical_values(df.sparkSession, [prob]).select(  # a row per entry of the table
            F.col("dof").alias("__key"), F.col("critical").alias(name)))
        keyed = df.withColumn("__key", table_dof(F.col(dof)))
    elif mode == "exact":
        @F.pandas_udf(T.DoubleType())
        def quantile(counts: pd.Series) -> pd.Series:
            return counts.map(lambda n: t_quantile(prob, float(n)))

        counts = df.filter(F.col(dof) >= 1).select(F.col(dof).cast("long").alias("__key")).distinct()
        values = counts.withColumn(name, quantile("__key"))
        keyed = df.withColumn("__key", F.col(dof).cast("long"))
    else:
        raise ValueError(f"mode must be 'table' or 'exact', not {mode!r}")
    return keyed.join(values, "__key", "left").drop("__key")
