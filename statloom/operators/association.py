"""Covariance and correlation of every column pair, and the t-test report on the correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import ratio
from statloom.functions.critical import table_probability, test_probability, with_critical
from statloom.operators.moments import PAIR_FIELDS, pair_moments
from statloom.sources.tables import literal_rows

# Labels of the report.
REJECT, KEEP, UNDEFINED = "Reject Null Hyp", "Fail to Reject", "Undefined"
# 1 - r^2 below this is rounding noise of a perfect correlation. It grows with the rows that one task adds up: the second
# value is for each of them, up to the third.
PERFECT, NOISE, NOISY_ROWS = 1e-14, 2.0 ** -55, 1 << 22


def pairs_of(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The moments behind every table here: one row per unordered pair of different columns."""
    columns = list(columns or df.columns)
    if len(columns) < 2:
        raise ValueError("at least two columns are needed")
    return pair_moments(df, columns, diagonal=False)


def _pearson() -> Column:
    return ratio(F.col("sxy"), F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy")))


def covariance_table(pairs: DataFrame) -> DataFrame:
    return pairs.select("col_x", "col_y", "n", ratio(F.col("sxy"), F.col("n") - 1).alias("cov"))


def correlation_table(pairs: DataFrame) -> DataFrame:
    return pairs.select("col_x", "col_y", "n", _pearson().alias("corr"))


def pair_covariance(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Sample covariance of every unordered pair: ``col_x, col_y, n, cov``."""
    return covariance_table(pairs_of(df, columns))


def pair_correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every unordered pair: ``col_x, col_y, n, corr``; null where a column is constant."""
    return correlation_table(pairs_of(df, columns))


def pair_statistic(df: DataFrame, statistic: str = "corr", columns: Sequence[str] | None = None) -> DataFrame:
    if statistic == "corr":
        return pair_correlation(df, columns)
    if statistic == "cov":
        return pair_covariance(df, columns)
    raise ValueError(f"statistic must be 'corr' or 'cov', not {statistic!r}")


def correlation_report(df: DataFrame, alpha: float = 0.05, test: str = "two-sided",
                       columns: Sequence[str] | None = None, mode: str = "table") -> DataFrame:
    """Is each correlation different from zero?

    Columns ``Columns, n, Corr, CoefDet, tValue, abs_tValue, critical, Significance``, largest correlation first.
    ``n`` and the degrees of freedom are those of the pair. ``mode="table"`` reads the published table,
    ``mode="exact"`` accepts any alpha.
    """
    return report_on(pairs_of(df, columns), alpha, test, mode)


def report_on(pairs: DataFrame, alpha: float = 0.05, test: str = "two-sided", mode: str = "table") -> DataFrame:
    """The report from moments taken before."""
    prob = test_probability(alpha, test)
    if mode == "table":
        prob = table_probability(prob)
    elif mode == "exact":  # the pairs are few; taken once, they serve the quantiles and the report
        pairs = literal_rows(pairs.sparkSession, pairs.collect(), f"col_x string, col_y string, {PAIR_FIELDS}")
    r, t, critical = F.col("Corr"), F.col("tValue"), F.col("critical")
    noise = F.greatest(F.lit(PERFECT), F.least(F.col("n"), F.lit(NOISY_ROWS)) * F.lit(NOISE))
    scored = (pairs
              .select(F.concat_ws(" vs ", "col_x", "col_y").alias("Columns"), "n", _pearson().alias("Corr"))
              .withColumn("CoefDet", F.pow(r, F.lit(2.0)))
              .withColumn("dof", F.col("n") - 2)
              .withColumn("tValue", F.when((F.col("dof") >= 1) & (1.0 - F.col("CoefDet") > noise),
                                           r * F.sqrt(F.col("dof") / (1.0 - F.col("CoefDet")))))
              .withColumn("abs_tValue", F.abs(t)))
    rejected = {"two-sided": F.abs(t) > critical, "upper one-sided": t > critical,
                "lower one-sided": t < -critical}[test]
    label = (F.when(t.isNull() | critical.isNull(), F.lit(UNDEFINED))
             .when(rejected, F.lit(REJECT)).otherwise(F.lit(KEEP)))
    return (with_critical(scored, "dof", prob, "critical", mode)
            .select("Columns", "n", "Corr", "CoefDet", "tValue", "abs_tValue", "critical",
                    label.alias("Significance"))
            .orderBy(F.desc_nulls_last("Corr"), "Columns"))
