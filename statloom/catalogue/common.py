"""Shared pieces of the registered queries: table access, rounding, SQL fragments."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.split import SEED
from statloom.sources.tables import read_parquet

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet", columns)


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round doubles, and turn -0.0 into 0.0, so that the last bits do not decide a comparison."""
    return df.withColumns({c: F.round(col(c), d) + F.lit(0.0) for c, d in digits.items()})


NET = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
LINE_PREDICTORS = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]


def lines(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Line items with the net price as target."""
    return (table(spark, folder, "lineitem", *LINE_PREDICTORS, *extra)
            .withColumn("net", F.expr(NET)))


def r(expression: str, digits: int, name: str) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name}"


def position_sql(key: str, seed: int = SEED) -> str:
    """SQL of ``hash_position`` for one whole-number key."""
    return f"(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT)"


def train_sql(key: str) -> str:
    return f"({position_sql(key)} < {round(0.7 * 2 ** 32)})"


def t_quantile_sql(probs: list[float], last_dof: int = 100) -> str:
    """CTEs ending in ``t_exact(v, prob, t)``: quantiles for 1..last_dof degrees of freedom.

    The distribution function is the finite trigonometric sum for whole degrees of freedom, inverted by bisection;
    it shares nothing with the incomplete beta function of the library.
    """
    listed = ", ".join(str(p) for p in probs)
    return f"""
dofs AS (SELECT CAST(range AS INTEGER) AS v FROM range(1, {last_dof + 1})),
terms AS (
  SELECT v, coalesce(list(CASE WHEN v % 2 = 1 THEN exp(lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5))
                               ELSE exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1)) END ORDER BY k)
                     FILTER (WHERE k IS NOT NULL), [0.0]) AS c
  FROM dofs LEFT JOIN (SELECT range AS k FROM range(0, {last_dof})) ON 2 * k <= v - 2 - v % 2
  GROUP BY v),
bisect AS (
  SELECT v, p.prob, c, CAST(0 AS DOUBLE) AS lo, CAST(1000 AS DOUBLE) AS hi, 0 AS step
  FROM terms, (SELECT unnest([{listed}]::DOUBLE[]) AS prob) p
  UNION ALL
  SELECT v, prob, c, CASE WHEN cdf < prob THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN cdf < prob THEN hi ELSE (lo + hi) / 2 END, step + 1
  FROM (SELECT *, 0.5 + 0.5 * CASE WHEN v % 2 = 1
                 THEN 2 / pi() * (th + sin(th) * list_sum(list_transform(c, lambda a, i: a * pow(cos(th), 2 * i - 1))))
                 ELSE sin(th) * list_sum(list_transform(c, lambda a, i: a * pow(cos(th), 2 * i - 2))) END AS cdf
        FROM (SELECT *, atan((lo + hi) / 2 / sqrt(v)) AS th FROM bisect WHERE step < 60))),
t_exact AS (SELECT v, prob, (lo + hi) / 2 AS t FROM bisect WHERE step = 60)"""


def fit_sql(tag: str, source: str, target: str, predictors: list[str]) -> tuple[str, str]:
    """CTEs that fit ``target`` on any number of predictors over the rows of ``source`` with ``train``.

    Gram-Schmidt in SQL: each predictor minus its projections on the ones before. Returns the CTEs and the name of
    the last one, which holds all rows of ``source`` with the fitted value ``{tag}_p``.
    """
    last, ctes = source, []
    for k, name in enumerate(predictors):
        step, w = f"{tag}_{k}", f"{tag}_w{k}"
        done = "".join(f", avg(CASE WHEN train THEN {tag}_z{i} * ({name}) END) / avg(CASE WHEN train THEN {tag}_z{i} "
                       f"* {tag}_z{i} END) AS c{i}" for i in range(k))
        ctes.append(f"{w} AS (SELECT avg(CASE WHEN train THEN {name} END) AS m{done} FROM {last})")
        value = f"{name} - m" + "".join(f" - c{i} * {tag}_z{i}" for i in range(k))
        ctes.append(f"{step} AS (SELECT t.*, {value} AS {tag}_z{k} FROM {last} t, {w})")
        last = step
    slopes = ", ".join(f"avg(CASE WHEN train THEN {tag}_z{i} * {target} END) / avg(CASE WHEN train THEN {tag}_z{i} * "
                       f"{tag}_z{i} END) AS b{i}" for i in range(len(predictors)))
    ctes.append(f"{tag}_b AS (SELECT avg(CASE WHEN train THEN {target} END) AS m, {slopes} FROM {last})")
    fitted = "m" + "".join(f" + b{i} * {tag}_z{i}" for i in range(len(predictors)))
    ctes.append(f"{tag}_fit AS (SELECT t.*, {fitted} AS {tag}_p FROM {last} t, {tag}_b)")
    return ",\n".join(ctes), f"{tag}_fit"
