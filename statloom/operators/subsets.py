"""Best-subset regression: every non-empty set of predictors, fitted on one share and measured on the other.

One pass takes the moments of both shares. Tasks then fit runs of neighbouring sets by sweeps (``sweep.py``) and
take r2 and rmse from the moments of the test share, so no list of sets, fits or results is on the driver. Mean absolute
errors need the rows: one more pass, in which every task repeats the sweeps and hands on one row per set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.moments import Moments, collect_moments, complete_rows
from statloom.operators.split import SEED, split_number
from statloom.operators.sweep import run_count, run_of_fits, run_size, set_numbers, squared_errors
from statloom.session import scratch_path

MOST = 30  # predictors; their 2^30 sets are more rows than a search can be meant to give
ROWS_TOGETHER, ROWS_AT_ONCE = 65_536, 2_048  # rows a task keeps for one round of all sets, and in one product


def column_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))


def column_subsets(columns: Sequence[str], limit: int | None = None) -> list[tuple[str, ...]]:
    """All non-empty subsets, the smaller ones first. ``limit`` refuses longer lists of columns."""
    columns = list(columns)
    if limit is not None and len(columns) > limit:
        raise ValueError(f"{len(columns)} predictors give 2^{len(columns)} - 1 subsets; the limit is {limit}")
    return [c for size in range(1, len(columns) + 1) for c in combinations(columns, size)]


def best_subset(df: DataFrame, target: str, predictors: Sequence[str], keys: Sequence[str] | None = None,
                weights: Sequence[float] = (0.7, 0.3), seed: int = SEED, limit: int | None = None,
                mae: bool = True) -> DataFrame:
    """``id, preds, num_preds, r2, rmse, mae`` for every subset; metrics are those of the test share.

    ``id`` numbers the subsets, the smaller ones first. A set of collinear predictors gets the fit of least norm. A
    target that is constant in the test share has no r2. ``mae=False`` leaves that column null and reads the rows once
    instead of twice; rmse is then, as always, taken from moments, which show an error down to about 1e-8 of the target's
    spread. The result is written to the shared folder and read back.
    """
    predictors = list(predictors)
    p = len(predictors)
    if not predictors or p > min(MOST, MOST if limit is None else limit):
        raise ValueError(f"{p} predictors give 2^{p} - 1 subsets; the limit is {MOST if limit is None else limit}")
    columns = [*predictors, target]
    rows = complete_rows(df, columns).select(
        *[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)],
        (split_number(keys or df.columns, weights, seed) == 0).alias("train"))
    names = [f"v{i}" for i in range(len(columns))]
    parts = collect_moments(rows, names, by="train")
    if True not in parts or False not in parts:
        raise ValueError("a share of the split is empty")
    found = _from_moments(df.sparkSession, parts[True], parts[False], predictors)
    if mae:
        errors = _absolute_errors(rows.filter(~F.col("train")).select(*names), names, parts[True])
        found = found.join(errors.select("rank", (F.col("absolute") / parts[False].n).alias("mae")), "rank")
    else:
        found = found.withColumn("mae", F.lit(None).cast("double"))
    path = scratch_path(df.sparkSession, "subsets")
    found.select("id", "preds", "num_preds", "r2", "rmse", "mae").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _from_moments(spark: SparkSession, train: Moments, test: Moments, predictors: list[str]) -> DataFrame:
    """``rank`` (in Gray-code order) and all but the mean absolute error of every set, a run of sets per input row."""
    p = len(predictors)
    fits, numbers, squares, size = run_of_fits(train), set_numbers(p), squared_errors(test), run_size(p)
    spread, n = float(test.scatter[p, p]), test.n

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                chosen, slopes, intercepts = fits(number)
                squared = squares(slopes, intercepts)
                yield pa.RecordBatch.from_pydict({
                    "rank": np.arange(number * size, (number + 1) * size), "id": numbers(chosen),
                    "preds": [", ".join(c for c, taken in zip(predictors, row) if taken) for row in chosen],
                    "num_preds": chosen.sum(1).astype(float),
                    "r2": pa.array(1.0 - squared / spread) if spread > 0 else pa.nulls(size, pa.float64()),
                    "rmse": np.sqrt(squared / n)})

    schema = "rank long, id long, preds string, num_preds double, r2 double, rmse double"
    return spark.range(run_count(p)).mapInArrow(measure, schema).filter("id >= 0")


def _absolute_errors(held: DataFrame, names: Sequence[str], train: Moments) -> DataFrame:
    """``rank`` and the sum of absolute errors of every set, from one pass over the rows."""
    p = len(names) - 1
    fits, size, runs = run_of_fits(train), run_size(p), run_count(p)
    together, at_once = ROWS_TOGETHER, ROWS_AT_ONCE

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, waiting, count, seen = np.zeros((runs, size)), [], 0, False

        def measure(values: np.ndarray) -> None:
            for number in range(runs):
                _, slopes, intercepts = fits(number)
                for start in range(0, len(values), at_once):
                    block = values[start:start + at_once]
                    missed = block[:, :p] @ slopes.T + intercepts - block[:, p:]
                    sums[number] += np.abs(missed, out=missed).sum(0)

        for batch in batches:
            waiting.append(np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names]))
            count, seen = count + batch.num_rows, seen or batch.num_rows > 0
            if count >= together:
                measure(np.concatenate(waiting))
                waiting, count = [], 0
        if count:
            measure(np.concatenate(waiting))
        if seen:
            for number in range(runs):
                yield pa.RecordBatch.from_pydict(
                    {"rank": np.arange(number * size, (number + 1) * size), "absolute": sums[number]})

    return held.mapInArrow(errors, "rank long, absolute double").groupBy("rank").agg(F.sum("absolute").alias("absolute"))


def ranked(subsets: DataFrame) -> DataFrame:
    """Best r2 first."""
    return subsets.orderBy(F.desc_nulls_last("r2"), "id")


def equal_to_extreme(df: DataFrame, column: str, largest: bool = True) -> DataFrame:
    """All rows whose value equals the largest (or smallest) one, ties included."""
    extreme = df.agg((F.max if largest else F.min)(col(column)).alias("__extreme"))
    return df.join(F.broadcast(extreme), col(column) == F.col("__extreme")).drop("__extreme")


def winners(subsets: DataFrame) -> DataFrame:
    """The rows with the largest r2, the smallest rmse and the smallest mae, each named by ``best_by``."""
    found = None
    for metric, largest in (("r2", True), ("rmse", False), ("mae", False)):
        rows = equal_to_extreme(subsets, metric, largest).select(F.lit(metric).alias("best_by"), "*")
        found = rows if found is None else found.unionByName(rows)
    return found
