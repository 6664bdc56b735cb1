"""Triangular factor of centred columns (tall-skinny QR), in one pass.

The factor R of the centred rows X satisfies R'R = X'X, but X'X is never formed: what R shows of nearly collinear columns
is limited by their condition, what X'X shows by its square. Each task folds its Arrow batches into one p x p factor;
two factors are merged by the factor of both stacked on one row for the difference of their means. Partial factors meet
in ``FAN`` tasks first, so the driver receives that many small matrices at most, however many tasks read the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.operators.moments import Moments, complete_rows

FAN = 32  # tasks that merge the partial factors before the driver does


@dataclass(frozen=True)
class Factor:
    """``upper.T @ upper`` are the centred sums of squares and products of ``columns`` over ``n`` rows."""

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    upper: np.ndarray

    @property
    def moments(self) -> Moments:
        return Moments(self.columns, self.n, self.mean, self.upper.T @ self.upper)


def collect_factor(df: DataFrame, columns: Sequence[str], on_null: str = "drop") -> Factor | None:
    """The factor of the complete rows; None when there are none."""
    columns = tuple(columns)
    if not columns or len(set(columns)) != len(columns):
        raise ValueError(f"columns must be given, each once: {list(columns)}")
    p = len(columns)
    rows = complete_rows(df, columns, on_null).select(*[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])

    # Parts are (rows, shift, offset, factor): the mean is shift + offset, and the shift one of the rows, so that the
    # distance of two means keeps its digits where both are large. Defined here, so that they travel by value.
    def of_values(values: np.ndarray) -> tuple:
        shift = values[0].copy()
        centred = values - shift
        offset = centred.mean(0)
        centred -= offset
        left = centred.mean(0)
        upper = np.zeros((p, p))
        found = np.linalg.qr(centred - left, mode="r")
        upper[:len(found)] = found
        return len(values), shift, offset + left, upper

    def merged(a: tuple | None, b: tuple) -> tuple:
        if a is None:
            return b
        n = a[0] + b[0]
        gap = (b[1] - a[1]) + (b[2] - a[2])
        upper = np.linalg.qr(np.vstack([a[3], b[3], np.sqrt(a[0] * (b[0] / n)) * gap]), mode="r")
        return n, a[1], a[2] + gap * (b[0] / n), upper

    def row(part: tuple | None) -> Iterator[pa.RecordBatch]:
        if part is not None:
            lists = [pa.array([np.ravel(x)], pa.list_(pa.float64())) for x in part[1:]]
            yield pa.RecordBatch.from_arrays([pa.array([part[0]], pa.int64()), *lists], ["n", "shift", "offset", "upper"])

    def parts(batch: pa.RecordBatch) -> Iterator[tuple]:
        for r in batch.to_pylist():
            yield r["n"], np.array(r["shift"]), np.array(r["offset"]), np.array(r["upper"]).reshape(p, p)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            if batch.num_rows:
                values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                part = merged(part, of_values(values))
        yield from row(part)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            for other in parts(batch.select(["n", "shift", "offset", "upper"])):
                part = merged(part, other)
        yield from row(part)

    schema = "n long, shift array<double>, offset array<double>, upper array<double>"
    partial = rows.mapInArrow(fold, schema).withColumn("slot", F.spark_partition_id() % FAN)
    total = None
    for r in partial.repartition(FAN, "slot").mapInArrow(merge, schema).collect():
        total = merged(total, (r["n"], np.array(r["shift"]), np.array(r["offset"]), np.array(r["upper"]).reshape(p, p)))
    return None if total is None else Factor(columns, total[0], total[1] + total[2], total[3])
