"""Matrix products along rows, a batch at a time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col


def row_products(columns: Sequence[str], matrix: np.ndarray, offset: np.ndarray) -> Column:
    """``x @ matrix + offset`` of each row as an array; null where a column is null."""
    matrix, offset = np.asarray(matrix, float), np.asarray(offset, float)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def products(*values: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(float) for v in values])
        missing = np.isnan(x).any(1)
        return pd.Series([None if gone else row for gone, row in zip(missing, x @ matrix + offset)], dtype=object)

    return products(*[col(c).cast("double") for c in columns])


def with_products(df: DataFrame, columns: Sequence[str], matrix: np.ndarray, offset: np.ndarray,
                  names: Sequence[str]) -> DataFrame:
    """Add the products as columns of the given names."""
    made = df.withColumn("__products", row_products(columns, matrix, offset))
    return made.withColumns({n: F.get("__products", F.lit(i)) for i, n in enumerate(names)}).drop("__products")
