"""Column expressions: quoting, safe arithmetic, casts, labels, array access."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its literal name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero divisor (plain ``/`` raises in ANSI mode)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(value: Column, digits: int = 0) -> Column:
    """Round half away from zero."""
    return F.round(value, digits)


def null_to(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def to_number(value: Column, type_name: str = "double") -> Column:
    """Cast that gives null for malformed text."""
    return value.try_cast(type_name)


def verdict(condition: Column, yes: str, no: str) -> Column:
    """``yes`` where the condition holds, otherwise ``no``."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def array_to_columns(df: DataFrame, array: str, names: Sequence[str], type_name: str = "double",
                     keep_array: bool = False, positions: Sequence[int] | None = None) -> DataFrame:
    """Spread an array column over typed columns, one name per element; a row of another length is an error.

    ``positions`` picks elements instead, one per name, counted from 0; a position beyond the end gives null. A null
    array gives nulls.
    """
    source = col(array)
    if positions is None:
        positions = range(len(names))
        kind = df.select(source).schema[0].dataType
        text = F.format_string(f"{array} has %d elements, not {len(names)}", F.size(source))
        source = F.when(source.isNull() | (F.size(source) == len(names)), source).otherwise(F.raise_error(text).cast(kind))
    if len(positions) != len(names):
        raise ValueError(f"{len(names)} names for {len(positions)} positions")
    wide = df.withColumns({n: F.get(source, F.lit(i)).cast(type_name) for n, i in zip(names, positions)})
    return wide if keep_array else wide.drop(array)


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Add an id that is unique within one evaluation. It is no join key: it changes with the partitioning."""
    return df.withColumn(name, F.monotonically_increasing_id())


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: to_number(col(name), t) for name, t in types.items()})


def add_in_order(df: DataFrame, columns: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add columns one after the other, so that a later one may read an earlier one."""
    for name, value in columns:
        df = df.withColumn(name, value)
    return df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[col(n) for n in names])
