"""From raw tables to one clean wide row per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col


# -- filters ---------------------------------------------------------------------------------------------------

def present(*names: str) -> Column:
    """All named columns hold a value."""
    condition = F.lit(True)
    for name in names:
        condition = condition & col(name).isNotNull()
    return condition


def one_of(name: str, values: Sequence) -> Column:
    return col(name).isin(list(values))


def inside(name: str, low=None, high=None) -> Column:
    """Open range: low < value < high, either bound optional."""
    condition = F.lit(True)
    if low is not None:
        condition = condition & (col(name) > F.lit(low))
    if high is not None:
        condition = condition & (col(name) < F.lit(high))
    return condition


def keep(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet every condition."""
    for condition in conditions:
        df = df.filter(condition)
    return df


# -- keys ------------------------------------------------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count. Counts are combined before the shuffle."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def no_key_twice(df: DataFrame, key: str) -> Column:
    """True, or an error when it is computed, should a key be held by more than one row.

    A subquery of one row inside the plan: nothing runs before the action, and other filters still reach the scan.
    """
    twice = duplicate_keys(df, [key]).agg(F.count(F.lit(1)).alias("keys"), F.min(col(key)).alias("least"))
    text = F.concat(F.lit(f"{key} is not unique: "), F.col("least").cast("string").substr(1, 100), F.lit(" ..."))
    return twice.select(F.when(F.col("keys") == 0, F.lit(True)).otherwise(
        F.raise_error(F.coalesce(text, F.lit(f"{key} is not unique: null"))).cast("boolean"))).scalar()


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that is largest by ``order``, ties settled by the other columns.

    An aggregate rather than a window, so that a key holding a large share of all rows is reduced before the
    shuffle and never sits in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    leading = [c for c in order if c not in keys]
    fields = df.schema
    if any(_unordered(fields[c].dataType) for c in rest):
        best = F.max_by(F.struct(*[col(c) for c in leading + rest]), F.struct(*[col(c) for c in leading]))
    else:
        best = F.max(F.struct(*[col(c) for c in leading + rest]))
    return (df.groupBy(*[col(k) for k in keys]).agg(best.alias("__row"))
            .select(*[col(k) for k in keys], "__row.*").select(*[col(c) for c in df.columns]))


def _unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.UserDefinedType, T.VariantType))


# -- joins -----------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Detail:
    """A table to be joined to the base, and what to do when its key is not unique.

    ``unique``: "raise" fails when rows are read and a key comes twice, "latest" keeps the largest row by ``order``,
    "trust" does neither.
    """

    table: DataFrame
    base_key: str
    detail_key: str
    unique: str = "raise"
    order: tuple[str, ...] = ()

    def rows(self) -> DataFrame:
        if self.unique == "trust":
            return self.table
        if self.unique == "latest":
            return keep_latest(self.table, [self.detail_key], list(self.order))
        if self.unique == "raise":
            return self.table.where(no_key_twice(self.table, self.detail_key))
        raise ValueError(f"unique must be 'raise', 'latest' or 'trust', not {self.unique!r}")


def wide_join(base: DataFrame, details: Sequence[Detail]) -> DataFrame:
    """Left joins of every detail table to the base: one row per base row.

    The join strategy is Spark's choice: it broadcasts a detail only below its own size threshold, otherwise it
    shuffles both sides and splits skewed partitions at run time. Later filters on detail columns turn the left
    joins into inner ones.
    """
    wide = base
    for detail in details:
        rows = detail.rows()
        clash = [c for c in rows.columns if c in wide.columns and c != detail.detail_key]
        if clash:
            raise ValueError(f"columns in both tables: {clash}")
        if detail.base_key == detail.detail_key:
            wide = wide.join(rows, detail.base_key, "left")
        else:
            wide = wide.join(rows, wide[detail.base_key] == rows[detail.detail_key], "left")
    return wide


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join that keeps each key column once."""
    return left.join(right, list(keys))


# -- row-wise branches -----------------------------------------------------------------------------------------

def regimes(df: DataFrame, branches: Sequence[tuple[Column, Mapping[str, Column]]]) -> DataFrame:
    """Change columns by the first branch whose condition holds for the row; other rows stay as they are.

    One projection: conditions and new values all read the incoming row.
    """
    changed: dict[str, Column | None] = {}
    names = dict.fromkeys(n for _, values in branches for n in values)
    for name in names:
        chain = None
        for condition, values in branches:
            own = values.get(name, col(name) if name in df.columns else F.lit(None))
            chain = F.when(condition, own) if chain is None else chain.when(condition, own)
        changed[name] = chain.otherwise(col(name) if name in df.columns else F.lit(None))
    return df.withColumns(changed)


# -- order -----------------------------------------------------------------------------------------------------

def sorted_by(df: DataFrame, *names: str, descending: bool = False) -> DataFrame:
    return df.orderBy(*[col(n).desc() if descending else col(n).asc() for n in names])


def top(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The k rows with the largest value; each task keeps k rows, so no full sort takes place."""
    return df.orderBy(col(by).desc(), *[col(t).asc() for t in ties]).limit(k)
