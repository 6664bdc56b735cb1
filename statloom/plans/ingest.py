"""The ingest job: raw tables to a clean wide parquet directory, in one evaluation of the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from statloom.functions.columns import add_in_order
from statloom.operators.prepare import Detail, keep, wide_join
from statloom.sinks.files import save_parquet, written_rows


def wide_clean(base: DataFrame, details: Sequence[Detail], conditions: Sequence[Column],
               derived: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Join, filter and derive; lazy."""
    return add_in_order(keep(wide_join(base, details), *conditions), derived)


def ingest(base: DataFrame, details: Sequence[Detail], conditions: Sequence[Column],
           derived: Sequence[tuple[str, Column]], path: str, sort_keys: Sequence[str] = ()) -> dict[str, int]:
    """Write the clean table and return the row counts before and after cleaning.

    The plan runs once, for the write. Left joins to unique keys keep the rows of the base, so the raw count is the
    base's own, and the clean count comes from the written footers; only a detail of unknown uniqueness ("trust")
    makes the raw count run the joins.
    """
    save_parquet(wide_clean(base, details, conditions, derived), path, sort_keys)
    unsure = any(d.unique == "trust" for d in details)
    raw = wide_join(base, details).count() if unsure else base.count()
    return {"raw_rows": raw, "clean_rows": written_rows(base.sparkSession, path)}
