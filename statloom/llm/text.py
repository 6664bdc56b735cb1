"""Shared pieces: what a word and a space are, whole texts, staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.session import scratch_path

SPACES = " \t\n\u000b\u000c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(name: str = "text") -> Column:
    """The text of a row; null is the empty text."""
    return F.coalesce(col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Only A-Z become small letters, whatever the locale. In plain ASCII there are no others, and ``lower`` is fast."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back.

    The result is computed once, does not change when tasks run again, and outlives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """For each name one that no column of the frame has, in any case, so that helper columns cannot clash."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def one_of_each(df: DataFrame, *by: str) -> DataFrame:
    """One row per value of the ``by`` columns, with all other columns: of different rows the one with the least hash of
    all its columns, so that reruns agree. ``by`` is dropped. Maps cannot be hashed and do not count."""
    others = [c for c in df.columns if c not in by]
    hashable = [col(c) for c in others if "map<" not in dict(df.dtypes)[c]]
    picked = F.min_by(F.struct(*[col(c) for c in others]), F.xxhash64(*hashable)).alias("picked")
    return df.groupBy(*by).agg(picked).select("picked.*")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]
