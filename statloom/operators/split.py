"""Train/test splits and folds.

The default split hashes the row's key, so a row stays on its side whatever the partitioning, the file layout or
a re-run of a lost task. ``random_split`` is Spark's own, which depends on all three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import col

SEED = 1069  # fixed value: seed of all splits and fits
RESOLUTION = 1 << 32  # of a position: the smallest share a split can tell apart is one in four billion


class PortableKey(tuple):
    """Key columns to be hashed by md5 of their text, which any SQL engine can repeat.

    Plain lists of names are hashed by xxhash64, which costs about a tenth.
    """


def portable_key(*columns: str) -> PortableKey:
    return PortableKey(columns)


def hash_position(keys: Sequence[str], seed: int = SEED) -> Column:
    """A whole number in [0, ``RESOLUTION``) that depends on the key values, their types and the seed only.

    For a ``PortableKey`` it is the first 32 bits of md5("seed:key1|key2...").
    """
    if isinstance(keys, PortableKey):
        text = F.concat_ws("|", *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys])
        digest = F.md5(F.concat(F.lit(f"{seed}:"), text))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.pmod(F.xxhash64(F.lit(seed), *[col(k) for k in keys]), F.lit(RESOLUTION))


def split_number(keys: Sequence[str], weights: Sequence[float] = (0.7, 0.3), seed: int = SEED) -> Column:
    """0 for the first share, 1 for the second, and so on. A share too small for the resolution is an error."""
    if not weights or min(weights) <= 0:
        raise ValueError(f"weights must be positive: {weights}")
    position = hash_position(keys, seed)
    bound, total, number = 0.0, float(sum(weights)), F.lit(len(weights) - 1)
    bounds = []
    for weight in weights[:-1]:
        bound += weight / total * RESOLUTION
        bounds.append(round(bound))
    edges = [0, *bounds, RESOLUTION]
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError(f"a share is below 1 / {RESOLUTION}: {weights}")
    for k in reversed(range(len(bounds))):
        number = F.when(position < bounds[k], F.lit(k)).otherwise(number)
    return number


def hash_split(df: DataFrame, keys: Sequence[str] | None = None, weights: Sequence[float] = (0.7, 0.3),
               seed: int = SEED) -> list[DataFrame]:
    """Split by the hash of ``keys`` (all columns when none are given: equal rows then stay together)."""
    number = split_number(keys or df.columns, weights, seed)
    return [df.filter(number == k) for k in range(len(weights))]


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = SEED) -> list[DataFrame]:
    """Spark's seeded row sampling; another partitioning of the same rows gives another split."""
    return df.randomSplit(list(weights), seed)


def with_fold(df: DataFrame, keys: Sequence[str] | None = None, folds: int = 3, seed: int = SEED,
              name: str = "fold") -> DataFrame:
    """Add a fold number in [0, folds) that depends on the key only."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    return df.withColumn(name, (hash_position(keys or df.columns, seed + 1) % folds).cast("int"))


def stable_layout(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Rows hashed by key into a fixed number of partitions and sorted there.

    A seeded tree, mixture or k-means fit repeats only on the same layout. Ranges would not do: their bounds are
    sampled. It costs one shuffle, so use it where the fit must be repeatable; the keys should identify a row.
    """
    return df.repartition(partitions, *[col(k) for k in keys]).sortWithinPartitions(*[col(k) for k in keys])
