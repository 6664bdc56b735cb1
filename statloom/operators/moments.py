"""First and second moments of many columns in one pass over the data.

``pair_moments`` is the only scan behind covariance, correlation, least squares, principal components,
subset search and the closed-form grid search. Its result has one row per unordered column pair:

    col_x, col_y, n, mean_x, mean_y, sxx, syy, sxy

where ``n`` counts the rows in which both columns are present and the ``s..`` are sums of squares and
products about the pair's own means. Raw sums of squares are never formed, so large offsets cost no digits.

While the buffers of one aggregate fit generated code at Spark's default ``spark.sql.codegen.maxFields``, Spark's own
functions are used. Beyond that Spark would interpret the aggregate row by row, so each task instead folds its Arrow
batches into p x p matrices, per group about the group's own means, and hands on one row per pair. Partial rows of a pair
meet in one task by the hash of group and pair, where a window gives their common mean and their sums are merged with the
correction for the difference of the means. Nothing is read while the plan is built, and both forms give the same rows
wherever the values of a group lie and however the table is sorted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col
from statloom.sources.tables import literal_rows

# Buffer fields up to which the aggregate stays in generated code.
NATIVE_FIELDS = 100
# Groups one task keeps before it hands on its partial sums, and how many matrix cells they may take together.
GROUPS_IN_MEMORY, CELLS_IN_MEMORY = 256, 8_000_000

PAIR_FIELDS = "n long, mean_x double, mean_y double, sxx double, syy double, sxy double"


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or not a number."""
    value = col(name)
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    if isinstance(kinds.get(name.lower()), (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def complete_rows(df: DataFrame, columns: Sequence[str], on_null: str = "drop") -> DataFrame:
    """Rows in which every named column is present; the null part of the test reaches the parquet scan.

    ``on_null="error"`` keeps all rows and fails when one of them lacks a value.
    """
    if on_null == "drop":
        for name in columns:
            df = df.filter(~is_missing(df, name))
        return df
    if on_null == "error":
        first, missing = columns[0], F.lit(False)
        for name in columns:
            missing = missing | is_missing(df, name)
        text = f"null in one of {', '.join(columns)}"
        return df.withColumn(first, F.when(missing, F.raise_error(F.lit(text)).cast(df.schema[first].dataType))
                             .otherwise(col(first)))
    raise ValueError(f"on_null must be 'drop' or 'error', not {on_null!r}")


def pair_moments(df: DataFrame, columns: Sequence[str], by: str | Column | None = None,
                 pairwise: bool = True, diagonal: bool = True) -> DataFrame:
    """Moments of every unordered pair of ``columns``; ``diagonal`` adds the pairs of a column with itself.

    ``by`` adds a grouping column (result column ``part``). ``pairwise=False`` says that no value is missing,
    which saves work; use it after ``complete_rows``. Values that are not a number count as missing.
    """
    columns = list(columns)
    if not columns:
        raise ValueError("no columns given")
    if len(set(columns)) != len(columns):
        raise ValueError(f"a column is named twice: {columns}")
    values = [F.when(~is_missing(df, c), col(c)) if pairwise else col(c) for c in columns]
    frame = df.select(*([_part(by).alias("part")] if by is not None else []),
                      *[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i if diagonal else i + 1, len(columns))]
    if _fits_generated_code(pairs, pairwise):
        found = _native(frame, pairs, by is not None, pairwise)
    else:
        found = _batched(frame, pairs, by is not None)
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(*(["part"] if by is not None else []),
                        F.get(names, F.col("i")).alias("col_x"), F.get(names, F.col("j")).alias("col_y"),
                        "n", "mean_x", "mean_y", "sxx", "syy", "sxy")


def _part(by: str | Column) -> Column:
    return col(by) if isinstance(by, str) else by


def _fits_generated_code(pairs: list[tuple[int, int]], pairwise: bool) -> bool:
    if pairwise:
        fields = sum(6 if i == j else 15 for i, j in pairs)
    else:
        used = {k for pair in pairs for k in pair}
        fields = 2 * len(used) + 4 * len({*pairs, *((k, k) for k in used)})
    return fields + 2 <= NATIVE_FIELDS


def _native(frame: DataFrame, pairs: list[tuple[int, int]], grouped: bool, pairwise: bool) -> DataFrame:
    aggregates: dict[str, str] = {}
    structs = []
    if pairwise:
        for i, j in pairs:
            x, y, tag = f"v{i}", f"v{j}", f"{i}_{j}"
            if i == j:
                aggregates |= {f"n{tag}": f"count({x})", f"mx{tag}": f"avg({x})", f"sx{tag}": f"regr_sxx({x}, {x})"}
                values = [f"{k}{tag}" for k in ("n", "mx", "mx", "sx", "sx", "sx")]
            else:
                aggregates |= {f"{k}{tag}": f"{f}({y}, {x})" for k, f in (
                    ("n", "regr_count"), ("mx", "regr_avgx"), ("my", "regr_avgy"), ("sx", "regr_sxx"),
                    ("sy", "regr_syy"), ("sp", "regr_sxy"))}
                values = [f"{k}{tag}" for k in ("n", "mx", "my", "sx", "sy", "sp")]
            structs.append(_pair(i, j, values))
    else:
        used = sorted({k for pair in pairs for k in pair})
        aggregates |= {"n": "count(1)", **{f"m{i}": f"avg(v{i})" for i in used}}
        aggregates |= {f"c{i}_{j}": f"covar_pop(v{i}, v{j})" for i, j in sorted({*pairs, *((k, k) for k in used)})}
        structs = [_pair(i, j, ["n", f"m{i}", f"m{j}", f"c{i}_{i} * n", f"c{j}_{j} * n", f"c{i}_{j} * n"])
                   for i, j in pairs]
    keys = ["part"] if grouped else []
    measured = frame.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in aggregates.items()])
    return measured.selectExpr(*keys, f"inline(array({', '.join(structs)}))")


def _pair(i: int, j: int, values: Sequence[str]) -> str:
    names = ("i", "j", "n", "mean_x", "mean_y", "sxx", "syy", "sxy")
    return f"named_struct({', '.join(f'{k!r}, {v}' for k, v in zip(names, (i, j, *values)))})"


def _batched(frame: DataFrame, pairs: list[tuple[int, int]], grouped: bool) -> DataFrame:
    names = [c for c in frame.columns if c != "part"]
    first, second = (np.array(side) for side in zip(*pairs))
    most = max(1, min(GROUPS_IN_MEMORY, CELLS_IN_MEMORY // len(names) ** 2))

    # Defined here, not at module level, so that they travel to the workers by value: they need numpy and pyarrow
    # but not this package.
    def centred(values: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, ...]:
        """Counts, means and sums about them for every pair of columns, over the rows in which both are present.

        Entry (i, j) belongs to column i among the rows that have j too.
        """
        if present.all():
            mean = values.mean(0)
            shifted = values - mean
            product = shifted.T @ shifted
            square = np.full_like(product, len(values))
            return square, np.repeat(mean[:, None], len(mean), 1), np.repeat(np.diag(product)[:, None], len(mean), 1), product
        both = present.astype(float)
        n = both.T @ both
        known = np.maximum(n, 1.0)
        values = np.where(present, values, 0.0)
        middle = values.sum(0) / np.diag(known)
        shifted = np.where(present, values - middle, 0.0)
        off = shifted.T @ both / known  # mean of i among the rows of (i, j), from the mean of i
        raw = (shifted ** 2).T @ both
        sxx, sxy = raw - n * off * off, shifted.T @ shifted - n * off * off.T
        # Where rows with both values lie far from the rest of their column, the differences above lose digits.
        for i, j in zip(*np.nonzero((sxx < 1e-6 * raw) & (n > 0))):
            rows = present[:, i] & present[:, j]
            x, y = shifted[rows, i], shifted[rows, j]
            x, y = x - x.mean(), y - y.mean()
            sxx[i, j], sxx[j, i], sxy[i, j] = x @ x, y @ y, x @ y
            sxy[j, i] = sxy[i, j]
        return n, middle[:, None] + off, sxx, sxy

    class Sums:
        """Moments of one group in one task about the group's own means so far."""

        def __init__(self):
            self.n, self.mean, self.sxx, self.sxy = (np.zeros((len(names),) * 2) for _ in range(4))

        def add(self, values: np.ndarray, present: np.ndarray) -> None:
            n, mean, sxx, sxy = centred(values, present)
            total = np.maximum(self.n + n, 1.0)
            gap = np.where(n > 0, mean - self.mean, 0.0)
            weight = self.n * (n / total)
            self.sxx += sxx + gap * gap * weight
            self.sxy += sxy + gap * gap.T * weight
            self.mean += gap * (n / total)
            self.n += n

        def rows(self, i: np.ndarray, j: np.ndarray) -> dict[str, np.ndarray]:
            return {"i": i.astype(np.int32), "j": j.astype(np.int32), "n": self.n[i, j].astype(np.int64),
                    "mean_x": self.mean[i, j], "mean_y": self.mean[j, i], "sxx": self.sxx[i, j], "syy": self.sxx[j, i],
                    "sxy": self.sxy[i, j]}

    def matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        columns = [batch.column(n) for n in names]
        values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
        if any(c.null_count for c in columns):
            present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
        else:
            present = np.broadcast_to(np.True_, values.shape)
        return values, present

    def emit(sums: dict, part_type) -> Iterator[pa.RecordBatch]:
        if not sums:
            return
        found = [group.rows(first, second) for group in sums.values()]
        fields = {name: np.concatenate([f[name] for f in found]) for name in found[0]}
        if grouped:
            parts = pa.array(list(sums), part_type)
            fields = {"part": parts.take(pa.array(np.repeat(np.arange(len(sums)), len(first)))), **fields}
        yield pa.RecordBatch.from_pydict(fields)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        part_type = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values, present = matrix(batch)
            if grouped:
                coded = batch.column("part").dictionary_encode(null_encoding="encode")
                part_type = batch.column("part").type
                codes = coded.indices.to_numpy(zero_copy_only=False)
                order = np.argsort(codes, kind="stable")
                values, present = values[order], np.broadcast_to(present, values.shape)[order]
                ends = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
                slices = [(part.as_py(), slice(ends[k], ends[k + 1])) for k, part in enumerate(coded.dictionary)]
            else:
                slices = [(None, slice(None))]
            for part, rows in slices:
                if part not in sums:
                    if len(sums) >= most:
                        yield from emit(sums, part_type)
                        sums = {}
                    sums[part] = Sums()
                sums[part].add(values[rows], present[rows])
        yield from emit(sums, part_type)

    part_field = f"part {frame.schema['part'].dataType.simpleString()}, " if grouped else ""
    partial = frame.mapInArrow(fold, f"{part_field}i int, j int, {PAIR_FIELDS}")
    if not grouped:  # a table without rows still gets a row per pair, with n = 0
        listed = literal_rows(frame.sparkSession, pairs, "i int, j int")
        partial = partial.unionByName(listed.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    return _merged(partial, [*(["part"] if grouped else []), "i", "j"])


def _merged(partial: DataFrame, keys: list[str]) -> DataFrame:
    """Partial moments ``keys, n, mean_x, mean_y, sxx, syy, sxy`` of the same keys as one row each.

    The common mean is taken relative to one of the partial means, and what each part adds for lying beside it is a product
    of differences: no large squares are subtracted. Window and aggregate share one shuffle; a key has at most a few rows
    per task of the scan.
    """
    same, n = Window.partitionBy(*keys), F.col("n")
    partial = partial.withColumns({c: F.when(n > 0, F.col(c)) for c in ("mean_x", "mean_y", "sxx", "syy", "sxy")})
    near = {f"near_{c}": F.min(f"mean_{c}").over(same) for c in "xy"}
    gaps = {f"gap_{c}": F.col(f"mean_{c}") - F.col(f"near_{c}") for c in "xy"}
    shifts = {f"shift_{c}": F.sum(n * F.col(f"gap_{c}")).over(same) / F.nullif(F.sum("n").over(same), F.lit(0)) for c in "xy"}
    beside = {f"gap_{c}": F.col(f"gap_{c}") - F.col(f"shift_{c}") for c in "xy"}
    parts = partial.withColumns(near).withColumns(gaps).withColumns(shifts).withColumns(beside)
    x, y = F.col("gap_x"), F.col("gap_y")
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.first(F.col(f"near_{c}") + F.col(f"shift_{c}")).alias(f"mean_{c}") for c in "xy"],
        F.sum(F.col("sxx") + n * x * x).alias("sxx"), F.sum(F.col("syy") + n * y * y).alias("syy"),
        F.sum(F.col("sxy") + n * x * y).alias("sxy"))


def column_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float | None, float | None]]:
    """Count, mean and sample standard deviation of each column over its present values, in one pass."""
    columns = list(columns)
    frame = df.select(*[F.when(~is_missing(df, c), col(c)).cast("double").alias(f"v{i}")
                        for i, c in enumerate(columns)])
    pairs = [(i, i) for i in range(len(columns))]
    rows = (_native(frame, pairs, False, True) if _fits_generated_code(pairs, True) else
            _batched(frame, pairs, False)).collect()
    return {columns[r["i"]]: (r["n"], r["mean_x"], (r["sxx"] / (r["n"] - 1)) ** 0.5 if r["n"] > 1 else None)
            for r in rows}


@dataclass(frozen=True)
class Moments:
    """Moments of complete rows on the driver: p numbers and one p x p matrix, whatever the row count."""

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    scatter: np.ndarray  # centred sums of squares and products

    def at(self, names: Sequence[str]) -> list[int]:
        return [self.columns.index(n) for n in names]

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if n == 0:
            return self
        gap = other.mean - self.mean
        return Moments(self.columns, n, self.mean + gap * (other.n / n),
                       self.scatter + other.scatter + np.outer(gap, gap) * (self.n * other.n / n))


def collect_moments(df: DataFrame, columns: Sequence[str], by: str | Column | None = None,
                    on_null: str = "drop") -> dict:
    """One pass over the complete rows; ``{part: Moments}``, with the single key None when ``by`` is not given."""
    columns = tuple(columns)
    return moments_from_rows(pair_moments(complete_rows(df, columns, on_null), columns, by, pairwise=False).collect(),
                             columns, by is not None)


def moments_from_rows(rows: Sequence[Row], columns: Sequence[str], grouped: bool = False) -> dict:
    """Collected rows of ``pair_moments``, diagonal included, as matrices; pairs of other columns are left out."""
    columns = tuple(columns)
    place = {c: i for i, c in enumerate(columns)}
    found: dict = {}
    for row in rows:
        if not row["n"] or row["col_x"] not in place or row["col_y"] not in place:
            continue
        part = row["part"] if grouped else None
        if part not in found:
            found[part] = Moments(columns, row["n"], np.zeros(len(columns)), np.zeros((len(columns),) * 2))
        i, j = place[row["col_x"]], place[row["col_y"]]
        moments = found[part]
        moments.mean[i], moments.mean[j] = row["mean_x"], row["mean_y"]
        moments.scatter[i, j] = moments.scatter[j, i] = row["sxy"]
    return found
