"""Many k-means fits at once: each pass over the rows moves the centres of all of them.

Starts are drawn by the hash of a row key, sums meet in any order but centres are rounded to ten digits after each move,
and a row equally near to two centres belongs to the lower one. So the centres do not depend on the layout of the rows.

Rows are kept between the passes as blocks of scaled numbers. Products in single precision, with a bound of their error, show
which centres can be nearest to a row; where that leaves more than one, double precision decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col
from statloom.operators.moments import column_moments, complete_rows
from statloom.operators.split import SEED
from statloom.sources.tables import literal_rows

ROUNDS = 4  # of drawing candidates for the starts; each brings as many as the largest k
DIGITS = 10  # of a centre, in scaled space
EQUAL = 2.0 ** 30  # distances that agree after rounding to a 2^-30th are equal
CELLS = 4_000_000  # row x centre products held at a time
BLOCK_BYTES = 8 << 20  # of the scaled numbers of a block
CHUNK, GROUP = 1024, 400  # rows and centres of a product in single precision: it stays in a core's cache
HALF_UNIT = 2.0 ** -24  # in the last place of a number in single precision
TASK_ROWS, TASK_BYTES = 2048, 64 << 20  # a task has that many rows at least, and that many bytes once every core has a task
KEEP = 2, 8  # moves after which the blocks hold the centres of their rows: from then on few rows change theirs
SLICES = 64  # at most, in which the sums of the tasks meet


@dataclass(frozen=True)
class Scale:
    """x = (value - mean) / deviation, 0 for constant columns. ``shift`` is what uncentred scaling would add."""

    mean: np.ndarray
    deviation: np.ndarray
    shift: np.ndarray
    rows: int  # from which these were taken

    @classmethod
    def of(cls, df: DataFrame, predictors: Sequence[str], center: bool) -> "Scale":
        found = column_moments(df, predictors)
        mean = np.array([found[p][1] or 0.0 if p in found else 0.0 for p in predictors])
        deviation = np.array([found[p][2] or 0.0 if p in found else 0.0 for p in predictors])
        safe = np.where(deviation > 0, deviation, np.inf)
        rows = max((n for n, _, _ in found.values()), default=0)
        return cls(mean, safe, np.zeros(len(mean)) if center else mean / safe, rows)

    def apply(self, values: np.ndarray) -> np.ndarray:
        return (values - self.mean) / self.deviation


def _nearness(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance less the square of the row itself, in whole 2^-30ths: one matrix product."""
    out = x @ (centres.T * (-2 * EQUAL))
    out += (centres ** 2).sum(1) * EQUAL
    return np.rint(out, out=out)


@dataclass(frozen=True)
class Blocks:
    """Rows in blocks: ``x`` (scaled, row after row) and ``weight`` as bytes; the draws of each turn, or ``own``, the centre
    that each row had in the fits ``kept``, fit after fit. Other rows of the frame hold sums."""

    frame: DataFrame
    width: int
    tasks: int  # at most
    kept: tuple[int, ...] = ()
    kind: str = "uint8"  # of a number in ``own``

    @classmethod
    def of(cls, rows: DataFrame, scale: Scale, many: int) -> "Blocks":
        """``many`` rows at most, all there is to tell how many tasks they are worth: each hands on sums of all centres."""
        width = len(scale.mean)
        names = ["x", "weight", *[f"draw{turn}" for turn in range(ROUNDS + 1)]]
        most = max(1, BLOCK_BYTES // (8 * max(1, width)))

        def packed(batches):
            for batch in batches:
                x = scale.apply(np.column_stack([batch.column(f"x{j}").to_numpy(zero_copy_only=False) for j in range(width)]))
                more = [batch.column(n).to_numpy(zero_copy_only=False) for n in names[1:]]
                for i in range(0, len(x), most):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([np.ascontiguousarray(v[i:i + most]).tobytes()], pa.binary()) for v in (x, *more)], names=names)

        cores = max(1, rows.sparkSession.sparkContext.defaultParallelism)
        full = -(-8 * many * width // (TASK_BYTES * cores)) * cores
        tasks = max(1, min(-(-many // TASK_ROWS), max(cores, full)))
        return cls(rows.coalesce(tasks).mapInArrow(packed, ", ".join(f"{n} binary" for n in names)), width, tasks)


def _read(batches: Iterator[pa.RecordBatch], width: int, kind: str = "") -> Iterator[dict[str, np.ndarray]]:
    kinds = {"x": float, "weight": float, "own": kind}
    for batch in batches:
        for i in np.flatnonzero(batch.column("x").is_valid().to_numpy(zero_copy_only=False)):
            block = {n: np.frombuffer(batch.column(n)[i].as_buffer(), kinds.get(n, np.int64)) for n in batch.schema.names}
            yield block | {"x": block["x"].reshape(-1, width)}


def _groups(spans: Sequence[tuple[int, int]]) -> list[list[int]]:
    """Neighbouring fits with up to ``GROUP`` centres, or one with more."""
    out: list[list[int]] = []
    for f, (_, end) in enumerate(spans):
        if out and end - spans[out[-1][0]][0] <= GROUP:
            out[-1].append(f)
        else:
            out.append([f])
    return out


def _owners(x: np.ndarray, centres: np.ndarray, spans: Sequence[tuple[int, int]]) -> np.ndarray:
    """For each fit (a span of the centres) the nearest centre of every row, counted from the start of the span.

    Row by centre, one product in single precision gives a lower bound of ``|c|^2 - 2 c.x``: what it may be off by, at most
    ``off`` x (2 |c||x| + |c|^2), is taken off by two more columns. The lowest bound belongs to a centre that is no longer
    than ``far``, which bounds its own error and with it the true minimum. A centre whose bound lies above that is not
    nearest. Rows with one centre left are done; for the others ``_nearness`` decides among all centres of the fit.
    """
    off = 2 * (x.shape[1] + 8) * HALF_UNIT  # twice the bound of a sum of that many rounded products
    more = np.sqrt(2 * off)
    size, length = (centres ** 2).sum(1), np.sqrt((x ** 2).sum(1))
    most = max(b - a for a, b in spans)
    kind = np.min_scalar_type(most)
    own, left = np.empty((len(spans), len(x)), kind), np.empty((len(spans), len(x)), kind)
    numbers = np.arange(most, dtype=kind)[:, None]
    groups = _groups(spans)
    widest = max(spans[g[-1]][1] - spans[g[0]][0] for g in groups)
    with np.errstate(all="ignore"):  # what single precision cannot hold leaves no centre, or several
        sides = np.column_stack([-2 * centres, size * (1 - off), -2 * off * np.sqrt(size)]).astype(np.float32)
        step = max(1, min(CHUNK, CELLS // widest))
        room, may, which = (np.empty((widest, min(step, len(x))), t) for t in (np.float32, np.uint8, kind))  # new ones cost more
        for i in range(0, len(x), step):
            here = length[i:i + step]
            rows = np.vstack([x[i:i + step].T, np.ones(len(here)), here]).astype(np.float32)
            short, square = rows[-1], rows[-1] ** 2
            if len(here) < room.shape[1]:
                room, may, which = (np.empty((widest, len(here)), v.dtype) for v in (room, may, which))
            for group in groups:
                first, end = spans[group[0]][0], spans[group[-1]][1]
                np.matmul(sides[first:end], rows, out=room[:end - first])
                places = [slice(spans[f][0] - first, spans[f][1] - first) for f in group]
                limit = np.empty((len(group), len(here)), np.float32)
                for j, at in enumerate(places):
                    np.minimum.reduce(room[at], axis=0, out=limit[j])
                far = limit + square
                np.sqrt(np.maximum(far, 0, out=far), out=far)
                far += np.float32(1 + more) * short
                far *= np.float32(1 / (1 - more))
                error = 2 * short + far
                error *= far
                error *= np.float32(2 * off)
                error += np.float32(2 / EQUAL)
                limit += error
                for j, (f, at) in enumerate(zip(group, places)):
                    np.less_equal(room[at], limit[j], out=may[at].view(bool))
                    np.add.reduce(may[at], axis=0, dtype=kind, out=left[f, i:i + step])
                    np.multiply(may[at], numbers[:at.stop - at.start], out=which[at])
                    np.maximum.reduce(which[at], axis=0, out=own[f, i:i + step])
    for f, (a, b) in enumerate(spans):
        unsure = np.flatnonzero(left[f] != 1)
        step = max(1, CELLS // (b - a))
        for i in range(0, len(unsure), step):
            some = unsure[i:i + step]
            own[f, some] = _nearness(x[some], centres[a:b]).argmin(1)
    return own


def _add(total: np.ndarray, own: np.ndarray, x: np.ndarray, w: np.ndarray) -> None:
    """Add weight and sums of x to the rows of ``total`` that ``own`` names."""
    order = np.argsort(own, kind="stable")
    x, w, held = x[order], w[order], np.bincount(own, minlength=len(total))
    ends = np.cumsum(held)
    for c in np.flatnonzero(held):
        mine = slice(ends[c] - held[c], ends[c])
        total[c, 0] += w[mine].sum()
        total[c, 1:] += w[mine] @ x[mine]


class _Sums:
    """A number of columns per centre, emitted by the tasks in slices as bytes. These meet by slice, and the driver gets one sum
    of each."""

    schema = "slice int, total binary"

    def __init__(self, count: int, width: int, tasks: int):
        self.shape = count, width
        slices = min(SLICES, count, tasks)
        self.cuts = [count * i // slices for i in range(slices + 1)]

    def emitted(self, total: np.ndarray) -> Iterator[tuple[int, bytes]]:
        return ((i, total[a:b].tobytes()) for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])))

    def collected(self, parts: DataFrame) -> np.ndarray:
        def added(batches):
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                for i, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                    part = np.frombuffer(part.as_buffer(), float)
                    found[i] = found[i] + part if i in found else part
            for i, part in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                                 names=["slice", "total"])

        if len(self.cuts) > 2:
            parts = parts.repartition(len(self.cuts) - 1, "slice").mapInArrow(added, self.schema)
        total = np.zeros(self.shape)
        for i, part in parts.collect():
            total[self.cuts[i]:self.cuts[i + 1]] += np.frombuffer(part, float).reshape(-1, self.shape[1])
        return total


def _spans(fits: Sequence[np.ndarray]) -> list[tuple[int, int]]:
    ends = np.cumsum([len(f) for f in fits])
    return [(int(e) - len(f), int(e)) for e, f in zip(ends, fits)]


def _moved(rows: Blocks, found: Mapping[int, np.ndarray], keep: bool) -> tuple[np.ndarray, Blocks]:
    """For every centre the change of weight and sums of x against the centres kept with the rows; one pass.

    A row counts where its centre is another one than the kept one: there it is added, here it is taken away. Without
    kept centres the sums are those of all rows. ``keep`` gives blocks that hold this pass's centres; they replace ``rows``.
    """
    fits = list(found.values())
    centres, spans, width, kind = np.concatenate(fits), _spans(fits), rows.width, rows.kind
    places = [rows.kept.index(k) for k in found] if rows.kept else None
    sums = _Sums(len(centres), width + 1, rows.tasks)
    names = ["x", "weight", "own", "slice", "total"] if keep else ["slice", "total"]
    kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary()][-len(names):]

    def emitted(*values):
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], names=names)

    def per_task(batches):
        total = np.zeros((len(centres), width + 1))
        for block in _read(batches, width, kind):
            x, w = block["x"], block["weight"]
            owners = _owners(x, centres, spans)
            old = block["own"].reshape(-1, len(x))[places] if places is not None else owners
            for (a, b), own, was in zip(spans, owners, old):
                if places is None:
                    _add(total[a:b], own, x, w)
                elif len(other := np.flatnonzero(own != was)):
                    twice = np.concatenate([other, other])
                    _add(total[a:b], np.concatenate([own[other], was[other]]), x[twice],
                         np.concatenate([w[other], -w[other]]))
            if keep:
                yield emitted(x.tobytes(), w.tobytes(), owners.tobytes(), None, None)
        for i, part in sums.emitted(total):
            yield emitted(*[None] * (len(names) - 2), i, part)

    frame = rows.frame.select("x", "weight", *["own"] * bool(rows.kept)).mapInArrow(
        per_task, "x binary, weight binary, own binary, " * keep + sums.schema)
    if not keep:
        return sums.collected(frame), rows
    frame.persist(StorageLevel.MEMORY_AND_DISK)
    total = sums.collected(frame.where("total is not null").select("slice", "total"))
    rows.frame.unpersist()
    return total, Blocks(frame, width, rows.tasks, tuple(found), np.min_scalar_type(max(map(len, fits))).name)


def _measured(rows: Blocks, fits: Sequence[np.ndarray]) -> np.ndarray:
    """For every centre of every fit the weight and the squared distances of its rows; one pass."""
    centres, spans, width = np.concatenate(fits), _spans(fits), rows.width
    sums = _Sums(len(centres), 2, rows.tasks)

    def per_task(batches):
        total = np.zeros((len(centres), 2))
        for block in _read(batches, width):
            x, w = block["x"], block["weight"]
            for (a, b), own in zip(spans, _owners(x, centres, spans)):
                apart = ((x - centres[a:b][own]) ** 2).sum(1)
                total[a:b] += np.column_stack([np.bincount(own, w, b - a), np.bincount(own, w * apart, b - a)])
        for i, part in sums.emitted(total):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.binary())],
                                             names=["slice", "total"])

    return sums.collected(rows.frame.select("x", "weight").mapInArrow(per_task, sums.schema))


def _drawn(rows: Blocks, known: np.ndarray, many: int, turn: int) -> np.ndarray:
    """``many`` distinct points, drawn in proportion to weight x squared distance to the nearest known candidate.

    Each row waits -log(1 - u) / distance with u from the hash of its key; a point comes with the first of its rows, and the
    first points to come are the sample. So one pass finds it, a task keeps ``many`` points, the same ones are drawn on any
    layout and whether equal rows were merged or not, and a table with at most ``many`` points gives all of them.
    """
    width = rows.width
    names = ["wait", *[f"x{j}" for j in range(width)]]

    def first(waits: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((*x.T[::-1], waits))  # rows that share a key wait as long: the lower point comes first, as below
        soonest = order[np.sort(np.unique(x[order], axis=0, return_index=True)[1])[:many]]
        return waits[soonest], x[soonest]

    def per_task(batches):
        waits, points = np.zeros(0), np.zeros((0, width))
        step = max(1, CELLS // max(1, len(known)))
        for block in _read(batches, width):
            for i in range(0, len(block["x"]), step):
                x, draw = block["x"][i:i + step], block[f"draw{turn}"][i:i + step]
                far = np.ones(len(x))
                if len(known):
                    far = _nearness(x, known).min(1) / EQUAL + (x ** 2).sum(1)
                out = far > 1e-8  # what lies on a candidate is not drawn again
                u = (draw[out] + 0.5) / (1 << 52)
                wait = -np.log1p(-u) / far[out]
                wait = wait.astype(np.float32).astype(float)  # the same whatever the order of sums
                soon = wait <= waits[-1] if len(waits) == many else np.ones(len(wait), bool)
                if soon.any():
                    waits, points = first(np.concatenate([waits, wait[soon]]), np.concatenate([points, x[out][soon]]))
        yield pa.RecordBatch.from_arrays([pa.array(waits), *[pa.array(v) for v in points.T]], names=names)

    parts = rows.frame.select("x", f"draw{turn}").mapInArrow(per_task, ", ".join(f"{n} double" for n in names))
    chosen = parts.groupBy(*names[1:]).agg(F.min("wait").alias("wait")).orderBy(*names).limit(many).toPandas()
    return chosen[names[1:]].to_numpy(float).reshape(-1, width)


def _starts(rows: Blocks, ks: Sequence[int], seed: int) -> list[np.ndarray]:
    """k-means|| once for the largest k: few rounds of candidates, weighted by the rows nearest to them; each fit then
    takes its k among the candidates, one after another by weight x squared distance."""
    candidates = _drawn(rows, np.zeros((0, rows.width)), 1, 0)
    for turn in range(1, ROUNDS + 1):
        more = _drawn(rows, candidates, max(ks), turn) if len(candidates) else candidates
        candidates = np.concatenate([candidates, more])
        if not len(more):
            break
    if not len(candidates):
        return [candidates for _ in ks]
    weight = _measured(rows, [candidates])[:, 0]
    starts = []
    for k in ks:
        draw, far, taken = np.random.default_rng([seed, k]), np.ones(len(candidates)), []
        while len(taken) < k and (weight * far).max() > 0:
            share = np.cumsum(weight * far)
            taken.append(int(np.searchsorted(share, draw.random() * share[-1], side="right")))
            apart = ((candidates - candidates[taken[-1]]) ** 2).sum(1)
            far = apart if len(taken) == 1 else np.minimum(far, apart)
        starts.append(candidates[taken])
    return starts


@dataclass(frozen=True)
class CentreFits:
    """Centres, sizes and costs of every fit. Centres are kept in centred scaled space."""

    predictors: tuple[str, ...]
    scale: Scale
    fitted: dict[int, np.ndarray]
    sizes: dict[int, np.ndarray]
    cost: dict[int, float]
    moves: dict[int, int]

    def costs(self, spark: SparkSession) -> DataFrame:
        """``k, cost``: the sum of squared distances to the nearest centre, about the final centres."""
        return literal_rows(spark, [(k, self.cost[k]) for k in self.fitted], "k int, cost double")

    def centres(self, spark: SparkSession) -> DataFrame:
        """``k, cluster, rows, feature, value`` in scaled space."""
        rows = [(k, c, int(self.sizes[k][c]), name, float(value)) for k, found in self.fitted.items()
                for c, centre in enumerate(found) for name, value in zip(self.predictors, centre + self.scale.shift)]
        return literal_rows(spark, rows, "k int, cluster int, rows long, feature string, value double")

    def assign(self, df: DataFrame, k: int, cluster: str = "cluster") -> DataFrame:
        """The complete rows with the number of the nearest centre of the fit for ``k``."""
        scale, centres = self.scale, self.fitted[k]

        @F.pandas_udf(T.IntegerType())
        def nearest(*values: pd.Series) -> pd.Series:
            x = scale.apply(np.column_stack([v.to_numpy(float) for v in values]))
            step = max(1, CELLS // max(1, len(centres)))
            own = [_nearness(x[i:i + step], centres).argmin(1) for i in range(0, len(x), step)]
            return pd.Series(np.concatenate(own) if own else [], dtype="int32")

        if not len(centres):
            return complete_rows(df, self.predictors).withColumn(cluster, F.lit(None).cast("int"))
        return complete_rows(df, self.predictors).withColumn(
            cluster, nearest(*[col(p).cast("double") for p in self.predictors]))

    def distances(self, assigned: DataFrame, k: int, cluster: str = "cluster") -> DataFrame:
        """Assigned rows with ``distance`` (squared, scaled, to the own centre) and ``nearest`` (to any centre)."""
        scale, centres = self.scale, self.fitted[k]

        @F.pandas_udf("distance double, nearest double")
        def apart(own: pd.Series, *values: pd.Series) -> pd.DataFrame:
            x = scale.apply(np.column_stack([v.to_numpy(float) for v in values]))
            near = [((x - c) ** 2).sum(1) for c in centres]
            all_ = np.stack(near, 1) if len(x) else np.zeros((0, len(centres)))
            return pd.DataFrame({"distance": all_[np.arange(len(x)), own.to_numpy(int)], "nearest": all_.min(1)})

        found = assigned.withColumn("__apart", apart(col(cluster), *[col(p).cast("double") for p in self.predictors]))
        return found.withColumns({n: F.col(f"__apart.{n}") for n in ("distance", "nearest")}).drop("__apart")


def _plain(df: DataFrame, predictors: Sequence[str], keys: Sequence[str], seed: int) -> list[Column]:
    """The predictors, and 52 bits for each turn of drawing starts."""
    draw = F.xxhash64(*[col(k) for k in keys])
    return [*[col(p).cast("double").alias(f"x{j}") for j, p in enumerate(predictors)],
            *[F.pmod(F.xxhash64(draw, F.lit(seed), F.lit(turn)), F.lit(1 << 52)).alias(f"draw{turn}")
              for turn in range(ROUNDS + 1)]]


def fit_centres(df: DataFrame, predictors: Sequence[str], ks: Sequence[int], keys: Sequence[str] | None = None,
                center: bool = True, starts: Mapping[int, Sequence[Sequence[float]]] | None = None, seed: int = SEED,
                max_iter: int = 40, tol: float = 1e-5, merge_equal_rows: bool = True) -> CentreFits:
    """k-means for every k in ``ks``, on scaled columns, all in the same passes over the rows.

    A pass gives each task one matrix of all centres that still move; it returns weight and sums per centre, or what the rows
    that change their centre add to those. A fit stops when no centre moves by more than ``tol``, or after ``max_iter``
    moves; a centre without rows stays where it is. One more pass measures all costs. ``keys`` names what tells rows apart
    when starts are drawn; without it the predictors do, and equal rows draw as one. ``starts`` gives centres for each k
    instead, in the units of the columns.
    Equal rows are replaced by one weighted row first, in one shuffle: no sum and no start changes, and columns with few
    distinct values shrink to a small table. ``merge_equal_rows=False`` saves the shuffle where hardly any rows are equal.

    Rows with a missing predictor do not count. With fewer distinct rows than k a fit has as many centres as were found;
    a table without rows gives fits without centres at cost 0. Rows are kept (memory, then disk) between the passes; what
    reaches the driver is a row per centre, and ``ROUNDS`` x the largest k candidates.
    """
    ks = list(dict.fromkeys(int(k) for k in ks))
    if not ks or min(ks) < 1:
        raise ValueError("ks must hold whole numbers from 1 on")
    rows = complete_rows(df, predictors)
    scale = Scale.of(rows, predictors, center)
    rows = rows.select(*_plain(rows, predictors, keys or predictors, seed))
    if merge_equal_rows:
        rows = rows.groupBy(*[f"x{j}" for j in range(len(predictors))]).agg(
            *[F.min(f"draw{turn}").alias(f"draw{turn}") for turn in range(ROUNDS + 1)],
            F.count(F.lit(1)).cast("double").alias("weight"))
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    blocks = Blocks.of(rows, scale, scale.rows)
    blocks.frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if starts is None:
            found = dict(zip(ks, _starts(blocks, ks, seed)))
        else:
            found = {k: scale.apply(np.asarray(starts[k], float).reshape(-1, len(predictors))) for k in ks}
        moves = dict.fromkeys(ks, 0)
        moving = [k for k in ks if len(found[k])]
        totals = {k: np.zeros((len(found[k]), len(predictors) + 1)) for k in moving}  # under the centres kept with the blocks
        for turn in range(max_iter):
            if not moving:
                break
            keep = turn in KEEP
            change, blocks = _moved(blocks, {k: found[k] for k in moving}, keep)
            at, still = 0, []
            for k in moving:
                old = found[k]
                own = totals[k] + change[at:at + len(old)]
                at += len(old)
                totals[k] = own if keep else totals[k]
                held = own[:, :1] > 0
                new = np.where(held, np.round(own[:, 1:] / np.where(held, own[:, :1], 1.0), DIGITS), old)
                found[k], moves[k] = new, moves[k] + 1
                if ((new - old) ** 2).sum(1).max() > tol ** 2:
                    still.append(k)
            moving = still
        filled = [k for k in ks if len(found[k])]
        sizes, cost = {k: np.zeros(0) for k in ks}, dict.fromkeys(ks, 0.0)
        if filled:
            total, at = _measured(blocks, [found[k] for k in filled]), 0
            for k in filled:
                own = total[at:at + len(found[k])]
                at += len(found[k])
                sizes[k], cost[k] = own[:, 0], float(own[:, 1].sum())
    finally:
        blocks.frame.unpersist()
    return CentreFits(tuple(predictors), scale, found, sizes, cost, moves)
