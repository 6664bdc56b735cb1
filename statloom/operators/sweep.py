"""All subsets of a list of predictors, fitted by sweeps in Gray-code order.

Neighbours in Gray-code order differ by one predictor, so each fit follows from the one before by a single sweep of
the moment matrix, p^2 steps instead of a solution of its own. Runs of neighbouring sets are dealt to tasks; a run
starts afresh from the moments, so rounding errors live for ``BLOCK`` sweeps at most.
"""

from __future__ import annotations

from collections.abc import Callable
from math import comb

import numpy as np

from statloom.operators.moments import Moments
from statloom.operators.ols import SINGULAR

BLOCK = 1024  # sets in a run, a power of two
# Share of a predictor's spread that the others of its set must leave to it; a set below is solved on its own.
PIVOT = 1e-6

Run = tuple[np.ndarray, np.ndarray, np.ndarray]


def run_size(p: int) -> int:
    return min(BLOCK, 1 << p)


def run_count(p: int) -> int:
    return (1 << p) // run_size(p)


def run_of_fits(train: Moments) -> Callable[[int], Run]:
    """A function of the number of a run that gives its sets (a row of booleans each), slopes and intercepts.

    ``train`` holds the predictors and, last, the target. Collinear or constant predictors get the slopes of least norm
    in correlation form. Set 0 of run 0 is the empty one.
    """
    mean, p = train.mean, len(train.mean) - 1
    size, pivot_limit, singular = run_size(p), PIVOT, SINGULAR
    scale = np.sqrt(np.diag(train.scatter))
    scale = np.where(scale > 0, scale, 1.0)
    start = train.scatter / np.outer(scale, scale)
    units = scale[p] / scale[:p]

    # Defined here, so that they travel to the workers by value.
    def sweep(table: np.ndarray, k: int, back: bool) -> None:
        pivot = table[k, k]
        line = table[k].copy()
        table -= np.multiply.outer(line, line / pivot)
        line /= -pivot if back else pivot
        table[k], table[:, k] = line, line
        table[k, k] = -1.0 / pivot

    def fits(number: int) -> Run:
        ranks = np.arange(number * size, (number + 1) * size)
        codes = ranks ^ (ranks >> 1)
        chosen = ((codes[:, None] >> np.arange(p)) & 1).astype(bool)
        slopes, table = np.zeros((size, p)), start.copy()
        inside, waiting = np.zeros(p, bool), list(np.flatnonzero(chosen[0]))
        for step in range(size):
            if step:
                k = int(np.flatnonzero(chosen[step] != chosen[step - 1])[0])
                if chosen[step, k]:
                    waiting.append(k)
                elif inside[k]:
                    sweep(table, k, back=True)
                    inside[k] = False
                else:
                    waiting.remove(k)
            for k in list(waiting):
                if table[k, k] > pivot_limit:
                    sweep(table, k, back=False)
                    inside[k] = True
                    waiting.remove(k)
            if waiting:
                x = np.flatnonzero(chosen[step])
                slopes[step, x] = np.linalg.pinv(start[np.ix_(x, x)], rcond=singular, hermitian=True) @ start[x, p]
            else:
                slopes[step, inside] = table[:p, p][inside]
        slopes *= units
        return chosen, slopes, mean[p] - slopes @ mean[:p]

    return fits


def set_numbers(p: int) -> Callable[[np.ndarray], np.ndarray]:
    """A function that numbers sets (a row of booleans each) from 0, the smaller ones first, then in the order of the
    columns; the empty set is -1."""
    ways = np.array([[comb(n, k) for k in range(p + 1)] for n in range(p + 1)], dtype=np.int64)
    before = np.concatenate([[-1], np.cumsum(ways[p])[:-1] - 1])

    def numbers(chosen: np.ndarray) -> np.ndarray:
        left = chosen.sum(1)
        found = before[left]
        for j in range(p):
            skipped = ~chosen[:, j] & (left > 0)
            found[skipped] += ways[p - j - 1, left[skipped] - 1]
            left = left - chosen[:, j]
        return found

    return numbers


def squared_errors(test: Moments) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of slopes and intercepts that gives the sum of squared errors over the rows behind ``test``."""
    n, mean, scatter = test.n, test.mean, test.scatter

    def squares(slopes: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
        contrast = np.column_stack([-slopes, np.ones(len(slopes))])
        inner = np.einsum("ij,ij->i", contrast @ scatter, contrast)
        return np.maximum(inner, 0.0) + n * (contrast @ mean - intercepts) ** 2

    return squares
