"""Least squares with its tests, from one pass of moments.

No row reaches the driver and no n x n matrix is formed: with S the centred scatter of the predictors, the slopes
solve S b = s_xy, and every sum of squares, F, t and partial F follows from S, s_xy and s_yy. For predictors that are
nearly collinear, such as the powers of a date, ``method="qr"`` takes the same from a triangular factor of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import col
from statloom.functions.products import row_products
from statloom.functions.distributions import f_quantile, f_upper_p, t_quantile, t_two_sided_p
from statloom.operators.association import KEEP, REJECT, UNDEFINED
from statloom.operators.factor import Factor, collect_factor
from statloom.operators.moments import Moments, collect_moments, complete_rows
from statloom.sources.tables import literal_rows

INTERCEPT = "(intercept)"
SINGULAR = 1e-10  # smallest eigenvalue of the correlation matrix that still counts as independent predictors
SINGULAR_FACTOR = 1e-11  # the same for the smallest singular value of a factor, the root of such an eigenvalue


def solve_slopes(scatter: np.ndarray, cross: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes and inverse scatter, solved in correlation form; raises when the predictors are collinear."""
    scale = np.sqrt(np.diag(scatter))
    if not np.all(scale > 0):
        raise ValueError("a predictor is constant")
    correlation = scatter / np.outer(scale, scale)
    if np.linalg.eigvalsh(correlation)[0] < SINGULAR:
        raise ValueError("the predictors are collinear")
    inverse = np.linalg.inv(correlation) / np.outer(scale, scale)
    return np.linalg.solve(correlation, cross / scale) / scale, inverse


def factor_of_inverse(upper: np.ndarray) -> np.ndarray:
    """F with F F' the inverse scatter, from the factor of the predictors; raises when they are collinear."""
    scale = np.linalg.norm(upper, axis=0)
    if not np.all(scale > 0):
        raise ValueError("a predictor is constant")
    if np.linalg.svd(upper / scale, compute_uv=False)[-1] < SINGULAR_FACTOR:
        raise ValueError("the predictors are collinear")
    return np.linalg.inv(upper / scale) / scale[:, None]


@dataclass(frozen=True)
class LeastSquares:
    """A fitted equation ``target = b0 + sum b_j x_j``."""

    target: str
    predictors: tuple[str, ...]
    moments: Moments
    residual_ss: float | None = None  # exact residual sum of squares where one was taken from the rows
    upper: np.ndarray | None = None  # triangular factor of the predictors and, last, the target

    @classmethod
    def fit(cls, df: DataFrame, target: str, predictors: Sequence[str], on_null: str = "drop",
            refine: bool = False, method: str = "moments") -> "LeastSquares":
        """Fit on the complete rows. ``refine`` sums the squared residuals in a second pass, which keeps digits
        when the fit is almost perfect. ``method="qr"`` keeps them, in one pass, there and where predictors are nearly
        collinear: up to a condition of 1e11 of the scaled columns, against 1e5 for moments."""
        if method not in ("moments", "qr"):
            raise ValueError(f"method must be 'moments' or 'qr', not {method!r}")
        predictors = tuple(predictors)
        if not predictors or target in predictors:
            raise ValueError("predictors must be given and must not hold the target")
        columns = (*predictors, target)
        if method == "qr":
            factor = collect_factor(df, columns, on_null)
            if factor is None:
                raise ValueError("no complete row to fit")
            model = cls.from_factor(factor, target, predictors)
        else:
            found = collect_moments(df, columns, on_null=on_null)
            if None not in found:
                raise ValueError("no complete row to fit")
            model = cls.from_moments(found[None], target, predictors)
        if refine:
            rows = complete_rows(df, columns, on_null)
            error = col(target).cast("double") - model.prediction
            model = replace(model, residual_ss=rows.agg(F.sum(error * error)).head()[0])
        return model

    @classmethod
    def from_moments(cls, moments: Moments, target: str, predictors: Sequence[str]) -> "LeastSquares":
        return cls(target, tuple(predictors), moments)

    @classmethod
    def from_factor(cls, factor: Factor, target: str, predictors: Sequence[str]) -> "LeastSquares":
        at = [factor.columns.index(c) for c in (*predictors, target)]
        return cls(target, tuple(predictors), factor.moments, upper=np.linalg.qr(factor.upper[:, at], mode="r"))

    @property
    def n(self) -> int:
        return self.moments.n

    @property
    def dof_error(self) -> int:
        return self.n - len(self.predictors) - 1

    @cached_property
    def _solved(self) -> tuple[np.ndarray, np.ndarray]:
        if self.dof_error < 0:
            raise ValueError(f"{self.n} rows cannot fit {len(self.predictors) + 1} coefficients")
        if self.upper is not None:
            k = len(self.predictors)
            inverse = self._inverse_factor
            return inverse @ self.upper[:k, k], inverse @ inverse.T
        x, y = self.moments.at(self.predictors), self.moments.at([self.target])[0]
        return solve_slopes(self.moments.scatter[np.ix_(x, x)], self.moments.scatter[x, y])

    @cached_property
    def _inverse_factor(self) -> np.ndarray:
        """F with F F' the inverse scatter of the predictors."""
        if self.upper is None:
            return np.linalg.cholesky(self._solved[1])
        k = len(self.predictors)
        return factor_of_inverse(self.upper[:k, :k])

    @property
    def slopes(self) -> np.ndarray:
        return self._solved[0]

    @property
    def means(self) -> np.ndarray:
        return self.moments.mean[self.moments.at(self.predictors)]

    @property
    def intercept(self) -> float:
        return float(self.moments.mean[self.moments.at([self.target])[0]] - self.slopes @ self.means)

    @property
    def ss_total(self) -> float:
        y = self.moments.at([self.target])[0]
        return float(self.moments.scatter[y, y])

    @property
    def ss_regression(self) -> float:
        if self.residual_ss is not None:
            return self.ss_total - self.residual_ss
        if self.upper is not None:
            return float(np.sum(self.upper[:-1, -1] ** 2))
        x, y = self.moments.at(self.predictors), self.moments.at([self.target])[0]
        return float(self.slopes @ self.moments.scatter[x, y])

    @property
    def ss_error(self) -> float:
        if self.residual_ss is not None:
            return self.residual_ss
        if self.upper is not None:
            return float(self.upper[-1, -1] ** 2)
        return max(self.ss_total - self.ss_regression, 0.0)

    @property
    def ms_error(self) -> float:
        return self.ss_error / self.dof_error if self.dof_error > 0 else float("nan")

    @property
    def f_value(self) -> float:
        return _divide(self.ss_regression / len(self.predictors), self.ms_error)

    @property
    def terms(self) -> tuple[str, ...]:
        return (INTERCEPT, *self.predictors)

    @property
    def estimates(self) -> np.ndarray:
        return np.concatenate([[self.intercept], self.slopes])

    @property
    def covariance(self) -> np.ndarray:
        """Covariance of the coefficients, intercept first."""
        inverse, means = self._solved[1], self.means
        cross = -inverse @ means
        corner = 1.0 / self.n + means @ inverse @ means
        return self.ms_error * np.block([[np.array([[corner]]), cross[None, :]], [cross[:, None], inverse]])

    @property
    def equation(self) -> str:
        return f"{self.target} = {self.intercept:.6g}" + "".join(
            f" {'+' if b >= 0 else '-'} {abs(b):.6g} {x}" for b, x in zip(self.slopes, self.predictors))

    @property
    def prediction(self) -> Column:
        """The fitted value as a plain column expression."""
        value = F.lit(self.intercept)
        for b, x in zip(self.slopes, self.predictors):
            value = value + F.lit(float(b)) * col(x).cast("double")
        return value

    # -- result tables -------------------------------------------------------------------------------------

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, float(b)) for t, b in zip(self.terms, self.estimates)]
        return literal_rows(spark, rows, "term string, estimate double")

    def coefficient_covariance(self, spark: SparkSession) -> DataFrame:
        rows = [(a, b, float(v)) for a, line in zip(self.terms, self.covariance) for b, v in zip(self.terms, line)]
        return literal_rows(spark, rows, "term_x string, term_y string, cov double")

    def anova(self, spark: SparkSession, alpha: float = 0.05) -> DataFrame:
        """Does the regression explain anything? One row with both sums of squares, F, its p-value and verdict."""
        k, dof, f = len(self.predictors), self.dof_error, self.f_value
        tested = dof > 0 and np.isfinite(f)
        critical = f_quantile(1.0 - alpha, k, dof) if dof > 0 else None
        row = (self.n, k, dof, self.ss_regression, self.ss_error, self.ss_total, self.ss_regression / k,
               _number(self.ms_error), _number(f), critical, f_upper_p(f, k, dof) if tested else None,
               _label(f > critical if tested else None))
        return literal_rows(spark, [row], "n long, dof_regression int, dof_error long, ss_regression double, ss_error double, "
                   "ss_total double, ms_regression double, ms_error double, f_value double, critical double, "
                   "p_value double, significance string")

    def t_tests(self, spark: SparkSession, alpha: float = 0.05) -> DataFrame:
        """Is each coefficient different from zero, given the others? Two-sided, intercept included."""
        critical = t_quantile(1.0 - alpha / 2.0, self.dof_error) if self.dof_error > 0 else None
        rows = []
        for term, b, variance in zip(self.terms, self.estimates, np.diag(self.covariance)):
            error = float(np.sqrt(variance))
            t = _divide(b, error)
            tested = critical is not None and np.isfinite(t)
            rows.append((term, float(b), _number(error), _number(t), critical,
                         t_two_sided_p(t, self.dof_error) if tested else None,
                         _label(abs(t) > critical if tested else None)))
        return literal_rows(spark, rows, "term string, estimate double, std_error double, t_value double, "
                                           "critical double, p_value double, significance string")

    def partial_f(self, spark: SparkSession, dropped: Sequence[Sequence[str]] | None = None,
                  alpha: float = 0.05) -> DataFrame:
        """Do the dropped terms add anything to the others? One row per set of terms (each single one by default)."""
        rows = []
        for names in dropped or [[x] for x in self.predictors]:
            unknown = set(names) - set(self.predictors)
            if unknown or not names:
                raise ValueError(f"not a set of predictors: {list(names)}")
            at = [self.predictors.index(x) for x in dict.fromkeys(names)]
            # Extra sum of squares of the dropped terms, without the cancellation of a difference of two fits.
            slopes, inverse = self._solved
            if self.upper is not None:
                kept = [i for i in range(len(slopes)) if i not in at]
                turned = np.linalg.qr(self.upper[:, [*kept, *at, len(slopes)]], mode="r")
                extra = float(np.sum(turned[len(kept):-1, -1] ** 2))
            else:
                extra = float(slopes[at] @ np.linalg.solve(inverse[np.ix_(at, at)], slopes[at]))
            r, dof = len(at), self.dof_error
            f = _divide(extra / r, self.ms_error)
            tested = dof > 0 and np.isfinite(f)
            critical = f_quantile(1.0 - alpha, r, dof) if dof > 0 else None
            rows.append((", ".join(names), r, dof, extra, _number(f), critical,
                         f_upper_p(f, r, dof) if tested else None, _label(f > critical if tested else None)))
        return literal_rows(spark, rows, "dropped string, dof_dropped int, dof_error long, extra_ss double, "
                                           "f_value double, critical double, p_value double, significance string")

    # -- row-wise results ----------------------------------------------------------------------------------

    def predict(self, df: DataFrame, name: str | None = None) -> DataFrame:
        return df.withColumn(name or f"pred_{self.target}", self.prediction)

    def leverage(self, df: DataFrame, name: str = "leverage") -> DataFrame:
        """Each row's diagonal entry of the hat matrix, 1/n + |L'(x - mean)|^2 with L L' the inverse scatter."""
        factor = self._inverse_factor
        parts = row_products(self.predictors, factor, -np.asarray(self.means) @ factor)
        value = F.lit(1.0 / self.n) + F.aggregate(parts, F.lit(0.0), lambda total, part: total + part * part)
        return df.withColumn(name, value)


def _divide(a: float, b: float) -> float:
    return float(a / b) if b and np.isfinite(b) else float("nan")


def _number(value: float) -> float | None:
    return float(value) if np.isfinite(value) else None


def _label(rejected: bool | None) -> str:
    return UNDEFINED if rejected is None else REJECT if rejected else KEEP
