"""Student t, F and normal distribution functions in plain Python.

They are called on the driver, a few times per report, with degrees of freedom found by an aggregate.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist


# Above this many error degrees of freedom the limit distributions (normal, chi-square) differ by less than 1e-8.
LIMIT_DOF = 1e8


def incomplete_beta(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularised incomplete beta function I_x(a, b); ``y`` is 1 - x where the caller knows it more exactly."""
    y = 1.0 - x if y is None else y
    if x <= 0.0 or y <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, y, x)
    log_x, log_y = (math.log(x) if x < 0.5 else math.log1p(-y)), (math.log(y) if y < 0.5 else math.log1p(-x))
    front = math.exp(a * log_x + b * log_y - _log_beta(a, b)) / a
    return front * _beta_fraction(a, b, x)


def _log_beta(a: float, b: float) -> float:
    big, small = max(a, b), min(a, b)
    if big < 1e3:
        return math.lgamma(big) + math.lgamma(small) - math.lgamma(big + small)
    # Difference of two Stirling series, so that large arguments keep their digits.
    total = big + small
    rest = small * math.log(total) + (big - 0.5) * math.log1p(small / big) - small
    rest += 1 / (12 * total) - 1 / (12 * big) - 1 / (360 * total ** 3) + 1 / (360 * big ** 3)
    return math.lgamma(small) - rest


def upper_gamma(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(s, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        for k in range(1, 10_000):
            term *= x / (s + k)
            total += term
            if term < total * 1e-16:
                return 1.0 - front * total
        raise ArithmeticError("the incomplete gamma series did not converge")
    b, c = x + 1.0 - s, 1e300
    d = value = 1.0 / b
    for k in range(1, 10_000):
        b += 2.0
        d = 1.0 / (b - k * (k - s) * d)
        c = b - k * (k - s) / c
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return front * value
    raise ArithmeticError("the incomplete gamma fraction did not converge")


def _beta_fraction(a: float, b: float, x: float) -> float:
    # Continued fraction 26.5.8 of Abramowitz and Stegun, evaluated forwards by Lentz's method.
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 20_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            return value
    raise ArithmeticError("the incomplete beta fraction did not converge")


def t_two_sided_p(t: float, dof: float) -> float:
    """P(|T| > |t|)."""
    if math.isinf(t):
        return 0.0
    if dof > LIMIT_DOF:
        return math.erfc(abs(t) / math.sqrt(2.0))
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t), t * t / (dof + t * t))


def t_cdf(t: float, dof: float) -> float:
    tail = t_two_sided_p(t, dof) / 2.0
    return 1.0 - tail if t > 0 else tail


def f_upper_p(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    if f <= 0.0:
        return 1.0
    if math.isinf(f):
        return 0.0
    if d2 > LIMIT_DOF:
        return upper_gamma(d1 / 2.0, d1 * f / 2.0)
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f))


def _root(decreasing, low: float, high: float) -> float:
    while decreasing(high) > 0.0:
        low, high = high, high * 2.0
    for _ in range(200):
        middle = 0.5 * (low + high)
        if middle in (low, high):
            break
        if decreasing(middle) > 0.0:
            low = middle
        else:
            high = middle
    return 0.5 * (low + high)


@lru_cache(maxsize=4096)
def t_quantile(prob: float, dof: float) -> float:
    """Value with P(T <= value) = prob."""
    if not 0.0 < prob < 1.0 or dof <= 0:
        raise ValueError(f"no t quantile for probability {prob} and {dof} degrees of freedom")
    if prob < 0.5:
        return -t_quantile(1.0 - prob, dof)
    if prob == 0.5:
        return 0.0
    if math.isinf(dof):
        return NormalDist().inv_cdf(prob)
    tail = 2.0 * (1.0 - prob)
    return _root(lambda t: t_two_sided_p(t, dof) - tail, 0.0, 2.0)


@lru_cache(maxsize=4096)
def f_quantile(prob: float, d1: float, d2: float) -> float:
    """Value with P(F <= value) = prob."""
    if not 0.0 < prob < 1.0 or d1 <= 0 or d2 <= 0:
        raise ValueError(f"no F quantile for probability {prob} and {d1}, {d2} degrees of freedom")
    return _root(lambda f: f_upper_p(f, d1, d2) - (1.0 - prob), 0.0, 2.0)
