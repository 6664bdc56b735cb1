import math

import pytest

from statloom.functions import critical
from statloom.functions.distributions import (f_quantile, f_upper_p, incomplete_beta, t_cdf, t_quantile,
                                              t_two_sided_p, upper_gamma)


def test_known_quantiles():
    assert t_quantile(0.95, 14) == pytest.approx(1.76131014, abs=1e-8)
    assert f_quantile(0.9, 2, 14) == pytest.approx(2.72646846, abs=1e-8)
    assert t_quantile(0.025, 10) == pytest.approx(-t_quantile(0.975, 10))
    assert t_quantile(0.975, math.inf) == pytest.approx(1.959963984540054)


def test_closed_forms():
    # One degree of freedom is the Cauchy law, two have an algebraic form.
    for t in (0.1, 1.0, 7.5, 300.0):
        assert t_cdf(t, 1) == pytest.approx(0.5 + math.atan(t) / math.pi, abs=1e-14)
        assert t_cdf(t, 2) == pytest.approx(0.5 + t / (2 * math.sqrt(2 + t * t)), abs=1e-14)
    assert f_upper_p(3.0, 2, 10) == pytest.approx((1 + 3.0 * 2 / 10) ** -5, abs=1e-14)
    assert incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-12)
    assert upper_gamma(1.0, 2.5) == pytest.approx(math.exp(-2.5), abs=1e-14)
    assert upper_gamma(0.5, 2.0) == pytest.approx(math.erfc(math.sqrt(2.0)), abs=1e-14)


def test_large_counts_join_the_limit():
    assert t_two_sided_p(2.0, 9e7) == pytest.approx(t_two_sided_p(2.0, 2e8), rel=1e-7)
    assert f_upper_p(3.0, 2, 9e7) == pytest.approx(f_upper_p(3.0, 2, 1e12), rel=1e-6)
    assert f_upper_p(1.7 ** 2, 1, 57) == pytest.approx(t_two_sided_p(1.7, 57), rel=1e-12)


def test_published_table(spark):
    wide = {r["df"]: r for r in critical.t_table(spark).collect()}
    assert len(wide) == 100
    assert list(wide[1.0])[1:] == [3.078, 6.314, 12.706, 31.821, 63.657, 318.313]
    assert list(wide[9.0])[1:] == [1.383, 1.833, 2.262, 2.821, 3.25, 4.296]
    assert list(wide[14.0])[1:] == [1.345, 1.761, 2.145, 2.624, 2.977, 3.787]
    assert list(wide[60.0])[1:] == [1.296, 1.671, 2.0, 2.39, 2.66, 3.232]
    assert list(wide[100.0])[1:] == [1.29, 1.66, 1.984, 2.364, 2.626, 3.174]
    assert [critical.published_value(0, p) for p in critical.PROBABILITIES] == [1.282, 1.645, 1.96, 2.326, 2.576, 3.09]


def test_probability_choice():
    assert critical.test_probability(0.05, "two-sided") == 0.975
    assert critical.test_probability(0.05, "upper one-sided") == 0.95
    with pytest.raises(ValueError):
        critical.test_probability(0.05, "both")
    with pytest.raises(ValueError, match="0.975"):
        critical.table_probability(0.98)
