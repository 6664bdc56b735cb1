from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from statloom.catalogue.common import LINE_PREDICTORS, lines
from statloom.operators.factor import collect_factor
from statloom.operators.ols import LeastSquares


@pytest.fixture(scope="module")
def fitted(worked):
    return LeastSquares.fit(worked, "yield", ["x1", "x2"])


def test_worked_example(spark, fitted):
    assert fitted.estimates == pytest.approx([-153.51169396, 1.23872327, 12.08235332], rel=1e-7)
    table = fitted.anova(spark, alpha=0.1).head()
    assert (table["n"], table["dof_regression"], table["dof_error"]) == (17, 2, 14)
    assert table["ss_regression"] == pytest.approx(12816.34590967, rel=1e-9)
    assert table["ss_error"] == pytest.approx(423.37409033, rel=1e-7)
    assert table["ss_regression"] + table["ss_error"] == pytest.approx(table["ss_total"])
    assert table["f_value"] == pytest.approx(211.90342871, rel=1e-7)
    assert table["critical"] == pytest.approx(2.72646846, rel=1e-7)
    assert table["significance"] == "Reject Null Hyp"


def test_t_tests_and_partial_f(spark, fitted):
    rows = fitted.t_tests(spark, alpha=0.1).collect()
    assert [r["std_error"] for r in rows] == pytest.approx([100.87985254, 0.39459026, 3.93229141], rel=1e-7)
    assert [r["t_value"] for r in rows] == pytest.approx([-1.52172798, 3.13926467, 3.07259866], rel=1e-7)
    assert rows[0]["critical"] == pytest.approx(1.76131014, rel=1e-8)
    assert [r["significance"] for r in rows] == ["Fail to Reject", "Reject Null Hyp", "Reject Null Hyp"]
    partial = {r["dropped"]: r for r in fitted.partial_f(spark, [["x1"], ["x2"], ["x1", "x2"]]).collect()}
    assert partial["x2"]["f_value"] == pytest.approx(9.44086253, rel=1e-7)
    assert partial["x1"]["f_value"] == pytest.approx(9.85498268, rel=1e-7)
    assert partial["x1"]["f_value"] == pytest.approx(rows[1]["t_value"] ** 2)
    assert partial["x1"]["p_value"] == pytest.approx(rows[1]["p_value"])
    assert partial["x1, x2"]["f_value"] == pytest.approx(211.90342871, rel=1e-7)


def test_covariance_equation_prediction(spark, worked, fitted):
    cov = {(r["term_x"], r["term_y"]): r["cov"] for r in fitted.coefficient_covariance(spark).collect()}
    x = np.array([[1, r["x1"], r["x2"]] for r in worked.collect()])
    expected = 30.24100645 * np.linalg.inv(x.T @ x)
    assert cov[("(intercept)", "x2")] == pytest.approx(expected[0, 2], rel=1e-6)
    assert cov[("x1", "x2")] == pytest.approx(expected[1, 2], rel=1e-6)
    assert fitted.equation == "yield = -153.512 + 1.23872 x1 + 12.0824 x2"
    errors = fitted.predict(worked).select((F.col("yield") - F.col("pred_yield")).alias("e"))
    total, squares = errors.agg(F.sum("e"), F.sum(F.col("e") * F.col("e"))).head()
    assert total == pytest.approx(0.0, abs=1e-8)
    assert squares == pytest.approx(423.37409033, rel=1e-8)


def test_leverage(worked, fitted):
    rows = fitted.leverage(worked).collect()
    x = np.array([[1, r["x1"], r["x2"]] for r in rows])
    hat = x @ np.linalg.inv(x.T @ x) @ x.T
    assert [r["leverage"] for r in rows] == pytest.approx(list(np.diag(hat)), rel=1e-8)
    assert sum(r["leverage"] for r in rows) == pytest.approx(3.0)


def test_agrees_with_spark_ml(spark, folder):
    df = lines(spark, folder)
    ours = LeastSquares.fit(df, "net", LINE_PREDICTORS)
    vectors = VectorAssembler(inputCols=LINE_PREDICTORS, outputCol="v").transform(df)
    theirs = LinearRegression(labelCol="net", featuresCol="v").fit(vectors)
    assert list(ours.slopes) == pytest.approx(list(theirs.coefficients), rel=1e-7)
    assert list(np.sqrt(np.diag(ours.covariance)))[1:] == pytest.approx(
        list(theirs.summary.coefficientStandardErrors)[:-1], rel=1e-7)
    assert [r["p_value"] for r in ours.t_tests(spark).collect()][1:] == pytest.approx(
        list(theirs.summary.pValues)[:-1], abs=1e-9)


def test_refined_residuals(spark):
    df = spark.range(1000).selectExpr("cast(id as double) x", "1e6 + 3 * id + (id % 2) * 1e-4 as y")
    plain = LeastSquares.fit(df, "y", ["x"])
    refined = LeastSquares.fit(df, "y", ["x"], refine=True)
    assert refined.ss_error == pytest.approx(1000 * 0.25 * 1e-8, rel=1e-2)
    assert refined.ss_regression + refined.ss_error == pytest.approx(plain.ss_total)


def exact_fit(rows):
    """Slopes, residual sum of squares and inverse scatter of ``(*x, y)`` rows in rational arithmetic."""
    rows = [[Fraction(v) for v in row] for row in rows]
    n, k = len(rows), len(rows[0]) - 1
    mean = [sum(c) / n for c in zip(*rows)]
    rows = [[v - m for v, m in zip(row, mean)] for row in rows]
    s = [[sum(row[i] * row[j] for row in rows) for j in range(k + 1)] for i in range(k + 1)]
    table = [[*s[i][:k], s[i][k], *[Fraction(int(i == j)) for j in range(k)]] for i in range(k)]
    for i in range(k):
        table[i] = [v / table[i][i] for v in table[i]]
        for j in range(k):
            if j != i:
                table[j] = [a - table[j][i] * b for a, b in zip(table[j], table[i])]
    slopes = [row[k] for row in table]
    return slopes, s[k][k] - sum(b * s[i][k] for i, b in enumerate(slopes)), [row[k + 1:] for row in table], s[k][k]


def test_nearly_collinear_against_rational_arithmetic(spark):
    """Powers of numbers near 100,000: a condition of some 1e6, where moments refuse to answer."""
    xs = [100_000 + i * 7 % 601 for i in range(600)]
    rows = [(float(x), float(x ** 2), float(x ** 3), float((x - 100_300) ** 3 // 1000 + x % 11 - 3 * (x % 5))) for x in xs]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(7)
    scaled = np.array(rows)[:, :3] - np.array(rows)[:, :3].mean(0)
    assert np.linalg.cond(scaled / np.linalg.norm(scaled, axis=0)) > 1e5
    with pytest.raises(ValueError, match="collinear"):
        LeastSquares.fit(df, "y", ["a", "b", "c"]).slopes
    found = LeastSquares.fit(df, "y", ["a", "b", "c"], method="qr")
    slopes, rss, inverse, total = exact_fit(rows)
    assert list(found.slopes) == pytest.approx([float(b) for b in slopes], rel=1e-8)
    assert found.ss_error == pytest.approx(float(rss), rel=1e-8)
    assert found.ss_total == pytest.approx(float(total), rel=1e-12)
    mse = float(rss) / 596
    for row, name, b, v in zip(found.t_tests(spark).collect()[1:], "abc", slopes, (inverse[i][i] for i in range(3))):
        assert row["term"] == name
        assert row["std_error"] == pytest.approx((mse * float(v)) ** 0.5, rel=1e-8)
        assert row["t_value"] == pytest.approx(float(b) / (mse * float(v)) ** 0.5, rel=1e-8)
    without = exact_fit([(a, y) for a, _, _, y in rows])[1]
    partial = found.partial_f(spark, [["b", "c"], ["c"]]).collect()
    assert partial[0]["extra_ss"] == pytest.approx(float(without - rss), rel=1e-8)
    assert partial[1]["extra_ss"] == pytest.approx(float(slopes[2] ** 2 / inverse[2][2]), rel=1e-8)
    assert found.f_value == pytest.approx(float((total - rss) / 3) / mse, rel=1e-8)


def test_both_methods_agree(spark, folder):
    df = lines(spark, folder).withColumn("net", F.when(F.col("l_quantity") != 7, F.col("net")))
    plain, qr = (LeastSquares.fit(df, "net", LINE_PREDICTORS, method=m) for m in ("moments", "qr"))
    assert plain.n == qr.n
    assert list(qr.estimates) == pytest.approx(list(plain.estimates), rel=1e-8)
    assert qr.anova(spark).head()["f_value"] == pytest.approx(plain.anova(spark).head()["f_value"], rel=1e-8)
    assert qr.covariance == pytest.approx(plain.covariance, rel=1e-7)
    ours, theirs = (m.leverage(df.na.drop()).agg(F.sum("leverage"), F.max("leverage")).head() for m in (qr, plain))
    assert list(ours) == pytest.approx(list(theirs), rel=1e-8)


def test_factor_of_far_parts(spark):
    """Rows sorted so that tasks lie far apart, a few rows only in some, none in others."""
    df = spark.range(0, 3000, 1, 40).selectExpr("id", "1e9 + 1e6 * floor(id / 100) + id % 7 as a", "id % 13 - 1e8 as b",
                                                "sin(id) as y")
    found = collect_factor(df.filter("id < 1000 or id > 2997"), ["a", "b", "y"])
    rows = np.array([r[1:] for r in df.filter("id < 1000 or id > 2997").collect()])
    centred = rows - rows.mean(0)
    assert found.n == len(rows)
    assert found.mean == pytest.approx(rows.mean(0), rel=1e-14)
    assert found.moments.scatter == pytest.approx(centred.T @ centred, rel=1e-9)
    assert collect_factor(df.filter("id < 0"), ["a", "b"]) is None
    with pytest.raises(ValueError):
        collect_factor(df, ["a", "a"])
    with pytest.raises(ValueError, match="method"):
        LeastSquares.fit(df, "y", ["a"], method="lu")
    with pytest.raises(ValueError, match="collinear"):
        LeastSquares.fit(df.selectExpr("a", "2 * a as c", "y"), "y", ["a", "c"], method="qr").slopes
    with pytest.raises(ValueError, match="constant"):
        LeastSquares.fit(df.selectExpr("a", "3.5D as c", "y"), "y", ["a", "c"], method="qr").slopes


def test_errors(spark):
    df = spark.range(20).selectExpr("cast(id as double) a", "2 * id + 1 as b", "1.0D one", "id * id as y")
    with pytest.raises(ValueError, match="collinear"):
        LeastSquares.fit(df, "y", ["a", "b"]).slopes
    with pytest.raises(ValueError, match="constant"):
        LeastSquares.fit(df, "y", ["a", "one"]).slopes
    with pytest.raises(ValueError, match="rows cannot fit"):
        LeastSquares.fit(df.limit(1), "y", ["a"]).slopes
    with pytest.raises(ValueError, match="no complete row"):
        LeastSquares.fit(df.filter("a < 0"), "y", ["a"])
    with pytest.raises(ValueError):
        LeastSquares.fit(df, "y", [])
    with pytest.raises(ValueError):
        LeastSquares.fit(df, "y", ["a"]).partial_f(spark, [["nothing"]])


def test_no_error_degrees_of_freedom(spark):
    exact = LeastSquares.fit(spark.createDataFrame([(1.0, 3.0), (2.0, 5.0)], "x double, y double"), "y", ["x"])
    assert exact.slopes[0] == pytest.approx(2.0)
    assert exact.anova(spark).head()["significance"] == "Undefined"
    assert exact.t_tests(spark).head()["t_value"] is None
