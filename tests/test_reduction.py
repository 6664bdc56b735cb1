import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from statloom.catalogue.common import LINE_PREDICTORS, lines
from statloom.operators.evaluate import evaluate
from statloom.operators.linear import fit_linear
from statloom.operators.pca import Components
from statloom.operators.split import hash_split
from statloom.operators.sweep import set_numbers
from statloom.operators.subsets import best_subset, column_pairs, column_subsets, equal_to_extreme, ranked, winners


def test_names():
    assert column_pairs(["a,b", "c", "d"]) == [("a,b", "c"), ("a,b", "d"), ("c", "d")]
    assert column_subsets(["a", "b"]) == [("a",), ("b",), ("a", "b")]
    assert len(column_subsets([str(i) for i in range(6)])) == 63
    with pytest.raises(ValueError):
        column_subsets([str(i) for i in range(13)], limit=12)


def test_best_subset_against_separate_fits(spark, folder):
    df = lines(spark, folder, "l_orderkey")
    found = {r["preds"]: r for r in best_subset(df, "net", LINE_PREDICTORS[:3], ["l_orderkey"]).collect()}
    assert len(found) == 7
    training, testing = hash_split(df, ["l_orderkey"])
    for chosen in (["l_discount"], ["l_extendedprice", "l_tax"], LINE_PREDICTORS[:3]):
        scored = fit_linear(training, "net", chosen, scale="z").transform(testing)
        row = found[", ".join(chosen)]
        for ours, theirs in (("r2", "r2"), ("rmse", "rmse"), ("mae", "mae")):
            expected = RegressionEvaluator(labelCol="net", predictionCol="pred_net", metricName=theirs).evaluate(scored)
            assert row[ours] == pytest.approx(expected, rel=1e-7)
        assert row["num_preds"] == len(chosen)


def test_every_subset_against_least_norm_fits(spark):
    """Eleven columns in two runs of sweeps; one is constant, one the sum of two others, one nearly a copy."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 11)) * 10.0 ** rng.integers(-3, 4, 11) + 1e4
    x[:, 4], x[:, 7], x[:, 9] = 3.0, x[:, 1] + x[:, 2], x[:, 0] + 3e-4 * (x[:, 3] - 1e4) * x[:, 0].std() / x[:, 3].std()
    y = x[:, 0] / x[:, 0].std() - x[:, 6] / x[:, 6].std() + rng.normal(size=400)
    names = [f"c{i}" for i in range(11)]
    df = spark.createDataFrame([(i, *map(float, row), float(v)) for i, (row, v) in enumerate(zip(x, y))],
                               "id long, " + ", ".join(f"{c} double" for c in names) + ", y double")
    found = best_subset(df, "y", names, ["id"])
    rows = sorted(found.collect(), key=lambda r: r["id"])
    assert [r["preds"] for r in rows] == [", ".join(s) for s in column_subsets(names)]
    assert [r["id"] for r in rows] == list(range(2 ** 11 - 1))
    kept = {r["id"] for r in hash_split(df, ["id"])[0].collect()}
    train = np.array([i in kept for i in range(400)])
    spread = ((y[~train] - y[~train].mean()) ** 2).sum()
    for row in rows[::7] + rows[-200:]:
        at = [names.index(c) for c in row["preds"].split(", ")]
        middle, deviation = x[train][:, at].mean(0), x[train][:, at].std(0)
        z = (x[:, at] - middle) / np.where(deviation > 1e-9, deviation, 1.0)
        b = np.linalg.lstsq(z[train], y[train] - y[train].mean(), rcond=1e-5)[0]
        missed = (y - y[train].mean() - z @ b)[~train]
        assert row["r2"] == pytest.approx(1 - (missed ** 2).sum() / spread, abs=1e-6)
        assert row["rmse"] == pytest.approx(np.sqrt((missed ** 2).mean()), rel=1e-6)
        assert row["mae"] == pytest.approx(np.abs(missed).mean(), rel=1e-6)
    plain = {r["id"]: r for r in best_subset(df.repartition(5), "y", names, ["id"], mae=False).collect()}
    assert all(plain[r["id"]]["mae"] is None and plain[r["id"]]["r2"] == pytest.approx(r["r2"], abs=1e-7) for r in rows)


def test_numbers_of_sets():
    for p in (1, 2, 5, 8):
        sets = [()] + column_subsets([str(i) for i in range(p)])
        chosen = np.array([[str(i) in s for i in range(p)] for s in sets])
        assert list(set_numbers(p)(chosen)) == list(range(-1, 2 ** p - 1))


def test_subsets_refuse_too_many(spark):
    df = spark.range(10).selectExpr("id", "id as y", *[f"id * {i} as c{i}" for i in range(31)])
    for names, limit in (([], None), ([f"c{i}" for i in range(31)], None), (["c1", "c2"], 1)):
        with pytest.raises(ValueError, match="limit"):
            best_subset(df, "y", names, ["id"], limit=limit)


def test_winners_and_ties(spark):
    rows = [(0, "a", 1.0, 0.5, 2.0, 1.0), (1, "b", 1.0, 0.7, 1.5, 1.0), (2, "a, b", 2.0, 0.7, 1.4, 1.2)]
    table = spark.createDataFrame(rows, "id long, preds string, num_preds double, r2 double, rmse double, mae double")
    found = {(r["best_by"], r["preds"]) for r in winners(table).collect()}
    assert found == {("r2", "b"), ("r2", "a, b"), ("rmse", "a, b"), ("mae", "a"), ("mae", "b")}
    assert [r["id"] for r in ranked(table).collect()] == [1, 2, 0]
    assert equal_to_extreme(table, "r2", largest=False).head()["preds"] == "a"


def test_components_of_worked_example(spark, worked):
    found = Components.fit(worked, ["x1", "x2"])
    assert list(found.explained) == pytest.approx([0.97723766, 0.02276234], abs=1e-8)
    assert list(found.loadings[:, 0]) == pytest.approx([2 ** -0.5] * 2)
    assert [r["cumulative"] for r in found.explained_variance(spark).collect()][-1] == pytest.approx(1.0)
    scores = found.project(worked, 2)
    variances = scores.agg(F.var_samp("pc1"), F.var_samp("pc2"), F.corr("pc1", "pc2")).head()
    assert variances[0] == pytest.approx(2 * found.explained[0])
    assert variances[2] == pytest.approx(0.0, abs=1e-9)


def test_components_agree_with_spark_ml(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet").select(
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(8)])
    ours = Components.fit(df, df.columns)
    raw = VectorAssembler(inputCols=df.columns, outputCol="raw").transform(df)
    scaled = StandardScaler(inputCol="raw", outputCol="z", withMean=True).fit(raw).transform(raw)
    theirs = PCA(k=8, inputCol="z", outputCol="pc").fit(scaled)
    assert list(ours.explained) == pytest.approx(list(theirs.explainedVariance), rel=1e-8)
    assert np.all(np.diff(ours.explained) <= 0)
    assert np.abs(ours.loadings) == pytest.approx(np.abs(theirs.pc.toArray()), abs=1e-6)
    with pytest.raises(ValueError):
        ours.project(df, 9)
    assert ours.loading_table(spark, 2).count() == 16


def test_evaluate_matches_spark_ml(spark, folder):
    df = lines(spark, folder, "l_returnflag").withColumn("p", F.expr("l_extendedprice + 10"))
    row = evaluate(df, "net", "p").head()
    for ours, theirs in (("rsquared", "r2"), ("rmse", "rmse"), ("mae", "mae"), ("mse", "mse")):
        expected = RegressionEvaluator(labelCol="net", predictionCol="p", metricName=theirs).evaluate(df)
        assert row[ours] == pytest.approx(expected, rel=1e-12)
    sliced = evaluate(df, "net", "p", ["l_returnflag"]).collect()
    assert sum(r["count"] for r in sliced) == row["count"]
    assert sum(r["mtv"] * r["count"] for r in sliced) / row["count"] == pytest.approx(row["mtv"])


def test_evaluate_ignores_rows_without_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None), (4.0, 3.0), (None, 9.0)], "y double, p double")
    row = evaluate(df, "y", "p").head()
    assert (row["count"], row["mtv"], row["mae"]) == (2, 2.5, 0.75)
    assert evaluate(df.filter("y = 1"), "y", "p").head()["rsquared"] is None
