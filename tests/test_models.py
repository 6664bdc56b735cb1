import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statloom.catalogue.common import LINE_PREDICTORS, lines
from statloom.operators.cluster import Clustering, cluster_profile, elbow
from statloom.operators.features import feature_stages, fit_stages, normalize_l1, standardize
from statloom.operators.linear import (ElasticNet, coefficient_summary, cross_validate, fit_linear, grid_report,
                                       linear_stage, moment_grid_search, parameter_docs, training_summary)
from statloom.operators.lloyd import Blocks, Scale, _moved, _nearness, _owners, _Sums, fit_centres
from statloom.operators.mixture import Mixture
from statloom.operators.moments import collect_moments
from statloom.operators.ols import LeastSquares
from statloom.operators import trees
from statloom.operators.split import hash_split, portable_key, random_split, split_number, stable_layout, with_fold
from statloom.operators.trees import fit_tree, forest_importance, spread, tree_settings, tree_text
from statloom.plans.clustering import run_clustering
from statloom.plans.regression import run_regression
from statloom.plans.study import feature_study
from statloom.sinks.files import load_model, save_model


@pytest.fixture(scope="module")
def data(spark, folder):
    return lines(spark, folder, "l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber").persist()


def test_hash_split_is_stable_and_whole(data):
    first, second = hash_split(data, ["l_orderkey"])
    again, _ = hash_split(data.repartition(5), ["l_orderkey"])
    assert first.count() + second.count() == data.count()
    assert sorted(r[0] for r in first.select("l_orderkey").collect()) == sorted(
        r[0] for r in again.select("l_orderkey").collect())
    shares = data.groupBy(split_number(["l_orderkey"], (0.5, 0.3, 0.2)).alias("s")).count().collect()
    assert {r["s"] for r in shares} == {0, 1, 2}
    with pytest.raises(ValueError):
        hash_split(data, ["l_orderkey"], (0.5, -0.5))
    assert sum(p.count() for p in random_split(data)) == data.count()
    assert {r[0] for r in with_fold(data, ["l_orderkey"]).select("fold").distinct().collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        with_fold(data, folds=1)


def test_hash_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    for keys in (["k"], portable_key("k")):
        assert sum(p.count() for p in hash_split(df, keys)) == 3


def test_shares_of_the_split(spark):
    df = spark.range(200_000)
    for keys in (["id"], portable_key("id")):
        assert hash_split(df, keys)[0].count() == pytest.approx(140_000, rel=0.01)
        other = hash_split(df, keys, seed=7)[0].join(hash_split(df, keys)[0], "id").count()
        assert other == pytest.approx(98_000, rel=0.02)


def test_scaling_agrees_with_spark_ml(data):
    columns = ["l_extendedprice", "l_quantity"]
    for scale, center in (("z", True), ("sd", False)):
        stages, name = feature_stages(columns, scale)
        ml = fit_stages(data, stages).transform(standardize(data, columns, center))
        gap = ml.select(F.max(F.abs(vector_to_array(name)[0] - F.col("l_extendedprice_z")))).head()[0]
        assert gap < 1e-12 * 1e3
    stages, name = feature_stages(columns, "l1")
    ml = fit_stages(data, stages).transform(normalize_l1(data, columns))
    assert ml.select(F.max(F.abs(vector_to_array(name)[1] - F.col("l_quantity_l1")))).head()[0] < 1e-14
    with pytest.raises(ValueError):
        feature_stages(columns, "log")


def test_scaling_of_constant_and_zero(spark):
    df = spark.createDataFrame([(2.0, 0.0, 0.0), (2.0, 3.0, -1.0), (None, 0.0, 0.0)], "c double, a double, b double")
    assert [r["c_z"] for r in standardize(df, ["c"]).collect()] == [0.0, 0.0, None]
    assert [(r["a_l1"], r["b_l1"]) for r in normalize_l1(df, ["a", "b"]).collect()] == [(0, 0), (0.75, -0.25), (0, 0)]


def test_linear_pipeline_and_summary(spark, data):
    model = fit_linear(data, "net", LINE_PREDICTORS)
    ours = LeastSquares.fit(data, "net", LINE_PREDICTORS)
    rows = coefficient_summary(model, LINE_PREDICTORS, spark).collect()
    tests = ours.t_tests(spark).collect()
    assert [r["t_value"] for r in rows] == pytest.approx([r["t_value"] for r in tests], rel=1e-6)
    assert rows[0]["estimate"] == pytest.approx(ours.intercept, rel=1e-7)
    summary = {r["measure"]: r["value"] for r in training_summary(model, spark).collect()}
    assert summary["rows"] == data.count() and summary["features"] == 4
    assert summary["mse"] == pytest.approx(summary["rmse"] ** 2)
    assert summary["rsquared"] == pytest.approx(1 - ours.ss_error / ours.ss_total, rel=1e-8)
    lasso = fit_linear(data, "net", LINE_PREDICTORS, reg_param=0.3, elastic_net=0.4)
    assert coefficient_summary(lasso, LINE_PREDICTORS, spark).head()["t_value"] is None


@pytest.mark.parametrize("reg, mix", [(0.0, 0.0), (50.0, 0.0), (400.0, 0.4), (3000.0, 1.0)])
def test_elastic_net_from_moments_agrees_with_spark_ml(data, reg, mix):
    theirs = linear_stage(fit_linear(data, "net", LINE_PREDICTORS, scale=None, reg_param=reg, elastic_net=mix,
                                     max_iter=500))
    moments = collect_moments(data, [*LINE_PREDICTORS, "net"])[None]
    ours = ElasticNet.from_moments(moments, "net", LINE_PREDICTORS, reg, mix)
    scale = np.sqrt(np.diag(moments.scatter))[:4]
    assert list(ours.slopes * scale) == pytest.approx(list(theirs.coefficients * scale), rel=1e-4,
                                                      abs=1e-5 * abs(ours.slopes * scale).max())
    assert ours.intercept == pytest.approx(theirs.intercept, rel=1e-4)


def test_grid_search_by_moments_agrees_with_refits(spark, data):
    grid = {"reg_param": (0.0, 300.0), "elastic_net": (0.0, 0.4)}
    quick = moment_grid_search(data, "net", LINE_PREDICTORS, ["l_orderkey"], **grid)
    slow = cross_validate(data, "net", LINE_PREDICTORS, ["l_orderkey"], max_iter=(15,), **grid)
    ours = {(r["reg_param"], r["elastic_net"]): r for r in quick.report(spark).collect()}
    theirs = {(r["reg_param"], r["elastic_net"]): r for r in grid_report(slow, spark).collect()}
    assert ours.keys() == theirs.keys() and len(ours) == 4
    for point in ours:
        assert ours[point]["avg_metric"] == pytest.approx(theirs[point]["avg_metric"], rel=1e-5)
    assert min(theirs.values(), key=lambda r: r["avg_metric"])["rank"] == 1
    docs = {r["parameter"]: r["value"] for r in parameter_docs(slow, spark).collect()}
    assert docs["regParam"] == 0.0
    best = linear_stage(slow).intercept
    assert quick.best.intercept == pytest.approx(best, rel=1e-5)


def test_grid_search_errors(data):
    with pytest.raises(ValueError):
        moment_grid_search(data, "net", LINE_PREDICTORS, metric="mae")
    with pytest.raises(ValueError, match="folds hold rows"):
        moment_grid_search(data.limit(1), "net", LINE_PREDICTORS, ["l_orderkey"])
    largest = moment_grid_search(data, "net", LINE_PREDICTORS[:1], ["l_orderkey"], metric="r2")
    assert largest.larger_is_better and max(r[2] for r in largest.rows) > 0.9


@pytest.mark.parametrize("kind", ["linear", "tree", "forest", "boosted"])
def test_every_test_row_is_scored_once(data, kind):
    settings = {"maxIter": 3} if kind == "boosted" else {}
    trial = run_regression(data, kind, "net", LINE_PREDICTORS, ["l_orderkey"], ["l_returnflag"], **settings)
    testing = hash_split(data, ["l_orderkey"])[1]
    assert trial.predictions.filter("pred_net is not null").count() == testing.count()
    metrics = trial.metrics.collect()
    assert sum(r["count"] for r in metrics) == testing.count()
    assert all(r["rsquared"] > 0.5 for r in metrics)
    assert trial.metrics.columns == ["target", "prediction", "l_returnflag", "count", "rsquared", "rmse", "mse",
                                     "mae", "mtv"]


def test_run_regression_arguments(data):
    with pytest.raises(ValueError):
        run_regression(data, "guess", "net", LINE_PREDICTORS)
    with pytest.raises(ValueError):
        run_regression(data, "tree", "net", LINE_PREDICTORS, split="alphabet")
    with pytest.raises(ValueError):
        fit_tree(data, "guess", "net", LINE_PREDICTORS)


def test_importance_and_settings(spark, data):
    scores, size = forest_importance(data, "net", LINE_PREDICTORS, scale="z")
    rows = scores.collect()
    assert sum(r["score"] for r in rows) == pytest.approx(1.0)
    assert rows[0]["predictor"] == "l_extendedprice" and all(r["score"] >= 0 for r in rows)
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)
    settings = {r["measure"]: r["value"] for r in size.collect()}
    assert (settings["features"], settings["maxBins"], settings["maxDepth"]) == (4, 32, 5)
    assert settings["nodes"] > 20
    boosted = fit_tree(data, "boosted", "net", LINE_PREDICTORS, maxIter=3)
    found = {r["measure"]: r["value"] for r in tree_settings(boosted, spark).collect()}
    assert found["stepSize"] == 0.1 and found["weight_0"] == 1.0 and found["maxIter"] == 3
    assert "Predict" in tree_text(fit_tree(data, "tree", "net", LINE_PREDICTORS, maxDepth=2))


def test_same_layout_same_model(spark, data, tmp_path):
    laid = stable_layout(data, ["l_orderkey", "l_linenumber", "net"], 3)
    assert laid.rdd.getNumPartitions() == 3
    model = fit_tree(laid, "forest", "net", LINE_PREDICTORS, numTrees=3)
    again = fit_tree(stable_layout(data.repartition(6), ["l_orderkey", "l_linenumber", "net"], 3), "forest", "net",
                     LINE_PREDICTORS, numTrees=3)
    assert tree_text(model).split("\n")[1:] == tree_text(again).split("\n")[1:]
    save_model(model, str(tmp_path / "model"))
    loaded = load_model(str(tmp_path / "model"))
    pairs = zip(model.transform(laid).select("pred_net").collect(), loaded.transform(laid).select("pred_net").collect())
    assert all(a == b for a, b in pairs)


def test_no_task_of_a_tree_fit_holds_more_than_its_rows(data, monkeypatch):
    n, held = data.count(), []
    one = data.coalesce(1)
    assert spread(one).rdd.getNumPartitions() == 1
    monkeypatch.setattr(trees, "ROWS_A_TASK", 500)
    sizes = spread(one).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == -(-n // 500) and max(r["count"] for r in sizes) < 600
    monkeypatch.setattr(trees, "spread", lambda rows, most=None: held.append(spread(rows, most)) or held[0])
    fit_tree(one, "tree", "net", LINE_PREDICTORS, maxDepth=2)
    assert held[0].rdd.getNumPartitions() == len(sizes)


GROUPED = ["l_quantity", "l_discount", "l_tax"]


def test_clusters(spark, data):
    run = run_clustering(data, GROUPED, 5, "l_orderkey", {"l_returnflag": "N"})
    rows = data.filter("l_returnflag = 'N'")
    profile = run.profile.collect()
    assert len(profile) == 5 and sum(r["l_orderkey"] for r in profile) == rows.count()
    assert "scaled_features" not in run.assigned.columns
    assert run.centres.count() == 15
    # Brute force: every row sits at its nearest centre, and the cost is the sum of those squared distances.
    scaled = standardize(run.assigned, GROUPED).select("cluster", *[f"{c}_z" for c in GROUPED]).toPandas()
    centres = np.zeros((5, 3))
    for r in run.centres.collect():
        centres[r["cluster"], GROUPED.index(r["feature"])] = r["value"]
    distances = ((scaled.iloc[:, 1:].to_numpy()[:, None, :] - centres) ** 2).sum(2)
    assert (distances.argmin(1) == scaled["cluster"]).mean() > 0.999
    assert distances.min(1).sum() == pytest.approx(run.clustering.cost, rel=1e-6)


def test_elbow(spark, data):
    costs = {r["k"]: r["cost"] for r in elbow(data, GROUPED, [2, 4, 8]).collect()}
    assert costs[2] > costs[4] > costs[8]
    merged = {r["k"]: r["cost"] for r in elbow(data, GROUPED, [2, 8], merge_equal_rows=True).collect()}
    assert merged[8] == pytest.approx(costs[8], rel=0.15)
    assert cluster_profile(data, "l_orderkey", GROUPED, "l_linenumber").count() == data.select(
        "l_linenumber").distinct().count()
    uncentred = Clustering.fit(data, GROUPED, 4, center=False)
    assert uncentred.cost == pytest.approx(Clustering.fit(data, GROUPED, 4).cost, rel=0.1)


def lloyd(x, centres, most, tol=1e-5):
    """Plain k-means from given starts."""
    for _ in range(most):
        own = ((x[:, None] - centres) ** 2).sum(2).round(9).argmin(1)
        new = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        done = ((new - centres) ** 2).sum(1).max() <= tol ** 2
        centres = new
        if done:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(2).min(1).sum()


def test_fits_in_shared_passes(data):
    values = np.array(data.select(*GROUPED).collect(), float)
    z = (values - values.mean(0)) / values.std(0, ddof=1)
    starts = {k: values[:: len(values) // k][:k] for k in (1, 3, 7)}
    fits = fit_centres(data, GROUPED, [1, 3, 7], starts=starts, max_iter=12)
    for k, first in starts.items():
        centres, cost = lloyd(z, (first - values.mean(0)) / values.std(0, ddof=1), 12)
        assert fits.fitted[k] == pytest.approx(centres, abs=1e-8) and fits.cost[k] == pytest.approx(cost, rel=1e-9)
    assert fits.sizes[7].sum() == len(values) and fits.moves[1] == 2
    one = fit_centres(data, GROUPED, [3], starts=starts, max_iter=12)
    assert np.array_equal(one.fitted[3], fits.fitted[3])
    moved = fit_centres(data, GROUPED, [3], starts=starts, max_iter=12, center=False)
    assert moved.cost[3] == pytest.approx(fits.cost[3])
    assert {r["feature"]: r["value"] for r in moved.centres(data.sparkSession).filter("cluster = 0").collect()} == (
        pytest.approx(dict(zip(GROUPED, fits.fitted[3][0] + values.mean(0) / values.std(0, ddof=1)))))


def test_starts_do_not_depend_on_the_layout(data):
    keys = ["l_orderkey", "l_linenumber"]
    found = [fit_centres(data.repartition(n), GROUPED, [4, 9], keys) for n in (3, 17)]
    for k in (4, 9):
        assert np.array_equal(found[0].fitted[k], found[1].fitted[k]) and found[0].moves[k] == found[1].moves[k]
        assert len(np.unique(found[0].fitted[k], axis=0)) == k
    assert not np.array_equal(fit_centres(data, GROUPED, [4], keys, seed=5).fitted[4], found[0].fitted[4])
    own = [{(r["l_orderkey"], r["l_linenumber"]): r["cluster"] for r in f.assign(data, 9).collect()} for f in found]
    assert own[0] == own[1] and set(own[0].values()) == set(range(9))
    # As good as Spark's own fit, give or take a local optimum.
    assert found[0].cost[9] < 1.15 * Clustering.fit(data, GROUPED, 9).cost


def test_equal_rows_change_nothing(data):
    """Merged or not, the same centres and costs from the same drawn starts."""
    keys = ["l_orderkey", "l_linenumber"]
    one, other = (fit_centres(data, GROUPED, [4, 9], keys, merge_equal_rows=m) for m in (True, False))
    for k in (4, 9):
        assert np.array_equal(one.fitted[k], other.fitted[k]) and one.cost[k] == pytest.approx(other.cost[k], rel=1e-9)


@pytest.mark.parametrize("parts", [1, 7])
def test_as_many_centres_as_points(spark, parts):
    """All points are found, also near ones that have next to no share of the squared distances."""
    power = F.pow(F.lit(3.0), F.pmod("id", F.lit(9)))
    df = spark.range(4000).select(power.alias("a"), (1 - 2 * power).alias("b")).repartition(parts)
    found = Clustering.fit(df, ["a", "b"], 9)
    assert found.centres(spark).count() == 18 and found.cost == pytest.approx(0.0, abs=1e-9)
    apart = found.distances(df).agg(F.max("distance"), F.max("nearest"), F.count_distinct("cluster")).head()
    assert apart[0] == apart[1] < 1e-12 and apart[2] == 9


def test_fits_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (3.0, 5.0), (None, 1.0)], "x double, y double")
    fits = fit_centres(df, ["x", "y"], [1, 2, 6])
    assert [len(fits.fitted[k]) for k in (1, 2, 6)] == [1, 2, 2]
    assert fits.cost[2] == fits.cost[6] == pytest.approx(0, abs=1e-12)
    assert fits.assign(df, 2).count() == 3
    none = fit_centres(df.limit(0), ["x", "y"], [2])
    assert none.cost == {2: 0.0} and none.centres(spark).count() == 0 and none.assign(df, 2).count() == 3
    with pytest.raises(ValueError):
        fit_centres(df, ["x", "y"], [0])


def test_nearest_centres_as_in_double_precision(spark):
    """Ties, outliers, tiny, huge and shifted numbers: single precision only leaves out what cannot be nearest."""
    draw = np.random.default_rng(3)
    plain, grid = draw.normal(size=(3000, 12)), draw.integers(0, 4, size=(3000, 3)).astype(float)
    far = plain.copy()
    far[:20] *= 1e4
    far[5] *= 1e25
    for x in (plain, grid, far, plain * 1e-7, plain * 1e-30, plain + 1e5, np.ones((50, 2)), plain[:1]):
        ks = [1, 2, 7, 90, 300]
        centres = [x[draw.choice(len(x), k)] for k in ks]
        ends = np.cumsum(ks)
        spans = [(int(e) - k, int(e)) for e, k in zip(ends, ks)]
        for f, own in enumerate(_owners(x, np.concatenate(centres), spans)):
            assert np.array_equal(own, _nearness(x, centres[f]).argmin(1))


def test_sums_of_the_rows_that_move(spark):
    """From pass to pass, with or without keeping, the changes add up to the sums of all rows; so do the slices of tasks."""
    draw = np.random.default_rng(4)
    x = draw.integers(0, 50, size=(5000, 3)).astype(float)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["x0", "x1", "x2"])).repartition(9).withColumns(
        {"weight": F.lit(2.0), **{f"draw{i}": F.lit(0).cast("long") for i in range(5)}})
    blocks = Blocks.of(df, Scale(np.zeros(3), np.ones(3), np.zeros(3), len(x)), len(x))
    blocks.frame.persist()
    totals, fits = 0.0, {k: x[draw.choice(len(x), k)] for k in (2, 5, 300)}
    for keep in (False, True, False, True, True, False):
        change, blocks = _moved(blocks, fits, keep)
        own = [_nearness(x, c).argmin(1) for c in fits.values()]
        wanted = np.concatenate([2.0 * np.column_stack([np.bincount(o, minlength=k), *[np.bincount(o, v, k) for v in x.T]])
                                 for o, k in zip(own, fits)])
        assert np.array_equal(totals + change, wanted)
        totals = wanted if keep else totals
        fits = {k: c + draw.normal(size=c.shape) for k, c in fits.items()}
    some = _moved(blocks, {5: fits[5]}, False)[0]  # one of the kept fits goes on
    own = _nearness(x, fits[5]).argmin(1)
    assert np.array_equal(some[:, 0] + totals[2:7, 0], 2.0 * np.bincount(own, minlength=5))
    blocks.frame.unpersist()
    sums, part = _Sums(40, 8, 3), np.arange(320.0).reshape(40, 8)
    parts = spark.createDataFrame([row for j in range(3) for row in sums.emitted(part + j)], sums.schema)
    assert parts.count() == 9 and np.array_equal(sums.collected(parts), 3 * part + 3)


def test_passes_have_as_many_tasks_as_rows_are_worth(spark):
    """A task of a pass hands on sums for every centre: few rows on many partitions are few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    spark.sparkContext.setJobGroup("sweep", "sweep")
    try:
        df = spark.range(4000).select(F.rand(1).alias("a"), F.rand(2).alias("b")).repartition(40)
        fits = fit_centres(df, ["a", "b"], [2, 3, 4], max_iter=5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = sorted(tracker.getJobIdsForGroup("sweep"))
    tasks = [tracker.getStageInfo(max(tracker.getJobInfo(j).stageIds)).numTasks for j in jobs[-4:]]
    assert max(fits.moves.values()) == 5 and tasks and max(tasks) <= 2


def test_mixture(spark, data):
    found = Mixture.fit(data, ["l_extendedprice", *GROUPED], k=3, max_iter=10)
    components = found.components(spark).collect()
    assert len(components) == 12
    assert sum(r["weight"] for r in components) / 4 == pytest.approx(1.0)
    cov = {(r["component"], r["feature_x"], r["feature_y"]): r["cov"] for r in found.covariances(spark).collect()}
    assert all(v == pytest.approx(cov[(c, b, a)]) for (c, a, b), v in cov.items())
    assigned = found.assign(data)
    assert assigned.count() == data.count()
    assert assigned.select(F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)).head()[0] == pytest.approx(1.0)


def test_mixture_does_not_depend_on_layout_or_copies(data):
    columns = ["l_extendedprice", *GROUPED]
    once = Mixture.fit(data, columns, k=3, max_iter=12, tol=0.0)
    for other in (data.repartition(7), data.union(data).union(data).coalesce(2)):
        again = Mixture.fit(other, columns, k=3, max_iter=12, tol=0.0)
        assert again.fitted.weights == pytest.approx(once.fitted.weights, rel=1e-6)
        assert again.fitted.means == pytest.approx(once.fitted.means, rel=1e-6, abs=1e-6)
    assert once.space.basis.shape == (4, 3)  # shares of one whole: a direction without variance is left out


def test_mixture_finds_separate_groups(spark):
    draw = np.random.default_rng(3)
    truth = {0: ((0.0, 0.0, 7.0), 500), 1: ((40.0, 1.0, 7.0), 300), 2: ((0.0, 9.0, 7.0), 200)}
    rows = [(g, float(a + x), float(b + y), c) for g, ((a, b, c), n) in truth.items() for x, y in draw.normal(0, 1, (n, 2))]
    df = spark.createDataFrame([*rows, (3, None, 1.0, 7.0)], "g int, a double, b double, c double")
    found = Mixture.fit(df, ["a", "b", "c"], k=3, scale=None)
    pairs = found.assign(df).groupBy("g", "component").count().collect()
    assert sorted(r["count"] for r in pairs) == [200, 300, 500] and len({r["component"] for r in pairs}) == 3
    of = {r["component"]: r["g"] for r in pairs}
    for r in found.components(spark).collect():
        (a, b, c), n = truth[of[r["component"]]]
        assert r["mean"] == pytest.approx({"a": a, "b": b, "c": c}[r["feature"]], abs=0.3)
        assert r["weight"] == pytest.approx(n / 1000, abs=1e-3)
    for r in found.covariances(spark).collect():
        constant = "c" in (r["feature_x"], r["feature_y"])
        assert r["cov"] == pytest.approx(0.0 if constant or r["feature_x"] != r["feature_y"] else 1.0, abs=0.35)
    same = Mixture.fit(df.select(*[F.lit(2.0).alias(c) for c in "abc"]), ["a", "b", "c"], k=2)
    assert sum(same.fitted.weights) == pytest.approx(1.0) and same.assign(df).count() == 1000
    with pytest.raises(ValueError, match="no row"):
        Mixture.fit(df.limit(0), ["a"], k=2)


def test_feature_study(data):
    found = feature_study(data, "net", LINE_PREDICTORS, ["l_orderkey"])
    assert found.covariance.count() == 10 and found.correlation.count() == 10
    assert found.subsets.count() == 15
    assert found.best.filter("best_by = 'r2'").head()["preds"].startswith("l_extendedprice")
    assert found.importance.head()["predictor"] == "l_extendedprice"
    assert found.components.explained.sum() == pytest.approx(1.0)
