"""Queries on trees, clusters and mixtures. Fits depend on random draws, so the SQL checks what must hold anyway:
which rows were scored, and that clusters and components account for all of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from statloom.catalogue.common import NET, Query, fit_sql, lines, r, rounded, table, train_sql
from statloom.operators.cluster import Clustering, elbow
from statloom.operators.features import vectors_from_array
from statloom.operators.lloyd import fit_centres
from statloom.operators.mixture import Mixture
from statloom.operators.moments import column_moments
from statloom.operators.split import portable_key
from statloom.operators.trees import fit_tree, forest_importance, importance_table, tree_settings
from statloom.plans.clustering import run_clustering, slice_of
from statloom.plans.regression import run_regression
from statloom.plans.study import feature_study
from statloom.session import scratch_path
from statloom.sinks.files import load_model, save_model

GROUPED = ["l_quantity", "l_discount", "l_tax"]
SLICE = {"l_returnflag": "N", "l_linestatus": "O"}


def _orders(spark, folder, *extra):
    """Orders with the totals of their lines: a unique key, a target and four predictors."""
    per = (lines(spark, folder, "l_orderkey").groupBy("l_orderkey")
           .agg(F.sum("net").alias("net"), F.sum("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"),
                F.avg("l_tax").alias("tax"), F.sum("l_quantity").alias("quantity")))
    return per


ORDER_PREDICTORS = ["price", "discount", "tax", "quantity"]


def _trial(kind, **settings):
    def run(spark, folder):
        return run_regression(_orders(spark, folder), kind, "net", ORDER_PREDICTORS, portable_key("l_orderkey"),
                              **settings).metrics
    return run


METRIC_DIGITS = {"rsquared": 7, "rmse": 4, "mae": 4, "mtv": 4}


def _linear_metrics(spark, folder):
    return rounded(_trial("linear")(spark, folder).drop("mse"), METRIC_DIGITS)


def _least_squares_metrics(spark, folder):
    return rounded(_trial("least_squares")(spark, folder).drop("mse"), METRIC_DIGITS)


def _scored_rows(spark, folder):
    """Every model scores each test row exactly once and beats the mean of the target."""
    out = None
    for kind in ("linear", "tree", "forest"):
        metrics = _trial(kind)(spark, folder).select(F.lit(kind).alias("kind"), "count", F.round("mtv", 4).alias("mtv"),
                                                     (F.col("rsquared") > 0.5).alias("useful"))
        out = metrics if out is None else out.unionByName(metrics)
    return out


def _importance(spark, folder):
    return forest_importance(_orders(spark, folder), "net", ORDER_PREDICTORS)[0]


def _importance_scaled(spark, folder):
    scores, _ = forest_importance(_orders(spark, folder), "net", ORDER_PREDICTORS, scale="z")
    return scores.agg(F.count(F.lit(1)).alias("predictors"), F.round(F.sum("score"), 9).alias("total"),
                      (F.min("score") >= 0).alias("not_negative"), F.max_by("predictor", "score").alias("first"))


def _settings(spark, folder):
    return tree_settings(fit_tree(_orders(spark, folder), "boosted", "net", ORDER_PREDICTORS), spark)


def _saved(spark, folder):
    """A saved and reloaded model predicts what the fitted one does."""
    df = _orders(spark, folder)
    model = fit_tree(df, "tree", "net", ORDER_PREDICTORS)
    path = scratch_path(spark, "model")
    save_model(model, path)
    twice = load_model(path).transform(model.transform(df).withColumnRenamed("pred_net", "before")
                                       .drop("raw_features"))
    return twice.agg(F.count(F.lit(1)).alias("rows"),
                     F.sum((F.col("before") == F.col("pred_net")).cast("long")).alias("same"))


def _exact(kind, **settings):
    """A model whose every possible split is a candidate (at most 50 distinct values a column): groups of predictions."""
    def run(spark, folder):
        df = lines(spark, folder)
        model = fit_tree(df, kind, "net", GROUPED, maxBins=64, **settings)
        return (model.transform(df).groupBy(F.round("pred_net", 3).alias("prediction"))
                .agg(F.count(F.lit(1)).alias("rows")))
    return run


def _importance_exact(spark, folder):
    """A single split gives all importance to its column."""
    model = fit_tree(lines(spark, folder), "forest", "net", GROUPED, maxBins=64, maxDepth=1, **ONE_TREE)
    return importance_table(model, GROUPED, spark)


ONE_TREE = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}


def _slice(spark, folder):
    return slice_of(table(spark, folder, "lineitem", *GROUPED, "l_orderkey", *SLICE), SLICE)


def _kmeans_profile(spark, folder):
    return run_clustering(table(spark, folder, "lineitem", *GROUPED, "l_orderkey", *SLICE), GROUPED, 10, "l_orderkey",
                          SLICE).profile


def _kmeans_totals(spark, folder):
    """The profile adds up to the slice: row count and averages."""
    n = F.col("l_orderkey")
    return _kmeans_profile(spark, folder).agg(
        F.sum(n).alias("rows"), *[F.round(F.sum(F.col(c) * n) / F.sum(n), 7).alias(c) for c in GROUPED])


def _kmeans_centres(spark, folder):
    return fit_centres(_keyed_slice(spark, folder), GROUPED, [10], LINE_KEY, center=False).centres(spark)


def _from_centres(spark, found, rows):
    """The rows with their squared distance to each centre, from the centres and the scale as tables: no model code."""
    stats = column_moments(rows, GROUPED)
    wide = found.centres(spark).groupBy("cluster").pivot("feature", GROUPED).agg(F.first("value"))
    centres = wide.select("cluster", *[F.col(c).alias(f"c_{c}") for c in GROUPED])  # k rows
    apart = sum((F.pow((F.col(c) - F.lit(stats[c][1])) / F.lit(stats[c][2]) - F.col(f"c_{c}"), 2) for c in GROUPED), F.lit(0.0))
    return apart, centres


def _kmeans_cost(spark, folder):
    """The cost equals the one recomputed from assigned rows and the centres as a table."""
    rows = _slice(spark, folder)
    found = Clustering.fit(rows, GROUPED, 10)
    apart, centres = _from_centres(spark, found, rows)
    total = found.assign(rows).join(F.broadcast(centres), "cluster").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(apart).alias("cost"))
    return total.select("rows", (F.abs(F.col("cost") / F.lit(found.cost) - 1) < 1e-9).alias("agrees"))


def _kmeans_assign(spark, folder):
    """How much farther each row's own centre is than the nearest of all centres, to nine digits."""
    rows = slice_of(table(spark, folder, "lineitem", *GROUPED, "l_orderkey", "l_linenumber", *SLICE), SLICE)
    found = Clustering.fit(rows, GROUPED, 10)
    apart, centres = _from_centres(spark, found, rows)
    listed = F.array_sort(F.collect_list(F.struct(*centres.columns)))
    centres = F.broadcast(centres.agg(listed.alias("centres")))  # one row holds all k
    named = found.assign(rows).join(centres, F.lit(True))
    each = F.transform("centres", lambda c: sum((F.pow((F.col(f) - F.lit(m)) / F.lit(sd) - c[f"c_{f}"], 2)
                                                 for f, (_, m, sd) in column_moments(rows, GROUPED).items()), F.lit(0.0)))
    return named.withColumn("each", each).select(
        "l_orderkey", "l_linenumber",
        (F.round(F.get("each", F.col("cluster")) - F.array_min("each"), 9) + F.lit(0.0)).alias("excess"))


def _distinct_points(spark, folder):
    """The tax rates of all lines: nine distinct points in two columns."""
    return table(spark, folder, "lineitem", "l_tax").select("l_tax", (1 - F.col("l_tax") * 2).alias("rest"))


def _kmeans_exact(spark, folder):
    """As many centres as distinct points: they are the points, and the cost is zero."""
    rows = _distinct_points(spark, folder)
    found = Clustering.fit(rows, ["l_tax", "rest"], 9)
    return (found.assign(rows).groupBy("cluster").agg(F.min("l_tax").alias("least"), F.max("l_tax").alias("most"),
                                                      F.count(F.lit(1)).alias("rows"))
            .select(F.round("least", 6).alias("least"), F.round("most", 6).alias("most"), "rows",
                    F.lit(round(found.cost, 9) + 0.0).alias("cost")))


LINE_KEY = ["l_orderkey", "l_linenumber"]
# Starts in the units of the columns, k times (quantity, discount, tax), and moves of the compared fits.
FIXED_STARTS = {2: [(10, 0.02, 0.02), (40, 0.08, 0.06)],
                5: [(5, 0.01, 0.07), (15, 0.09, 0.01), (25, 0.05, 0.04), (35, 0.02, 0.02), (45, 0.08, 0.06)]}
FIXED_MOVES = 5


def _keyed_slice(spark, folder):
    return slice_of(table(spark, folder, "lineitem", *GROUPED, *LINE_KEY, *SLICE), SLICE)


def _sweep_fixed(spark, folder):
    """Centres, sizes and costs of two fits that share their passes, from given starts."""
    fits = fit_centres(_keyed_slice(spark, folder), GROUPED, list(FIXED_STARTS), starts=FIXED_STARTS,
                       max_iter=FIXED_MOVES, tol=0.0)
    wide = fits.centres(spark).groupBy("k", "cluster", "rows").pivot("feature", GROUPED).agg(F.first("value"))
    return rounded(wide.join(fits.costs(spark), "k"), {**dict.fromkeys(GROUPED, 6), "cost": 4})


def _sweep_assign(spark, folder):
    """The cluster of every line under the larger of the two fits."""
    rows = _keyed_slice(spark, folder)
    fits = fit_centres(rows, GROUPED, list(FIXED_STARTS), starts=FIXED_STARTS, max_iter=FIXED_MOVES, tol=0.0)
    return fits.assign(rows, 5).select(*LINE_KEY, "cluster")


def _elbow(spark, folder):
    return elbow(_keyed_slice(spark, folder), GROUPED, keys=LINE_KEY)


def _sweep_costs(spark, folder):
    """The whole sweep from drawn starts, against the costs of its own centres measured by SQL functions alone."""
    rows = _keyed_slice(spark, folder)
    fits = fit_centres(rows, GROUPED, [5, 10, 20, 40], LINE_KEY)
    stats = column_moments(rows, GROUPED)
    scaled = [((F.col(c) - F.lit(stats[c][1])) / F.lit(stats[c][2])).alias(c) for c in GROUPED]
    points = rows.groupBy(*scaled).agg(F.count(F.lit(1)).alias("n"))
    listed = (fits.centres(spark).groupBy("k", "cluster").pivot("feature", GROUPED).agg(F.first("value"))
              .groupBy("k").agg(F.collect_list(F.struct(*GROUPED)).alias("centres")))
    by_k = {r["k"]: r["centres"] for r in listed.collect()}
    nearest = {k: F.array_min(F.transform(
        F.array(*[F.struct(*[F.lit(c[f]).alias(f) for f in GROUPED]) for c in centres]),
        lambda c: sum((F.pow(F.col(f) - c[f], 2) for f in GROUPED), F.lit(0.0)))) for k, centres in by_k.items()}
    again = points.agg(F.sum("n").alias("rows"), *[F.sum(d * F.col("n")).alias(f"c{k}") for k, d in nearest.items()])
    same = [F.struct(F.lit(k).alias("k"), (F.abs(F.col(f"c{k}") / F.lit(fits.cost[k]) - 1) < 1e-9).alias("agrees"))
            for k in by_k]
    return again.select("rows", F.explode(F.array(*same)).alias("e")).select("rows", "e.*")


def _elbow_embeddings(spark, folder):
    df = table(spark, folder, "embeddings", "embedding")
    wide = df.select(*[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)])
    return elbow(wide, wide.columns)


def _array_vectors(spark, folder):
    from pyspark.ml.functions import vector_to_array
    df = vectors_from_array(table(spark, folder, "embeddings", "vec_id", "embedding"), "embedding")
    back = vector_to_array("raw_features")
    return df.select("vec_id", F.size(back).alias("length"),
                     (F.round(F.aggregate(back, F.lit(0.0), lambda a, v: a + v), 5) + F.lit(0.0)).alias("total"))


MIXED = ["l_extendedprice", *GROUPED]


def _mixture(spark, folder):
    return Mixture.fit(_line_slice(spark, folder), MIXED)


def _line_slice(spark, folder):
    return slice_of(table(spark, folder, "lineitem", *MIXED, *SLICE), SLICE)


def _gmm_components(spark, folder):
    return _mixture(spark, folder).components(spark)


def _gmm_totals(spark, folder):
    """Weights sum to 1, each mean of row-normalised features sums to 1, every row has a component."""
    found = _mixture(spark, folder)
    parts = found.components(spark).groupBy("component").agg(F.first("weight").alias("weight"),
                                                             F.sum("mean").alias("total"))
    checks = parts.agg(F.round(F.sum("weight"), 6).alias("weights"),
                       (F.max(F.abs(F.col("total") - 1)) < 1e-6).alias("means_sum_to_1"))
    rows = found.assign(_line_slice(spark, folder)).agg(F.count("component")).head()[0]
    return checks.withColumn("rows", F.lit(rows).cast("long"))


def _gmm_responsibilities(spark, folder):
    """The probabilities of each row against those recomputed from weights, means and covariances as tables."""
    columns = [*MIXED, "l_orderkey", "l_linenumber"]
    rows = slice_of(table(spark, folder, "lineitem", *columns, *SLICE), SLICE)
    found = Mixture.fit(rows, MIXED)
    listed = found.components(spark).collect()
    k = len(listed) // len(MIXED)
    weights, means, covariances = np.zeros(k), np.zeros((k, len(MIXED))), np.zeros((k, len(MIXED), len(MIXED)))
    for row in listed:
        weights[row["component"]] = row["weight"]
        means[row["component"], MIXED.index(row["feature"])] = row["mean"]
    for row in found.covariances(spark).collect():
        covariances[row["component"], MIXED.index(row["feature_x"]), MIXED.index(row["feature_y"])] = row["cov"]
    # In units of the deviations over all components, no feature's digits are lost beside those of a larger one.
    beside = means - weights @ means
    unit = np.sqrt(weights @ (np.diagonal(covariances, axis1=1, axis2=2) + beside ** 2))

    def apart(batches):
        # Features that sum to 1 make every covariance singular; as in the fit, null directions do not count.
        parts = []
        for w, m, cov in zip(weights, means, covariances):
            values, vectors = np.linalg.eigh(cov / np.outer(unit, unit))
            used = np.arange(len(values)) > 0  # one direction: the sum of the features
            parts.append((np.log(w) - np.log(values[used]).sum() / 2, m,
                          vectors[:, used] / np.sqrt(values[used])))
        for batch in batches:
            x = batch[MIXED].to_numpy(float)
            x = x / np.abs(x).sum(1, keepdims=True)
            logs = np.column_stack([c - (((x - m) / unit @ root) ** 2).sum(1) / 2 for c, m, root in parts])
            p = np.exp(logs - logs.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            gap = np.abs(p - np.stack(batch["probability"].to_numpy())).max(1)
            yield batch[["l_orderkey", "l_linenumber"]].assign(agrees=gap < 1e-6)

    return found.assign(rows).select(*columns, "probability").mapInPandas(
        apart, "l_orderkey long, l_linenumber int, agrees boolean")


def _study(spark, folder):
    found = feature_study(_orders(spark, folder), "net", ORDER_PREDICTORS, ["l_orderkey"])
    return (found.best.select("best_by", "preds", F.lit(None).cast("string").alias("predictor"),
                              F.col("r2").alias("score"))
            .unionByName(found.importance.select(F.lit("importance").alias("best_by"),
                                                 F.lit(None).cast("string").alias("preds"), "predictor", "score")))


# -- SQL -------------------------------------------------------------------------------------------------------

_SLICED = "lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'"
_SLICED_K = "lineitem, (VALUES (5), (10), (20), (40)) AS v(k) WHERE l_returnflag = 'N' AND l_linestatus = 'O'"
_ORDERS = f"(SELECT l_orderkey, sum({NET}) AS net FROM lineitem GROUP BY l_orderkey)"

_TOTALS = f"""(SELECT l_orderkey, sum({NET}) AS net, sum(l_extendedprice) AS price, avg(l_discount) AS discount,
    avg(l_tax) AS tax, sum(l_quantity) AS quantity, {train_sql('l_orderkey')} AS train
    FROM lineitem GROUP BY l_orderkey)"""
_CTES, _FIT = fit_sql("f", "totals", "net", ORDER_PREDICTORS)
_LINEAR_METRICS = f"""WITH totals AS {_TOTALS}, {_CTES}
    SELECT 'net' AS target, 'pred_net' AS prediction, CAST(count(*) AS BIGINT) AS "count",
    {r('1 - avg((net - f_p) * (net - f_p)) / var_pop(net)', 7, 'rsquared')},
    {r('sqrt(avg((net - f_p) * (net - f_p)))', 4, 'rmse')}, {r('avg(abs(net - f_p))', 4, 'mae')},
    {r('avg(net)', 4, 'mtv')} FROM {_FIT} WHERE NOT train"""

def _best_split(tag: str, source: str, y: str, node: str) -> str:
    """CTEs: for each node of ``source`` the split of least squares over all values of all columns, and every row with
    its side (``{tag}_side``) and the mean of that side (``{tag}_p``)."""
    long = " UNION ALL ".join(f"SELECT {node} AS node, '{c}' AS f, {c} AS x, {y} AS y FROM {source}" for c in GROUPED)
    value = "CASE b.f " + " ".join(f"WHEN '{c}' THEN {c}" for c in GROUPED) + " END"
    return f"""
{tag}_g AS (SELECT node, f, x, count(*) AS n, sum(y) AS s FROM ({long}) GROUP BY node, f, x),
{tag}_c AS (SELECT *, sum(n) OVER (PARTITION BY node, f ORDER BY x) AS nl, sum(s) OVER (PARTITION BY node, f ORDER BY x) AS sl,
                   sum(n) OVER (PARTITION BY node, f) AS nt, sum(s) OVER (PARTITION BY node, f) AS st FROM {tag}_g),
{tag}_b AS (SELECT node, arg_max(struct_pack(f := f, x := x, l := sl / nl, r := (st - sl) / (nt - nl)),
                                 sl * sl / nl + (st - sl) * (st - sl) / (nt - nl)) AS b
            FROM {tag}_c WHERE nl < nt GROUP BY node),
{tag} AS (SELECT s.*, CASE WHEN {value} <= b.x THEN 0 ELSE 1 END AS {tag}_side,
                 CASE WHEN {value} <= b.x THEN b.l ELSE b.r END AS {tag}_p FROM {source} s JOIN {tag}_b ON {node} = {tag}_b.node)"""


_ROOT = f"rows AS (SELECT {', '.join(GROUPED)}, {NET} AS net FROM lineitem), " + _best_split("a", "rows", "net", "0")
_TWO_LEVELS = f"""WITH {_ROOT}, {_best_split('b', 'a', 'net', 'a_side')}
    SELECT {r('b_p', 3, 'prediction')}, CAST(count(*) AS BIGINT) AS rows FROM b GROUP BY 1"""



def _fixed_fits() -> str:
    """CTEs: scaled points with their counts, then assignment and centres in turn; ``end_a`` holds the last assignment."""
    values = ", ".join(f"({k}, {i}, {', '.join(f'{v}::DOUBLE' for v in start)})" for k, starts in FIXED_STARTS.items()
                       for i, start in enumerate(starts))
    z = {c: f"({c} - m_{c}) / s_{c}" for c in GROUPED}
    apart = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in GROUPED)
    listed = ", ".join(GROUPED)

    def assigned(name: str, centres: str) -> str:
        return f"""{name} AS (SELECT c.k, {', '.join('p.' + c for c in GROUPED)}, any_value(p.n) AS n, min({apart}) AS d,
        arg_min(c.cluster, struct_pack(d := round({apart}, 9), c := c.cluster)) AS cluster
        FROM points p, {centres} c GROUP BY c.k, {', '.join('p.' + c for c in GROUPED)})"""

    steps = ["stats AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in GROUPED)
             + f" FROM {_SLICED})",
             "points AS (SELECT " + ", ".join(f"{z[c]} AS {c}" for c in GROUPED) + ", count(*)::DOUBLE AS n FROM "
             f"(SELECT * FROM {_SLICED}), stats GROUP BY 1, 2, 3)",
             f"c0 AS (SELECT k, cluster, {', '.join(f'{z[c]} AS {c}' for c in GROUPED)} FROM (VALUES {values}) "
             f"AS v(k, cluster, {listed}), stats)"]
    for i in range(FIXED_MOVES):
        steps += [assigned(f"a{i}", f"c{i}"), f"""c{i + 1} AS (SELECT o.k, o.cluster, """ + ", ".join(
            f"coalesce(any_value(m.{c}), any_value(o.{c})) AS {c}" for c in GROUPED) + f""" FROM c{i} o LEFT JOIN
            (SELECT k, cluster, {', '.join(f'sum(n * {c}) / sum(n) AS {c}' for c in GROUPED)} FROM a{i} GROUP BY 1, 2) m
            ON o.k = m.k AND o.cluster = m.cluster GROUP BY 1, 2)"""]
    steps.append(assigned("end_a", f"c{FIXED_MOVES}"))
    return "WITH " + ", ".join(steps)


QUERIES: dict[str, Query] = {
    "linear_metrics": (_linear_metrics, _LINEAR_METRICS),
    "least_squares_metrics": (_least_squares_metrics, _LINEAR_METRICS),
    "tree_metrics": (_trial("tree"), None),
    "forest_metrics": (_trial("forest"), None),
    "gbt_metrics": (_trial("boosted"), None),
    "model_scored_rows": (_scored_rows, f"""
        SELECT kind, CAST(count(*) AS BIGINT) AS "count", round(avg(net), 4) AS mtv, true AS useful
        FROM {_ORDERS}, (VALUES ('linear'), ('tree'), ('forest')) AS k(kind)
        WHERE NOT {train_sql('l_orderkey')} GROUP BY kind"""),
    "tree_exact": (_exact("tree", maxDepth=2), _TWO_LEVELS),
    "forest_exact": (_exact("forest", maxDepth=2, **ONE_TREE), _TWO_LEVELS),
    "boosted_exact": (_exact("boosted", maxDepth=1, maxIter=2), f"""
        WITH {_ROOT}, rest AS (SELECT *, 2 * (net - a_p) AS residual FROM a), {_best_split('b', 'rest', 'residual', '0')}
        SELECT {r('a_p + 0.1 * b_p', 3, 'prediction')}, CAST(count(*) AS BIGINT) AS rows FROM b GROUP BY 1"""),
    "importance_exact": (_importance_exact, f"""WITH {_ROOT}
        SELECT c AS predictor, CASE WHEN c = b.f THEN 1.0 ELSE 0.0 END::DOUBLE AS score
        FROM a_b, (VALUES {', '.join(f"('{c}')" for c in GROUPED)}) AS k(c)"""),
    "forest_importance": (_importance, None),
    "forest_importance_scaled": (_importance_scaled, f"""
        WITH totals AS {_TOTALS} SELECT count(*) AS predictors, 1.0::DOUBLE AS total, true AS not_negative,
               arg_max(p, strength) AS first  -- the column that goes with the target most closely
        FROM (""" + " UNION ALL ".join(f"SELECT '{p}' AS p, abs(corr({p}, net)) AS strength FROM totals"
                                      for p in ORDER_PREDICTORS) + ")"),
    "gbt_settings": (_settings, None),
    "model_save_load": (_saved, f"SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS same "
                                f"FROM {_ORDERS}"),
    "kmeans_profile": (_kmeans_profile, None),
    "kmeans_totals": (_kmeans_totals, "SELECT CAST(count(*) AS BIGINT) AS rows, " + ", ".join(
        f"round(avg({c}), 7) AS {c}" for c in GROUPED) + f" FROM {_SLICED}"),
    "kmeans_centres": (_kmeans_centres, None),
    "kmeans_cost": (_kmeans_cost, f"SELECT CAST(count(*) AS BIGINT) AS rows, true AS agrees FROM {_SLICED}"),
    "kmeans_assign": (_kmeans_assign, f"SELECT l_orderkey, l_linenumber, 0.0::DOUBLE AS excess FROM {_SLICED}"),
    "kmeans_centres_exact": (_kmeans_exact, """
        SELECT round(l_tax, 6) AS least, round(l_tax, 6) AS most, CAST(count(*) AS BIGINT) AS rows, 0.0::DOUBLE AS cost
        FROM lineitem GROUP BY l_tax"""),
    "gmm_responsibilities": (_gmm_responsibilities, f"SELECT l_orderkey, l_linenumber, true AS agrees FROM {_SLICED}"),
    "kmeans_elbow": (_elbow, None),
    "kmeans_sweep_fixed": (_sweep_fixed, f"""{_fixed_fits()}
        SELECT c.k::INTEGER AS k, c.cluster::INTEGER AS cluster, coalesce(sum(a.n), 0)::BIGINT AS rows,
               {', '.join(f'round(any_value(c.{c}), 6) AS {c}' for c in GROUPED)}, any_value(round(t.cost, 4)) AS cost
        FROM c{FIXED_MOVES} c LEFT JOIN end_a a ON a.k = c.k AND a.cluster = c.cluster
        JOIN (SELECT k, sum(n * d) AS cost FROM end_a GROUP BY k) t ON t.k = c.k GROUP BY c.k, c.cluster"""),
    "kmeans_sweep_assign": (_sweep_assign, f"""{_fixed_fits()}
        SELECT l_orderkey, l_linenumber, a.cluster::INTEGER AS cluster
        FROM (SELECT * FROM {_SLICED}) l, stats JOIN end_a a ON a.k = 5 AND {' AND '.join(
            f'a.{c} = (l.{c} - m_{c}) / s_{c}' for c in GROUPED)}"""),
    "kmeans_sweep_costs": (_sweep_costs, f"""
        SELECT CAST(count(*) AS BIGINT) AS rows, k, true AS agrees FROM {_SLICED_K} GROUP BY k"""),
    "kmeans_elbow_embeddings": (_elbow_embeddings, None),
    "array_vectors": (_array_vectors, f"""
        SELECT vec_id, CAST(len(embedding) AS INTEGER) AS length,
               {r('list_sum(list_transform(embedding, lambda v: v::DOUBLE))', 5, 'total')} FROM embeddings"""),
    "gmm_components": (_gmm_components, None),
    "gmm_totals": (_gmm_totals, f"""SELECT 1.0::DOUBLE AS weights, true AS means_sum_to_1,
                                           CAST(count(*) AS BIGINT) AS rows FROM {_SLICED}"""),
    "feature_study": (_study, None),
}
