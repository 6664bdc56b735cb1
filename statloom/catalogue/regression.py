"""Queries on least squares, its tests, splits, evaluation, best subsets and tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.catalogue.common import (LINE_PREDICTORS, NET, Query, fit_sql, lines, position_sql, r, rounded, table,
                                       train_sql)
from statloom.operators.evaluate import evaluate, with_residual
from statloom.operators.linear import (coefficient_summary, cross_validate, fit_linear, grid_report,
                                       moment_grid_search, parameter_docs, training_residuals, training_summary)
from statloom.operators.ols import LeastSquares
from statloom.operators.split import SEED, hash_split, portable_key, split_number, with_fold
from statloom.sources.tables import literal_rows
from statloom.operators.subsets import best_subset, column_subsets, ranked, winners

TARGET, TWO = "p_retailprice", ["p_partkey", "p_size"]


def _part(spark, folder, *extra):
    return table(spark, folder, "part", *TWO, TARGET, *extra)


def _two(spark, folder):
    return LeastSquares.fit(_part(spark, folder), TARGET, TWO)


def _split_counts(spark, folder):
    return rounded(table(spark, folder, "orders", "o_orderkey", "o_totalprice")
                   .groupBy(split_number(portable_key("o_orderkey")).alias("share"))
                   .agg(F.count(F.lit(1)).alias("rows"), F.avg("o_totalprice").alias("mean_price")), {"mean_price": 6})


SMALL = (0.9, 0.0999, 0.0001)


def _split_small(spark, folder):
    """A share of one in ten thousand."""
    number = split_number(portable_key("l_orderkey", "l_linenumber"), SMALL)
    return (table(spark, folder, "lineitem", "l_orderkey", "l_linenumber").groupBy(number.alias("share"))
            .agg(F.count(F.lit(1)).alias("rows")))


def _fold_counts(spark, folder):
    return (with_fold(table(spark, folder, "orders", "o_orderkey"), portable_key("o_orderkey")).groupBy("fold")
            .agg(F.count(F.lit(1)).alias("rows")))


def _ols_one(spark, folder):
    return rounded(LeastSquares.fit(_part(spark, folder), TARGET, TWO[:1]).coefficient_table(spark), {"estimate": 8})


def _ols_two(spark, folder):
    return rounded(_two(spark, folder).coefficient_table(spark), {"estimate": 8})


def _ols_covariance(spark, folder):
    return rounded(_two(spark, folder).coefficient_covariance(spark), {"cov": 9})


def _ols_anova(spark, folder):
    found = _two(spark, folder).anova(spark)
    return rounded(found, {"critical": 8, "p_value": 10, "ss_regression": 3, "ss_error": 3, "ss_total": 3, "ms_regression": 3, "ms_error": 6,
                           "f_value": 6})


def _ols_t_tests(spark, folder):
    found = _two(spark, folder).t_tests(spark)
    return rounded(found, {"critical": 8, "p_value": 8, "estimate": 8, "std_error": 8, "t_value": 6})


def _partial_f(spark, folder):
    found = _two(spark, folder).partial_f(spark, [["p_partkey"], ["p_size"], TWO])
    return rounded(found, {"critical": 7, "p_value": 8, "extra_ss": 3, "f_value": 6})


def _leverage(spark, folder):
    df = _part(spark, folder)
    return rounded(LeastSquares.fit(df, TARGET, TWO).leverage(df).select("p_partkey", "leverage"), {"leverage": 10})


def _predicted(spark, folder, *extra):
    training, testing = hash_split(_part(spark, folder, *extra), portable_key("p_partkey"))
    return LeastSquares.fit(training, TARGET, TWO[:1]).predict(testing)


def _predict_evaluate(spark, folder):
    return rounded(evaluate(_predicted(spark, folder), TARGET, f"pred_{TARGET}"), METRIC_DIGITS)


def _evaluate_by_slice(spark, folder):
    return rounded(evaluate(_predicted(spark, folder, "p_brand"), TARGET, f"pred_{TARGET}", ["p_brand"]), METRIC_DIGITS)


def _predict_rows(spark, folder):
    rows = with_residual(_predicted(spark, folder), TARGET, f"pred_{TARGET}")
    return rounded(rows.select("p_partkey", f"pred_{TARGET}", "residual"), {f"pred_{TARGET}": 6, "residual": 6})


METRIC_DIGITS = {"rsquared": 8, "rmse": 7, "mse": 6, "mae": 7, "mtv": 7}
SUBSET_DIGITS = {"r2": 8, "rmse": 7, "mae": 7}


def _best_subset(spark, folder):
    return rounded(ranked(best_subset(_part(spark, folder), TARGET, TWO, portable_key("p_partkey"))), SUBSET_DIGITS)


def _winners(spark, folder):
    return rounded(winners(best_subset(_part(spark, folder), TARGET, TWO, portable_key("p_partkey"))), SUBSET_DIGITS)


def _best_subset_lines(spark, folder):
    found = best_subset(lines(spark, folder, "l_orderkey"), "net", LINE_PREDICTORS, portable_key("l_orderkey"))
    return rounded(ranked(found), {"r2": 8, "rmse": 4, "mae": 4})


def _embedding_subsets(p):
    """Every set of the first ``p`` entries of the embeddings, the next entry as target."""
    def run(spark, folder):
        df = table(spark, folder, "embeddings", "vec_id", "embedding")
        df = df.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(p + 1)])
        return rounded(best_subset(df, f"e{p}", [f"e{i}" for i in range(p)], portable_key("vec_id")), SUBSET_DIGITS)
    return run


DAY, MIDDLE, UNIT = "1600-01-01", 145_000, 1_000  # for the cubic trend: first day, and origin and unit of the SQL


def _ols_illconditioned(spark, folder):
    """A cubic trend in days since 1600: the three powers have a condition of about a million."""
    df = table(spark, folder, "lineitem", "l_shipdate", "l_extendedprice")
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.lit(DAY).cast("date")).cast("double")
    df = df.select("l_extendedprice", days.alias("d1"), (days * days).alias("d2"), (days * days * days).alias("d3"))
    found = LeastSquares.fit(df, "l_extendedprice", ["d1", "d2", "d3"], method="qr").t_tests(spark)
    power = F.substring("term", 2, 1).cast("int")
    scale = F.pow(F.lit(float(UNIT)), power) / F.pow(F.lit(MIDDLE / UNIT), F.lit(3) - power)
    found = found.filter("term like 'd%'").select("term", (F.col("estimate") * scale).alias("estimate"),
                                                   (F.col("std_error") * scale).alias("std_error"), "t_value")
    return rounded(found, {"estimate": 4, "std_error": 4, "t_value": 6})


def _best_subset_collinear(spark, folder):
    """One predictor is a multiple of another: the sets with both fit as well as with either."""
    df = _part(spark, folder).withColumn("double_size", F.col("p_size") * 2)
    found = best_subset(df, TARGET, ["p_partkey", "p_size", "double_size"], portable_key("p_partkey"))
    return rounded(found, SUBSET_DIGITS)


def _ols_lines(spark, folder):
    """Four predictors on the whole table, with residuals summed from the rows."""
    found = LeastSquares.fit(lines(spark, folder), "net", LINE_PREDICTORS, refine=True).anova(spark)
    return found.select("n", "dof_regression", "dof_error", F.round(F.col("ss_error") / F.col("n"), 3).alias("mean_error"),
                        F.round("f_value", 2).alias("f_value"), "significance")


def _equation(spark, folder):
    """The fitted equation as text."""
    return literal_rows(spark, [(_two(spark, folder).equation,)], "equation string").select(
        F.regexp_extract("equation", r"^(\w+) = ", 1).alias("target"),
        *[F.round(F.replace(F.regexp_extract("equation", pattern, 1), F.lit(" "), F.lit("")).cast("double"), 3).alias(name)
          for name, pattern in (("intercept", r"= (\S+)"), ("b1", r"([+-] \S+) p_partkey"), ("b2", r"([+-] \S+) p_size"))])


def _best_coefficients(spark, folder):
    """The coefficients of the best of all grid points."""
    best = moment_grid_search(_part(spark, folder), TARGET, TWO[:1], portable_key("p_partkey")).best
    rows = [("(intercept)", best.intercept), *zip(best.predictors, map(float, best.slopes))]
    return rounded(literal_rows(spark, rows, "term string, estimate double"), {"estimate": 6})


def _fitted(spark, folder):
    return fit_linear(_part(spark, folder), TARGET, TWO)


def _linear_coefficients(spark, folder):
    found = coefficient_summary(_fitted(spark, folder), TWO, spark)
    return rounded(found, {"p_value": 8, "estimate": 7, "std_error": 7, "t_value": 6})


def _linear_summary(spark, folder):
    found = training_summary(_fitted(spark, folder), spark)
    return rounded(found.filter(~F.col("measure").rlike("^(iterations|objective)")), {"value": 6})


def _linear_residuals(spark, folder):
    return training_residuals(_fitted(spark, folder)).agg(
        F.count(F.lit(1)).alias("rows"), (F.round(F.sum("residuals"), 4) + F.lit(0.0)).alias("total"),
        F.round(F.sum(F.col("residuals") * F.col("residuals")), 4).alias("squares"))


def _grid_moments(spark, folder):
    found = moment_grid_search(_part(spark, folder), TARGET, TWO[:1], portable_key("p_partkey")).report(spark)
    return rounded(found, {"avg_metric": 7})


def _grid_moments_best(spark, folder):
    training, testing = hash_split(_part(spark, folder), portable_key("p_partkey"))
    best = moment_grid_search(training, TARGET, TWO[:1], portable_key("p_partkey")).best
    return rounded(evaluate(best.predict(testing), TARGET, f"pred_{TARGET}"), METRIC_DIGITS)


def _tuned(spark, folder):
    return cross_validate(_part(spark, folder), TARGET, TWO[:1], portable_key("p_partkey"))


def _grid_refit(spark, folder):
    found = grid_report(_tuned(spark, folder), spark)
    return rounded(found.drop("rank"), {"avg_metric": 3})


def _grid_docs(spark, folder):
    """The chosen value and the documentation of every tuned parameter, over all grid points."""
    return parameter_docs(_tuned(spark, folder), spark).select("parameter", F.length("description") > 20, "value").toDF(
        "parameter", "described", "value").withColumn(
        "value", F.when(F.col("parameter") == "regParam", F.col("value")))  # the others tie where nothing is penalised


# -- SQL -------------------------------------------------------------------------------------------------------

def _closed_form(source: str = "part") -> str:
    """CTE ``f``: the two-predictor fit in closed form, one row."""
    return f"""
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(p_partkey) AS m1, avg(p_size) AS m2, avg(p_retailprice) AS my,
        var_pop(p_partkey) * count(*) AS s11, var_pop(p_size) * count(*) AS s22,
        covar_pop(p_partkey, p_size) * count(*) AS s12, covar_pop(p_partkey, p_retailprice) * count(*) AS s1y,
        covar_pop(p_size, p_retailprice) * count(*) AS s2y, var_pop(p_retailprice) * count(*) AS syy,
        stddev_samp(p_partkey) AS sd1, stddev_samp(p_size) AS sd2 FROM {source}),
s AS (SELECT *, s22 / (s11 * s22 - s12 * s12) AS i11, s11 / (s11 * s22 - s12 * s12) AS i22,
        -s12 / (s11 * s22 - s12 * s12) AS i12 FROM m),
b AS (SELECT *, i11 * s1y + i12 * s2y AS b1, i12 * s1y + i22 * s2y AS b2 FROM s),
q AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, b1 * s1y + b2 * s2y AS ssr FROM b),
e AS (SELECT *, syy - ssr AS sse, (syy - ssr) / (n - 3) AS mse FROM q),
f AS (SELECT *, mse * (1 / n + m1 * m1 * i11 + 2 * m1 * m2 * i12 + m2 * m2 * i22) AS v0, mse * i11 AS v1,
        mse * i22 AS v2, -mse * (i11 * m1 + i12 * m2) AS v01, -mse * (i12 * m1 + i22 * m2) AS v02,
        mse * i12 AS v12 FROM e)"""


# Exact 0.05 critical values stay between these bounds for more than 190 degrees of freedom.
def _label(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Reject Null Hyp' ELSE 'Fail to Reject' END AS significance"


_METRICS = f"""'p_retailprice' AS target, 'pred_p_retailprice' AS prediction, {{by}} CAST(count(*) AS BIGINT) AS "count",
    {r('1 - avg((y - p) * (y - p)) / var_pop(y)', 8, 'rsquared')}, {r('sqrt(avg((y - p) * (y - p)))', 7, 'rmse')},
    {r('avg((y - p) * (y - p))', 6, 'mse')}, {r('avg(abs(y - p))', 7, 'mae')}, {r('avg(y)', 7, 'mtv')}"""
_SCORED = f"""
WITH c AS (SELECT regr_slope(p_retailprice, p_partkey) AS b, regr_intercept(p_retailprice, p_partkey) AS a
           FROM part WHERE {train_sql('p_partkey')}),
t AS (SELECT p_partkey, p_brand, p_retailprice AS y, a + b * p_partkey AS p FROM part, c
      WHERE NOT {train_sql('p_partkey')})"""

_SUBSETS = f"""
WITH {_closed_form("(SELECT * FROM part WHERE " + train_sql("p_partkey") + ")")},
t AS (SELECT p_retailprice AS y, my + s1y / s11 * (p_partkey - m1) AS p1, my + s2y / s22 * (p_size - m2) AS p2,
             b0 + b1 * p_partkey + b2 * p_size AS p12 FROM part, f WHERE NOT {train_sql('p_partkey')}),
subsets AS (
""" + " UNION ALL ".join(f"""
  SELECT CAST({i} AS BIGINT) AS id, '{names}' AS preds, CAST({k} AS DOUBLE) AS num_preds,
    {r(f'1 - avg((y - {p}) * (y - {p})) / var_pop(y)', 8, 'r2')}, {r(f'sqrt(avg((y - {p}) * (y - {p})))', 7, 'rmse')},
    {r(f'avg(abs(y - {p}))', 7, 'mae')} FROM t""" for i, names, k, p in (
        (0, "p_partkey", 1, "p1"), (1, "p_size", 1, "p2"), (2, "p_partkey, p_size", 2, "p12"))) + ")"

_FOLD = f"CAST({position_sql('{key}', SEED + 1)} % 3 AS INTEGER)"


def _grid(extra: str, digits: int, rank: str) -> str:
    """Elastic net with one predictor has a closed form: soft threshold, then shrink."""
    return f"""
WITH d AS (SELECT p_partkey AS x, p_retailprice AS y, {_FOLD.format(key='p_partkey')} AS fold FROM part),
k AS (SELECT f.fold, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS rho
      FROM d JOIN (SELECT DISTINCT fold FROM d) f ON d.fold <> f.fold GROUP BY f.fold),
g AS (SELECT *, sign(rho) * greatest(abs(rho) - reg / sy * mix, 0) / (1 + reg / sy * (1 - mix)) * sy / sx AS b
      FROM k, (VALUES (0.0::DOUBLE), (0.3)) AS r(reg), (VALUES (0.0::DOUBLE), (0.4)) AS e(mix)),
s AS (SELECT reg, mix, fold, sqrt(avg(pow(y - my - b * (x - mx), 2))) AS rmse FROM g JOIN d USING (fold)
      GROUP BY reg, mix, fold),
a AS (SELECT reg, mix, avg(rmse) AS score FROM s GROUP BY reg, mix)
SELECT {extra} reg AS reg_param, mix AS elastic_net, {r('score', digits, 'avg_metric')} {rank} FROM a"""


def _grid_best(where: str) -> str:
    """CTEs ending in ``best``: slope and means of the best grid point, refitted on all rows of the condition."""
    return f"""
d AS (SELECT p_partkey AS x, p_retailprice AS y, {_FOLD.format(key='p_partkey')} AS fold FROM part WHERE {where}),
k AS (SELECT f.fold, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS rho
      FROM d JOIN (SELECT DISTINCT fold FROM d) f ON d.fold <> f.fold GROUP BY f.fold
      UNION ALL SELECT -1, avg(x), avg(y), stddev_pop(x), stddev_pop(y), corr(x, y) FROM d),
g AS (SELECT *, sign(rho) * greatest(abs(rho) - reg / sy * mix, 0) / (1 + reg / sy * (1 - mix)) * sy / sx AS b
      FROM k, (VALUES (0.0::DOUBLE), (0.3)) AS r(reg), (VALUES (0.0::DOUBLE), (0.4)) AS e(mix)),
s AS (SELECT reg, mix, fold, sqrt(avg(pow(y - my - b * (x - mx), 2))) AS rmse FROM g JOIN d USING (fold)
      GROUP BY reg, mix, fold),
w AS (SELECT reg, mix FROM s GROUP BY reg, mix ORDER BY round(avg(rmse), 9), reg, mix LIMIT 1),
best AS (SELECT b, mx, my FROM g JOIN w USING (reg, mix) WHERE fold = -1)"""


_GRID_BEST = f"""
WITH {_grid_best(train_sql('p_partkey'))},
t AS (SELECT p_retailprice AS y, my + b * (p_partkey - mx) AS p FROM part, best WHERE NOT {train_sql('p_partkey')})
SELECT {_METRICS.format(by='')} FROM t"""

_LINES = f"(SELECT *, {NET} AS net, {train_sql('l_orderkey')} AS train FROM lineitem)"


def _line_subsets() -> str:
    ctes, rows = [f"lines AS {_LINES}"], []
    for i, subset in enumerate(column_subsets(LINE_PREDICTORS)):
        text, name = fit_sql(f"s{i}", "lines", "net", list(subset))
        ctes.append(text)
        rows.append(f"""SELECT CAST({i} AS BIGINT) AS id, '{", ".join(subset)}' AS preds,
            CAST({len(subset)} AS DOUBLE) AS num_preds,
            {r(f'1 - avg((net - s{i}_p) * (net - s{i}_p)) / var_pop(net)', 8, 'r2')},
            {r(f'sqrt(avg((net - s{i}_p) * (net - s{i}_p)))', 4, 'rmse')}, {r(f'avg(abs(net - s{i}_p))', 4, 'mae')}
            FROM {name} WHERE NOT train""")
    return "WITH " + ", ".join(ctes) + " UNION ALL ".join(rows)


def _ols_lines_sql() -> str:
    text, name = fit_sql("f", "lines", "net", LINE_PREDICTORS)
    return f"""WITH lines AS (SELECT *, {NET} AS net, true AS train FROM lineitem), {text},
        e AS (SELECT CAST(count(*) AS BIGINT) AS n, sum((net - f_p) * (net - f_p)) AS sse,
                     var_pop(net) * count(*) AS syy FROM {name})
        SELECT n, 4 AS dof_regression, n - 5 AS dof_error, round(sse / n, 3) AS mean_error,
               round((syy - sse) / 4 / (sse / (n - 5)), 2) AS f_value, 'Reject Null Hyp' AS significance FROM e"""


def _swept(source: str, values: list[str], limit: str) -> str:
    """CTEs: ``swept(members, a)`` holds the covariance matrix of ``values`` (row by row in a list; the last is the
    target) after sweeping the members, for every set of members that meets the condition ``limit`` of a step."""
    q = len(values)
    pairs = ", ".join(f"covar_pop({x}, {y})" for x in values for y in values)
    i, k = f"((t - 1) // {q} + 1)", f"((t - 1) % {q} + 1)"

    def at(i, k):
        return f"a[({i} - 1) * {q} + {k}]"

    return f"""
swept AS (
  SELECT 0 AS last, CAST([] AS BIGINT[]) AS members, (SELECT [{pairs}] FROM {source}) AS a
  UNION ALL
  SELECT j AS last, list_append(members, j), list_transform(a, lambda v, t: CASE
      WHEN {i} = j AND {k} = j THEN -1 / v
      WHEN {i} = j OR {k} = j THEN v / {at('j', 'j')}
      ELSE v - {at(i, 'j')} * {at('j', k)} / {at('j', 'j')} END)
  FROM swept, (SELECT unnest(range(1, {q})) AS j) WHERE j > last AND {limit})"""


def _embedding_subsets_sql(p: int) -> str:
    """Every set fitted by sweeps along a tree of sets, and measured on the rows."""
    q = p + 1
    values = [f"CAST(embedding[{i}] AS DOUBLE)" for i in range(1, q + 1)]
    train = f"(SELECT * FROM embeddings WHERE {train_sql('vec_id')})"
    return f"""WITH RECURSIVE {_swept(train, values, 'true')},
        means AS (SELECT [{', '.join(f'avg({v})' for v in values)}] AS m FROM {train}),
        fits AS (SELECT members, list_transform(range(1, {q + 1}), lambda i: CASE WHEN i = {q} THEN 1.0
                   WHEN list_contains(members, i) THEN -a[i * {q}] ELSE 0.0 END)::DOUBLE[{q}] AS c
                 FROM swept WHERE len(members) > 0),
        held AS (SELECT [{', '.join(f'{v} - m[{i}]' for i, v in enumerate(values, 1))}]::DOUBLE[{q}] AS v
                 FROM embeddings, means WHERE NOT {train_sql('vec_id')}),
        total AS (SELECT count(*) AS n, var_pop(v[{q}]) AS spread FROM held),
        errors AS (SELECT members, avg(pow(array_inner_product(c, v), 2)) AS square, avg(abs(array_inner_product(c, v))) AS mae
                   FROM fits, held GROUP BY members)
        SELECT row_number() OVER (ORDER BY len(members), members) - 1 AS id,
            array_to_string(list_transform(members, lambda i: 'e' || (i - 1)), ', ') AS preds,
            CAST(len(members) AS DOUBLE) AS num_preds, {r('1 - square / spread', 8, 'r2')}, {r('sqrt(square)', 7, 'rmse')},
            {r('mae', 7, 'mae')} FROM errors, total"""


def _ols_illconditioned_sql() -> str:
    """The trend in u = (day - MIDDLE) / UNIT, whose powers are well conditioned, as a polynomial of the day."""
    day = f"(date_diff('day', DATE '{DAY}', CAST(l_shipdate AS DATE)) - {MIDDLE}) / {UNIT}.0::DOUBLE"
    c, powers = MIDDLE / UNIT, ["u", "u * u", "u * u * u"]
    terms = [("d1", (1.0, -2 * c, 3 * c * c)), ("d2", (0.0, 1.0, -3 * c)), ("d3", (0.0, 0.0, 1.0))]
    rows = []
    for power, (name, g) in enumerate(terms, 1):
        estimate = " + ".join(f"{x!r} * a[{4 * i}]" for i, x in enumerate(g, 1))
        variance = " + ".join(f"{x * y!r} * -a[{4 * (i - 1) + k}]" for i, x in enumerate(g, 1) for k, y in enumerate(g, 1))
        scale = f"pow({c!r}, {3 - power})"
        rows.append(f"""SELECT '{name}' AS term, {r(f'({estimate}) / {scale}', 4, 'estimate')},
            {r(f'sqrt(({variance}) * a[16] / (n - 4)) / {scale}', 4, 'std_error')},
            {r(f'({estimate}) / sqrt(({variance}) * a[16] / (n - 4))', 6, 't_value')} FROM swept, counted WHERE len(members) = 3""")
    return f"""WITH RECURSIVE days AS (SELECT {day} AS u, l_extendedprice FROM lineitem),
        counted AS (SELECT count(*) AS n FROM days), {_swept('days', [*powers, 'l_extendedprice'], 'j = last + 1')}
        """ + " UNION ALL ".join(rows)


def _area(t: str) -> str:
    """P(|T| < t) for d degrees of freedom as a finite sum, from the terms of ``_t_area``."""
    angle = f"atan({t} / sqrt(d))"
    return f"""(CASE WHEN d % 2 = 1
        THEN 2 / pi() * ({angle} + sin({angle}) * list_sum(list_transform(c, lambda a, i: a * pow(cos({angle}), 2 * i - 1))))
        ELSE sin({angle}) * list_sum(list_transform(c, lambda a, i: a * pow(cos({angle}), 2 * i - 2))) END)"""


def _t_area() -> str:
    """CTEs: the coefficients of the sum for n - 3 degrees of freedom, and the critical value by bisection."""
    return f"""
t_terms AS (
  SELECT d, list(CASE WHEN d % 2 = 1 THEN exp(lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5))
                      ELSE exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1)) END ORDER BY k) AS c
  FROM (SELECT CAST(n - 3 AS BIGINT) AS d FROM f), (SELECT unnest(range(0, 1000000)) AS k)
  WHERE 2 * k <= d - 2 - d % 2 GROUP BY d),
t_bisect AS (
  SELECT CAST(0 AS DOUBLE) AS lo, CAST(100 AS DOUBLE) AS hi, 0 AS step
  UNION ALL SELECT CASE WHEN {_area('((lo + hi) / 2)')} < 0.95 THEN (lo + hi) / 2 ELSE lo END,
                   CASE WHEN {_area('((lo + hi) / 2)')} < 0.95 THEN hi ELSE (lo + hi) / 2 END, step + 1
  FROM t_bisect, t_terms WHERE step < 60),
t_found AS (SELECT (lo + hi) / 2 AS t_critical FROM t_bisect WHERE step = 60)"""


_ONE = "(t_critical * t_critical)"  # the critical F of one degree of freedom

QUERIES: dict[str, Query] = {
    "ols_lines": (_ols_lines, _ols_lines_sql()),
    "hash_split_counts": (_split_counts, f"""
        SELECT CASE WHEN {train_sql('o_orderkey')} THEN 0 ELSE 1 END AS share, CAST(count(*) AS BIGINT) AS rows,
               {r('avg(o_totalprice)', 6, 'mean_price')} FROM orders GROUP BY 1"""),
    "hash_split_small_share": (_split_small, f"""
        SELECT CASE WHEN p < {round(0.9 * 2 ** 32)} THEN 0 WHEN p < {round(0.9999 * 2 ** 32)} THEN 1 ELSE 2 END AS share,
               CAST(count(*) AS BIGINT) AS rows
        FROM (SELECT ('0x' || substr(md5('{SEED}:' || l_orderkey || '|' || l_linenumber), 1, 8))::BIGINT AS p FROM lineitem)
        GROUP BY 1"""),
    "fold_counts": (_fold_counts, f"SELECT {_FOLD.format(key='o_orderkey')} AS fold, CAST(count(*) AS BIGINT) AS rows "
                                  f"FROM orders GROUP BY 1"),
    "ols_one": (_ols_one, f"""
        SELECT '(intercept)' AS term, {r('regr_intercept(p_retailprice, p_partkey)', 8, 'estimate')} FROM part
        UNION ALL SELECT 'p_partkey', {r('regr_slope(p_retailprice, p_partkey)', 8, 'estimate')} FROM part"""),
    "ols_two": (_ols_two, f"WITH {_closed_form()} " + " UNION ALL ".join(
        f"SELECT '{t}' AS term, {r(b, 8, 'estimate')} FROM f"
        for t, b in (("(intercept)", "b0"), ("p_partkey", "b1"), ("p_size", "b2")))),
    "ols_covariance": (_ols_covariance, f"WITH {_closed_form()} " + " UNION ALL ".join(
        f"SELECT '{a}' AS term_x, '{b}' AS term_y, {r(v, 9, 'cov')} FROM f" for a, b, v in (
            ("(intercept)", "(intercept)", "v0"), ("(intercept)", "p_partkey", "v01"), ("(intercept)", "p_size", "v02"),
            ("p_partkey", "(intercept)", "v01"), ("p_partkey", "p_partkey", "v1"), ("p_partkey", "p_size", "v12"),
            ("p_size", "(intercept)", "v02"), ("p_size", "p_partkey", "v12"), ("p_size", "p_size", "v2")))),
    "ols_anova": (_ols_anova, f"""
        WITH {_closed_form()} SELECT CAST(n AS BIGINT) AS n, 2 AS dof_regression, CAST(n - 3 AS BIGINT) AS dof_error,
        {r('ssr', 3, 'ss_regression')}, {r('sse', 3, 'ss_error')}, {r('syy', 3, 'ss_total')},
        {r('ssr / 2', 3, 'ms_regression')}, {r('mse', 6, 'ms_error')}, {r('ssr / 2 / mse', 6, 'f_value')},
        {r('(n - 3) / 2 * (pow(0.05, -2 / (n - 3)) - 1)', 8, 'critical')},
        {r('pow(1 + ssr / sse, -(n - 3) / 2)', 10, 'p_value')},
        {_label('ssr / 2 / mse > 3.0')} FROM f"""),
    "equation": (_equation, f"""WITH {_closed_form()} SELECT 'p_retailprice' AS target, """ + ", ".join(
        # six significant digits, as the text has
        r(f"round({e}, 5 - CAST(floor(log10(abs({e}))) AS INTEGER))", 3, n)
        for e, n in (("b0", "intercept"), ("b1", "b1"), ("b2", "b2"))) + " FROM f"),
    "ols_t_tests": (_ols_t_tests, f"WITH RECURSIVE {_closed_form()}, {_t_area()} " + " UNION ALL ".join(
        f"SELECT '{t}' AS term, {r(b, 8, 'estimate')}, {r(f'sqrt({v})', 8, 'std_error')}, "
        f"{r(f'{b} / sqrt({v})', 6, 't_value')}, {r('t_critical', 8, 'critical')}, "
        f"{r('1 - ' + _area(f'(abs({b}) / sqrt({v}))'), 8, 'p_value')}, "
        f"{_label(f'abs({b}) / sqrt({v}) > t_critical')} FROM f, t_terms, t_found"
        for t, b, v in (("(intercept)", "b0", "v0"), ("p_partkey", "b1", "v1"), ("p_size", "b2", "v2")))),
    "partial_f": (_partial_f, f"WITH RECURSIVE {_closed_form()}, {_t_area()} " + " UNION ALL ".join(
        f"SELECT '{t}' AS dropped, {k} AS dof_dropped, CAST(n - 3 AS BIGINT) AS dof_error, {r(x, 3, 'extra_ss')}, "
        f"{r(f'({x}) / {k} / mse', 6, 'f_value')}, {r(c, 7, 'critical')}, {r(q, 8, 'p_value')}, "
        f"{_label(f'({x}) / {k} / mse > {c}')} FROM f, t_terms, t_found"
        for t, k, x, c, q in (
            ("p_partkey", 1, "ssr - s2y * s2y / s22", _ONE, "1 - " + _area("sqrt((ssr - s2y * s2y / s22) / mse)")),
            ("p_size", 1, "ssr - s1y * s1y / s11", _ONE, "1 - " + _area("sqrt((ssr - s1y * s1y / s11) / mse)")),
            ("p_partkey, p_size", 2, "ssr", "((n - 3) / 2 * (pow(0.05, -2 / (n - 3)) - 1))", "pow(1 + ssr / sse, -(n - 3) / 2)")))),
    "leverage": (_leverage, f"""
        WITH {_closed_form()} SELECT p_partkey, {r('''1 / n + (p_partkey - m1) * (p_partkey - m1) * i11
        + 2 * (p_partkey - m1) * (p_size - m2) * i12 + (p_size - m2) * (p_size - m2) * i22''', 10, 'leverage')}
        FROM part, f"""),
    "predict_evaluate": (_predict_evaluate, f"{_SCORED} SELECT {_METRICS.format(by='')} FROM t"),
    "evaluate_by_slice": (_evaluate_by_slice,
                          f"{_SCORED} SELECT {_METRICS.format(by='p_brand,')} FROM t GROUP BY p_brand"),
    "predict_rows": (_predict_rows, f"{_SCORED} SELECT p_partkey, {r('p', 6, 'pred_p_retailprice')}, "
                                    f"{r('y - p', 6, 'residual')} FROM t"),
    "best_subset": (_best_subset, f"{_SUBSETS} SELECT * FROM subsets"),
    "best_subset_winners": (_winners, f"""{_SUBSETS}
        SELECT 'r2' AS best_by, * FROM subsets WHERE r2 = (SELECT max(r2) FROM subsets)
        UNION ALL SELECT 'rmse', * FROM subsets WHERE rmse = (SELECT min(rmse) FROM subsets)
        UNION ALL SELECT 'mae', * FROM subsets WHERE mae = (SELECT min(mae) FROM subsets)"""),
    "best_subset_lines": (_best_subset_lines, _line_subsets()),
    "best_subset_wide": (_embedding_subsets(13), _embedding_subsets_sql(13)),
    "best_subset_sweep": (_embedding_subsets(16), _embedding_subsets_sql(16)),
    "ols_illconditioned": (_ols_illconditioned, _ols_illconditioned_sql()),
    "best_subset_collinear": (_best_subset_collinear, f"{_SUBSETS} " + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS id, '{names}' AS preds, CAST({k} AS DOUBLE) AS num_preds, r2, rmse, mae FROM subsets "
        f"WHERE id = {same}" for i, names, k, same in (
            (0, "p_partkey", 1, 0), (1, "p_size", 1, 1), (2, "double_size", 1, 1), (3, "p_partkey, p_size", 2, 2),
            (4, "p_partkey, double_size", 2, 2), (5, "p_size, double_size", 2, 1),
            (6, "p_partkey, p_size, double_size", 3, 2)))),
    "linear_coefficients": (_linear_coefficients, f"WITH RECURSIVE {_closed_form()}, {_t_area()} " + " UNION ALL ".join(
        f"SELECT '{t}' AS term, {r(f'{b} * {sd}', 7, 'estimate')}, {r(f'sqrt({v}) * {sd}', 7, 'std_error')}, "
        f"{r(f'{b} / sqrt({v})', 6, 't_value')}, {r('1 - ' + _area(f'(abs({b}) / sqrt({v}))'), 8, 'p_value')} "
        f"FROM f, t_terms" for t, b, v, sd in (
            ("(intercept)", "b0", "v0", "1"), ("p_partkey", "b1", "v1", "sd1"), ("p_size", "b2", "v2", "sd2")))),
    "linear_summary": (_linear_summary, f"""WITH {_closed_form()},
        t AS (SELECT p_retailprice AS y, p_retailprice - b0 - b1 * p_partkey - b2 * p_size AS e FROM part, f),
        u AS (SELECT count(*) AS n, avg(e * e) AS mse, avg(abs(e)) AS mae, min(e) AS lo, max(e) AS hi FROM t)
        """ + " UNION ALL ".join(f"SELECT '{k}' AS measure, {r(v, 6, 'value')} FROM u, f" for k, v in (
            ("rows", "u.n::DOUBLE"), ("features", "2.0::DOUBLE"), ("intercept", "b0"), ("deviance_residual_min", "lo"),
            ("deviance_residual_max", "hi"), ("explained_variance", "ssr / f.n"), ("rsquared", "ssr / syy"),
            ("rmse", "sqrt(u.mse)"), ("mae", "mae"), ("mse", "u.mse")))),
    "linear_residuals": (_linear_residuals, f"""WITH {_closed_form()},
        t AS (SELECT p_retailprice - b0 - b1 * p_partkey - b2 * p_size AS e FROM part, f)
        SELECT CAST(count(*) AS BIGINT) AS rows, round(sum(e), 4) + 0.0 AS total, round(sum(e * e), 4) AS squares
        FROM t"""),
    "cv_grid": (_grid_moments, _grid("", 7, ", CAST(rank() OVER (ORDER BY round(score, 10)) AS INTEGER) AS rank")),
    "best_model_coefficients": (_best_coefficients, f"""WITH {_grid_best('true')}
        SELECT '(intercept)' AS term, {r('my - b * mx', 6, 'estimate')} FROM best
        UNION ALL SELECT 'p_partkey', {r('b', 6, 'estimate')} FROM best"""),
    "cv_grid_best": (_grid_moments_best, _GRID_BEST),
    "cv_grid_refit": (_grid_refit, " UNION ALL ".join(
        f"SELECT * FROM ({_grid(f'{i}::DOUBLE AS max_iter,', 3, '')})" for i in (10, 15))),
    "cv_grid_docs": (_grid_docs, f"""WITH {_grid_best('true')}
        SELECT n AS parameter, true AS described, CASE WHEN n = 'regParam' THEN reg END AS value
        FROM w, (VALUES ('maxIter'), ('regParam'), ('elasticNetParam')) AS p(n)"""),
}
