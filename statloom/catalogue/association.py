"""Queries on covariance, correlation, critical values and principal components."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from statloom.catalogue.common import (LINE_PREDICTORS, NET, Query, lines, r, rounded, t_quantile_sql, table)
from statloom.functions.critical import critical_values, table_dof
from statloom.operators.association import correlation_report, pair_covariance, pair_correlation, pair_statistic
from statloom.operators.moments import pair_moments
from statloom.operators.pca import Components

REPORT_DIGITS = {"Corr": 9, "CoefDet": 9, "tValue": 6, "abs_tValue": 6}
# A column with gaps, so that pairs have different row counts.
GAPS = "CASE WHEN l_linenumber > 2 THEN l_quantity END"


def _covariance(spark, folder):
    return rounded(pair_covariance(table(spark, folder, "lineitem", *LINE_PREDICTORS)), {"cov": 6})


def _correlation(spark, folder):
    return rounded(pair_correlation(table(spark, folder, "lineitem", *LINE_PREDICTORS)), {"corr": 9})


def _with_gaps(spark, folder):
    return table(spark, folder, "lineitem", "l_extendedprice", "l_tax", "l_quantity", "l_linenumber").select(
        "l_extendedprice", F.expr(GAPS).alias("quantity"),
        F.expr("CASE WHEN l_tax > 0.02 THEN l_tax END").alias("tax"))


def _correlation_gaps(spark, folder):
    return rounded(pair_statistic(_with_gaps(spark, folder), "corr"), {"corr": 9})


def _correlation_gaps_wide(spark, folder):
    wide = _with_gaps(spark, folder).withColumns({"double_tax": F.expr("tax * tax"),
                                                  "price_root": F.expr("sqrt(l_extendedprice)")})
    return rounded(pair_correlation(wide), {"corr": 9})


def _constant_column(spark, folder):
    df = table(spark, folder, "supplier", "s_suppkey", "s_acctbal")
    return correlation_report(df.withColumns({"one": F.lit(1.0), "twice": F.expr("2 * s_suppkey + 1")})
                              ).select("Columns", "n", F.round("Corr", 9).alias("Corr"), "Significance")


FAR = ["l_quantity", "l_linenumber", "l_partkey", "l_suppkey", "price", "day", "order", "both"]


def _far_groups(spark, folder):
    """Eight columns whose values lie a thousand million apart from group to group, in order of the groups."""
    df = table(spark, folder, "lineitem", "l_quantity", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
               "l_orderkey", "l_returnflag")
    df = df.withColumns({"price": F.expr("floor(l_extendedprice / 100)"), "day": F.expr("dayofyear(l_shipdate)"),
                         "order": F.expr("l_orderkey % 1000"), "both": F.expr("l_quantity * l_linenumber")})
    far = F.expr("1000000000L * (ascii(l_returnflag) - 65)")
    far = df.select("l_returnflag", *[(F.col(c) + far).cast("double").alias(c) for c in FAR]).sortWithinPartitions("l_returnflag")
    n = F.col("n")
    return rounded(pair_moments(far, FAR, "l_returnflag").select("part", "col_x", "col_y", "n", "mean_x", "mean_y", *[
        (F.col(s) / n).alias(v) for s, v in (("sxx", "var_x"), ("syy", "var_y"), ("sxy", "cov"))]),
        {"mean_x": 4, "mean_y": 4, "var_x": 3, "var_y": 3, "cov": 3})


def _report_large(spark, folder):
    return rounded(correlation_report(lines(spark, folder).select("net", *LINE_PREDICTORS)), REPORT_DIGITS)


def _report_small(spark, folder):
    df = table(spark, folder, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    return rounded(correlation_report(df, 0.05), REPORT_DIGITS)


def _report_exact(spark, folder):
    df = table(spark, folder, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    return rounded(correlation_report(df, 0.07, mode="exact"), {**REPORT_DIGITS, "critical": 8})


def _one_sided(spark, folder):
    df = table(spark, folder, "part", "p_partkey", "p_size", "p_retailprice").withColumn(
        "discounted", F.expr("p_size - p_retailprice"))
    both = [correlation_report(df, 0.05, test).withColumn("test", F.lit(test))
            for test in ("upper one-sided", "lower one-sided")]
    return rounded(both[0].unionByName(both[1]), {**REPORT_DIGITS, "Corr": 8, "CoefDet": 8})


def _t_critical(spark, folder):
    """The critical values that apply to each customer's orders: n - 2 degrees of freedom, six probabilities. Customers
    with too few orders for any have nulls."""
    per = (table(spark, folder, "orders", "o_custkey").groupBy("o_custkey")
           .agg(F.count(F.lit(1)).alias("n")).withColumn("dof", F.col("n") - 2))
    values = critical_values(spark).withColumnRenamed("dof", "key")
    return (per.join(F.broadcast(values), table_dof(F.col("dof")) == F.col("key"), "left")
            .select("o_custkey", "n", "dof", "prob", "critical"))


def _embedding_columns(spark, folder, k=64):
    df = table(spark, folder, "embeddings", "embedding")
    return df.select(*[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(k)])


def _wide_covariance(spark, folder):
    return rounded(pair_covariance(_embedding_columns(spark, folder)), {"cov": 9})


def _moments_by_group(spark, folder, columns, form):
    """Moments per source with gaps: one group has no complete pair at all, and both ways of counting meet them."""
    df = table(spark, folder, "documents", "doc_id", "n_chars", "source").select(
        "source", F.when(F.col("source") != "src3", F.col("doc_id").cast("double")).alias("a"),
        F.when(F.col("doc_id") % 3 != 0, F.col("n_chars").cast("double")).alias("b"),
        *[F.col("n_chars").cast("double").alias(f"x{i}") for i in range(columns)])
    found = pair_moments(df, ["a", "b", *[f"x{i}" for i in range(columns)]], "source")
    return (found.where("col_x IN ('a', 'b') AND col_y IN ('a', 'b')")
            .select(F.lit(form).alias("form"), F.col("part").alias("source"), "col_x", "col_y", "n",
                    *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("mean_x", "mean_y", "sxx", "syy", "sxy")]))


def _grouped(spark, folder):
    return _moments_by_group(spark, folder, 0, "narrow").unionByName(_moments_by_group(spark, folder, 8, "wide"))


def _pca_two(spark, folder):
    found = Components.fit(table(spark, folder, "part", "p_partkey", "p_retailprice"), ["p_partkey", "p_retailprice"])
    joined = found.explained_variance(spark).join(found.loading_table(spark), "component")
    return rounded(joined, {"explained": 8, "cumulative": 8, "loading": 8})


def _pca_projection(spark, folder):
    df = table(spark, folder, "part", "p_partkey", "p_retailprice")
    found = Components.fit(df, ["p_partkey", "p_retailprice"])
    return rounded(found.project(df).select("p_partkey", "pc1", "pc2"), {"pc1": 6, "pc2": 6})


def _pca_embeddings(spark, folder):
    df = _embedding_columns(spark, folder)
    return rounded(Components.fit(df, df.columns).explained_variance(spark), {"explained": 9, "cumulative": 9})


def _pca_norms(spark, folder):
    """All 64 scores of every vector: their squares add up to those of the z-scores."""
    df = table(spark, folder, "embeddings", "vec_id", "embedding")
    df = df.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)])
    scored = Components.fit(df, df.columns[1:]).project(df)
    return scored.select("vec_id", F.round(sum((F.pow(F.col(f"pc{i + 1}"), 2) for i in range(64)), F.lit(0.0)), 6).alias("norm"))


def _pca_variances(spark, folder):
    """The variance of each score is its share of the total variance of 64 z-scores; scores do not correlate."""
    df = _embedding_columns(spark, folder)
    found = Components.fit(df, df.columns)
    names = [f"pc{i + 1}" for i in range(64)]
    scored = found.project(df).select(*names)
    variances = scored.select(F.posexplode(F.array(*names)).alias("at", "v")).groupBy("at").agg(F.var_samp("v").alias("v"))
    return (found.explained_variance(spark).join(variances, F.col("component") == F.col("at") + 1)
            .select("component", (F.abs(F.col("v") / (64 * F.col("explained")) - 1) < 1e-8).alias("agrees")))


# -- SQL -------------------------------------------------------------------------------------------------------

def _pairs(columns: list[str], source: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_x, '{b}' AS col_y, CAST(regr_count({b}, {a}) AS BIGINT) AS n, {value.format(a=a, b=b)} "
        f"FROM {source}" for a, b in combinations(columns, 2))


def _report(columns: list[str], source: str, critical: str, rejected: str = "abs(t) > critical",
            digits: int = 12, corr_digits: int = 9) -> str:
    pairs = " UNION ALL ".join(
        f"SELECT '{a} vs {b}' AS Columns, CAST(regr_count({b}, {a}) AS BIGINT) AS n, corr({b}, {a}) AS r FROM {source}"
        for a, b in combinations(columns, 2))
    return f"""
    SELECT Columns, n, {r('r', corr_digits, 'Corr')}, {r('r * r', corr_digits, 'CoefDet')}, {r('t', 6, 'tValue')},
           {r('abs(t)', 6, 'abs_tValue')}, round(critical::DOUBLE, {digits}) AS critical,
           CASE WHEN {rejected} THEN 'Reject Null Hyp' ELSE 'Fail to Reject' END AS Significance
    FROM (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t, {critical} AS critical FROM ({pairs}))"""


_LINES = f"(SELECT *, {NET} AS net FROM lineitem)"
_GAPPED = f"""(SELECT l_extendedprice, {GAPS} AS quantity, CASE WHEN l_tax > 0.02 THEN l_tax END AS tax FROM lineitem)"""
_GAPPED_WIDE = f"(SELECT *, tax * tax AS double_tax, sqrt(l_extendedprice) AS price_root FROM {_GAPPED})"
_PART = "(SELECT *, p_size - p_retailprice AS discounted FROM part)"
_ONE_SIDED = ["p_partkey", "p_size", "p_retailprice", "discounted"]
_CORR = r("corr({b}, {a})", 9, "corr")
# Two-sided 0.05: table row "infinity" for line items and parts; 98 degrees of freedom for 100 suppliers.
_SUPPLIER_CRITICAL = "CASE WHEN n - 2 = 98 THEN 1.984 WHEN n - 2 > 100 THEN 1.96 WHEN n - 2 = 8 THEN 2.306 END"

_T_CRITICAL = f"""
WITH RECURSIVE {t_quantile_sql([0.9, 0.95, 0.975, 0.99, 0.995, 0.999])},
published AS (
  SELECT v, prob, CASE WHEN prob = 0.999 AND v = 1 THEN 318.313 WHEN prob = 0.999 AND v = 7 THEN 4.782
    WHEN prob = 0.999 AND v = 8 THEN 4.499 WHEN prob = 0.999 AND v = 9 THEN 4.296
    WHEN prob = 0.999 AND v = 10 THEN 4.143 WHEN prob = 0.999 AND v = 11 THEN 4.024
    WHEN prob = 0.999 AND v = 12 THEN 3.929 ELSE round(t, 3) END::DOUBLE AS critical FROM t_exact
  UNION ALL SELECT 0, * FROM (VALUES (0.9::DOUBLE, 1.282::DOUBLE), (0.95, 1.645), (0.975, 1.960), (0.99, 2.326),
                                     (0.995, 2.576), (0.999, 3.090)))
SELECT o_custkey, n, n - 2 AS dof, prob, critical
FROM (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey)
LEFT JOIN published ON v = CASE WHEN n - 2 > 100 THEN 0 WHEN n - 2 >= 1 THEN n - 2 END"""

_REPORT_EXACT = f"WITH RECURSIVE {t_quantile_sql([0.965])} " + _report(
    ["s_suppkey", "s_nationkey", "s_acctbal"], "supplier", "(SELECT t FROM t_exact WHERE v = n - 2)", digits=8)

_WIDE = f"""
WITH long AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v,
                     generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT 'e' || a.i AS col_x, 'e' || b.i AS col_y, CAST(count(*) AS BIGINT) AS n, {r('covar_samp(a.v, b.v)', 9, 'cov')}
FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i"""

_SHARES = "(1 + abs(r)) / 2 AS e1, (1 - abs(r)) / 2 AS e2"
_PCA_TWO = f"""
WITH m AS (SELECT {_SHARES}, r FROM (SELECT corr(p_partkey, p_retailprice) AS r FROM part))
SELECT CAST(k AS INTEGER) AS component, {r("CASE k WHEN 1 THEN e1 ELSE e2 END", 8, "explained")},
       {r("CASE k WHEN 1 THEN e1 ELSE 1 END", 8, "cumulative")}, f AS feature,
       {r("CASE WHEN f = 'p_partkey' THEN 1 WHEN (k = 1) = (r > 0) THEN 1 ELSE -1 END / sqrt(2)", 8, "loading")}
FROM m, (VALUES (1), (2)) AS a(k), (VALUES ('p_partkey'), ('p_retailprice')) AS b(f)"""
_PCA_PROJECTION = f"""
WITH m AS (SELECT avg(p_partkey) AS ma, stddev_samp(p_partkey) AS sa, avg(p_retailprice) AS mb,
                  stddev_samp(p_retailprice) AS sb, sign(corr(p_partkey, p_retailprice)) AS d FROM part),
z AS (SELECT p_partkey, (p_partkey - ma) / sa AS a, (p_retailprice - mb) / sb AS b, d FROM part, m)
SELECT p_partkey, {r('(a + d * b) / sqrt(2)', 6, 'pc1')}, {r('(a - d * b) / sqrt(2)', 6, 'pc2')} FROM z"""

# Whole numbers near zero, summed without rounding: the distance between groups is added to the means only.
_FAR_SQL = """
WITH d AS (SELECT l_returnflag, l_quantity::HUGEINT AS l_quantity, l_linenumber::HUGEINT AS l_linenumber, l_partkey::HUGEINT AS l_partkey,
                  l_suppkey::HUGEINT AS l_suppkey, floor(l_extendedprice / 100)::HUGEINT AS price, dayofyear(l_shipdate)::HUGEINT AS day,
                  (l_orderkey % 1000)::HUGEINT AS "order", (l_quantity * l_linenumber)::HUGEINT AS "both" FROM lineitem),
sums AS (""" + " UNION ALL ".join(
    f"""SELECT l_returnflag AS part, '{a}' AS col_x, '{b}' AS col_y, count(*) AS n, sum("{a}") AS sx, sum("{b}") AS sy,
               sum("{a}" * "{a}") AS xx, sum("{b}" * "{b}") AS yy, sum("{a}" * "{b}") AS xy FROM d GROUP BY l_returnflag"""
    for i, a in enumerate(FAR) for b in FAR[i:]) + """)
SELECT part, col_x, col_y, n, """ + ", ".join(r(e, d, v) for e, d, v in (
    ("sx / n + 1000000000.0 * (ascii(part) - 65)", 4, "mean_x"), ("sy / n + 1000000000.0 * (ascii(part) - 65)", 4, "mean_y"),
    ("(n * xx - sx * sx)::DOUBLE / n / n", 3, "var_x"), ("(n * yy - sy * sy)::DOUBLE / n / n", 3, "var_y"),
    ("(n * xy - sx * sy)::DOUBLE / n / n", 3, "cov"))) + " FROM sums"

QUERIES: dict[str, Query] = {
    "moments_far_groups": (_far_groups, _FAR_SQL),
    "pair_covariance": (_covariance, _pairs(LINE_PREDICTORS, "lineitem", r("covar_samp({b}, {a})", 6, "cov"))),
    "pair_correlation": (_correlation, _pairs(LINE_PREDICTORS, "lineitem", _CORR)),
    "pair_correlation_gaps": (_correlation_gaps, _pairs(["l_extendedprice", "quantity", "tax"], _GAPPED, _CORR)),
    "pair_correlation_gaps_wide": (_correlation_gaps_wide, _pairs(
        ["l_extendedprice", "quantity", "tax", "double_tax", "price_root"], _GAPPED_WIDE, _CORR)),
    "wide_covariance": (_wide_covariance, _WIDE),
    "correlation_undefined": (_constant_column, f"""
        SELECT 's_suppkey vs s_acctbal' AS Columns, CAST(count(*) AS BIGINT) AS n,
               round(corr(s_suppkey, s_acctbal), 9) AS Corr,
               CASE WHEN abs(corr(s_suppkey, s_acctbal)) > 0.5 THEN 'Reject Null Hyp' ELSE 'Fail to Reject' END
                 AS Significance FROM supplier
        UNION ALL SELECT 's_acctbal vs twice', count(*), round(corr(s_suppkey, s_acctbal), 9), CASE WHEN
               abs(corr(s_suppkey, s_acctbal)) > 0.5 THEN 'Reject Null Hyp' ELSE 'Fail to Reject' END FROM supplier
        UNION ALL SELECT c, n, v, 'Undefined' FROM (SELECT count(*) AS n FROM supplier),
               (VALUES ('s_suppkey vs one', NULL), ('s_acctbal vs one', NULL), ('one vs twice', NULL),
                       ('s_suppkey vs twice', 1.0)) AS t(c, v)"""),
    "correlation_report_large": (_report_large, _report(["net", *LINE_PREDICTORS], _LINES, "1.96")),
    "correlation_report_small": (_report_small, _report(
        ["s_suppkey", "s_nationkey", "s_acctbal"], "supplier", _SUPPLIER_CRITICAL)),
    "correlation_report_exact": (_report_exact, _REPORT_EXACT),
    "correlation_one_sided": (_one_sided, " UNION ALL ".join(
        f"SELECT *, '{test}' AS test FROM ({_report(_ONE_SIDED, _PART, '1.645', rejected, corr_digits=8)})"
        for test, rejected in (("upper one-sided", "t > critical"), ("lower one-sided", "t < -critical")))),
    "moments_by_group": (_grouped, """
WITH d AS (SELECT source, CASE WHEN source <> 'src3' THEN doc_id::DOUBLE END AS a,
                  CASE WHEN doc_id % 3 <> 0 THEN n_chars::DOUBLE END AS b FROM documents),
pairs AS (SELECT source, 'a' AS col_x, 'a' AS col_y, a AS x, a AS y FROM d
          UNION ALL SELECT source, 'a', 'b', CASE WHEN b IS NOT NULL THEN a END, CASE WHEN a IS NOT NULL THEN b END FROM d
          UNION ALL SELECT source, 'b', 'b', b, b FROM d)
SELECT form, source, col_x, col_y, count(x) AS n, """ + ", ".join(r(e, 4, n) for e, n in (
        ("avg(x)", "mean_x"), ("avg(y)", "mean_y"), ("var_pop(x) * count(x)", "sxx"), ("var_pop(y) * count(y)", "syy"),
        ("covar_pop(x, y) * count(x)", "sxy"))) + """
FROM pairs, (VALUES ('narrow'), ('wide')) AS f(form) GROUP BY form, source, col_x, col_y"""),
    "t_critical": (_t_critical, _T_CRITICAL),
    "pca_two": (_pca_two, _PCA_TWO),
    "pca_projection": (_pca_projection, _PCA_PROJECTION),
    "pca_projection_embeddings": (_pca_norms, f"""
WITH long AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT i, avg(v) AS a, stddev_samp(v) AS s FROM long GROUP BY i)
SELECT vec_id, {r('sum(pow((v - a) / s, 2))', 6, 'norm')} FROM long JOIN m USING (i) GROUP BY vec_id"""),
    "pca_variance_embeddings": (_pca_variances, """SELECT DISTINCT CAST(i AS INTEGER) AS component, true AS agrees
        FROM (SELECT generate_subscripts(embedding, 1) AS i FROM embeddings)"""),
    "pca_embeddings": (_pca_embeddings, None),
}
