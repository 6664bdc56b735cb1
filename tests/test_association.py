import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.operators import moments
from statloom.operators.association import correlation_report, pair_correlation, pair_covariance, pair_statistic
from statloom.operators.moments import collect_moments, complete_rows, pair_moments


def as_dict(df, value):
    return {(r["col_x"], r["col_y"]): r[value] for r in df.collect()}


def test_worked_example(worked):
    cov = as_dict(pair_covariance(worked), "cov")
    assert cov[("x1", "x2")] == pytest.approx(13.066875, rel=1e-9)
    assert cov[("x1", "yield")] == pytest.approx(326.87625, rel=1e-9)
    assert cov[("x2", "yield")] == pytest.approx(32.784375, rel=1e-9)
    corr = as_dict(pair_correlation(worked), "corr")
    assert corr[("x1", "x2")] == pytest.approx(0.95447531, abs=1e-8)
    report = correlation_report(worked, 0.05).collect()
    assert [r["Columns"] for r in report] == ["x1 vs yield", "x2 vs yield", "x1 vs x2"]
    assert [r["tValue"] for r in report] == pytest.approx([16.284, 16.134, 12.393], abs=1e-3)
    assert {r["critical"] for r in report} == {2.131}
    assert {r["Significance"] for r in report} == {"Reject Null Hyp"}


def test_bad_arguments(worked):
    for call in (lambda: pair_statistic(worked, "mean"), lambda: correlation_report(worked, 0.05, "sideways"),
                 lambda: correlation_report(worked, 0.07), lambda: correlation_report(worked, 0.05, mode="guess"),
                 lambda: pair_covariance(worked.select("x1")), lambda: pair_moments(worked, ["x1", "x1"])):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("rows, critical", [(102, 1.984), (103, 1.96), (3, 12.706)])
def test_degrees_of_freedom_bounds(spark, rows, critical):
    df = spark.range(rows).select(F.col("id").cast("double").alias("a"), F.expr("(id * 7) % 11").alias("b"))
    assert correlation_report(df).head()["critical"] == critical


def test_too_few_rows_and_empty_input(spark):
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0)], "a double, b double")
    assert correlation_report(two).head()["Significance"] == "Undefined"
    empty = two.filter("a > 9")
    row = correlation_report(empty).head()
    assert (row["n"], row["Corr"], row["Significance"]) == (0, None, "Undefined")


def test_constant_and_perfect_columns(spark):
    df = spark.range(50).selectExpr("cast(id as double) a", "1.0D one", "3 * id + 7 as b", "-id as down")
    labels = {r["Columns"]: (r["Corr"], r["Significance"]) for r in correlation_report(df).collect()}
    assert labels["a vs one"] == (None, "Undefined")
    assert labels["a vs b"][1] == "Undefined" and labels["a vs b"][0] == pytest.approx(1.0)
    assert labels["a vs down"][0] == pytest.approx(-1.0)


def test_dotted_names(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 3.0, 1.0), (4.0, 4.5, 1.0)], "`a.b` double, `c``d` double, e double")
    assert correlation_report(df).count() == 3


def test_one_sided(spark):
    df = spark.range(40).selectExpr("cast(id as double) a", "-id + (id % 5) as b")
    verdict = {t: correlation_report(df, 0.05, t).head()["Significance"]
               for t in ("upper one-sided", "lower one-sided", "two-sided")}
    assert verdict == {"upper one-sided": "Fail to Reject", "lower one-sided": "Reject Null Hyp",
                       "two-sided": "Reject Null Hyp"}


def brute(values):
    found = {}
    p = values.shape[1]
    for i in range(p):
        for j in range(i, p):
            both = ~np.isnan(values[:, i]) & ~np.isnan(values[:, j])
            x, y = values[both, i], values[both, j]
            dx, dy = x - x.mean(), y - y.mean()
            found[i, j] = (both.sum(), x.mean(), y.mean(), dx @ dx, dy @ dy, dx @ dy)
    return found


@pytest.mark.parametrize("p", [2, 4, 7])
@pytest.mark.parametrize("gaps", [False, True])
@pytest.mark.parametrize("native", [False, True])
def test_both_moment_paths_against_brute_force(spark, monkeypatch, p, gaps, native):
    monkeypatch.setattr(moments, "_fits_generated_code", lambda *_: native)
    rng = np.random.default_rng(5)
    values = rng.normal(size=(300, p)) * rng.uniform(0.01, 1e3, p) + rng.uniform(-1e6, 1e6, p)
    if gaps:
        values[rng.random(values.shape) < 0.2] = np.nan
    names = [f"c{i}" for i in range(p)]
    rows = [tuple(None if np.isnan(v) else float(v) for v in row) for row in values]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    truth = brute(values)
    found = pair_moments(df, names, pairwise=gaps).collect()
    assert len(found) == p * (p + 1) // 2
    for row in found:
        expected = truth[names.index(row["col_x"]), names.index(row["col_y"])]
        assert row["n"] == expected[0]
        assert [row[k] for k in ("mean_x", "mean_y", "sxx", "syy")] == pytest.approx(expected[1:5], rel=1e-9)
        assert row["sxy"] == pytest.approx(expected[5], abs=1e-9 * np.sqrt(expected[3] * expected[4]))


def test_grouped_moments_flush_and_merge(spark, monkeypatch):
    monkeypatch.setattr(moments, "GROUPS_IN_MEMORY", 2)
    monkeypatch.setattr(moments, "_fits_generated_code", lambda *_: False)
    df = spark.range(5000).selectExpr("id % 9 as g", *[f"(id * {k}) % 97 + {k} * 1e4 as c{k}" for k in range(1, 7)])
    names = [f"c{k}" for k in range(1, 7)]
    found = collect_moments(df.repartition(4), names, by="g")
    assert sum(m.n for m in found.values()) == 5000
    whole = collect_moments(df, names)[None]
    total = None
    for part in found.values():
        total = part if total is None else total + part
    assert total.n == whole.n
    assert np.allclose(total.mean, whole.mean, rtol=1e-12)
    assert np.allclose(total.scatter, whole.scatter, rtol=1e-9, atol=1e-6)


def test_repartitioning_changes_nothing(spark, folder):
    df = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    once, again = as_dict(pair_correlation(df), "corr"), as_dict(pair_correlation(df.repartition(7)), "corr")
    for pair in once:
        assert once[pair] == pytest.approx(again[pair], abs=1e-12)


def test_null_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (2.0, 5.0)], "a double, b double")
    assert complete_rows(df, ["a", "b"]).count() == 2
    with pytest.raises(Exception, match="null in one of a, b"):
        collect_moments(df, ["a", "b"], on_null="error")
    with pytest.raises(ValueError):
        complete_rows(df, ["a"], "ignore")


def test_workers_need_no_package(tmp_path):
    """The package may be importable on the driver only."""
    script = tmp_path / "elsewhere.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {os.path.join(os.path.dirname(__file__), "..")!r})
from statloom.session import build_session
from statloom.operators.moments import pair_moments
from statloom.operators.subsets import best_subset
spark = build_session("elsewhere", "local[2]", spark__ui__enabled="false")
df = spark.range(500).selectExpr("id", *[f"cast((id * {{k}}) % 31 as double) c{{k}}" for k in (2, 3, 5, 7, 11)])
assert pair_moments(df, ["c2", "c3", "c5", "c7", "c11"]).count() == 15
assert best_subset(df, "c2", ["c3", "c5"], ["id"]).count() == 3
""")
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_empty_input_has_the_same_rows_on_both_paths(spark, monkeypatch):
    df = spark.range(0).selectExpr("cast(id as double) a", "cast(id as double) b")
    for native in (True, False):
        monkeypatch.setattr(moments, "_fits_generated_code", lambda *_, n=native: n)
        assert [(r["n"], r["sxy"]) for r in pair_moments(df, ["a", "b"]).collect()] == [(0, None)] * 3


def test_not_a_number_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, float("nan")), (3.0, 5.0), (None, 4.0)], "a double, b double")
    assert pair_moments(df, ["a", "b"], diagonal=False).head()["n"] == 2
    assert complete_rows(df, ["a", "b"]).count() == 2
    assert moments.column_moments(df, ["a", "b"])["b"][:2] == (3, pytest.approx(11 / 3))


def test_both_forms_of_grouped_moments_agree(spark, monkeypatch):
    """Groups without any complete pair, gaps, large offsets: the same rows whichever form runs."""
    from pyspark.sql import functions as F

    from statloom.operators import moments
    df = spark.range(3000).select(
        (F.col("id") % 7).alias("g"), F.when(F.col("id") % 7 != 3, F.col("id") * 0.5 + 1e7).alias("a"),
        F.when(F.col("id") % 5 != 0, F.sin(F.col("id").cast("double"))).alias("b"), (F.col("id") % 11).cast("double").alias("c"))

    def rows():
        return {(r["part"], r["col_x"], r["col_y"]): tuple(r)[3:]
                for r in moments.pair_moments(df, ["a", "b", "c"], "g").collect()}

    native = rows()
    monkeypatch.setattr(moments, "NATIVE_FIELDS", 0)
    batched = rows()
    assert native.keys() == batched.keys() and len(native) == 7 * 6
    for key, values in native.items():
        assert batched[key][0] == values[0]
        for x, y in zip(values[1:], batched[key][1:]):
            assert (x is None) == (y is None) and (x is None or y == pytest.approx(x, rel=1e-9, abs=1e-6)), key


@pytest.mark.parametrize("columns", [2, 8])
def test_far_groups_in_both_forms(spark, monkeypatch, columns):
    """Groups around 0, 1e9 and -1e9, sorted, with gaps that leave some pairs far from the rest of their columns."""
    import numpy as np
    from pyspark.sql import functions as F

    from statloom.operators import moments
    names = [f"c{i}" for i in range(columns)]
    far = (F.col("id") % 3 - 1) * 1_000_000_000
    df = spark.range(6000).select((F.col("id") % 3).alias("g"), *[
        F.when((F.col("id") * (i + 3)) % 11 != 0, F.col("id") * (i + 1) % 97 + far).cast("double").alias(c) for i, c in enumerate(names)])
    for by in ("g", None):
        frame = (df if by else df.withColumn("c0", F.when(F.col("g") == 1, F.col("c0")))).sortWithinPartitions("g")
        table = frame.toPandas()
        found = {}
        for fields in (0, 10 ** 6):
            monkeypatch.setattr(moments, "NATIVE_FIELDS", fields)
            got = moments.pair_moments(frame, names, by).collect()
            found[fields] = {(r["part"] if by else None, r["col_x"], r["col_y"]): tuple(r)[-6:] for r in got}
        assert found[0].keys() == found[10 ** 6].keys() and len(found[0]) == columns * (columns + 1) // 2 * (3 if by else 1)
        for (part, a, b), values in found[0].items():
            rows = (table if part is None else table[table.g == part])[[a, b]].dropna().to_numpy()
            rows = rows.astype(np.longdouble)
            mean = rows.mean(0)
            (xx, xy), (_, yy) = (rows - mean).T @ (rows - mean)
            for form in (values, found[10 ** 6][part, a, b]):
                assert form[0] == len(rows)
                assert form[1:] == pytest.approx([float(v) for v in (*mean, xx, yy, xy)], rel=1e-9, abs=1e-6 * float(xx * yy) ** 0.5)


def test_wide_moments_start_no_job_while_planned(spark):
    from statloom.operators import moments
    df = spark.range(100).selectExpr("id % 3 AS g", *[f"cast(id * {i} as double) AS c{i}" for i in range(9)])
    spark.sparkContext.setJobGroup("planning", "")
    moments.pair_moments(df, [f"c{i}" for i in range(9)], "g")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_many_groups_are_fast(spark):
    import time

    from pyspark.sql import functions as F

    from statloom.operators.moments import pair_moments
    df = spark.range(40_000).select("id", *[(F.col("id") * (i + 1) % 13).cast("double").alias(f"c{i}") for i in range(8)])
    start = time.time()
    assert pair_moments(df, [f"c{i}" for i in range(8)], "id").count() == 40_000 * 36
    assert time.time() - start < 60


def test_a_perfect_pair_of_many_rows_is_undefined(spark):
    """Added up in one task, 600,000 rows leave 1 - r^2 at 6e-12; what lies above the noise is still tested."""
    df = spark.range(1, 600_001, 1, 1).select(F.col("id").alias("x"), (F.col("id") * 0.1).alias("z"),
                                              (F.col("id") + 5.0 * F.pmod("id", F.lit(2))).alias("near"))
    found = {r["Columns"]: r["Significance"] for r in correlation_report(df).collect()}
    assert found == {"x vs z": "Undefined", "x vs near": "Reject Null Hyp", "z vs near": "Reject Null Hyp"}
