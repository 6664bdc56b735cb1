"""What the physical plans must look like: filters and columns at the scan, combination before the shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from statloom.catalogue.preparation import _wide_prepare
from statloom.operators.association import correlation_report
from statloom.operators.evaluate import evaluate
from statloom.operators.moments import complete_rows, pair_moments
from statloom.operators.ols import LeastSquares
from statloom.operators.prepare import Detail, keep_latest, top, wide_join
from statloom.operators.split import hash_split
from statloom.plans.clustering import slice_of
from statloom.sinks.keyed import upsert


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def items(spark, folder):
    return spark.read.parquet(f"{folder}/lineitem.parquet")


def test_slices_and_null_checks_reach_the_scan(items):
    rows = complete_rows(slice_of(items, {"l_returnflag": "N", "l_linestatus": "O"}), ["l_tax", "l_quantity"])
    text = plan(pair_moments(rows, ["l_tax", "l_quantity"], pairwise=False))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("EqualTo(l_returnflag,N)", "EqualTo(l_linestatus,O)", "IsNotNull(l_tax)", "IsNotNull(l_quantity)"):
        assert part in pushed
    assert "l_extendedprice" not in text


def test_narrow_moments_stay_in_generated_code(items):
    columns = ["l_tax", "l_quantity", "l_discount", "l_extendedprice", "l_linenumber", "l_partkey"]
    df = pair_moments(items, columns, pairwise=False)
    df.collect()
    text = plan(df)
    assert "MapInArrow" not in text
    assert len(re.findall(r"\*\(\d+\) HashAggregate", text)) == 2


def test_wide_moments_read_once_and_shuffle_partial_rows_only(items):
    columns = ["l_tax", "l_quantity", "l_discount", "l_extendedprice", "l_linenumber", "l_partkey"]
    text = plan(pair_moments(items, columns))
    assert text.count("FileScan") == 1 and text.count("MapInArrow") == 1
    assert text.index("Exchange hashpartitioning(i") < text.index("MapInArrow")  # plans print top down
    assert text.count("Exchange") == 1


def test_report_has_no_cross_join(items):
    text = plan(correlation_report(items, columns=["l_tax", "l_quantity", "l_discount", "l_extendedprice"]))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_latest_is_combined_before_the_shuffle(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    text = plan(keep_latest(orders.select("o_custkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderdate"]))
    assert "partial_max" in text and text.index("Exchange") < text.index("partial_max")
    assert "Window" not in text


def test_detail_filters_turn_left_joins_into_inner_ones(spark, folder):
    text = plan(_wide_prepare(spark, folder))
    assert "Inner" in text
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(c_mktsegment,BUILDING\)", text)


def test_a_wide_row_is_planned_without_a_job(spark, folder):
    spark.sparkContext.setJobGroup("wide planning", "")
    df = _wide_prepare(spark, folder)
    planned = len(spark.sparkContext.statusTracker().getJobIdsForGroup("wide planning"))
    found = df.count()
    assert planned - reads_of_schemas(df) <= 0 and found > 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def reads_of_schemas(df):
    """Spark reads the footer of every table it opens by path in a job of its own."""
    return len({f.rsplit("/", 1)[1] for f in df.inputFiles()})


def test_prediction_is_a_projection(items):
    model = LeastSquares.fit(items, "l_extendedprice", ["l_quantity", "l_tax"])
    text = plan(model.predict(items))
    assert "Exchange" not in text and "Python" not in text
    text = plan(model.leverage(items))  # a matrix product per Arrow batch
    assert "Exchange" not in text and text.count("Python") <= 2
    scored = evaluate(model.predict(hash_split(items, ["l_orderkey"])[1]), "l_extendedprice", "pred_l_extendedprice")
    assert plan(scored).count("Exchange") == 1


def test_top_keeps_k_rows_per_task(items):
    assert "TakeOrderedAndProject" in plan(top(items, 10, "l_extendedprice", "l_orderkey"))


def test_a_key_with_a_third_of_all_rows(spark):
    """Nothing is dropped or capped when one key dominates."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    latest = keep_latest(rows, ["k"], ["v"])
    assert latest.count() == 20_001
    assert latest.filter("k = -1").head()["v"] == 29_997
    target = spark.range(-1, 10).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v"))
    merged = upsert(target, rows, ["k"], ["v"])
    assert merged.count() == 20_001 + target.join(rows, "k", "left_anti").count()
    wide = wide_join(rows, [Detail(target.withColumnsRenamed({"k": "dk", "v": "dv"}), "k", "dk")])
    assert wide.count() == 30_000 and wide.filter("dv is not null").count() == 10_006
    parts = pair_moments(rows.withColumn("w", F.col("v") * 2), ["v", "w"], by="k", pairwise=False, diagonal=False)
    assert parts.filter("part = -1").head()["n"] == 10_000
