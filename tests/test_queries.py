import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import __spark_entry__ as entry_points  # noqa: E402
from statloom.catalogue import ALL  # noqa: E402
from check import connect, difference  # noqa: E402

SQL = {name: sql for name, (_, sql) in ALL.items() if sql is not None}
# Model fits without SQL that test_models.py checks on smaller data.
SLOW = {"gbt_metrics", "gbt_settings", "feature_study", "kmeans_elbow", "forest_importance", "forest_metrics",
        "tree_metrics", "kmeans_profile", "gmm_components", "kmeans_elbow_embeddings", "kmeans_centres"}


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
    assert set(ALL) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(ALL) - SLOW))
def test_query(spark, folder, db, name):
    df = entry_points.queries()[name](spark, folder)
    found = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert found
        return
    answer = db.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert difference(found, df.columns, answer.fetchall(), names) == ""
