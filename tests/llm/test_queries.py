"""The registered text queries: against their SQL where they have one, else one row per document."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import __spark_entry__ as entry_points  # noqa: E402
from check import connect, difference  # noqa: E402
from statloom.llm.catalogue import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    run, sql = QUERIES[name]
    df = run(spark, FOLDER)
    found = [tuple(r) for r in df.collect()]
    db = connect(FOLDER)
    if sql is None and "doc_id" not in df.columns:  # op12_whiten: test_whitening.py compares all its rows
        assert found
        return
    if sql is None:
        ids = [r[df.columns.index("doc_id")] for r in found]
        assert sorted(ids) == [r[0] for r in db.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]
        return
    answer = db.execute(sql)
    names = [d[0] for d in answer.description]
    assert difference(found, df.columns, answer.fetchall(), names) == ""
