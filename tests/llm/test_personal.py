"""Personal data: base spans against the patterns as given, what the trees add, odd rows."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statloom.llm import personal
from statloom.llm.personal import KINDS, base_spans, candidates, find_personal, op11_personal, redact

# The patterns as the contract gives them.
GIVEN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(p) <= 255 for p in found.split("."))
    if kind == 2:
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def plain(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(GIVEN) for m in re.finditer(p, text) if valid(k, m.group()))


def written(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.", "@", ".", "1", "25", "300", "0012", " ", "-", "+", "(", ")", "x@y.z", "\n", "é", "é@ü.de",
                                 "4111111111111111", "+1 (555) 555-0100", "1.2.3.4", "@@", "..", "_%"]), max_size=14).map("".join))
def test_base_spans_are_those_of_the_given_patterns(text):
    assert base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "1 " * 100_000, "+1" + " " * 200_000, "a@" * 100_000,
                 "x@" + "y" * 200_000, "at " * 60_000 + "@", "(" * 100_000 + "12", "1.2.3.4 " * 20_000):
        candidates(text, base_spans(text))
    assert time.time() - start < 40


def test_query_against_the_given_patterns(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    rows = op11_personal(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(written(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert set(written(spans).split(",")) - {""} <= set(r["spans"].split(","))


@pytest.fixture(scope="module")
def planted(spark):
    """Phones in running text, numbers that are none, and phones that the base pattern overruns or that lack the plus."""
    n = F.col("id")
    phone = F.format_string("+1 (%03d) 555-%04d", n % 900 + 100, n * 37 % 10000)
    number = F.concat(F.lit("order "), (n * 7919 + 10_000_000).cast("string"), F.when(n % 4 < 2, F.concat(F.lit(" of "), (n * 31 % 997).cast("string"))).otherwise(" today"))
    after = F.when(n % 2 == 0, " today").otherwise(F.concat(F.lit(", "), (n * 7907 + 4_000_000_000_000_000).cast("string"), F.lit(" is paid")))
    text = (F.when(n % 3 == 0, F.concat(F.lit("please call "), phone, after))
            .when(n % 30 == 1, F.concat(F.lit("please call "), phone, F.lit(" 4111111111111111 today")))
            .otherwise(number))
    return spark.range(3000).select(n.alias("doc_id"), text.alias("text"))


def test_trees_add_what_the_patterns_overrun(planted):
    rows = find_personal(planted).collect()
    over = [r for r in rows if r["doc_id"] % 30 == 1]
    caught = sum(any(a["kind"] == 3 and (a["start"], a["end"]) == (12, 29) for a in r["added"]) for r in over)
    assert len(over) == 100 and caught >= 95
    clean = [r for r in rows if r["doc_id"] % 3 and r["doc_id"] % 30 != 1]
    assert sum(bool(r["added"]) for r in clean) <= len(clean) // 100
    assert all(any(b["kind"] == 3 for b in r["base"]) for r in rows if r["doc_id"] % 3 == 0)


def test_added_spans_touch_nothing(planted):
    for r in find_personal(planted).collect():
        spans = sorted((s["start"], s["end"]) for s in r["base"] + r["added"])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_held_out_accuracy(planted):
    rows = personal.sampled(personal.propose(planted))
    held = F.pmod(F.xxhash64("row", F.lit("held")), F.lit(personal.HELD)) == 0
    model = personal.fit_trees(rows.where(~held))
    scored = model.transform(rows.where(held)).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")), F.count("*")).first()
    assert scored[1] > 400 and scored[0] > 0.98


def test_every_labelled_candidate_counts(spark):
    """More candidates of one kind and label than a sample ever held, each of them in the fit."""
    n = F.col("id")
    docs = spark.range(0, 30_000, 1, 8).select(n.alias("doc_id"), F.concat(F.lit("order "), (n * 7919 + 10_000_000).cast("string"), F.lit(" today")).alias("text"))
    assert personal.sampled(personal.propose(docs)).where("kind = 3 AND label = 0").count() == 30_000


def test_sample_is_bounded(planted):
    rows = personal.sampled(personal.propose(planted), 50).groupBy("kind", "label").count().collect()
    assert rows and all(r["count"] < 110 for r in rows)


def test_odd_rows(spark, odd, none):
    rows = find_personal(odd).collect()
    assert len(rows) == odd.count() and all(r["base"] == [] and r["added"] == [] for r in rows)
    assert find_personal(none).collect() == []
    one = spark.createDataFrame([(None, "a@b.de"), (1, None), (1, "")], "doc_id long, text string").selectExpr("*", "1 AS base", "2 AS row", "3 AS candidates", "4 AS id")
    assert sum(len(r["base"]) for r in find_personal(one).collect()) == 1
    clean = {r["doc_id"]: r["text"] for r in redact(one.where("text IS NULL OR text != ''")).collect()}
    assert clean == {None: "[personal]", 1: None}
