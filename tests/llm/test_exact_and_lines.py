import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from .conftest import ROWS
from statloom.llm.exact import exact_dedup, exact_groups, misra_gries
from statloom.llm.lines import line_dedup
from statloom.llm.neardup import near_dedup


def test_misra_gries_keeps_every_frequent_key():
    stream = [b"a", b"b", b"a", b"c", b"a", b"d", b"a", b"e", b"b", b"a"] * 20
    counts = {}
    for key in stream:
        counts = misra_gries(counts, [(key, 1)], 2)
        assert len(counts) <= 2
    assert b"a" in counts and counts[b"a"] >= Counter(stream)[b"a"] - len(stream) / 3


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_exact_groups(odd, keep, counters):
    groups = defaultdict(list)
    for id, text, _ in ROWS:
        groups[hashlib.sha256((text or "").encode()).digest()].append(id)
    found = exact_groups(odd, keep=keep, counters=counters).collect()
    assert Counter((r["doc_id"], bytes(r["digest"])) for r in found) == Counter(
        (id, d) for d, ids in groups.items() for id in ids)
    for r in found:
        ids = groups[bytes(r["digest"])]
        known = [x for x in ids if x is not None]
        assert r["keep_id"] == ((max if keep == "max" else min)(known) if known else None)
        assert r["group_size"] == len(ids)
    assert sum(r["kept"] for r in found) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_exact_dedup(odd, none):
    kept = exact_dedup(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({t or "" for _, t, _ in ROWS})
    assert exact_dedup(none).count() == exact_groups(none).count() == 0
    with pytest.raises(ValueError):
        exact_groups(odd, keep="first")


def test_dedup_picks_the_marked_row(spark):
    """Null is the empty text, also among rows of one id; of rows that differ elsewhere the same one stays each time."""
    docs = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (2, "long text", "c"), (2, "long text", "d")],
                                 "doc_id long, text string, note string")
    for dedup in (exact_dedup, near_dedup):
        found = [sorted((r["doc_id"], r["note"]) for r in dedup(docs.repartition(n)).collect()) for n in (1, 2, 4)]
        assert found[0] == found[1] == found[2] and [i for i, _ in found[0]] == [1, 2]


def test_line_dedup(odd, none):
    holders = defaultdict(set)
    spaces = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(spaces))
    for id, text, _ in ROWS:
        for line in (text or "").split("\n"):
            holders[key(line)].add(id)
    first = {k: min((x for x in ids if x is not None), default=None) for k, ids in holders.items()}
    gone = lambda id, line: len(key(line)) >= 10 and len(holders[key(line)]) > 1 and id != first[key(line)]
    want = Counter()
    for id, text, _ in ROWS:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not gone(id, x)]
        want[(id, "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    found = line_dedup(odd)
    assert Counter(tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()) == want
    assert set(odd.columns) <= set(found.columns)
    assert line_dedup(none).count() == 0


def test_line_threshold(spark):
    docs = spark.createDataFrame([(i, f"common line {i % 2 if i < 4 else 7}\nown line number {i}") for i in range(6)],
                                 "doc_id long, text string")
    dropped = {r["doc_id"]: r["n_dropped"] for r in line_dedup(docs, least_docs=3).collect()}
    assert sum(dropped.values()) == 0
    dropped = {r["doc_id"]: r["n_dropped"] for r in line_dedup(docs).collect()}
    assert dropped == {0: 0, 1: 0, 2: 1, 3: 1, 4: 0, 5: 1}


def test_line_cost_is_linear(spark):
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.expr("repeat('the same line\n', 100000)").alias("text"))
    assert {r["doc_id"]: r["n_dropped"] for r in line_dedup(docs).collect()} == {0: 0, 1: 100000}
