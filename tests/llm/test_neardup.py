import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from statloom.llm.components import components
from statloom.llm.neardup import near_dedup, near_groups
from statloom.llm.sketch import Shingler, sketches

from .conftest import ROWS


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, percent=80):
    """id -> (set size, component id), by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter()
    for ids in holders.values():
        common.update((a, b) for k, a in enumerate(ids) for b in ids[:k])
    for (a, b), both in common.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(docs, rows, width):
    found = {r["doc_id"]: r for r in near_groups(docs, width=width).collect()}
    want = brute(rows, width)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == want
    assert all(r["kept"] == (i == want[i][1]) for i, r in found.items())


def test_sketch_estimates_jaccard():
    rng = np.random.default_rng(1)
    for s in (0.5, 0.8, 0.95):
        a, b = [], []
        for _ in range(60):
            x = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
            n = int(round(300 * 2 * s / (1 + s)))
            a.append(np.unique(x))
            b.append(np.unique(np.r_[x[:n], rng.integers(0, 2 ** 63, 300 - n).astype(np.uint64)]))
        agree = (sketches(a) == sketches(b)).mean()
        assert abs(agree - s) < 0.02
    one = sketches([np.array([7], np.uint64), np.array([7, 9], np.uint64)])
    assert (one != np.iinfo(np.uint64).max).all()


def test_shingler():
    s = Shingler(2)
    assert len(s("a b c a b")) == 3 and len(s("A")) == 1 and len(s(" \t\n")) == 0
    assert (s("A\x0bB") == s("a b")).all() and not (s("a b") == s("b a")).any()
    assert len(s("a b")) == 1


@pytest.mark.parametrize("width", [2, 5])
def test_documents(spark, texts, width):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), texts, width)


def test_group_of_near_copies_and_a_shared_passage(spark):
    """Many members that differ from the hub by more than a link allows, but link among themselves."""
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = random.choices(vocabulary, k=120)
    rows = []
    for i in range(350):
        words = list(base)
        for _ in range(random.choice([0, 2, 4, 8, 12])):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        rows.append((i, " ".join(words)))
    for i in range(350, 500):
        rows.append((i, " ".join(base[:60] + random.choices(vocabulary, k=random.randint(20, 90)))))
    random.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows, 2)


def test_odd_rows(odd, none):
    found = near_groups(odd).collect()
    assert len(found) == len(ROWS)
    same = [r for r in found if r["component_id"] == 6]
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in same) == [-1, 6, 7, 7]
    assert [r["doc_id"] for r in same if r["kept"]] == [6]
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in found if r["n_shingles"] == 0)
    kept = near_dedup(odd)
    assert kept.columns == odd.columns and kept.count() == len([r for r in found if r["kept"]])
    assert near_groups(none).count() == near_dedup(none).count() == 0
    with pytest.raises(ValueError):
        near_groups(odd, band_rows=7)


def test_components(spark):
    random.seed(2)
    links = [(i, i + 1) for i in range(100)] + [(200, x) for x in range(201, 400)] + [(500, 450), (450, 451), (7, 7)]
    random.shuffle(links)
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, **{i: 200 for i in range(200, 400)}, **{i: 450 for i in (450, 451, 500)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
