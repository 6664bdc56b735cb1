"""Every stage of the pipeline against plain Python on its own input."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from statloom.llm import toxicity as T
from statloom.llm.packing import optimal_boundaries

from .test_neardup import brute
from .test_toxicity import plain_weight

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before the first stage and after each one, written in between."""
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs[-1], FOLDER).write.parquet(path)
        docs.append(spark.read.parquet(path))
    return docs


def rows(df):
    return [(r["doc_id"], r["text"] or "", r["source"]) for r in df.collect()]


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_toxicity(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    lexicon = T.learn_lexicon(T.labelled_sample(steps[0], labels))
    a, b, c = lexicon.curve
    kept = set()
    for id, text, _ in rows(steps[0]):
        folded = T.fold(text)
        weight, _ = plain_weight(folded, lexicon)
        z = a + b * math.log1p(weight) + c * math.log1p(100 * weight / max(1, len(folded.split())))
        if 1 / (1 + math.exp(-z)) < 0.5:
            kept.add(id)
    assert {i for i, _, _ in rows(steps[1])} == kept


def test_lines(steps):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for id, text, _ in rows(steps[1]):
        for line in text.split("\n"):
            holders[key(line)].add(id)
    want = Counter()
    for id, text, source in rows(steps[1]):
        kept = [x for x in text.split("\n") if len(key(x)) < 10 or id == min(holders[key(x)])]
        want[(id, "\n".join(kept), source)] += 1
    assert Counter(rows(steps[2])) == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2].collect())


def test_near(steps):
    docs = [(i, t) for i, t, _ in rows(steps[2])]
    groups = brute(docs, 5)
    assert sorted(i for i, _, _ in rows(steps[3])) == sorted(i for i in groups if groups[i][1] == i)


def test_mix(steps):
    size, by_source = {}, defaultdict(list)
    for id, text, source in rows(steps[3]):
        size[id] = len(WORDS.findall(text))
        by_source[source].append((id, text))
    names = sorted(by_source)
    total = {s: sum(size[i] for i, _ in by_source[s]) for s in names}
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(total.values()) - 3 * sum(total[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * total[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    want = Counter()
    for s in names:
        r = target[s] / total[s]
        certain = int(r)
        goal = target[s] - certain * total[s]
        full, open_docs = set(), by_source[s]  # documents in full get a whole copy more
        while open_docs:
            level = goal / max(1, sum(size[i] * size[i].bit_length() for i, _ in open_docs))
            over = {i for i, _ in open_docs if level * max(1, size[i].bit_length()) > 1}
            top = max(size[i].bit_length() for i, _ in open_docs)
            over = {i for i in over if size[i].bit_length() == top}
            if not over:
                break
            full |= over
            goal -= sum(size[i] for i in over)
            open_docs = [d for d in open_docs if d[0] not in over]
        order = []
        for id, text in by_source[s]:
            want[id] += certain + (id in full)
            p = 0.0 if id in full or goal <= 0 else level * max(1, size[id].bit_length())
            digest = hashlib.md5(f"17:{id}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()
            u = (int(digest[:13], 16) + 0.5) / 2 ** 52
            if p > 0:
                order.append((u / (1 - u) * (1 - p) / p, id))
        done = 0
        for _, id in sorted(order):
            if done + size[id] / 2 <= goal:
                want[id] += 1
            done += size[id]
    assert Counter(i for i, _, _ in rows(steps[4])) == +want


def test_pack(steps):
    tokens = Counter((i, len(WORDS.findall(t))) for i, t, _ in rows(steps[4]))
    packed = steps[5].collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in packed) == tokens
    histogram = Counter(r["n_tokens"] for r in packed)
    ends = optimal_boundaries(sorted(histogram), [histogram[n] for n in sorted(histogram)])
    assert all(r["bucket_len"] == next(e for e in ends if e >= r["n_tokens"]) for r in packed)
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in packed}) == len(packed)
    batches = Counter((r["bucket_len"], r["batch"]) for r in packed)
    assert all(length * n <= 65536 or n == 1 for (length, _), n in batches.items())


def test_run(spark, steps):
    count = lambda df: Counter((r["doc_id"], r["n_tokens"], r["bucket"]) for r in df.collect())
    assert count(pipeline.run(spark, FOLDER)) == count(steps[5])


def test_odd_and_empty_documents(spark, odd, none):
    for docs in (odd, none):
        docs = docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.lit(0).cast("long").alias("n_chars"))
        for _, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
