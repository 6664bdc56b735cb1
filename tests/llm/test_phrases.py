"""Phrases against counts by hand, with groups small enough to extend prefixes; odd rows."""

import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statloom.llm import phrases
from statloom.llm.phrases import collocations, phrase_counts, words_of


def plain(rows, support, share=50, top=2000):
    """(text, lang) rows -> the result by hand."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            for size in (1, 2, 3):
                for i in range(len(ws) - size + 1):
                    counts[(lang, *ws[i:i + size])] += 1
    frequent = {p: a for p, a in counts.items() if len(p) > 2 and a >= support}
    found = []
    for (lang, *ws), a in frequent.items():
        cuts = [(1000000 * a * a // (l * r), k, l, r) for k in range(1, len(ws))
                for l, r in [(counts[(lang, *ws[:k])], counts[(lang, *ws[k:])])]]
        score, _, l, r = min(cuts)
        if not any(q[0] == lang and len(q) - 1 > len(ws) and 100 * b >= share * a
                   and any(list(q[1 + i:1 + i + len(ws)]) == ws for i in range(len(q) - len(ws))) for q, b in frequent.items()):
            found.append((lang, -score, -a, " ".join(ws).encode(), l, r))
    result = []
    for lang in {f[0] for f in found}:
        for rank, (_, s, a, p, l, r) in enumerate(sorted(f for f in found if f[0] == lang)[:top], 1):
            result.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(result)


TALK = [("The cat sat. The cat sat, the CAT sat!\nthe cat ran", "en")] * 4 + [
    ("a a a a a", "en"), ("a a a", None), ("x y z; x y z; x y q", None), ("x y z " * 5, "und"), ("ß Ä ä é", "de"), (None, "en"), ("", None),
    (" \t ", ""), ("tab\tand  space\x0bline\x0cfeed\rx y z", ""), ("😀 😀 😀 b😀", "fr"), ("don't stop don't stop now", "en"), ("İI K", "en")]


@pytest.mark.parametrize("budget", [3, 40, 1_000_000])
@pytest.mark.parametrize("support", [1, 3])
def test_against_counts_by_hand(spark, budget, support):
    df = spark.createDataFrame(TALK, "text string, lang string").withColumns({c: F.lit("x") for c in ("w1", "word", "grp", "cell", "n", "a", "score")})
    got = [tuple(r) for r in collocations(df.repartition(3), support=support, budget=budget).collect()]
    assert sorted(got) == plain(TALK, support)


def test_budget_does_not_change_results(spark):
    """Groups of 2,000 suffixes extend the frequent words by a second and a third word."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert sorted(tuple(r) for r in collocations(docs, budget=2_000).collect()) == plain(rows, 10)


def test_a_language_is_cut_at_its_first_rows(spark):
    df = spark.createDataFrame(TALK, "text string, lang string")
    assert sorted(tuple(r) for r in collocations(df, support=1, top=2).collect()) == plain(TALK, 1, top=2)


def test_groups_keep_to_the_budget(spark):
    """No group, apart from one whose phrases are all equal, takes many more suffixes than the budget."""
    df = spark.range(2000).select(F.concat(F.lit("hot "), F.col("id") % 40, F.lit(" "), F.col("id") % 700).alias("text"), F.lit("en").alias("lang"))
    read = phrases._read(df, "text", "lang")
    counted = phrases.staged(phrases.count_words(read), "words")
    words = counted.where("word is not null").select("lang", "word", "f", phrases.cell_of(F.col("lang"), F.col("word")).alias("hash"))
    cut = phrases.suffixes(read, words, phrases._totals(counted.where("word is null").select("cell", "f")), 100)
    each = F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)
    sizes = [r["rows"] for r in cut.groupBy("grp").agg(F.sum(each).alias("rows")).collect()]
    assert len(sizes) > 20 and max(sizes) <= 300


def test_counts(spark):
    df = spark.createDataFrame([("b a b a b", "en"), ("b a", "en")], "text string, lang string")
    totals, words, found = phrase_counts(df, support=1)
    assert totals.collect()[0]["n"] == 7 and {r["word"]: r["f"] for r in words.collect()} == {"a": 3, "b": 4}
    assert {(r["w1"], r["w2"], r["w3"]): r["a"] for r in found.collect()} == {
        ("a", "b", None): 2, ("b", "a", None): 3, ("a", "b", "a"): 1, ("b", "a", "b"): 2}


def test_empty(spark):
    df = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert collocations(df).collect() == [] and collocations(df.limit(0)).collect() == []


def test_words_of():
    words, pieces = words_of(pa.array(["A b.c", "", "d", " É, x"], pa.large_string()))
    assert words.to_pylist() == ["a", "b", "c", "d", "É", "x"]
    assert [len(set(pieces[i:j])) for i, j in ((0, 2), (0, 3), (2, 4), (4, 6))] == [1, 2, 2, 2]


def test_text_is_handled_in_portions_of_two_megabytes():
    """A worker's arrays are many times the portion; with 4 MB the executors came to their limit."""
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b"] * 3000, "text": ["word " * 400] * 6000})
    sizes = [sum(map(len, texts.to_pylist())) for _, texts in phrases.by_language(batch)]
    assert sum(sizes) == 12_000_000 and max(sizes) <= (2 << 20) + 2000
