import math
import random
import time
import zlib
from collections import Counter

import pytest

from statloom.llm import toxicity as T

from .conftest import ROWS


def test_fold():
    assert T.fold("Idіot  1D10T! stüpid") == " idiot idioti stupid "  # Cyrillic i
    assert T.fold("") == T.fold(" \n") == "  " or T.fold("").strip() == ""
    assert T.fold("123-456 a1") == " ai "
    assert T.fold("ﬁne ＦＵＬＬ") == " fine full "


def plain_weight(folded, lexicon):
    """Every position, every entry: what the automaton does in one pass."""
    spans = [(i, i + len(p)) for p in lexicon.exceptions for i in range(len(folded)) if folded.startswith(p, i)]
    hits = [w for e, w in lexicon.weights.items() for i in range(len(folded)) if folded.startswith(e, i)
            and not any(a <= i and i + len(e) <= b for a, b in spans)]
    return sum(hits), len(hits)


LEXICON = T.Lexicon({" idiot ": 3.0, " stup": 2.0, " clown ": 1.5}, (" clown fish ",), (-3.0, 1.0, 2.0))


@pytest.mark.parametrize("text, weight", [
    ("you IDIOT", 3.0), ("1d10t 5tupid", 5.0), ("idiotic", 0.0), ("a clown fish and a clown", 1.5), ("clown fish", 0.0),
    ("idiot idiot idiot", 9.0), ("", 0.0), ("ｃｌｏｗｎ сlown", 3.0)])
def test_weigh(text, weight):
    folded = T.fold(text)
    assert T.weigh(folded, LEXICON.automaton())[0] == pytest.approx(weight)
    assert T.weigh(folded, LEXICON.automaton()) == pytest.approx(plain_weight(folded, LEXICON))


def test_weigh_many_phrases_in_one_text():
    """Hits and exception phrases that overlap, against the definition; 100,000 of them in time."""
    lexicon = T.Lexicon({" a": 1.0, " a b": 2.0, " b ": 4.0, " c a": 8.0}, (" a b c ", " c a ", " b c a b "), (-3.0, 1.0, 2.0))
    random.seed(8)
    for _ in range(200):
        folded = " " + " ".join(random.choices("abcd", k=random.randint(1, 40))) + " "
        assert T.weigh(folded, lexicon.automaton()) == plain_weight(folded, lexicon)
    folded, start = T.fold("a b c " * 50_000 + "d b"), time.process_time()
    assert T.weigh(folded, lexicon.automaton()) == (4.0, 1)
    assert time.process_time() - start < 10


def test_scores_equal_the_definition(spark, texts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r["doc_id"]: r for r in T.score_toxicity(docs, LEXICON).collect()}
    assert len(found) == len(texts)
    for id, text in texts:
        folded = T.fold(text)
        weight, hits = plain_weight(folded, LEXICON)
        words = max(1, len(folded.split()))
        score = 1 / (1 + math.exp(3.0 - math.log1p(weight) - 2.0 * math.log1p(100 * weight / words)))
        assert found[id]["score"] == pytest.approx(score) and found[id]["hits"] == hits
        assert found[id]["predicted"] == int(score >= 0.5)
    kept = {r["doc_id"] for r in T.drop_toxic(docs, LEXICON).collect()}
    assert kept == {i for i, r in found.items() if not r["predicted"]}


def test_odd_rows(odd, none):
    found = T.score_toxicity(odd, LEXICON).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _, _ in ROWS)
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = T.drop_toxic(odd, LEXICON)
    assert kept.columns == odd.columns and kept.count() == len(ROWS)
    assert T.score_toxicity(none, LEXICON).count() == T.drop_toxic(none, LEXICON).count() == 0


def test_learning_without_labels(spark, odd):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    lexicon = T.learn_lexicon(T.labelled_sample(odd, labels))
    assert not lexicon.weights
    assert {r["predicted"] for r in T.score_toxicity(odd, lexicon).collect()} <= {0, 1}


def test_learns_words_stems_and_exceptions(spark):
    rows, labels = [], []
    for i in range(600):
        words = [f"w{(i * 7 + j) % 500}x" for j in range(30)]
        toxic = i % 6 == 0
        if toxic:
            words.insert(5, ["grobian", f"fieskram{chr(97 + i % 26)}{chr(97 + i // 26)}"][i // 6 % 2])
        elif i % 6 == 1:
            words.insert(9, "grobian stew")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = T.learn_lexicon(T.labelled_sample(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    assert any(e.startswith(" fiesk") and not e.endswith(" ") for e in lexicon.weights)


def test_held_out_accuracy(spark):
    """Learned on four fifths of the labels, judged on the rest."""
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [r for r in T.op3_toxicity(spark, folder).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    judged = [(truth[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in truth]
    counts = Counter(judged)
    assert counts[1, 1] / (counts[1, 1] + counts[0, 1]) > 0.9
    assert counts[1, 1] / (counts[1, 1] + counts[1, 0]) > 0.85
