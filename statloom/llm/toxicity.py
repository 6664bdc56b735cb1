"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exceptions."""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import staged, whole

SAMPLE = 24_000  # labelled rows to learn from, about: the bound of everything that is collected while learning
STEMS = range(4, 9)  # lengths of word beginnings that may become entries; whole words up to LONGEST may too
LONGEST = 24
SUPPORT = 4  # toxic documents an entry needs at least

# Letters of other scripts that look like Latin ones, and signs and digits written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ԁ": "d", "н": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}


class _Fold(dict):
    """Translation table that fills itself: what each character becomes."""

    def __missing__(self, code: int) -> str:
        char = chr(code).lower()
        char = HOMOGLYPHS.get(char, char)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        found = "".join(c if c.isalpha() else SUBSTITUTES.get(c, " ") for c in
                        (HOMOGLYPHS.get(c, c) for c in plain.lower()))
        self[code] = found
        return found


_FOLD = _Fold()


def fold(text: str) -> str:
    """Small letters without accents, look-alikes and substitutes as the letters they stand for, one space between
    words and one at either end; combining marks vanish, everything else is a space. Digits and signs stand for
    letters only inside or beside letters: a token without any letter becomes nothing."""
    tokens = text.split()
    return " " + " ".join(" ".join(t.translate(_FOLD).split()) for t in tokens if not t.isascii() or any(map(str.isalpha, t))) + " "


@dataclass(frozen=True)
class Lexicon:
    """``weights``: entry -> weight. An entry " stem" matches words that begin with it, " word " the whole word.
    ``exceptions``: folded phrases with a space at either end, in which matches do not count.
    ``curve``: intercept and slopes of the score in log(1 + weight) and log(1 + weight per 100 words)."""

    weights: Mapping[str, float]
    exceptions: Sequence[str] = ()
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        if not len(machine):
            return None
        machine.make_automaton()
        return machine


def weigh(folded: str, machine: ahocorasick.Automaton | None) -> tuple[float, int]:
    """Sum of the weights of the matches outside exception phrases, and how many they are."""
    if machine is None:
        return 0.0, 0
    hits, spared = [], []
    for end, (length, weight) in machine.iter(folded):
        (spared if weight is None else hits).append((end - length + 1, end, weight))
    if spared:
        spared.sort(key=lambda s: s[0])
        starts, reach = [s[0] for s in spared], list(accumulate((s[1] for s in spared), max))
        hits = [h for h in hits if not (k := bisect_right(starts, h[0])) or reach[k - 1] < h[1]]
    return sum(h[2] for h in hits), len(hits)


def features(weight: float, words: int) -> tuple[float, float]:
    return math.log1p(weight), math.log1p(100.0 * weight / max(1, words))


def is_held_out(id: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of the id as text is a multiple of 5."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
                    sample: int = SAMPLE) -> DataFrame:
    """``text, toxic`` of about ``sample`` labelled rows that are not held out, chosen by a hash of the id.

    A text counts once however many copies it has, and is toxic if one of them is; labels without an id or a value
    are ignored.
    """
    marked = (labels.where(col(label).isNotNull() & col(id).isNotNull() & ~is_held_out(col(id)))
              .groupBy(col(id).alias("_label_id")).agg(F.max(col(label)).cast("int").alias("toxic")))
    marked = staged(marked, "labels")
    share = min(1.0, sample / max(1, marked.count()))
    chosen = marked.where(F.pmod(F.xxhash64("_label_id"), F.lit(1 << 32)) < int(share * (1 << 32)))
    texts = docs.select(col(id).alias("own_id"), whole(text).alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("own_id") == F.col("_label_id"))  # the bound makes the broadcast safe
    return staged(found.groupBy("text").agg(F.max("toxic").alias("toxic")), "sample")


def _entries(words: set[str]) -> set[str]:
    found = {" " + w[:k] for w in words for k in STEMS if len(w) >= k}
    found.update(f" {w} " for w in words if 3 <= len(w) <= LONGEST)
    return found


def _counted(sample: DataFrame, entries_of, kept: set[str] | None = None, label: int | None = None,
             support: int = 1) -> Counter:
    """Documents of the sample per (entry, label), summed over tasks."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                if label is None or toxic == label:
                    found = entries_of(fold(text))
                    total.update((e, int(toxic)) for e in (found if kept is None else found & kept))
        yield pd.DataFrame([(e, t, n) for (e, t), n in total.items()], columns=["entry", "toxic", "n"])

    counted = (sample.mapInPandas(count, "entry string, toxic int, n long").groupBy("entry", "toxic")
               .agg(F.sum("n").alias("n")).where(F.col("n") >= support))
    return Counter({(r[0], r[1]): r[2] for r in counted.collect()})


def choose(counts: Mapping[tuple[str, int], int], toxic: int, clean: int, candidates: int) -> dict[str, float]:
    """Entries that tell toxic documents apart, with log odds as weights, none of them the beginning of another.

    The evidence of an entry (log likelihood ratio against the overall rate) must exceed what the best of all
    candidates reaches by chance.
    """
    rate = toxic / (toxic + clean)
    scored = []
    for entry in {e for e, _ in counts}:
        a, b = counts.get((entry, 1), 0), counts.get((entry, 0), 0)
        share = a / (a + b)
        evidence = a * math.log(share / rate) + (b * math.log((1 - share) / (1 - rate)) if b else 0.0) if a else 0.0
        weight = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if weight > 2.0 and evidence > math.log(candidates) + 3:
            scored.append((-round(weight, 6), -len(entry), entry))
    chosen: dict[str, float] = {}
    covered: set[str] = set()  # every beginning of a chosen entry
    for weight, _, entry in sorted(scored):
        if entry in covered or any(entry[:k] in chosen for k in range(3, len(entry))):
            continue
        chosen[entry] = -weight
        covered.update(entry[:k] for k in range(2, len(entry) + 1))
    return chosen


def _phrases(weights: Mapping[str, float]):
    machine = Lexicon(weights).automaton()

    def phrases(folded: str) -> set[str]:
        """Two-word phrases with a match in one of them."""
        found = set()
        for end, (length, _) in machine.iter(folded) if machine else ():
            start = end - length + 1
            stop = folded.index(" ", start + 1)
            before = folded.rfind(" ", 0, start)
            after = folded.find(" ", stop + 1)
            if before >= 0:
                found.add(folded[before:stop + 1])
            if after >= 0:
                found.add(folded[start:after + 1])
        return found
    return phrases


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge, which keeps separable data finite."""
    design = np.c_[np.ones(len(x)), x]
    beta, penalty = np.zeros(3), ridge * np.diag([0.01, 1.0, 1.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty + 1e-9 * np.eye(3),
                               design.T @ (y - p) - penalty @ beta)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def learn_lexicon(sample: DataFrame, exceptions: Sequence[str] = ()) -> Lexicon:
    """The lexicon of a staged sample (``text, toxic``).

    Words and word beginnings of toxic documents become candidates; those that tell apart become entries. Two-word
    phrases around entries that are clean in at least nine of ten documents become exceptions, beside the given ones.
    Without toxic or without clean rows the lexicon is empty and all scores are equal. What is collected is bounded by
    the sample: candidates occur in ``SUPPORT`` of its documents.
    """
    totals = Counter({r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()})
    toxic, clean = totals[1], totals[0]
    given = tuple(fold(p) for p in exceptions)
    if not toxic or not clean:
        return Lexicon({}, given, (math.log((toxic + 0.5) / (clean + 0.5)), 0.0, 0.0))

    def words(folded: str) -> set[str]:
        return _entries(set(folded.split()))

    candidates = _counted(sample, words, label=1, support=SUPPORT)
    kept = {e for e, _ in candidates}
    counts = candidates + _counted(sample, words, kept, label=0)
    weights = choose(counts, toxic, clean, max(1, len(kept)))
    phrases = _phrases(weights)
    often = _counted(sample, phrases, label=0, support=SUPPORT)
    around = often + _counted(sample, phrases, {p for p, _ in often}, label=1)
    spared = tuple(sorted(p for p, _ in often if around[p, 0] >= 9 * around[p, 1]))
    lexicon = Lexicon(weights, given + spared)
    rows = [(r["weight"], r["words"], r["toxic"]) for r in _weighed(sample, lexicon, "toxic").collect()]
    x = np.array([features(w, n) for w, n, _ in rows])
    return Lexicon(weights, given + spared, fit_curve(x, np.array([t for _, _, t in rows], float)))


def _weighed(docs: DataFrame, lexicon: Lexicon, *keep: str) -> DataFrame:
    """The kept columns with ``weight`` (sum over matches), ``hits`` and ``words`` of the column ``text``."""
    def weigh_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = lexicon.automaton()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                folded = fold(text)
                rows.append((*weigh(folded, machine), folded.count(" ") - 1))
            found = pd.DataFrame(rows, columns=["weight", "hits", "words"], index=batch.index)
            yield pd.concat([batch[list(keep)], found], axis=1)

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, "text").mapInPandas(weigh_all, kinds + "weight double, hits long, words long")


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id, seal`` (64-bit hash of the text), ``score, predicted, hits``.

    The whole text is folded, the lexicon is matched in one pass, matches inside exception phrases do not count, and
    the score is a logistic curve in the total weight and in the weight per 100 words, both on a log scale. Null,
    empty and wordless texts weigh nothing and get the score of a text without matches. Repeated rows stay, each with
    the same score; an empty table gives no rows; no other column is read. No shuffle: the lexicon goes to the tasks.
    """
    a, b, c = lexicon.curve
    rows = docs.select(col(id).cast("string").alias("id_text"), F.xxhash64(whole(text)).alias("seal"),
                       whole(text).alias("text"))  # pandas would turn long ids with nulls into doubles
    weight = F.col("weight")
    z = (F.lit(a) + F.lit(b) * F.log1p(weight)
         + F.lit(c) * F.log1p(100.0 * weight / F.greatest(F.col("words"), F.lit(1))))
    kind = docs.schema[id].dataType
    return (_weighed(rows, lexicon, "id_text", "seal")
            .withColumn("score", 1 / (1 + F.exp(-z)))
            .select(F.col("id_text").cast(kind).alias(id), "seal", "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits"))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; see ``score_toxicity``."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        machine = lexicon.automaton()
        a, b, c = lexicon.curve

        def one(string):
            folded = fold(string)
            x, y = features(weigh(folded, machine)[0], folded.count(" ") - 1)
            return 1 / (1 + math.exp(-(a + b * x + c * y)))
        return texts.map(one)

    return docs.where(score(whole(text)) < 0.5)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    lexicon = learn_lexicon(labelled_sample(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))
    scored = score_toxicity(docs, lexicon)
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "hits")


QUERIES = {"op3_toxicity": (op3_toxicity, None)}
