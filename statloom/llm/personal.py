"""Personal data in text: fixed patterns, and candidate spans that boosted trees select by format and context."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import staged, whole

KINDS = ("email", "ip", "card", "phone")
# Patterns of the base kinds. Possessive repeats and the look-behind keep them linear in the text; they match the same.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

# Generators of candidates, wider than the base kinds: signs written out, no plus, other separators, no check digit.
PROPOSED = (
    (0, re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?|\x20(?:at|AT)\x20)"
                   r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?|\x20(?:dot|DOT)\x20)[A-Za-z0-9-]{1,63}){1,6}")),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[.\-][0-9]{1,3}){3}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])\+?(?:[0-9]{1,3}[\x20-]?)?\([0-9]{2,5}\)[\x20-]?[0-9]{2,4}[\x20.-]?[0-9]{2,6}(?![0-9])")),
)
SIGNS = ("@", " at ", " AT ", "(at)", "(AT)", "[at]", "[AT]")  # one of them is in every candidate address
NEAR = 24  # characters of context on each side

FEATURES = ("email", "ip", "card", "phone", "length", "digits", "letters", "spaces", "dashes", "dots", "round", "groups",
            "first_group", "last_group", "longest_group", "shortest_group", "distinct_digits", "check_digit", "in_range", "written_sign", "glued_before",
            "glued_after", "digits_before", "digits_after", "letters_before", "letters_after", "quote_before", "equals_before",
            "colon_before", "hex_before", "line_start", "line_end")
EVEN = 20_000  # candidates of a kind and label weigh as so many where there are more
OPEN = 2  # label of candidates about which the base rules say nothing
TREES, DEPTH = 20, 4
HELD = 4  # one in so many documents calibrates the thresholds
PRECISION = 0.95  # what the spans above a threshold must reach on the calibration share
LEAST = 20  # calibration candidates from a threshold up, with fewer of which it is not trusted
BINS = 200


def luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = int(char) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds in order; kind is the position in ``KINDS``."""
    found = []
    last = 0
    at = text.find("@")
    while at >= 0:  # an address needs its sign, so runs without one are not looked at
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = NOT_DIGITS.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def overruns(text: str) -> list[tuple[int, int, int]]:
    """Digit chains in which a base pattern ran over the end of a card or phone number into the next one: ``(start, kind, end)``."""
    if not DIGIT.search(text):
        return []
    found = [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() > 19 and len(NOT_DIGITS.sub("", m.group())) > 19]
    return found + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if len(NOT_DIGITS.sub("", m.group())) > 15]


def features(text: str, start: int, end: int, kind: int) -> list[float]:
    """Format and context of a candidate, in the order of ``FEATURES``.

    The leading plus of a phone number and where the base pattern would end are left out on purpose, so that the trees
    judge a candidate by what it looks like and where it stands.
    """
    span = text[start:end]
    before, after = text[max(0, start - NEAR):start], text[end:end + NEAR]
    groups = [len(g) for g in NOT_DIGITS.split(span) if g]
    near, next_ = before[-1:], after[:1]
    bare = before.rstrip()
    letters = sum(c.isalpha() for c in span)
    plain = span.lstrip("+")
    return [*(float(kind == k) for k in range(len(KINDS))), float(len(plain)), float(sum(groups)), float(letters),
            float(span.count(" ")), float(span.count("-")), float(span.count(".")), float(span.count("(") + span.count("/")),
            float(len(groups)), float(groups[0] if groups else 0), float(groups[-1] if groups else 0),
            float(max(groups, default=0)), float(min(groups, default=0)), float(len({c for c in span if "0" <= c <= "9"})),
            float(kind == 2 and luhn(NOT_DIGITS.sub("", span))), float(kind == 1 and all(int(g) <= 255 for g in NOT_DIGITS.split(span))),
            float(kind == 0 and "@" not in span), float(near.isalnum() or near in ("_", "-", "/", "=")) if near else 0.0,
            float(next_.isalnum() or next_ in ("_", "-", "/", "=")) if next_ else 0.0,
            float(sum(c.isdigit() for c in before)), float(sum(c.isdigit() for c in after)),
            float(sum(c.isalpha() for c in before)), float(sum(c.isalpha() for c in after)),
            float(bare[-1:] in ("\"", "'", "`")) if bare else 0.0, float(bare[-1:] == "="), float(bare[-1:] == ":"),
            float(bool(near) and near in "abcdef0123456789"), float(not bare or before.endswith("\n")),
            float(not after.strip() or after.startswith("\n"))]


def candidates(text: str, base: Sequence[tuple[int, int, int]]) -> list[dict]:
    """Overlapping spans of all generators with their labels.

    1: a base span of its kind. 0: touches no base span, so the rules speak against it. ``OPEN``: the same inside an
    overrun of its kind, where they do not: such candidates are scored but not learned from. Candidates that touch a base
    span without being it are dropped: they can be neither learned from nor added.
    """
    found, known, open_ = [], {(s, k, e) for s, k, e in base}, overruns(text)
    digits = DIGIT.search(text) is not None
    proposed = set()
    for kind, pattern in PROPOSED:
        if digits if kind else any(sign in text for sign in SIGNS):
            proposed.update((m.start(), kind, m.end()) for m in pattern.finditer(text))
    touched = Ends(base)
    inside = [Ends([o for o in open_ if o[1] == k]) for k in range(len(KINDS))]
    for start, kind, end in sorted(proposed):
        label = int((start, kind, end) in known)
        if not label and touched.meet(start, end):
            continue
        if not label and inside[kind].meet(start, end):
            label = OPEN
        found.append({"kind": kind, "start": start, "end": end, "label": label, "features": features(text, start, end, kind)})
    return found


class Ends:
    """Sorted spans that tell in logarithmic time whether one of them meets another span."""

    def __init__(self, spans: Sequence[tuple[int, int, int]]):
        ordered = sorted(spans)
        self.starts, self.furthest = [s for s, _, _ in ordered], list(accumulate((e for _, _, e in ordered), max))

    def meet(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)  # those that begin before the end
        return before > 0 and self.furthest[before - 1] > start


def propose(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, row, base, candidates``, a row per document, staged; ``row`` numbers the rows."""
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    item = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32()),
                      ("features", pa.list_(pa.float32()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, proposed = [], []
            for value in batch.column(1):
                string = value.as_py()
                spans = base_spans(string)
                base.append([{"kind": k, "start": s, "end": e} for s, k, e in spans])
                proposed.append(candidates(string, spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(proposed, pa.list_(item))],
                                             ["id", "base", "candidates"])

    read = docs.select(col(id).alias("id"), whole(text).alias("text"))
    fields = "kind: int, start: int, end: int"
    made = read.mapInArrow(scan, f"id {read.schema['id'].dataType.simpleString()}, base array<struct<{fields}>>, "
                                 f"candidates array<struct<{fields}, label: int, features: array<float>>>")
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "spans")


def sampled(proposed: DataFrame, sample: int | None = None) -> DataFrame:
    """``row, kind, label, features`` (a vector) of every labelled candidate; with ``sample`` only about so many of each kind and
    label, by the hash of their place."""
    every = proposed.select("row", F.explode("candidates").alias("c")).select("row", "c.*").where(F.col("label") != OPEN)
    if sample is not None:
        counts = every.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("rows")).collect()  # at most 8 rows
        share = F.lit(0.0)
        for r in counts:
            share = F.when((F.col("kind") == r["kind"]) & (F.col("label") == r["label"]), min(1.0, sample / r["rows"])).otherwise(share)
        drawn = F.pmod(F.xxhash64("row", "start", "end", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30)
        every = every.where(drawn)
    return every.select("row", "kind", "label", array_to_vector(F.col("features").cast("array<double>")).alias("features"))


def fit_trees(train: DataFrame) -> GBTClassificationModel | None:
    """Boosted trees over all labelled candidates, both labels weighing alike; none where one label is missing.

    Within a label a kind weighs as its rows, but as ``EVEN`` of them at most, so that a frequent kind does not decide alone.
    """
    cells = {(r["kind"], r["label"]): r["count"] for r in train.groupBy("kind", "label").count().collect()}  # at most 8
    totals = {label: sum(min(n, EVEN) for (_, l), n in cells.items() if l == label) for _, label in cells}
    if len(totals) < 2:
        return None
    weight = F.lit(0.0)
    for (kind, label), n in cells.items():
        weight = F.when((F.col("kind") == kind) & (F.col("label") == label),
                        min(n, EVEN) / n * sum(totals.values()) / (2 * totals[label])).otherwise(weight)
    algorithm = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=11)
    return algorithm.fit(train.withColumn("weight", weight))


def _score() -> Column:
    return vector_to_array(F.col("probability"))[1]


def calibrate(model: GBTClassificationModel, held: DataFrame, precision: float = PRECISION) -> dict[int, float]:
    """The lowest score per kind whose calibrated probability is at least ``precision``; kinds without one are left out.

    Isotonic calibration on a histogram of scores, so the driver receives a bounded number of rows.
    """
    level = F.floor(_score() * BINS).cast("int")
    rows = (model.transform(held).groupBy("kind", level.alias("level"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("right")).collect())
    found = {}
    for kind in range(len(KINDS)):
        pools: list[list[int]] = []  # lowest level, rows, rows of label 1; shares rise from pool to pool
        for r in sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["level"]):
            pools.append([r["level"], r["rows"], r["right"]])
            while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
                _, seen, right = pools.pop()
                pools[-1][1] += seen
                pools[-1][2] += right
        sure = [pool for pool in pools if pool[2] >= precision * pool[1]]
        if sum(pool[1] for pool in sure) >= LEAST:
            found[kind] = sure[0][0] / BINS
    return found


def added_spans(proposed: DataFrame, model: GBTClassificationModel, thresholds: dict[int, float]) -> DataFrame:
    """``row, added``: the candidates other than base spans above their threshold; of overlapping ones the likeliest, then the longest."""
    least = F.lit(2.0)
    for kind, threshold in thresholds.items():
        least = F.when(F.col("kind") == kind, threshold).otherwise(least)
    every = (proposed.select("row", F.explode("candidates").alias("c")).select("row", "c.*").where("label != 1")
             .select("row", "kind", "start", "end", array_to_vector(F.col("features").cast("array<double>")).alias("features")))
    chosen = (model.transform(every).withColumn("score", _score()).where(F.col("score") >= least)
              .select("row", F.struct(-F.col("score"), F.col("start") - F.col("end"), "start", "kind", "end").alias("span")))

    @F.pandas_udf("array<struct<kind: int, start: int, end: int>>")
    def apart(spans):
        def one(listed):
            taken = []
            for s in sorted((tuple(s.values()) for s in listed)):
                if all(s[4] <= t["start"] or s[2] >= t["end"] for t in taken):
                    taken.append({"kind": s[3], "start": s[2], "end": s[4]})
            return taken
        return spans.map(one)

    return chosen.groupBy("row").agg(F.collect_list("span").alias("spans")).select("row", apart("spans").alias("added"))


def find_personal(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int | None = None,
                  precision: float = PRECISION) -> DataFrame:
    """One row per document: ``id, base, added`` (arrays of kind, start, end; code points, end exclusive), in order of start.

    ``base`` has the spans of the fixed patterns. Generators that accept more propose overlapping candidates; trees,
    boosted on those that carry a label from the base spans (all of them unless ``sample`` bounds each kind and label), score every other candidate by format
    and context, and those above the threshold of their kind, calibrated on documents outside the fit, are ``added``;
    they never touch a base span or each other. Where a table has too few spans of a kind to calibrate it, none of it is added.

    A null or empty text has no spans, repeated rows stay, each with its spans, an empty table gives no rows; other
    columns are not read. Whole texts; what is shuffled are the added spans and a short row per document.
    """
    proposed = propose(docs, id, text)
    rows = staged(sampled(proposed, sample), "labelled")
    held = F.pmod(F.xxhash64("row", F.lit("held")), F.lit(HELD)) == 0
    model = fit_trees(rows.where(~held))
    thresholds = calibrate(model, rows.where(held), precision) if model else {}
    none = F.array().cast("array<struct<kind: int, start: int, end: int>>")
    if not thresholds:
        return proposed.select(F.col("id").alias(id), "base", none.alias("added"))
    added = added_spans(proposed, model, thresholds)
    return (proposed.select("id", "row", "base").join(added, "row", "left")
            .select(F.col("id").alias(id), "base", F.coalesce("added", none).alias("added")))


def redact(docs: DataFrame, id: str = "doc_id", text: str = "text", mark: str = "[personal]") -> DataFrame:
    """``id, text`` with every base span replaced by ``mark``; a null text stays null."""
    @F.pandas_udf("string")
    def clean(texts):
        def one(string):
            if string is None:
                return None
            parts, last = [], 0
            for start, _, end in base_spans(string):
                if end > last:
                    parts += [string[last:start], mark] if start >= last else []
                    last = end
            return "".join(parts) + string[last:]
        return texts.map(one)
    return docs.select(col(id), clean(col(text)).alias(text))


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: Column) -> Column:
        placed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), s["kind"].alias("k"), s["end"].alias("e"))))
        return F.array_join(F.transform(placed, lambda p: F.concat_ws(":", F.get(names, p["k"]), p["s"], p["e"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    found = find_personal(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", *[count(k) for k in range(len(KINDS))], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


QUERIES = {"op11_personal": (op11_personal, None)}
