"""Secrets in text: fixed patterns, and windows of high entropy in candidate strings."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import whole

# Patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
NAMES = ("passw", "secret", "token", "api")  # one of them is in every assignment
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need not be looked at
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{20,}")
WINDOW = 20
MARGIN = 1.5  # standard deviations below the expected entropy of random windows; most random windows reach that
PART = re.compile(r"[A-Za-z0-9+/_.-]+(?:=+\Z)?")  # a candidate is cut at "=", unless it is padding at the end
# Letter pairs that are common in English, German, French and Spanish: 16 of the 19 in a window of prose, 4 of random letters.
PAIRS = frozenset("""th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me
 de hi ri ro ic ne ea ra ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss
 so rs un lo ge ie em ad ol rt po na ul ni ts mo pa im mi ai sh ir su id os iv ia am fi ci vi ig tu ld mp fe ab ap gr
 sc ei au ht ke ze nz tz lt hr zu ue qu da do br bu st nn rd gh""".split())
PROSE = 8  # common pairs from which a window of letters alone is words and not a key
_NAME = r"(?:[A-Z]?[a-z]{1,18}(?:[A-Z][a-z]{2,18})*|[A-Z]{2,12})"  # a word, words in CamelCase, or capitals: no word fills a window
_NAMES = rf"(?=[^/=]{{3}}){_NAME}(?:[_.-]+{_NAME})*"
# What is harmless in a candidate, and only that; no pattern has an open end.
ALLOW = (r"(?<![0-9A-Za-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9A-Za-z])",  # UUIDs
         r"(?:\A|(?<==))/{0,2}(?:[A-Za-z0-9_-]+\.)+(?:com|org|net)(?=/|\Z)",  # the host of a URL
         # Folders and files named in words. Shorter names are scanned, since base64 has them between its slashes.
         rf"(?:\A|(?<=[/=])){_NAMES}(?=/)|(?<=/){_NAMES}\Z",
         r"(?i:(?:0123456789)?abcdefghijklmnopqrstuvwxyz(?:0123456789)?|0123456789(?:abcdef)?|(?:1234567890){2,})")


def _threshold(alphabet: int, window: int = WINDOW) -> float:
    """Expected entropy of ``window`` random characters of an alphabet, less ``MARGIN`` standard deviations.

    Both moments of sum(c * log2(c)) over the characters are exact, from the binomial and trinomial counts.
    """
    n, p = window, 1 / alphabet
    plogp = [c * math.log2(c) if c else 0.0 for c in range(n + 1)]
    one = [math.comb(n, c) * p ** c * (1 - p) ** (n - c) for c in range(n + 1)]
    mean = sum(q * x for q, x in zip(one, plogp))
    square = sum(q * x * x for q, x in zip(one, plogp))
    cross = sum(math.comb(n, c) * math.comb(n - c, d) * p ** (c + d) * (1 - 2 * p) ** (n - c - d) * plogp[c] * plogp[d]
                for c in range(n + 1) for d in range(n + 1 - c))
    variance = alphabet * square + alphabet * (alphabet - 1) * cross - (alphabet * mean) ** 2
    return math.log2(n) - (alphabet * mean + MARGIN * math.sqrt(max(variance, 0.0))) / n


# What a window of each alphabet must reach, in bits per character.
IN_DIGITS, IN_HEX, IN_CASE, IN_BASE32, IN_ALNUM, IN_LETTERS, IN_BASE62, IN_BASE64 = map(_threshold, (10, 16, 26, 32, 36, 52, 62, 64))


def _kind(char: str) -> int:
    """0 digit of base32, 1 other digit, 2 and 3 small letter (hexadecimal, other), 4 and 5 capital, 6 dash, 7 sign."""
    if char.isdigit():
        return 0 if "2" <= char <= "7" else 1
    if char.isalpha():
        return (2 if char.islower() else 4) + (char.lower() > "f")
    return 6 if char == "-" else 7


CHARACTERS = {chr(c): _kind(chr(c)) for c in range(128)}


def window_threshold(kinds: Sequence[int], pairs: int) -> float:
    """The threshold of a window by the narrowest alphabet that holds it; ``kinds`` has its characters per ``_kind``,
    ``pairs`` the number of its common letter pairs.

    Windows with signs must mix letters and digits: else they are prose, paths, dates or phone numbers. Windows of
    letters alone must not look like words.
    """
    digits, small, capital = kinds[0] + kinds[1], kinds[2] + kinds[3], kinds[4] + kinds[5]
    if kinds[6] or kinds[7]:
        if not digits or not (small or capital):
            return math.inf
        if kinds[7] or (small and kinds[3] + kinds[5]):
            return IN_BASE64
        return IN_HEX if not kinds[3] + kinds[5] else IN_ALNUM
    if not digits:
        return math.inf if pairs > PROSE else IN_LETTERS if small and capital else IN_CASE
    if not small and not capital:
        return IN_DIGITS
    if not kinds[3] + kinds[5]:
        return IN_HEX
    if small and capital:
        return IN_BASE62
    return IN_BASE32 if capital and not kinds[1] else IN_ALNUM


def random_windows(string: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """Joined spans of the windows whose entropy reaches the threshold of their own alphabet.

    Counts move with the window: each step changes two of them, so the cost does not depend on the window.
    H = log2(w) - sum(c * log2(c)) / w; the kinds of characters and the common pairs are counted likewise.
    """
    if len(string) < window:
        return []
    plogp = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    counts: dict[str, int] = {}
    kinds, total, spans, bits = [0] * 8, 0.0, [], math.log2(window)
    small, pairs = string.lower(), 0
    for at, char in enumerate(string):
        n = counts.get(char, 0)
        total += plogp[n + 1] - plogp[n]
        counts[char] = n + 1
        kinds[CHARACTERS[char]] += 1
        pairs += at > 0 and small[at - 1:at + 1] in PAIRS
        if at >= window:
            old = string[at - window]
            n = counts[old]
            total += plogp[n - 1] - plogp[n]
            counts[old] = n - 1
            kinds[CHARACTERS[old]] -= 1
            pairs -= small[at - window:at - window + 2] in PAIRS
        if at >= window - 1 and bits - total / window >= window_threshold(kinds, pairs) - 1e-9:
            start, end = at - window + 1, at + 1
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds; kind is the position in ``KINDS``."""
    found = []
    small = text.lower()
    if any(name in small for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def pieces(string: str, allow: re.Pattern | None) -> Iterator[tuple[int, int]]:
    """What remains of a candidate without the characters the allow-list matches, cut at "="."""
    last, ends = 0, []
    for m in allow.finditer(string) if allow else ():
        if m.end() > m.start():
            ends.append((last, m.start()))
            last = m.end()
    for start, end in [*ends, (last, len(string))]:
        for part in PART.finditer(string, start, end):
            yield part.span()


def entropy_spans(text: str, base: Sequence[tuple[int, int, int]], allow: re.Pattern | None) -> list[tuple[int, int, int]]:
    """Spans the method adds: windows of high entropy that no base span touches, outside what the allow-list matches.

    ``base`` is in order of start.
    """
    found = []
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    for m in CANDIDATE.finditer(text):
        string = m.group()
        for first, stop in pieces(string, allow):
            for start, end in random_windows(string[first:stop]):
                start, end = start + first + m.start(), end + first + m.start()
                before = bisect_left(starts, end)  # of the base spans that start before the end, does one reach the start?
                if not before or reach[before - 1] <= start:
                    found.append((start, 3, end))
    return found


def scan_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text", allow: Iterable[str] = ALLOW) -> DataFrame:
    """One row per document: ``id, spans`` (array of kind, start, end; code points, end exclusive) in order of start.

    Kinds: ``assign`` (a named value), ``access`` (access key ids), ``hex`` (24 or more hexadecimal digits), and
    ``entropy``: candidate strings of 20 or more key characters, cut at "=", are scanned by a sliding window, whose
    entropy must reach what is expected of random characters of the window's own alphabet. ``allow`` lists patterns; the characters that
    they match in a candidate are not scanned, the rest of it is. Base kinds are never suppressed, and an entropy span never touches one of them. A null
    or empty text has no spans; repeated rows stay, each with its spans; an empty table gives no rows; other columns
    are not read.

    Whole texts, no shuffle; memory holds a batch of texts.
    """
    allowed = "|".join(f"(?:{p})" for p in allow)
    kind = "struct<kind: string, start: int, end: int>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(allowed) if allowed else None
        item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            rows = []
            for value in batch.column(1):
                string = value.as_py()
                base = base_spans(string)
                spans = sorted(base + entropy_spans(string, base, pattern))
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(item))], ["id", "spans"])

    read = docs.select(col(id).alias("id"), whole(text).alias("text"))
    return read.mapInArrow(scan, f"id {read.schema['id'].dataType.simpleString()}, spans array<{kind}>") \
        .withColumnRenamed("id", id)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every base span replaced by ``mark``; a null text stays null."""
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
    return docs.withColumn(text, clean(col(text)))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = joined(F.filter(spans, lambda s: s["kind"] != "entropy"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"),
                        joined(spans).alias("spans"), count("entropy"))


QUERIES = {"op10_secrets": (op10_secrets, None)}
