"""Phrase collocations: word prefixes grouped by memory budget, a depth-truncated suffix tree per group, cut scores.

The work is divided as in vertical partitioning of suffix trees. A prefix is the start of a suffix of a piece of text.
Word prefixes are taken in hash cells, whose totals are known from the word counts; cells are packed into groups of at
most ``BUDGET`` suffixes, a cell above the budget is extended by a second word, and what is still above it by a third.
Every group is then independent: one task receives its suffixes, cut to three words, and reads the counts of all its
phrases from the totals of the leaves below them. What travels are cells (fixed numbers), never lists of words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import staged, whole

SUPPORT, SHARE, TOP = 10, 50, 2000  # least count of a phrase; percent of it that a longer one covers; rows per language
BUDGET = 400_000  # suffixes of one group
CELLS = 1 << 16  # cells of one-word and of two-word prefixes
SLOTS = 1 << 23  # bits that tell which words may be frequent
BATCH_BYTES = 2 << 20  # text handled at a time, unless one text is longer
SEED = "\x00"  # between language and word in the hash of a word

# Classes of bytes: 0 part of a word (also all bytes of letters beyond ASCII), 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier that spreads combined hashes


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, A-Z in small letters, and the number of the piece each word lies in."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8, offsets[-1] - offsets[0], offsets[0]) if raw else np.zeros(0, np.uint8)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    kinds = _CLASS[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets - offsets[0]] = True  # a text starts a new piece
    first = first[:-1]
    inside = kinds == 0
    starts = inside & first
    starts[0] = inside[0]
    starts[1:] |= inside[1:] & ~inside[:-1]
    at = np.flatnonzero(starts)
    pieces = np.cumsum((kinds == 2) | first)[at]
    bounds = np.concatenate([np.cumsum(inside)[at] - 1, [np.count_nonzero(inside)]]).astype(np.int32)
    letters = _LOWER[data[inside]]
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(letters)), pieces


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    start = zlib.crc32((lang + SEED).encode())
    return np.array([zlib.crc32(w.encode(), start) for w in words.to_pylist()], np.uint64)


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a longer prefix from the hash of the shorter one and that of the next word."""
    mixed = (first * MIX + second + np.uint64(1)) * MIX
    return mixed ^ (mixed >> np.uint64(29))


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """``(lang, texts)`` of a batch in portions of ``BATCH_BYTES``."""
    langs = batch.column(0).dictionary_encode()
    texts = batch.column(1).cast(pa.large_string())
    codes = langs.indices.to_numpy(zero_copy_only=False)
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)) if len(texts) else []
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        mine = np.flatnonzero(codes == code)
        portion = np.cumsum(np.asarray(sizes)[mine]) // BATCH_BYTES
        for part in np.split(mine, np.flatnonzero(np.diff(portion)) + 1):
            yield lang, texts.take(pa.array(part))


def _read(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(col(lang).cast("string"), F.lit("und")).alias("lang"), whole(text).alias("text"))


def cell_of(lang: Column, word: Column) -> Column:
    return F.crc32(F.concat(lang, F.lit(SEED), word).cast("binary"))


def count_words(read: DataFrame) -> DataFrame:
    """``lang, word, f`` for every word, and ``lang, word null, cell, f`` for the cells of two-word prefixes."""
    cells = CELLS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(cells, np.int64)
        for batch in batches:
            for lang, texts in by_language(batch):
                words, pieces = words_of(texts)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                codes = coded.indices.to_numpy()
                counts = np.bincount(codes, minlength=len(coded.dictionary))
                hashes = word_hashes(lang, coded.dictionary)
                follows = np.flatnonzero(pieces[1:] == pieces[:-1])
                both = joined(hashes[codes[follows]], hashes[codes[follows + 1]])
                pairs += np.bincount((both % np.uint64(cells)).astype(np.int64), minlength=cells)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(counts)), "word": coded.dictionary,
                                                  "cell": pa.nulls(len(counts), pa.int32()), "f": counts})
        some = np.flatnonzero(pairs)
        if len(some):
            yield pa.RecordBatch.from_pydict({"lang": pa.nulls(len(some), pa.string()), "word": pa.nulls(len(some), pa.string()),
                                              "cell": some.astype(np.int32), "f": pairs[some]})

    partial = read.mapInArrow(count, "lang string, word string, cell int, f long")
    return partial.groupBy("lang", "word", "cell").agg(F.sum("f").alias("f"))


def pack_cells(totals: np.ndarray, budget: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each cell the number of its first group, and into how many groups it is split.

    Cells below the budget share groups, in order, as long as the sum stays within the budget.
    """
    parts = np.maximum(1, -(-totals // budget))
    start, group, room = np.zeros(len(totals), np.int64), first, 0
    for cell, total in enumerate(totals.tolist()):  # a fixed number of cells
        if parts[cell] > 1:
            start[cell] = group + (room > 0)
            group, room = start[cell] + int(parts[cell]), 0
        else:
            if room + total > budget:
                group, room = group + 1, 0
            start[cell] = group
            room += total
    return start, parts


def _totals(cells: DataFrame) -> np.ndarray:
    """``cell, f`` rows, at most ``CELLS`` of them, as an array."""
    found = np.zeros(CELLS, np.int64)
    for row in cells.collect():
        found[row["cell"]] = row["f"]
    return found


def frequent_slots(words: DataFrame) -> np.ndarray:
    """A bit per hash slot that holds a frequent word. At most SLOTS / 64 rows reach the driver, whatever the vocabulary."""
    slot = F.pmod("hash", F.lit(SLOTS))
    rows = (words.select(F.shiftright(slot, 6).cast("int").alias("block"), F.pmod(slot, F.lit(64)).cast("int").alias("bit"))
            .groupBy("block").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits")).collect())
    blocks = np.zeros(SLOTS // 64, np.int64)
    blocks[[r["block"] for r in rows]] = [r["bits"] for r in rows]
    return np.unpackbits(blocks.view(np.uint8), bitorder="little").astype(bool)


def suffixes(read: DataFrame, words: DataFrame, pair_totals: np.ndarray, budget: int) -> DataFrame:
    """``lang, grp, whole, w1, w2, w3, n`` (the last four arrays): the suffixes of each group, cut to three words.

    ``words`` has the frequent ones (``lang, word, f, hash``). A suffix that starts with two words of which one is rare
    tells nothing that the word counts do not, and a rare third word is cut off: such slots are known from a bit set of
    fixed size, which may let some rare words pass. ``whole`` is false for groups of extended two-word prefixes, whose
    other suffixes lie in other groups. Equal suffixes of a portion of text are one entry.
    """
    spark = read.sparkSession
    cell = F.pmod("hash", F.lit(CELLS)).cast("int").alias("cell")
    one_start, one_parts = pack_cells(_totals(words.groupBy(cell).agg(F.sum("f").alias("f"))), budget)
    two_start, two_parts = pack_cells(pair_totals, budget, int(one_start[-1] + one_parts[-1]))
    shared = spark.sparkContext.broadcast((np.packbits(frequent_slots(words)), one_start, one_parts, two_start, two_parts))
    cells, slots = CELLS, SLOTS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, one_start, one_parts, two_start, two_parts = shared.value
        frequent = np.unpackbits(bits).astype(bool)
        for batch in batches:
            for lang, texts in by_language(batch):
                words, pieces = words_of(texts)
                if len(words) < 2:
                    continue
                coded = words.dictionary_encode()
                hashes = word_hashes(lang, coded.dictionary)
                often = frequent[(hashes % np.uint64(slots)).astype(np.int64)]
                codes = coded.indices.to_numpy().astype(np.int64)
                size = len(coded.dictionary)
                ahead = np.full(len(codes), size)  # the code of no word
                ahead[:-1] = np.where((pieces[1:] == pieces[:-1]) & often[codes[1:]], codes[1:], size)
                third = np.full(len(codes), size)
                third[:-1] = np.where(pieces[1:] == pieces[:-1], ahead[1:], size)
                kept = often[codes] & (ahead < size)
                pair, inverse = np.unique(codes[kept] * (size + 1) + ahead[kept], return_inverse=True)
                leaf, counts = np.unique(inverse.astype(np.int64) * (size + 1) + third[kept], return_counts=True)
                if not len(leaf):
                    continue
                of, c3 = np.divmod(leaf, size + 1)
                c1, c2 = np.divmod(pair[of], size + 1)
                h1, h2 = hashes[c1], joined(hashes[c1], hashes[c2])
                cell1, cell2 = (h1 % np.uint64(cells)).astype(np.int64), (h2 % np.uint64(cells)).astype(np.int64)
                spread2 = (h2 // np.uint64(cells)).astype(np.int64)
                group = one_start[cell1] + spread2 % one_parts[cell1]
                extended = (one_parts[cell1] > 1) & (two_parts[cell2] > 1)
                h3 = joined(h2, np.append(hashes, np.uint64(0))[c3])
                spread3 = (h3 // np.uint64(cells)).astype(np.int64)
                group = np.where(extended, two_start[cell2] + spread3 % two_parts[cell2], group)
                order = np.argsort(group, kind="stable")
                group = group[order]
                starts = np.flatnonzero(np.diff(group, prepend=-1))
                ends = pa.array(np.append(starts, len(group)).astype(np.int32))
                listed = coded.dictionary
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(starts)), "grp": group[starts], "whole": ~extended[order][starts],
                    **{name: pa.ListArray.from_arrays(ends, listed.take(pa.array(c[order], mask=c[order] == size)))
                       for name, c in (("w1", c1), ("w2", c2), ("w3", c3))},
                    "n": pa.ListArray.from_arrays(ends, pa.array(counts[order]))})

    text = "array<string>"
    return read.mapInArrow(cut, f"lang string, grp long, whole boolean, w1 {text}, w2 {text}, w3 {text}, n array<long>")


def subtrees(cut: DataFrame, support: int) -> DataFrame:
    """``lang, w1, w2, w3, a``: the counts of all two- and three-word phrases with at least ``support`` occurrences.

    Each group builds its own subtree, three words deep: leaves are the distinct suffixes, a node's count is the sum of
    the leaves below. Only the two-word nodes of extended prefixes are partial and are summed once more.
    """
    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        lang, entire = group.column("lang")[0].as_py(), group.column("whole")[0].as_py()
        flat = {k: group.column(k).combine_chunks().flatten() for k in ("w1", "w2", "w3", "n")}
        rows = len(flat["n"])
        coded = pa.concat_arrays([flat[k] for k in ("w1", "w2", "w3")]).dictionary_encode()
        size = len(coded.dictionary)
        codes = coded.indices.fill_null(size).to_numpy().astype(np.int64)
        weight = flat["n"].to_numpy()
        pair, inverse = np.unique(codes[:rows] * (size + 1) + codes[rows:2 * rows], return_inverse=True)
        leaf, place = np.unique(inverse.astype(np.int64) * (size + 1) + codes[2 * rows:], return_inverse=True)
        total = np.zeros(len(leaf), np.int64)
        np.add.at(total, place, weight)
        of, c3 = np.divmod(leaf, size + 1)
        above = np.zeros(len(pair), np.int64)
        np.add.at(above, of, total)
        two = np.flatnonzero(above >= support) if entire else np.arange(len(pair))
        three = np.flatnonzero((total >= support) & (c3 < size))
        c1, c2 = np.divmod(np.concatenate([pair[two], pair[of[three]]]), size + 1)
        c3 = np.concatenate([np.full(len(two), size), c3[three]])
        take = coded.dictionary.take
        return pa.table({"lang": pa.array([lang] * len(c1), pa.string()), "w1": take(pa.array(c1)), "w2": take(pa.array(c2)),
                         "w3": take(pa.array(c3, mask=c3 == size)), "a": np.concatenate([above[two], total[three]])})

    # ``whole`` is one value per group, since extended prefixes have groups of their own.
    found = cut.groupBy("lang", "grp").applyInArrow(build, "lang string, w1 string, w2 string, w3 string, a long")
    return found.groupBy("lang", "w1", "w2", "w3").agg(F.sum("a").alias("a")).where(F.col("a") >= support)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT,
                  budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(totals, words, phrases)``: ``lang, n``; ``lang, word, f``; ``lang, w1, w2, w3, a`` (w3 null for two words).

    Words and phrases are those with at least ``support`` occurrences; all are counted.
    """
    read = _read(docs, text, lang)
    counted = staged(count_words(read), "words")
    totals = counted.where("word is not null").groupBy("lang").agg(F.sum("f").alias("n"))
    words = (counted.where((F.col("f") >= support) & F.col("word").isNotNull())
             .select("lang", "word", "f", cell_of(F.col("lang"), F.col("word")).alias("hash")))
    pairs = _totals(counted.where("word is null").select("cell", "f"))
    phrases = staged(subtrees(suffixes(read, words, pairs, budget), support), "phrases")
    return totals, words.drop("hash"), phrases


def cut_scores(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, a, l, r, score``: the lowest-scoring cut of each phrase, ties to the shortest first part."""
    def score(left: str, right: str) -> Column:
        a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", left, right))
        return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * a * a, l * r)  # a bigint: at most 1000000

    def word(position: str) -> DataFrame:
        return words.select("lang", F.col("word").alias(position), F.col("f").alias(f"f_{position}"))

    def pair(first: str, second: str) -> DataFrame:
        return twos.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(f"f_{first}{second}"))

    twos, threes = phrases.where("w3 is null"), phrases.where("w3 is not null")
    short = (twos.join(word("w1"), ["lang", "w1"]).join(word("w2"), ["lang", "w2"])
             .select("lang", "w1", "w2", "w3", "a", F.col("f_w1").alias("l"), F.col("f_w2").alias("r"),
                     score("f_w1", "f_w2").alias("score")))
    long = (threes.join(word("w1"), ["lang", "w1"]).join(word("w3"), ["lang", "w3"])
            .join(pair("w1", "w2"), ["lang", "w1", "w2"]).join(pair("w2", "w3"), ["lang", "w2", "w3"])
            .withColumns({"early": score("f_w1", "f_w2w3"), "late": score("f_w1w2", "f_w3")}))
    late = F.col("late") < F.col("early")
    long = long.select("lang", "w1", "w2", "w3", "a", F.when(late, F.col("f_w1w2")).otherwise(F.col("f_w1")).alias("l"),
                       F.when(late, F.col("f_w3")).otherwise(F.col("f_w2w3")).alias("r"),
                       F.least("early", "late").alias("score"))
    return short.unionByName(long)


def uncovered(phrases: DataFrame, share: int = SHARE) -> DataFrame:
    """The phrases without those whose words lie in a longer one with at least ``share`` percent of their count."""
    threes = phrases.where("w3 is not null")
    inner = (threes.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
             .groupBy("lang", "p").agg(F.max("a").alias("longer")).select("lang", "p.w1", "p.w2", "longer"))
    covered = inner.withColumn("w3", F.lit(None).cast("string"))
    same = phrases["w3"].eqNullSafe(covered["w3"])
    keys = (phrases["lang"] == covered["lang"]) & (phrases["w1"] == covered["w1"]) & (phrases["w2"] == covered["w2"])
    large = F.col("longer").cast("decimal(19,0)") * 100 >= phrases["a"].cast("decimal(19,0)") * share
    return phrases.join(covered, keys & same & large, "left_anti")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, share: int = SHARE,
                 top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """The ``top`` phrases of two and three words per language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z become small letters; texts are split at ``.,;:!?`` and line ends into pieces, these at spaces and tabs into
    words. ``a`` is the count of a phrase inside pieces, overlaps included, and at least ``support``; ``l`` and ``r``
    those of its two parts at the lowest-scoring cut, ``n`` the words of the language. The score is
    floor(1000000 a a / (l r)). A phrase inside a longer one with at least ``share`` percent of its count is left out.

    A null text is the empty text and has no words, a null language is ``und``, repeated rows count each time, ties go
    to the larger count and then to the smaller phrase in byte order; an empty table gives no rows, and other columns
    are not read. All counts are exact, over whole texts; ``budget`` decides only how the work is divided.
    """
    totals, words, phrases = phrase_counts(docs, text, lang, support, budget)
    named = F.concat_ws(" ", "w1", "w2", "w3")
    kept = uncovered(cut_scores(words, phrases), share).select("lang", named.alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language with most rows is cut down in 64 parts first; one task then sees at most 64 * top of its rows.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    local = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("place") <= top)
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


_SPLIT = "[.,;:!?\\x0A-\\x0D]"
ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPLIT}')) AS piece FROM documents),
parts AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
spread AS (SELECT lang, id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM parts),
suffix AS (SELECT lang, w, lead(w, 1) OVER o AS x, lead(w, 2) OVER o AS y FROM spread WINDOW o AS (PARTITION BY id ORDER BY i)),
n AS (SELECT lang, count(*) AS n FROM suffix GROUP BY lang),
f1 AS (SELECT lang, w, count(*) AS f FROM suffix GROUP BY ALL),
f2 AS (SELECT lang, w, x, count(*) AS f FROM suffix WHERE x IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w, x, y, count(*) AS f FROM suffix WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= {SUPPORT}),
cuts AS (
  SELECT c.lang, c.w || ' ' || c.x AS phrase, c.w, c.x, 2 AS size, c.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM f2 c JOIN f1 l ON l.lang = c.lang AND l.w = c.w JOIN f1 r ON r.lang = c.lang AND r.w = c.x WHERE c.f >= {SUPPORT}
  UNION ALL
  SELECT c.lang, c.w || ' ' || c.x || ' ' || c.y, c.w, c.x, 3, c.f, 1, l.f, r.f
  FROM f3 c JOIN f1 l ON l.lang = c.lang AND l.w = c.w JOIN f2 r ON r.lang = c.lang AND r.w = c.x AND r.x = c.y
  UNION ALL
  SELECT c.lang, c.w || ' ' || c.x || ' ' || c.y, c.w, c.x, 3, c.f, 2, l.f, r.f
  FROM f3 c JOIN f2 l ON l.lang = c.lang AND l.w = c.w AND l.x = c.x JOIN f1 r ON r.lang = c.lang AND r.w = c.y),
scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase, size ORDER BY score, k) = 1),
longer AS (SELECT lang, w, x, max(f) AS f FROM (SELECT lang, w, x, f FROM f3 UNION ALL SELECT lang, x, y, f FROM f3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON b.size = 2 AND g.lang = b.lang AND g.w = b.w AND g.x = b.x
         WHERE g.f IS NULL OR 100 * g.f < {SHARE} * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= {TOP}
"""

QUERIES = {"op13_phrases": (op13_phrases, ORACLE)}
