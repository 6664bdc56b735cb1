"""Document fingerprints by winnowing: k-gram hashes, the minimum of every window, with positions."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import LOWER, SPACES, UPPER, WORD, ascii_lower, let, staged, whole

GRAM, WINDOW = 5, 16  # words: every shared run of GRAM + WINDOW - 1 = 20 words leaves a shared fingerprint
# Bytes without spaces: every shared run of BYTES + SPAN - 1 = 11 bytes leaves a shared fingerprint.
BYTES, SPAN = 6, 6
POSITION = (1 << 31) - 1
HASH = ((1 << 32) - 1) << 31
BLOCK = 1 << 20  # bytes of text of the neighbouring documents that are put in order together


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The selected k-grams of a text in order of position, as longs: 32 bits of hash, then 31 bits of position.

    Every k-gram of words (A-Z in small letters) is hashed anew from the hashes of its words; nothing rolls. Of every ``window`` consecutive hashes
    the smallest is selected, of equal ones the rightmost: positions are stored from the top down, so that the
    smallest long is that one. A text of fewer than ``gram`` words has one k-gram of all its words, one with fewer
    than ``window`` k-grams has one window, and one without words has none.
    """
    words = F.regexp_extract_all(ascii_lower(text), F.lit(f"({WORD})"), 1)

    def grams(h: Column) -> Column:
        hashed = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(h) - gram, F.lit(0))),
            lambda i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + j) for j in range(gram)]), 32), 31)
            + (F.lit(POSITION) - i).cast("long"))
        return F.when(F.size(h) > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    def minima(e: Column) -> Column:
        least = F.transform(F.sequence(F.lit(1), F.greatest(F.size(e) - (window - 1), F.lit(1))),
                            lambda j: F.array_min(F.slice(e, j, window)))
        return F.when(F.size(e) > 0, F.array_distinct(least)).otherwise(e)

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), grams), minima)


def bytes_of(text: Column) -> Column:
    """The UTF-8 bytes of a text, A-Z in small letters, without spaces."""
    plain = F.octet_length(text) == F.char_length(text)
    return (F.when(plain, F.translate(F.lower(text), SPACES, "")).otherwise(F.translate(text, UPPER + SPACES, LOWER))
            .cast("binary"))


def byte_grams(data: Column, gram: int = BYTES, shift: Column | int = 0) -> Column:
    """The k-grams of bytes in the form of ``winnow``, their positions ``shift`` further on.

    Fewer than ``gram`` bytes are one k-gram, no bytes none. Each k-gram is hashed anew, since expressions carry nothing
    from one position to the next.
    """
    last = F.lit(POSITION + 1) - shift
    return let(data, lambda b: F.when(F.octet_length(b) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.octet_length(b) - (gram - 1), F.lit(1))),
        lambda i: F.xxhash64(F.substring(b, i, F.lit(gram))).bitwiseAND(F.lit(HASH)).bitwiseOR(last - i)))
        .otherwise(F.array().cast("array<bigint>")))


def window_minima(grams: Column, window: int = SPAN) -> Column:
    """The least k-gram of every window, with the ties of ``winnow``; fewer than ``window`` k-grams are one window.

    The least of some neighbours first, then the least of several of those, which together cover a window: for 6, of
    3 and then of 2. Behind the end ``get`` gives null, which ``least`` skips; the windows there are cut off.
    """
    part = math.ceil(math.sqrt(window))
    offsets = sorted({*range(part, window - part, part), window - part} - {0})

    def least(e: Column, steps) -> Column:
        return F.transform(e, lambda x, i: F.least(x, *[F.get(e, i + k) for k in steps])) if steps else e

    def whole_windows(e: Column) -> Column:
        found = let(least(e, range(1, part)), lambda p: least(p, offsets))
        return F.slice(found, F.lit(1), F.greatest(F.size(e) - (window - 1), F.least(F.size(e), F.lit(1))))

    return let(grams, whole_windows)


def byte_minima(data: Column, gram: int = BYTES, window: int = SPAN) -> Column:
    """The selected k-gram of every window over bytes."""
    return window_minima(byte_grams(data, gram), window)


def winnow_bytes(text: Column, gram: int = BYTES, window: int = SPAN) -> Column:
    """Like ``winnow``, over the bytes of a text without its spaces, so that short and unspaced texts have several."""
    return F.array_distinct(byte_minima(bytes_of(text), gram, window))


def kept_byte_fingerprints(rows: DataFrame, text: Column, dropped: Column, gram: int = BYTES, window: int = SPAN) -> DataFrame:
    """``rows`` with ``own``, the ``winnow_bytes`` of a text, and what ``changed_byte_fingerprints`` needs of it when its
    end ``dropped`` gives way to another: ``same`` entries of ``own`` stay, those of the ``at`` windows that end before
    ``dropped``; ``tail`` is the kept bytes from where the next window begins, fewer than a window has.
    """
    run = gram + window - 1  # bytes of a window
    kept, at = F.col("_kept"), F.col("at")
    rows = rows.withColumns({"_bytes": bytes_of(text), "_dropped": F.octet_length(F.translate(dropped, SPACES, ""))})
    rows = rows.withColumn("_kept", F.octet_length("_bytes") - F.col("_dropped")).withColumn("at", F.greatest(kept - (run - 1), F.lit(0)))
    rows = rows.withColumns({
        "own": F.array_distinct(byte_minima(F.col("_bytes"), gram, window)), "tail": F.substring("_bytes", at + 1, kept - at),
        "_last": F.array_min(byte_grams(F.substring("_bytes", at, F.lit(run)), gram, at - 1))})
    same = F.when(at > 0, F.array_position("own", F.col("_last"))).otherwise(0).cast("int")
    return rows.withColumn("same", same).drop("_bytes", "_dropped", "_kept", "_last")


def changed_byte_fingerprints(added: Column, gram: int = BYTES, window: int = SPAN) -> Column:
    """The ``winnow_bytes`` of a kept text that goes on with ``added``, from ``kept_byte_fingerprints``; only the windows that
    reach into what was added are made anew."""
    def more(data: Column) -> Column:
        none = F.array().cast("array<bigint>")
        return F.when((F.col("at") > 0) & (F.octet_length(data) < gram + window - 1), none).otherwise(
            window_minima(byte_grams(data, gram, F.col("at")), window))

    return F.array_distinct(F.concat(F.slice("own", F.lit(1), F.col("same")), let(F.concat("tail", bytes_of(added)), more)))


def both_byte_fingerprints(rows: DataFrame, text: Column, dropped: Column, added: Column, gram: int = BYTES,
                           window: int = SPAN) -> DataFrame:
    """``rows`` with ``own`` and ``changed``: the ``winnow_bytes`` of a text, and of the same text with its end ``dropped``
    replaced by ``added``; the first ``same`` entries of both are equal."""
    rows = kept_byte_fingerprints(rows, text, dropped, gram, window)
    return rows.withColumn("changed", changed_byte_fingerprints(added, gram, window)).drop("at", "tail")


def hashes(selected: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(selected, lambda x: F.shiftright(x, 31)))


def positions(selected: Column) -> Column:
    return F.transform(selected, lambda x: (F.lit(POSITION) - x.bitwiseAND(F.lit(POSITION))).cast("int"))


def written(selected: Column) -> Column:
    """Each selected k-gram as ``HASH@position``, with 8 hexadecimal digits of hash."""
    return F.transform(selected, lambda x: F.concat(
        F.lpad(F.hex(F.shiftright(x, 31)), 8, "0"), F.lit("@"), F.lit(POSITION) - x.bitwiseAND(F.lit(POSITION))))


def as_text(parts: Column) -> Column:
    """What ``written`` gives, in order of position and small letters."""
    return F.lower(F.array_join(parts, " "))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes; 1 when both are empty."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", gram: int | None = None,
                 window: int | None = None, select: Callable[..., Column] = winnow) -> DataFrame:
    """One row per document: ``id, hashes, positions`` (arrays in order of position).

    ``select`` is ``winnow`` (words) or ``winnow_bytes``, whose ``gram`` and ``window`` are taken where none are given.
    Equal texts have equal fingerprints, and two texts that share ``gram + window - 1`` consecutive units share one of
    them. A null text is the empty text and has empty arrays. Repeated rows stay, an empty table gives no rows, other
    columns are not read. No shuffle.
    """
    given = {k: v for k, v in (("gram", gram), ("window", window)) if v is not None}
    return (docs.select(col(id).alias("id"), select(whole(text), **given).alias("s"))
            .select(F.col("id").alias(id), F.transform("s", lambda x: F.shiftright(x, 31)).alias("hashes"),
                    positions(F.col("s")).alias("positions")))


def neighbours(keys: DataFrame) -> DataFrame:
    """For each row of ``keys`` (key, id, ask; ids distinct) the row before it by id: ``key, before, before_ask``; the
    first follows the last one.

    Keys are range partitioned and staged with their partition; order is then local to a partition, and one row per
    partition links the partitions.
    """
    parts = staged(keys.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "order")
    row = F.struct("id", "key", "ask")
    lines = parts.select("key", "part", F.lag(row).over(Window.partitionBy("part").orderBy("id")).alias("last"))
    every = Window.orderBy("part")
    wrap = F.last("end").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = (parts.groupBy("part").agg(F.max(row).alias("end"))  # a row per partition
            .select("part", F.coalesce(F.lag("end").over(every), wrap).alias("end")))
    last = F.coalesce("last", "end")
    return (lines.join(F.broadcast(ends), "part")
            .select("key", last["key"].alias("before"), last["ask"].alias("before_ask")))


def block_starts(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row with ``starts``: the first ids, ascending, of blocks of about ``size`` bytes of the texts of ``rows`` (id, text).
    Rows of one id share a block.

    Ids are range partitioned and cut by the running sum of bytes inside a partition; staged, a value per block.
    """
    room = F.octet_length("text") + F.lit(64)  # empty texts take room as well
    parts = rows.select("id", room.alias("room")).repartitionByRange("id").withColumn("part", F.spark_partition_id())
    run = F.sum("room").over(Window.partitionBy("part").orderBy("id"))  # the same for all rows of an id
    cuts = (parts.select("id", "part", F.floor(run / size).alias("cut"))
            .groupBy("part", "cut").agg(F.min(F.struct("id")).alias("start")))
    starts = F.array_distinct(F.transform(F.sort_array(F.collect_list("start")), lambda s: s["id"]))
    return staged(cuts.agg(starts.alias("starts")), "blocks")


def block_of(id: Column, starts: Column) -> Column:
    """The last of ``starts`` that is not above ``id``, by binary search; the first one where there is none, or for null."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(24))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(starts, at + s) <= id, at + s).otherwise(at))


def in_blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """``rows`` (id, text) by ``block`` of neighbouring ids, with ``seal``, the hash of the text, ``stands`` for the one row of
    an id with the smallest seal, and ``after``: false, or true for a copy of the row that stands for the first id of the
    next block (behind the last one, the first). So every row finds the row that stands for the next id in its block."""
    starts = F.col("starts")
    rows = rows.crossJoin(F.broadcast(block_starts(rows, size))).withColumn("block", block_of(F.col("id"), starts))
    here = F.struct("block", F.lit(False).alias("after"))
    before = F.struct(F.pmod(F.col("block") - 1, F.size(starts)).alias("block"), F.lit(True).alias("after"))
    is_start = F.get(starts, F.col("block")).eqNullSafe(F.col("id"))
    places = F.explode(F.when(is_start, F.array(here, before)).otherwise(F.array(here)))
    rows = rows.select("id", "text", F.xxhash64("text").alias("seal"), places.alias("place")).select("id", "text", "seal", "place.*")
    rows = rows.repartition("block")  # serves both orders, by id in this place and by block; Spark would shuffle for each
    least = F.row_number().over(Window.partitionBy("block", "after", "id").orderBy("seal")) == 1
    return rows.withColumn("stands", least).where(F.col("stands") | ~F.col("after"))


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text",
                        select: Callable[[Column], Column] = winnow, block: int = BLOCK) -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, a row per document.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document by ascending id; the first follows the last. ``near_edited`` and ``near_next`` are the Jaccard index of
    the document's hashes with those of the edited text and of the next document; two empty fingerprints are alike
    (1). Null ids are one id before all others. Where rows repeat an id, the row with the smallest text hash stands for
    it as a next document, and every row has the next id as its next document. A single id is its own next document.
    ``select`` is ``winnow`` (words) or ``winnow_bytes``.

    Texts are shuffled once, into blocks of neighbouring ids of about ``block`` bytes, and winnowed once: a row hands its
    hashes on to the rows before it. With ``winnow_bytes``, the windows that the edited text has in common with the text
    are not made again either. All rows of one id are in one block, so in one task.
    """
    rows = in_blocks(docs.select(col(id).alias("id"), whole(text).alias("text")), block)
    size = F.char_length("text")
    quarter = F.floor(size / 4).cast("int")
    kept = F.substring("text", F.lit(1), size - quarter)
    if select is winnow_bytes:
        rows = kept_byte_fingerprints(rows, F.col("text"), F.substring("text", size - quarter + 1, quarter))
    else:
        rows = rows.withColumns({"own": select(F.col("text")), "same": F.lit(0)})
    rows = rows.withColumn("own_hashes", hashes(F.col("own")))
    rows = rows.withColumn("handed", F.when(F.col("stands"), F.struct("text", "own_hashes")))
    following = F.expr("lead(handed) ignore nulls over (partition by block order by after, id, seal)")
    rows = rows.withColumn("next", following).where(~F.col("after"))
    rows = rows.withColumn("added", F.substring(F.col("next.text"), F.lit(1), quarter))
    edited = F.concat(kept, F.col("added"))
    changed = changed_byte_fingerprints(F.col("added")) if select is winnow_bytes else select(edited)
    rows = rows.select("id", size.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), "own", "own_hashes",
                       "same", F.col("next.own_hashes").alias("next_hashes"), changed.alias("changed"))
    rows = rows.withColumn("own_written", written(F.col("own")))
    more = written(F.slice("changed", F.col("same") + 1, F.size("changed")))
    return rows.select(F.col("id").alias(id), "n_chars", "edited_sha256", as_text(F.col("own_written")).alias("fingerprint"),
                       as_text(F.concat(F.slice("own_written", F.lit(1), F.col("same")), more)).alias("edited_fingerprint"),
                       likeness(F.col("own_hashes"), hashes(F.col("changed"))).alias("near_edited"),
                       likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"))


def op2_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"), select=winnow_bytes)


QUERIES = {"op2_winnow": (op2_winnow, None)}
