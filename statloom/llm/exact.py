"""Exact duplicates: frequent digests are found and removed map-side, all others meet in an ordinary shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import one_of_each, staged, unused, whole

COUNTERS = 1024


def misra_gries(counts: dict[bytes, int], more: Iterable[tuple[bytes, int]], counters: int) -> dict[bytes, int]:
    """Merge weighted counts into a summary of at most ``counters`` keys.

    A key is undercounted by at most (all counts) / (counters + 1), so a key above that share is always kept.
    """
    for key, n in more:
        counts[key] = counts.get(key, 0) + n
    if len(counts) > counters:
        cut = sorted(counts.values(), reverse=True)[counters]
        counts = {key: n - cut for key, n in counts.items() if n > cut}
    return counts


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Candidates for frequent digests: ``digest``, at most ``counters`` rows.

    One summary per task, summed; every digest with more than 2 / (counters + 1) of all rows is among them.
    """
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            found = batch.column(0).value_counts()
            counts = misra_gries(counts, zip(found.field(0).to_pylist(), found.field(1).to_pylist()), counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())],
                                         ["digest", "n"])

    return (digests.select("digest").mapInArrow(summarise, "digest binary, n long")
            .groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(counters)
            .select("digest"))


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "max",
                 counters: int = COUNTERS) -> DataFrame:
    """One row per document: ``id, keep_id, group_size, kept, digest`` (SHA-256 of the whole text).

    Of equal texts the row with the largest (``keep="min"``: smallest) id stays; a null id loses against any other,
    and of rows that repeat an id with the same text one stays. A null text equals the empty text. An empty table
    gives no rows. Other columns are not read.

    Texts are read once; the digests are staged. Misra-Gries summaries name candidates, an exact count verifies them,
    and the winners (at most ``counters`` rows) are broadcast: their rows are decided where they lie. A digest in the
    remaining shuffle holds at most 2 / (counters + 1) of the rows, and its rows are joined, not gathered.
    """
    if keep not in ("max", "min"):
        raise ValueError(f"keep must be max or min, not {keep!r}")
    all_digests = staged(docs.select(col(id).alias("id"), F.unhex(F.sha2(whole(text), 256)).alias("digest"),
                                     F.monotonically_increasing_id().alias("row")), "digests")
    best = F.max(F.struct("id", "row")) if keep == "max" else F.min(F.struct(F.col("id").isNull(), "id", "row"))

    def groups(df: DataFrame) -> DataFrame:
        return df.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))

    def marked(df: DataFrame, found: DataFrame) -> DataFrame:
        return df.join(found, "digest").select(
            "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
            "digest")

    total = all_digests.count()
    verified = groups(all_digests.join(F.broadcast(frequent(all_digests, counters)), "digest"))
    winners = staged(verified.where((F.col("group_size") > 1) & (F.col("group_size") * (counters + 1) > total)),
                     "winners")
    rest = all_digests.join(F.broadcast(winners), "digest", "left_anti")
    return (marked(all_digests, F.broadcast(winners)).unionByName(marked(rest, groups(rest)))
            .withColumnRenamed("id", id))


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "max",
                counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names; see ``exact_groups``.

    Of rows with the same id and text (null is the empty text) that differ elsewhere, the one with the least hash of
    its columns stays.
    """
    groups = exact_groups(docs, id, text, keep, counters)
    stay_id, stay_digest, own_id, own = unused(docs, "stay_id", "stay_digest", "own_id", "own_digest")
    stays = groups.where("kept").select(col(id).alias(stay_id), F.col("digest").alias(stay_digest))
    named = docs.withColumns({own_id: col(id), own: F.unhex(F.sha2(whole(text), 256))})
    at = (F.col(own) == F.col(stay_digest)) & F.col(own_id).eqNullSafe(F.col(stay_id))
    return one_of_each(named.join(stays, at, "left_semi"), own_id, own)


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {"op6_exact": (op6_exact, """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")}
