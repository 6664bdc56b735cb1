"""Packing by optimal length buckets: boundaries from the global histogram, batches of a token budget inside each."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import staged, whole, word_count
from statloom.sources.tables import literal_rows

BUCKETS, BUDGET = 16, 1 << 16
BLOCK_ROWS = 20_000  # rows numbered by one window


def optimal_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int = BUCKETS) -> list[int]:
    """Upper ends of the buckets that pad the fewest tokens, for ascending distinct lengths and their counts.

    cost[k][j] = min over i < j of cost[k-1][i] + length[j] * (rows up to j - rows up to i): for fixed k a minimum of
    lines in length[j], whose slopes fall with i while the queries rise, so one pass over a hull of lines finds every
    cost[k][j]. Time and memory are lengths x buckets.
    """
    m, k = len(lengths), min(buckets, len(lengths))
    if not m:
        return []
    upto = [0]
    for n in counts:
        upto.append(upto[-1] + n)
    cost: list[float] = [0] + [float("inf")] * m
    came: list[list[int]] = []
    for level in range(1, k + 1):
        new: list[float] = [float("inf")] * (m + 1)
        back = [0] * (m + 1)
        hull: deque[tuple[int, int, int]] = deque()  # slope, intercept, i
        for j in range(level, m + 1):
            i = j - 1
            if cost[i] < float("inf"):
                line = (-upto[i], cost[i], i)
                while len(hull) > 1 and ((hull[-1][1] - hull[-2][1]) * (hull[-1][0] - line[0])
                                         >= (line[1] - hull[-1][1]) * (hull[-2][0] - hull[-1][0])):
                    hull.pop()
                hull.append(line)
            x = lengths[j - 1]
            while len(hull) > 1 and hull[0][0] * x + hull[0][1] >= hull[1][0] * x + hull[1][1]:
                hull.popleft()
            new[j], back[j] = hull[0][0] * x + hull[0][1] + x * upto[j], hull[0][2]
        cost = new
        came.append(back)
    ends, j = [], m
    for back in reversed(came):
        ends.append(lengths[j - 1])
        j = back[j]
    return ends[::-1]


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, budget: int = BUDGET,
         length: str | None = None) -> DataFrame:
    """One row per document: ``id, n_tokens, bucket, bucket_len, batch, slot, padding``.

    ``n_tokens`` is the ``length`` column, by default the number of words of the text; a null text or length counts 0.
    At most ``buckets`` buckets; their upper ends minimise the padding over all documents. A batch of a bucket holds
    ``budget // bucket_len`` documents, and at least one: a document over the budget is a batch of its own. ``batch``
    counts from 0 in its bucket and only the last one of a bucket is not full; ``slot`` is the place in the batch.
    Empty documents stay, in the first bucket. Repeated rows are documents of their own. An empty table gives no rows.

    The driver receives the histogram: a row per distinct length, of which there are at most as many as the longest
    document has tokens. Rows are numbered in blocks of about ``BLOCK_ROWS`` whose offsets are summed, so no bucket
    is ordered in one task; numbers follow the staged rows and do not change when tasks run again.
    """
    if buckets < 1 or budget < 1:
        raise ValueError("buckets and budget must be positive")
    n = word_count(whole(text)) if length is None else F.coalesce(col(length).cast("long"), F.lit(0))
    rows = staged(docs.select(col(id).alias("id"), n.alias("n_tokens"), F.monotonically_increasing_id().alias("row")),
                  "lengths")
    histogram = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = sorted((r["n_tokens"], r["n"]) for r in histogram)
    ends = optimal_boundaries([x for x, _ in histogram], [c for _, c in histogram], buckets)
    blocks = max(1, -(-sum(c for _, c in histogram) // BLOCK_ROWS))
    held, at = [], 0
    for bucket, end in enumerate(ends):  # each length with its bucket
        while at < len(histogram) and histogram[at][0] <= end:
            held.append((histogram[at][0], bucket, end, max(1, budget // max(1, end))))
            at += 1
    spark = docs.sparkSession
    bucket_of = literal_rows(spark, held, "n_tokens long, bucket integer, bucket_len long, per_batch long")
    placed = (rows.join(F.broadcast(bucket_of), "n_tokens")
              .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))))
    counts = placed.groupBy("bucket", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.row_number().over(Window.partitionBy("bucket", "block").orderBy("row")) - 1
    return (placed.join(offsets, ["bucket", "block"]).withColumn("place", place)
            .select(F.col("id").alias(id), "n_tokens", "bucket", "bucket_len",
                    F.floor(F.col("place") / F.col("per_batch")).alias("batch"),
                    (F.col("place") % F.col("per_batch")).alias("slot"),
                    (F.col("bucket_len") - F.col("n_tokens")).alias("padding")))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op1_pack": (op1_pack, None)}
