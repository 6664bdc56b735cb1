"""Near duplicates: fast similarity sketches, banding, and exact verification on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.components import components
from statloom.llm.sketch import COORDINATES, Shingler, band_keys, sketches
from statloom.llm.text import one_of_each, staged, unused, whole

WIDTH, PERCENT = 5, 80
BAND_ROWS = 5  # 32 bands of 5 coordinates; see near_groups for what they miss
BLOCK_SHINGLES = 500_000  # about as many shingles stand on either side of a block comparison
SHELLS = 10  # distance shells around a hub


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sketch_rows(docs: DataFrame, id: str, text: str, width: int, band_rows: int) -> DataFrame:
    """``id, seal`` (64-bit hash of the text), ``n`` (set size), ``digest`` (of the set, null without words), ``bands``."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in _batches(batches):
            sets = [shingle(t.as_py()) for t in batch.column(2)]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            for i, k in zip(full, band_keys(sketches([sets[i] for i in full]), band_rows)):
                keys[i] = k
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "seal", "n", "digest", "bands"])

    read = docs.select(col(id).alias("id"), F.xxhash64(whole(text)).alias("seal"), whole(text).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(sketch, f"id {kind}, seal long, n long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame, nodes: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """The full sets of the documents in ``nodes`` (node, id, seal): ``node, shingles`` (sorted 64-bit hashes)."""
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in _batches(batches):
            sets = [shingle(t.as_py()).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))],
                                             ["node", "shingles"])

    read = docs.select(col(id).alias("_id"), F.xxhash64(whole(text)).alias("_seal"), whole(text).alias("text"))
    # A shuffle join at every size: the nodes grow with the documents, so a broadcast would only serve small tables.
    wanted = nodes.select("node", "id", "seal").hint("merge")
    found = read.join(wanted, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_seal") == F.col("seal")))
    # A row that repeats id and text comes back more than once with the same set.
    return found.select("node", "text").mapInArrow(shingles, "node long, shingles array<long>").dropDuplicates(["node"])


def _alike(both: Column, n: Column, m: Column, percent: int) -> Column:
    return both * 100 >= (n + m - both) * percent


def _compared(tested: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links that the hubs did not show: ``u, v``, for members of a bucket that are not connected yet.

    ``tested`` has every member of a bucket with its hub and their distance. Members connected with the hub need no
    further test among themselves; every other one (asking) is compared with all members of the hub that the triangle
    inequality leaves: distances to the hub may differ by at most 1 - percent / 100, so only neighbouring shells
    meet. Both sides are cut into blocks by the number of their shingles, which bounds the memory of a comparison
    whatever the length of the texts; a pair of blocks is one group, which returns at most one link per label it
    joins, never all pairs.
    """
    reach = int(np.ceil((100 - percent) * SHELLS / 100)) + 1
    marked = (tested.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
              .join(labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")), "hub", "left")
              .withColumn("asks", F.col("label") != F.coalesce("hub_label", "hub"))
              .withColumn("shell", F.least(F.floor(F.col("distance") * SHELLS), F.lit(SHELLS - 1)).cast("int"))
              .select("node", "hub", "label", "asks", "shell", "n"))
    marked = staged(marked, "tested")
    sizes = staged(marked.groupBy("hub", "shell").agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("held"),
        F.ceil(F.sum(F.when(F.col("asks"), F.col("n")).otherwise(0)) / BLOCK_SHINGLES).cast("int").alias("asked")), "blocks")
    open_hubs = sizes.groupBy("hub").agg(F.max("asked").alias("most")).where("most > 0").select("hub")
    near = [(a, b) for a in range(SHELLS) for b in range(max(0, a - reach), min(SHELLS, a + reach + 1))]
    spark = tested.sparkSession
    meets = spark.createDataFrame(near, "ask_shell int, shell int")  # at most SHELLS * SHELLS rows
    units = (sizes.join(open_hubs, "hub").join(F.broadcast(meets), "shell")
             .join(sizes.where("asked > 0").select("hub", F.col("shell").alias("ask_shell"), F.col("asked").alias("asks_in")),
                   ["hub", "ask_shell"])
             .select("hub", "shell", "ask_shell", "held", "asks_in"))
    units = staged(units, "units")
    block = F.xxhash64("node")
    held = (marked.join(units, ["hub", "shell"])
            .select("hub", "shell", "ask_shell", F.pmod(block, F.col("held")).alias("part"), "node", "label",
                    F.explode(F.sequence(F.lit(0).cast("long"), (F.col("asks_in") - 1).cast("long"))).alias("ask_part"), F.lit(False).alias("asks")))
    asking = (marked.where("asks").withColumnRenamed("shell", "ask_shell").join(units, ["hub", "ask_shell"])
              .select("hub", "shell", "ask_shell", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("held") - 1).cast("long"))).alias("part"),
                      "node", "label", F.pmod(block, F.col("asks_in")).alias("ask_part"), F.lit(True).alias("asks")))
    rows = held.unionByName(asking).join(sets, "node")

    def compare(group: pa.Table) -> pa.Table:
        asks = np.array(group["asks"].to_pylist(), bool)
        nodes, labels = group["node"].to_numpy(), group["label"].to_pylist()
        sets = group["shingles"].combine_chunks()
        sets = sets if isinstance(sets, pa.Array) else pa.concat_arrays(sets.chunks)
        flat, offsets = sets.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(np.diff(sets.offsets.to_numpy()))]
        values, place = np.unique(flat, return_inverse=True)
        n = np.diff(offsets)
        parent = {x: x for x in labels}

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        mark, links = np.zeros(len(values), bool), []
        for i in np.flatnonzero(asks):
            own = place[offsets[i]:offsets[i + 1]]
            mark[own] = True
            both = np.add.reduceat(mark[place], offsets[:-1].astype(np.int64))
            mark[own] = False
            for j in np.flatnonzero(~asks & (both * 100 >= (n + n[i] - both) * percent)):
                a, b = root(labels[i]), root(labels[j])
                if a != b:
                    parent[a] = b
                    links.append((int(nodes[i]), int(nodes[j])))
        return pa.table({"u": pa.array([a for a, _ in links], pa.int64()), "v": pa.array([b for _, b in links], pa.int64())})

    return (rows.groupBy("hub", "shell", "ask_shell", "part", "ask_part")
            .applyInArrow(compare, "u long, v long"))


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT,
                band_rows: int = BAND_ROWS) -> DataFrame:
    """One row per document: ``id, seal, n_shingles, component_id, kept``.

    A document's set holds the distinct ``width``-word shingles of its whole text with A-Z in small letters (fewer
    words: the whole sequence). Two documents link when 100 * intersection >= percent * union, and components are what
    links connect. ``component_id`` is the smallest id of the component and its row is kept; a null id is larger than
    all others, and of rows that repeat the smallest id one is kept. A document without words (null, empty, blank)
    links with nothing and is kept. An empty table gives no rows. Other columns are not read.

    Equal sets are one class and are sketched once more only as its representative. Two sets of similarity s meet in
    some band with probability 1 - (1 - s^r)^b; for 32 bands of 5 rows that misses 3 pairs in a million at 0.8 and
    fewer above. In every bucket the least member is the hub and all members are verified against it on full sets;
    members that stay unconnected are compared in blocks (see ``_compared``), so every pair that shares a bucket is
    decided exactly or connected otherwise. No bucket is capped, and none is gathered in one task.
    """
    if band_rows < 1 or COORDINATES % band_rows:
        raise ValueError(f"band_rows must divide {COORDINATES}")
    rows = staged(sketch_rows(docs, id, text, width, band_rows).withColumn("row", F.monotonically_increasing_id()),
                  "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "seal", "row")).alias("best")
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(first, F.first("n").alias("n"),
                                                                     F.first("bands").alias("bands"))
    classes = staged(classes.select("digest", F.col("best.row").alias("node"), "best.void", "best.id", "best.seal", "n",
                                    "bands"), "classes")
    member = classes.select("node", F.explode("bands").alias("key"))
    hubs = staged(member.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("held"))
                  .where("held > 1").select("key", "hub"), "hubs")
    pairs = staged(member.join(hubs, "key").where("node <> hub").select("node", "hub").distinct(), "pairs")
    wanted = pairs.select("node").unionByName(pairs.select(F.col("hub").alias("node"))).distinct()
    sets = staged(shingle_sets(docs, staged(classes.join(wanted, "node", "left_semi").select("node", "id", "seal"), "wanted"),
                               id, text, width), "sets")
    of_hub = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles"))
    both = F.size(F.array_intersect("shingles", "hub_shingles"))
    n, m = F.size("shingles"), F.size("hub_shingles")
    verified = (pairs.join(sets, "node").join(of_hub, "hub")
                .select("node", "hub", both.alias("both"), n.alias("n"), m.alias("m")))
    verified = staged(verified.select("node", "hub", (1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).alias("distance"),
                                      _alike(F.col("both"), F.col("n"), F.col("m"), percent).alias("linked"), "n"), "verified")
    links = verified.where("linked").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    labels = staged(components(links), "labels")
    more = staged(_compared(verified.select("node", "hub", "distance", "n"), sets, labels, percent), "links")
    labels = staged(components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(more)), "labels")

    named = classes.drop("bands").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    best = F.min(F.struct("void", "id", "seal", "node")).alias("best")
    named = staged(named, "named")
    heads = staged(named.groupBy("label").agg(best).select("label", F.col("best.id").alias("component_id"),
                                                          F.col("best.node").alias("keeper")), "heads")
    placed = staged(named.join(heads, "label").select("digest", "component_id", "keeper"), "placed")
    full = rows.where("digest IS NOT NULL").drop("bands").join(placed, "digest").select(
        "id", "seal", "n", "component_id", (F.col("row") == F.col("keeper")).alias("kept"))
    void = rows.where("digest IS NULL").select("id", "seal", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return full.unionByName(void).select(F.col("id").alias(id), "seal", F.col("n").alias("n_shingles"), "component_id", "kept")


def near_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH,
               percent: int = PERCENT) -> DataFrame:
    """The kept documents with all their columns, whatever their names; see ``near_groups``.

    Rows equal in id and text (null is the empty text) count once: the one with the least hash of its columns stays.
    """
    kept_id, kept_seal, own_id, own = unused(docs, "kept_id", "kept_seal", "own_id", "own_seal")
    kept = near_groups(docs, id, text, width, percent).where("kept").select(
        col(id).alias(kept_id), F.col("seal").alias(kept_seal))
    named = docs.withColumns({own_id: col(id), own: F.xxhash64(whole(text))})
    at = F.col(own_id).eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_seal))
    return one_of_each(named.join(kept, at, "left_semi"), own_id, own)


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents", "doc_id", "text"), width=2)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op9_near": (op9_near, None)}
