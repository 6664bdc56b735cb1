"""Lines that many documents share: all but the first document lose them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import SPACES, ascii_lower, staged, unused, whole

LEAST_CHARS, LEAST_DOCS = 10, 2


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


KEPT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                     T.StructField("n_dropped", T.LongType())])


@F.pandas_udf(KEPT)
def _without(text: pd.Series, dropped: pd.Series) -> pd.DataFrame:
    """The lines of a text except those at the dropped positions."""
    rows = []
    for whole_text, positions in zip(text, dropped):
        lines = whole_text.split("\n")
        if positions is None or len(positions) == 0:
            rows.append((whole_text, len(lines), 0))
        else:
            gone = set(map(int, positions))
            rows.append(("\n".join([x for i, x in enumerate(lines) if i not in gone]), len(lines), len(gone)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])


def repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                   least_docs: int = LEAST_DOCS) -> DataFrame:
    """Positions of the lines to drop: ``id, seal`` (64-bit hash of the text), ``dropped`` (array of positions).

    A key is identified by its 128-bit digest. Counting is a map-side combined aggregate, so a line of every document
    costs one row per task; rows are then matched to the repeated keys by a join, whose hot keys Spark splits.
    """
    lines = (docs.select(col(id).alias("id"), whole(text).alias("text"))
             .select("id", F.xxhash64("text").alias("seal"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
             .withColumn("line", line_key(F.col("line"))).where(F.length("line") >= least_chars)
             .select("id", "seal", "at", F.unhex(F.md5("line")).alias("key")))
    # With a threshold of two documents the smallest and the largest id tell; beyond it they are counted.
    found = lines.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                     F.max(F.col("id").isNull()).alias("void"))
    if least_docs > 2:
        held = lines.select("key", "id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("held"))
        found = found.join(held, "key").where(F.col("held") >= least_docs)
    repeated = (found.where(F.col("first").isNotNull() & ((F.col("first") < F.col("last")) | F.col("void")))
                .select("key", "first"))
    # Staged, so that both sides of the join are plain inputs: a small one goes to the lines, and where it is large Spark
    # can split the partition of a hot key, which it cannot below an aggregate.
    repeated = staged(repeated, "repeated")
    return (lines.join(repeated, "key").where(~F.col("id").eqNullSafe(F.col("first")))
            .groupBy("id", "seal").agg(F.collect_set("at").alias("dropped")))


def line_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
               least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents without repeated lines: all columns, ``text`` replaced, plus ``n_lines`` and ``n_dropped``.

    Texts are split at line feeds only. The key of a line is the line without white space at its ends and with A-Z in
    small letters. Keys of at least ``least_chars`` code points in at least ``least_docs`` documents stay only in the
    smallest id that holds them, there with all their lines. A null or empty text is one empty line and stays empty;
    rows that repeat an id are one document, each keeping its own text; rows with a null id together are one document
    that comes after all others. Columns named ``n_lines`` or ``n_dropped`` are replaced. An empty table stays empty.

    Each text is moved once, to meet the positions it loses.
    """
    gone_id, gone_seal, dropped, made = unused(docs, "gone_id", "gone_seal", "dropped", "made")
    gone = repeated_lines(docs, id, text, least_chars, least_docs).select(
        F.col("id").alias(gone_id), F.col("seal").alias(gone_seal), F.col("dropped").alias(dropped))
    at = col(id).eqNullSafe(F.col(gone_id)) & (F.xxhash64(whole(text)) == F.col(gone_seal))
    done = docs.join(gone, at, "left").withColumn(made, _without(whole(text), F.col(dropped)))
    return (done.withColumns({text: F.col(made)["text"], "n_lines": F.col(made)["n_lines"],
                              "n_dropped": F.col(made)["n_dropped"]})
            .drop(gone_id, gone_seal, dropped, made))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op5_lines": (op5_lines, r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
flagged AS (
  SELECT doc_id, line, pos, r.k IS NOT NULL AND doc_id <> first AS gone FROM keyed LEFT JOIN repeated r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id""")}
