"""Mixing sources to target weights: certain whole copies first, Pareto order sampling for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import staged, unused, whole, word_count

WEIGHTS, SHARE, MOST_COPIES, SEED = (5.0, 2.0, 1.0), 1.0, 3, 17
CELLS = 1 << 16  # of the histogram that finds where a source's sample ends


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources in code point order, null last, take the weights in turn and share ``share`` of all sizes in their
    proportion. A target stops at ``most`` times its source's size and the excess goes to the others by weight until
    none is above: the common level ``target / weight`` of the uncapped sources follows from one ordered pass over
    the sources. Sources without words have target 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    listed = per.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights)))
    every = Window.partitionBy()
    full = Window.orderBy("ratio", "source")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * float(most)
    level = (listed.withColumn("ratio", cap / F.col("w"))
             .withColumns({"total": F.sum("source_size").over(every) * float(share),
                           "capped": F.coalesce(F.sum(cap).over(before), F.lit(0.0)),
                           "open": F.sum("w").over(full.rowsBetween(0, Window.unboundedFollowing))})
             .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open")))
    reached = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"]
    return (level.withColumn("reached", reached)
            .select("source", "source_size", F.when(F.col("reached").isNull() | (F.col("ratio") < F.col("reached")), cap)
                    .otherwise(F.col("reached") * F.col("w")).alias("target")))


def uniform(*keys: Column, seed: int = SEED) -> Column:
    """In (0, 1), from the first 52 bits of a digest of the keys: the same in every run and every engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def size_class(size: Column) -> Column:
    """Number of binary digits of a size: 1 for 0 and 1 word, 2 up to 3, 3 up to 7 and so on."""
    return F.length(F.bin(size)).cast("long")


def inclusion(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source and size class: ``source, class, source_size, target, certain, p, open_words``.

    With r = target / source_size every document of the source gets floor(r) certain copies. The words still open are
    shared by inclusion probabilities proportional to the size class, p = level * class, whose expected words are the open
    ones; where p would pass 1 the class gets one more certain copy instead (p = 0) and the others share what remains.
    The level follows from one pass over the classes of a source, the largest first. ``open_words`` is what the classes
    with p < 1 have to bring.
    """
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = targets.withColumn("certain", F.floor(r)).withColumn(
        "open_words", F.col("target") - F.col("certain") * F.col("source_size")).withColumnRenamed("source", "to_source")
    classes = sizes.groupBy("source", size_class(F.col("size")).alias("class")).agg(F.sum("size").alias("words"))
    falling = Window.partitionBy("source").orderBy(F.desc("class"))
    before = F.coalesce(F.sum("words").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("class") * F.col("words")).over(falling.rowsBetween(0, Window.unboundedFollowing))
    shared = (classes.join(rates, F.col("source").eqNullSafe(F.col("to_source"))).drop("to_source")
              .withColumns({"left": F.col("open_words") - before, "rest": rest})
              .withColumn("level", F.col("left") / F.nullif(F.col("rest"), F.lit(0))))
    reached = F.max(F.when(F.col("level") * F.col("class") <= 1, F.struct("class", "level", "left"))).over(
        Window.partitionBy("source"))
    p = (F.when(F.col("open_words") <= 0, 0.0)
         .when(F.col("reached").isNull() | (F.col("class") > F.col("reached.class")), 1.0)
         .otherwise(F.col("class") * F.col("reached.level")))
    return (shared.withColumn("reached", reached).withColumn("p", p)
            .select("source", "class", "source_size", "target", (F.col("certain") + F.floor("p")).alias("certain"),
                    (F.col("p") - F.floor("p")).alias("p"), F.coalesce("reached.left", F.lit(0.0)).alias("open_words")))


def mix_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
               weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
               seed: int = SEED) -> DataFrame:
    """One row per document: ``id, seal, size, source_size, target, copies``.

    ``size`` counts the words of the text (null: 0). Every document gets the certain copies of its source and size class
    and is sampled for one more with a probability p that grows with the number of digits of its size (``inclusion``).
    Documents are ranked by Pareto's order variable, the odds u / (1 - u) of a uniform number over the inclusion odds
    p / (1 - p), and the sample of fixed size takes them in that order. Its size is fixed in words, not in documents: it
    ends where the words come nearest to the open part of the target, so each source misses its target by at most half
    of the words of one document. u depends on the seed, the id and the text alone, so reruns agree. No document gets more
    than ``most`` copies. Ties go by id and text hash; rows equal in both share their rank and are taken or left together.
    Documents without words are sampled like those of one word; all documents of a source without words get 0 copies.
    A null id counts as the text "null". An empty table gives no rows.

    Texts are read once; sizes are staged. The end of each sample is found in a histogram of at most ``CELLS`` cells
    per source, combined map-side, and only documents in the cell at the end are put in order, so a source with a
    third of all rows is never sorted in one task.
    """
    sizes = staged(docs.select(col(id).alias("id"), col(source).alias("source"), F.md5(whole(text)).alias("seal"),
                               word_count(whole(text)).alias("size")), "sizes")
    to = staged(inclusion(sizes, source_targets(sizes, weights, share, most)), "targets").withColumnsRenamed(
        {"source": "to_source", "class": "to_class"})
    u = uniform(F.col("id"), F.col("seal"), seed=seed)
    # odds / inclusion odds, mapped to (0, 1) so that it can be cut into cells; the order is the same.
    odds = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    ranked = (sizes.join(to, F.col("source").eqNullSafe(F.col("to_source")) & (size_class(F.col("size")) == F.col("to_class")))
              .drop("to_source", "to_class")
              .withColumn("u", u)
              .withColumn("q", F.when(F.col("p") > 0, odds / (1 + odds)).otherwise(1.0))
              .withColumn("cell", F.least(F.floor(F.col("q") * CELLS), F.lit(CELLS - 1))))
    cells = ranked.where("p > 0").groupBy("source", "cell").agg(F.sum("size").alias("words"), F.max("open_words").alias("open_words"))
    upto = Window.partitionBy("source").orderBy("cell")
    ends = (cells.withColumn("until", F.sum("words").over(upto))
            .where(F.col("until") >= F.col("open_words"))
            .groupBy("source").agg(F.min(F.struct("cell", (F.col("until") - F.col("words")).alias("before"))).alias("e"))
            .select(F.col("source").alias("end_source"), F.col("e.cell").alias("end_cell"), F.col("e.before").alias("before")))
    placed = ranked.join(ends, F.col("source").eqNullSafe(F.col("end_source")), "left")
    clear = placed.where("p = 0 OR end_cell IS NULL OR cell <> end_cell").withColumn("more", (F.col("p") > 0) & F.coalesce(
        F.col("cell") < F.col("end_cell"), F.lit(True)))
    order = Window.partitionBy("source").orderBy("q", "id", "seal")
    within = F.sum("size").over(order)  # rows of equal rank together
    equal = F.sum("size").over(Window.partitionBy("source", "q", "id", "seal"))
    edge = (placed.where("p > 0 AND cell = end_cell").withColumns({"within": within, "equal": equal})
            .withColumn("more", F.col("before") + F.col("within") - F.col("equal") / 2 <= F.col("open_words"))
            .drop("within", "equal"))
    return (clear.unionByName(edge)
            .select("id", "seal", "size", "source_size", "target",
                    (F.col("certain") + F.col("more").cast("int")).cast("int").alias("copies"))
            .withColumnRenamed("id", id))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
        seed: int = SEED) -> DataFrame:
    """The mixed documents with the columns they had, each row as often as it is taken; see ``mix_counts``."""
    mix_id, mix_seal, copies, copy = unused(docs, "mix_id", "mix_seal", "copies", "copy")
    counts = (mix_counts(docs, id, text, source, weights, share, most, seed).where("copies > 0")
              .select(col(id).alias(mix_id), F.col("seal").alias(mix_seal), F.col("copies").alias(copies))
              .dropDuplicates([mix_id, mix_seal]))
    at = col(id).eqNullSafe(F.col(mix_id)) & (F.md5(whole(text)) == F.col(mix_seal))
    return (docs.join(counts, at).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .drop(mix_id, mix_seal, copies, copy))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mix_counts(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return counts.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                         "copies")


QUERIES = {"op8_mix": (op8_mix, r"""
WITH sizes AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS seal,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
listed AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM per),
ratios AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / w AS ratio,
         sum(source_size) OVER ()::DOUBLE AS total FROM listed),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ratios),
reached AS (SELECT min(ratio) AS ratio, arg_min(level, ratio) AS level FROM levels WHERE level <= ratio),
targets AS (
  SELECT source, source_size, CASE WHEN r.ratio IS NULL OR l.ratio < r.ratio THEN cap ELSE r.level * w END AS target
  FROM levels l, reached r),
rates AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END)::BIGINT AS certain,
         target - certain * source_size AS open_words FROM targets),
classes AS (
  SELECT s.source, length(bin(s.size)) AS class, sum(s.size)::BIGINT AS words, any_value(t.source_size) AS source_size,
         any_value(target) AS target, any_value(certain) AS certain, any_value(open_words) AS open_words
  FROM sizes s JOIN rates t ON s.source IS NOT DISTINCT FROM t.source GROUP BY 1, 2),
shared AS (
  SELECT *, open_words - coalesce(sum(words) OVER (PARTITION BY source ORDER BY class DESC
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest_words,
         rest_words / nullif(sum(class * words) OVER (PARTITION BY source ORDER BY class DESC
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS level FROM classes),
most AS (
  SELECT source, max(class) AS class, arg_max(level, class) AS level, arg_max(rest_words, class) AS rest_words
  FROM shared WHERE level * class <= 1 GROUP BY source),
inclusion AS (
  SELECT s.source, s.class, source_size, target, certain, m.rest_words,
         CASE WHEN open_words <= 0 THEN 0 WHEN m.class IS NULL OR s.class > m.class THEN 1 ELSE s.class * m.level END AS p
  FROM shared s LEFT JOIN most m ON s.source IS NOT DISTINCT FROM m.source),
odds AS (
  SELECT s.*, t.source_size, t.target, t.certain + floor(t.p)::BIGINT AS certain, t.p - floor(t.p) AS p, t.rest_words,
         ((('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || seal), 1, 13))::BIGINT)::DOUBLE + 0.5)
         / 4503599627370496.0::DOUBLE AS u
  FROM sizes s JOIN inclusion t ON s.source IS NOT DISTINCT FROM t.source AND length(bin(s.size)) = t.class),
ranked AS (SELECT *, CASE WHEN p > 0 THEN u / (1 - u) * (1 - p) / p END AS q FROM odds),
placed AS (
  SELECT *, certain + CASE WHEN p > 0 AND sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, seal) - size / 2.0
                                <= rest_words THEN 1 ELSE 0 END AS copies FROM ranked)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies::INTEGER AS copies FROM placed""")}
