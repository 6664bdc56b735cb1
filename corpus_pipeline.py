"""From raw documents to packed batches: drop toxic texts, repeated lines and near copies, mix the sources, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.llm.lines import line_dedup
from statloom.llm.mixing import mix
from statloom.llm.neardup import near_dedup
from statloom.llm.packing import pack
from statloom.llm.text import staged
from statloom.llm.toxicity import drop_toxic, labelled_sample, learn_lexicon


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the lexicon, learned from the labels of the folder, does not call toxic."""
    sample = labelled_sample(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return drop_toxic(docs, learn_lexicon(sample))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every repeated line stays in one document only. Documents that lose all lines stay, empty."""
    done = line_dedup(docs).drop("n_lines", "n_dropped")
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return near_dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportion of their weights; a document comes up to three times, each time a row."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document of the mix with its bucket, batch and slot."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_dedup", near), ("mix", mixture), ("pack", packing)]

ORACLE_SQL = None  # the lexicon and the sketches are not SQL; tests/llm/test_pipeline.py compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
