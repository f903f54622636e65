"""Documents to training windows.

Each stage takes the documents that the one before kept, in the columns of
``documents``; the last gives the pieces of the windows.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import lines, mixing, neardup, packing, quality
from granary.llm.common import WORD, stage, table
from granary.llm.queries import PACKING

# Workers still hold memory of the stages before, so they remember fewer words here.
WINDOWS = replace(PACKING, remembered=200_000)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated line chunks go, and documents of which nothing is left; ``n_chars`` follows the text."""
    cut = lines.dedup_lines(docs).filter((F.col("removed_lines") == 0) | F.col("text").rlike(WORD))
    cut = cut.withColumn("n_chars", F.when(F.col("removed_lines") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays. Rows are told apart by number, so those that repeat an id go only if their texts are alike."""
    numbered = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "pipeline-numbered")
    found = stage(neardup.near_duplicates(numbered.select(F.col("_row").alias("doc_id"), "text")), "pipeline-near")
    gone = found.filter("NOT kept").select(F.col("doc_id").alias("_row"))
    return numbered.join(gone, "_row", "left_anti").select(docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions of their weights, rows in the order of the schedule."""
    return mixing.in_order(mixing.mix(docs)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in windows of 2048 tokens."""
    return packing.pack(docs, WINDOWS, with_ids=False)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", unrepeated_lines),
    ("near-duplicates", no_near_duplicates),
    ("mixing sources", mixed_sources),
    ("packing", packed),
]
# Learnt tables, hashes and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
