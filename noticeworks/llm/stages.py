"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on all that its predecessor kept.

All but the last return the columns of ``docs``. Null and empty texts pass as the operators define; an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import bpe, factorisation, jaccard_join, line_dedup, mixing
from noticeworks.llm.queries import table, vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the factorisation machine accepts."""
    model = factorisation.train(docs, table(spark, sf_dir, "labels"))
    return factorisation.score(docs, model).where("predicted = 1").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the chunks of lines that an earlier one has; ``n_chars`` follows the text.

    A document that has no word left goes: all of it stands elsewhere.
    """
    left = line_dedup.remove_repeated_chunks(docs)
    left = left.where((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether they decode to its text."""
    encoded = bpe.encode(docs, vocabulary_path())
    return encoded.select("doc_id", "lang", "source", "n_tokens", "decodes", "ids")


written = mixing.written
