"""The corpus pipeline: quality, repeated lines, near copies, mixing and tokens, each stage on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticeworks.llm import stages

STAGES = [
    ("quality classifier", stages.quality),
    ("line dedup", stages.lines),
    ("n-gram jaccard join", stages.near_copies),
    ("mixing sources", stages.mix),
    ("bpe", stages.tokens),
]

#: The classifier, the chunk hashes and the rounding cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = stages.written(docs, "stage")
    return docs
