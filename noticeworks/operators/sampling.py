"""Repeatable samples: the order is a hash of id and seed, not a random draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.operators.joins import rows_in
from noticeworks.operators.ranking import first_n

# A sample of at most this many ids is broadcast; a larger one joins as the planner decides.
MAX_BROADCAST_IDS = 100_000


def _draw(column: str, seed: int) -> list[Column]:
    text = F.col(column).cast("string")
    return [F.md5(F.concat(text, F.lit(f":{seed}"))), F.col(column)]


def sample_ids(df: DataFrame, column: str, n: int, seed: int) -> DataFrame:
    """``n`` distinct ids (all of them if there are fewer)."""
    return df.select(column).distinct().orderBy(*_draw(column, seed)).limit(n)


def sample_rows(df: DataFrame, column: str, n: int, seed: int) -> DataFrame:
    """All rows of ``n`` sampled ids."""
    return rows_in(df, sample_ids(df, column, n, seed), column, column)


def sample_ids_per(df: DataFrame, category: str, column: str, n: int, seed: int) -> DataFrame:
    """``n`` distinct ids per category."""
    ids = df.select(category, column).where(F.col(category).isNotNull()).distinct()
    return first_n(ids, [category], _draw(column, seed), n)


def sample_criteria(
    criteria: DataFrame,
    categorised: DataFrame,
    categories: list[str],
    status: int,
    n: int,
    seed: int,
) -> DataFrame:
    """Per category, all criteria of ``n`` sampled documents that have the status and criteria."""
    listed = (
        categorised.where(F.col("category").isin(categories) & (F.col("status") == status))
        .select("category", F.col("cNoticeId").cast("string").alias("_id"))
        .distinct()
    )
    having = rows_in(listed, criteria, "_id", "documentId")
    drawn = sample_ids_per(having, "category", "_id", n, seed)
    if n * len(categories) <= MAX_BROADCAST_IDS:
        drawn = F.broadcast(drawn)
    return criteria.join(drawn, criteria["documentId"].cast("string") == drawn["_id"]).drop("_id")


def head(df: DataFrame, column: str, n: int) -> DataFrame:
    """First ``n`` rows by id."""
    return df.orderBy(column).limit(n)
