"""Assigning notices to categories by procurement-code prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shortest_prefixes(pairs: DataFrame) -> DataFrame:
    """Distinct pairs without prefixes that merely lengthen another of the same category.

    Of two prefixes that both start a code one starts the other, so afterwards a code
    matches a category at most once.
    """
    pairs = pairs.select("category", "prefix").distinct()
    shorter = F.sequence(F.lit(0), F.length("prefix") - 1)
    stems = pairs.where(F.length("prefix") > 0).withColumn(
        "_stem", F.explode(F.transform(shorter, lambda n: F.substring("prefix", F.lit(1), n)))
    )
    known = pairs.select("category", F.col("prefix").alias("_stem"))
    nested = stems.join(known, ["category", "_stem"], "left_semi").select("category", "prefix")
    return pairs.join(nested, ["category", "prefix"], "left_anti")


def categorise(
    notices: DataFrame, pairs: DataFrame, code: str, mode: str = "all"
) -> DataFrame:
    """``notices`` with a category column, one row per match.

    ``mode="all"``: one row per matching (category, prefix) pair, so a notice repeats
    within a category that holds nested prefixes. ``mode="distinct_category"``: one row
    per notice and category; the map is reduced beforehand, the notices are not shuffled.

    The prefix test is an equi-join: each code is cut at the few prefix lengths that
    occur in the map. The map side is broadcast when its measured size allows, else the
    join shuffles on the prefix and adaptive skew handling splits hot prefixes.
    """
    if mode not in ("all", "distinct_category"):
        raise ValueError(f"unknown mode: {mode}")
    lengths = pairs.agg(F.sort_array(F.collect_set(F.length("prefix")))).scalar()
    if mode == "distinct_category":
        pairs = shortest_prefixes(pairs)
    # Without the length filter a code shorter than a cut would be cut to itself again
    # and match its own prefix more than once.
    return (
        notices.where(F.col(code).isNotNull())
        .withColumn("_length", F.explode(lengths))
        .where(F.col("_length") <= F.length(code))
        .withColumn("_prefix", F.substring(F.col(code), F.lit(1), F.col("_length")))
        .join(pairs.select(F.col("prefix").alias("_prefix"), "category"), "_prefix")
        .drop("_prefix", "_length")
    )
