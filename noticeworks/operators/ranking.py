"""First n rows per key, with a total order so that results do not depend on arrival.

``row_number() <= n`` lets Spark cut every map task to n rows per key before the
shuffle, so a hot key sends n rows per task, not all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Up to this n Spark cuts before the shuffle (its windowGroupLimitThreshold).
EARLY_CUT = 1000
SLOTS = 64


def _cut(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per key; beyond the early cut a hot key is first cut in slots."""
    if n > EARLY_CUT:
        slot = F.pmod(F.xxhash64(*df.columns), F.lit(SLOTS))
        df = _cut(df.withColumn("_slot", slot), [*keys, "_slot"], order, n).drop("_slot")
    return _cut(df, keys, order, n)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return first_n(df, keys, order, 1)


def keep_latest(df: DataFrame, keys: list[str], version: str, tie: list[Column]) -> DataFrame:
    """One row per key: highest version from 1 on; ``tie`` orders equal versions, best first."""
    return keep_first(df.where(F.col(version) >= 1), keys, [F.col(version).desc(), *tie])
