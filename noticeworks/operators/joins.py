"""Joins against a set of ids.

Ids of different types are compared as text: under ANSI a text/number comparison
would cast the text and fail on the first id that is no number.

No side is broadcast by hint; the planner and adaptive execution broadcast the id
side when its measured size allows. Beyond that the join is a sort-merge join, and
both hot cases are covered: a hot id on the id side is collapsed by the partial
aggregation of ``distinct`` before its shuffle, a hot id on the row side is cut up by
adaptive skew handling. The latter needs both inputs of the join to be plain
shuffles, and ``distinct`` would leave an aggregation there; the hash in the join key
makes the distinct ids go through one more (narrow) shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ID, _HASH = "_member_id", "_member_hash"


def _id_columns(left: DataFrame, left_id: str, right: DataFrame, right_id: str) -> tuple[Column, Column]:
    if left.schema[left_id].dataType == right.schema[right_id].dataType:
        return F.col(left_id), F.col(right_id)
    return F.col(left_id).cast("string"), F.col(right_id).cast("string")


def _keyed(df: DataFrame, key: Column) -> DataFrame:
    return df.withColumns({_ID: key, _HASH: F.xxhash64(key)})


def _join(df: DataFrame, ids: DataFrame, column: str, id_column: str, how: str) -> DataFrame:
    key, id_key = _id_columns(df, column, ids, id_column)
    distinct = ids.select(id_key.alias(_ID)).where(F.col(_ID).isNotNull()).distinct()
    right = _keyed(distinct, F.col(_ID))
    if how == "left":
        right = right.withColumn("_member", F.lit(True))
    return _keyed(df, key).join(right, [_ID, _HASH], how).drop(_ID, _HASH)


def rows_in(df: DataFrame, ids: DataFrame, column: str, id_column: str) -> DataFrame:
    """Rows whose id occurs in ``ids``."""
    return _join(df, ids, column, id_column, "left_semi")


def rows_not_in(df: DataFrame, ids: DataFrame, column: str, id_column: str) -> DataFrame:
    """Rows whose id does not occur in ``ids``; rows without an id stay."""
    return _join(df, ids, column, id_column, "left_anti")


def flag_in(df: DataFrame, ids: DataFrame, column: str, id_column: str, flag: str) -> DataFrame:
    """All rows plus a boolean: does the id occur in ``ids``? Never NULL."""
    marked = _join(df, ids, column, id_column, "left")
    return marked.withColumn(flag, F.coalesce("_member", F.lit(False))).drop("_member")


def detail_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Inner join on id; the right id goes, and so does any right column the left has too."""
    left_key, right_key = _id_columns(left, left_id, right, right_id)
    extra = [c for c in right.columns if c != right_id and c not in left.columns]
    keyed = _keyed(right, right_key).select(_ID, _HASH, *extra)
    return _keyed(left, left_key).join(keyed, [_ID, _HASH], "inner").drop(_ID, _HASH)
