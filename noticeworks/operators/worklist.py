"""What is still to be fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.operators.joins import rows_not_in


def remaining(wanted: DataFrame, landed: DataFrame, column: str, landed_column: str) -> DataFrame:
    """Wanted rows whose id has not landed, in numeric id order (non-numbers last)."""
    number = F.col(column).try_cast("long")
    return rows_not_in(wanted, landed, column, landed_column).orderBy(
        number.asc_nulls_last(), F.col(column).cast("string")
    )
