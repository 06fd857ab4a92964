"""Month windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def windows(spark: SparkSession, first: str, last: str, step: str = "1 month") -> DataFrame:
    """One row per window: its key (first day) and both bounds, as date and as request text.

    A window ends on the day before the next one starts, so windows of any step leave no gap.
    """
    start = F.explode(
        F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"interval {step}"))
    )
    end = F.date_sub((F.col("window_start") + F.expr(f"interval {step}")).cast("date"), 1)
    return (
        spark.range(1)
        .select(start.alias("window_start"))
        .withColumn("window_end", end)
        .withColumn("start_text", bound_text(F.col("window_start"), "00:00:00.000"))
        .withColumn("end_text", bound_text(F.col("window_end"), "23:59:59.999"))
    )


def bound_text(day: Column, time: str) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f"T{time}Z"))


def in_range(day: Column, first: str, last: str) -> Column:
    """Both days included."""
    return (day >= F.lit(first).cast("date")) & (day < F.date_add(F.lit(last).cast("date"), 1))
