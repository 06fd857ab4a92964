"""Counts, distributions and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks import fixed_values as V
from noticeworks.sources.tables import small_table


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), column)


def distinct_with_null(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, NULL counting as one."""
    return df.select(column).distinct().agg(F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, width: float, bins: int, low: float = 0.0) -> DataFrame:
    """Rows per fixed-width bin, the last bin closed, empty bins shown, other values ignored."""
    high = low + width * bins
    inside = df.where(F.col(column).between(low, high))
    index = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("long")
    counts = inside.groupBy(index.alias("bin")).agg(F.count("*").alias("_n"))
    all_bins = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("bin") * width + low).alias("bin_start"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n"),
    )


def crosstab(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.groupBy(first, second).agg(F.count("*").alias("n"))


def completeness(windows: DataFrame, rows: DataFrame, key: str, cap: int = V.RESULT_CAP) -> DataFrame:
    """Rows per ingest window; empty windows and windows that hit the cap are marked.

    ``rows[key]`` holds the ``window_start`` a row belongs to. Rows of other windows, or of none,
    are counted in one more row with NULL bounds and the status ``outside``.
    """
    counts = rows.groupBy(F.col(key).cast("date").alias("window_start")).agg(F.count("*").alias("_n"))
    listed = windows.withColumn("_listed", F.lit(True))
    met = listed.join(counts, "window_start", "full").withColumn("_listed", F.coalesce("_listed", F.lit(False)))
    found = met.groupBy("_listed", *[F.when(F.col("_listed"), F.col(c)).alias(c) for c in windows.columns]).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n")
    )
    status = (
        F.when(~F.col("_listed"), "outside")
        .when(F.col("n") == 0, "empty")
        .when(F.col("n") >= cap, "saturated")
        .otherwise("ok")
    )
    return found.select(*windows.columns, "n", status.alias("status"))


def month_report(windows: DataFrame, pages: DataFrame, day: str, cap: int = V.RESULT_CAP) -> DataFrame:
    """Landed notices of each month against the ``total`` that its result pages state.

    ``n`` counts distinct notices, ``total`` is the largest that a page of the month states. The
    status is ``saturated`` where the total reaches the cap of the source, ``empty`` without
    notices, ``missing`` with fewer than stated, else ``ok``. Notices of other months, or without
    a day, are counted in one row with NULL bounds and the status ``outside``.
    """
    month = F.trunc(F.col(day).try_cast("date"), "MM").alias("window_start")
    counts = pages.groupBy(month).agg(F.count_distinct("cNoticeId").alias("_n"), F.max("total").alias("_total"))
    listed = windows.withColumn("_listed", F.lit(True))
    met = listed.join(counts, "window_start", "full").withColumn("_listed", F.coalesce("_listed", F.lit(False)))
    found = met.groupBy("_listed", *[F.when(F.col("_listed"), F.col(c)).alias(c) for c in windows.columns]).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.max(F.when(F.col("_listed"), F.col("_total"))).alias("total")
    )
    status = (
        F.when(~F.col("_listed"), "outside")
        .when(F.col("total") >= cap, "saturated")
        .when(F.col("n") == 0, "empty")
        .when(F.col("n") < F.col("total"), "missing")
        .otherwise("ok")
    )
    return found.select(*windows.columns, "n", "total", status.alias("status"))


def saturated(rows: DataFrame, key: str, cap: int = V.RESULT_CAP) -> DataFrame:
    """Windows with at least ``cap`` rows."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= cap)


def with_labels(df: DataFrame, field: str) -> DataFrame:
    """Adds the long label of a field name; NULL for fields without one."""
    labels = small_table(
        df.sparkSession, **{field: list(V.FIELD_LABELS), "label": list(V.FIELD_LABELS.values())}
    )
    return df.join(labels, field, "left")
