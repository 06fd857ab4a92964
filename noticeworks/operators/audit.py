"""Counts of what the operators leave out, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import fixed_values as V
from noticeworks import schemas
from noticeworks.functions.json_text import malformed, parse_audited


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows before and after keeping one per key."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("before"), F.count("*").alias("after"))
    )


def json_column(df: DataFrame, column: str) -> DataFrame:
    """Rows, NULLs and malformed texts of a JSON column."""
    return df.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(column).isNull()).alias("missing"),
        F.count_if(malformed(F.col(column))).alias("malformed"),
    )


def _lost(item: Column) -> list[Column]:
    """For each field of a criterion: whether it has a value that its type cannot hold."""
    fields = schemas.CRITERION.fields
    return [item[f.name].isNotNull() & item[f.name].try_cast(f.dataType).isNull() for f in fields]


def criteria_sections(detail: DataFrame) -> DataFrame:
    """Why notices give no criteria, criteria lacking one of the expected keys, and values that their type loses.

    ``malformed`` counts texts that are not one JSON value; of those that only go on behind it the criteria are read.
    """
    keys = F.array(*[F.lit(k) for k in V.CRITERION_KEYS])
    incomplete = F.filter("_list", lambda item: F.size(F.array_except(keys, F.map_keys(item))) > 0)
    lost = F.aggregate(
        F.transform("_list", lambda item: F.size(F.filter(F.array(*_lost(item)), lambda x: x))),
        F.lit(0),
        lambda total, n: total + n,
    )
    return (
        detail.select("section2", parse_audited(F.col("section2"), schemas.SECTION2_KEYS).alias("_parsed"))
        .select("section2", F.col("_parsed.malformed").alias("_malformed"), F.col("_parsed.value.section22").alias("_section"))
        .withColumn("_list", F.col("_section.noticeAwardCriteriaList"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("section2").isNull()).alias("missing"),
            F.count_if("_malformed").alias("malformed"),
            F.count_if(F.col("_section").isNull()).alias("no_section"),
            F.count_if(F.col("_list").isNull()).alias("no_list"),
            F.count_if(F.size("_list") == 0).alias("empty_list"),
            F.coalesce(F.sum(F.size(incomplete)), F.lit(0)).alias("incomplete"),
            F.coalesce(F.sum(lost), F.lit(0)).alias("mistyped"),
        )
    )


def bidder_versions(raw: DataFrame) -> DataFrame:
    """Documents without a version from 1 on, which give no bidders."""
    valid = F.exists("_parsed.value", lambda v: v["versionNo"] >= 1)
    return raw.select(parse_audited(F.col("participation"), schemas.VERSIONS).alias("_parsed")).agg(
        F.count("*").alias("n"),
        F.count_if("_parsed.malformed").alias("malformed"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("no_valid_version"),
    )


def codes(notices: DataFrame, code: str) -> DataFrame:
    """Notices without a procurement code, which get no category."""
    return notices.agg(F.count("*").alias("n"), F.count_if(F.col(code).isNull()).alias("missing"))
