"""Bidders out of participation documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeworks import schemas
from noticeworks.functions import text
from noticeworks.functions.json_text import parse
from noticeworks.operators.joins import flag_in


def latest_version(versions: Column, element: StructType, version: str = "versionNo") -> Column:
    """The element with the highest version from 1 on, the last of equals; NULL if none.

    Works inside the row, so nothing is shuffled.
    """
    valid = F.filter(versions, lambda v: v[version] >= 1)
    return F.reduce(
        valid,
        F.lit(None).cast(element),
        lambda best, v: F.when(best.isNull() | (v[version] >= best[version]), v).otherwise(best),
    )


def explode_bidders(raw: DataFrame) -> DataFrame:
    """One row per participant of each document's latest version."""
    versions = parse(F.col("participation"), schemas.PARTICIPATION)
    # The outer form keeps the planner from deriving a filter that parses the text again;
    # documents without suppliers go at the second explode.
    return (
        raw.select("documentId", versions.alias("_versions"))
        .select("documentId", latest_version(F.col("_versions"), schemas.STATEMENT).alias("_latest"))
        .select("documentId", F.explode_outer("_latest.statementSuppliers").alias("_supplier"))
        .select("documentId", F.explode("_supplier.statementParticipants").alias("_participant"))
        .select("_participant.*", "documentId")
    )


def with_fiscal_digits(bidders: DataFrame) -> DataFrame:
    return bidders.withColumn("fiscalNumber_numeric", text.digits(F.col("fiscalNumber")))


def bidders_silver(raw: DataFrame, registry: DataFrame, registry_column: str = "fiscalNumber") -> DataFrame:
    """Bidders with the digits of their fiscal number and whether the registry lists them."""
    digits = with_fiscal_digits(explode_bidders(raw))
    return flag_in(digits, registry, "fiscalNumber_numeric", registry_column, "is_social_enterprise")


def participation_split(bidders: DataFrame, social: DataFrame, social_id: str) -> DataFrame:
    """Flags the bidders of social contracts."""
    return flag_in(bidders, social, "documentId", social_id, "social_contract")
