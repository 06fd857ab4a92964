"""Award criteria out of notice details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks import fixed_values as V
from noticeworks import schemas
from noticeworks.functions.json_text import parse
from noticeworks.operators.joins import detail_join, rows_in


def explode_criteria(detail: DataFrame, id_column: str = "documentId", keep: list[str] | None = None) -> DataFrame:
    """One row per award criterion; notices without a (filled) criteria section give none."""
    keep = keep or []
    section = parse(F.col("section2"), schemas.SECTION2)["section22"]
    # The outer form keeps the planner from deriving a filter that parses the text again.
    return (
        detail.select(id_column, *keep, section.alias("_section"))
        .select(
            id_column,
            *keep,
            F.col("_section.shortDescription").alias("short_description"),
            F.explode_outer("_section.noticeAwardCriteriaList").alias("_criterion"),
        )
        .where(F.col("_criterion").isNotNull())
        .select(
            id_column,
            *keep,
            "short_description",
            *[F.col(f"_criterion.{key}").alias(key) for key in V.CRITERION_KEYS],
        )
    )


def criteria_of(detail: DataFrame, categorised: DataFrame, repeat: bool = False) -> DataFrame:
    """Criteria of the notices in a category list.

    Each criterion comes once; ``repeat=True`` gives it once per list row of its notice.
    """
    needed = detail.select("documentId", "section2")
    if not repeat:
        return explode_criteria(rows_in(needed, categorised, "documentId", "cNoticeId"))
    ids = categorised.select(F.col("cNoticeId").alias("_list_id"))
    return explode_criteria(detail_join(needed, ids, "documentId", "_list_id"))


def criteria_in_category(criteria: DataFrame, categorised: DataFrame, category: str) -> DataFrame:
    """Criteria joined to the list rows of one category."""
    return detail_join(
        criteria, categorised.where(F.col("category") == category), "documentId", "cNoticeId"
    )


def green_energy_criteria(criteria: DataFrame, categorised: DataFrame) -> DataFrame:
    """Green-energy criteria of notices in the energy category."""
    named = criteria.where(F.col("noticeAwardCriteriaName") == V.GREEN_ENERGY_NAME)
    return criteria_in_category(named, categorised, V.ENERGY_CATEGORY)
