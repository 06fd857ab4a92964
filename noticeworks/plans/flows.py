"""The table flows: landed data -> bronze -> silver -> category, criteria and report tables.

Table names are arguments of ``Tables``; the names used here are relative to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeworks import fixed_values as V
from noticeworks import schemas
from noticeworks.functions import dates
from noticeworks.operators import bidders, categories, criteria, matching, notices, reports, sampling, worklist
from noticeworks.sources import files
from noticeworks.sources.tables import Tables, enforce, small_table

MAPPINGS = {
    "social": V.SOCIAL_CATEGORIES,
    "enterprise": V.ENTERPRISE_CATEGORIES,
    "infra": V.INFRA_CATEGORIES,
}


def notice_list(tables: Tables, pages: str) -> None:
    """Landed result pages -> one row per notice."""
    landed = files.read_list_pages(tables.spark, pages)
    tables.overwrite(notices.dedupe_list(landed).drop("_page", "_line", "_pos", "total"), "notice_list")


def detail_worklist(tables: Tables, types: list[int] = V.DETAIL_NOTICE_TYPES) -> DataFrame:
    """Notices whose detail has not landed."""
    wanted = notices.of_types(tables.read("notice_list"), types).select("cNoticeId", "sysNoticeTypeId")
    return worklist.remaining(wanted, tables.read("notice_detail"), "cNoticeId", "documentId")


def bidder_worklist(tables: Tables) -> DataFrame:
    """Awarded participation notices whose bidders have not landed."""
    wanted = notices.awarded(tables.read("notice_list"), V.PARTICIPATION_TYPE)
    return worklist.remaining(wanted, tables.read("bidders_raw"), "cNoticeId", "documentId")


def award_worklist(tables: Tables) -> DataFrame:
    """Details of awarded participation notices with the id of their award notice."""
    wanted = notices.awarded(tables.read("notice_list"), V.PARTICIPATION_TYPE)
    return notices.award_ids(tables.read("notice_detail"), wanted)


def restrict_detail(tables: Tables, types: list[int] = V.DETAIL_NOTICE_TYPES) -> None:
    """Drops details of other notice types from the detail table."""
    kept = notices.restrict_detail(tables.read("notice_detail"), tables.read("notice_list"), types)
    tables.replace(kept, "notice_detail")


def silver_list(tables: Tables) -> None:
    silver = notices.silver_list(tables.read("notice_list"), tables.read("notice_detail"))
    tables.overwrite(silver, "notice_list_silver")


def reserved_report(tables: Tables, url_base: str, path: str, any_flag: bool = False) -> None:
    files.write_csv(notices.reserved_report(tables.read("notice_list_silver"), url_base, any_flag), path)


def category_tables(tables: Tables, name: str, pairs: DataFrame | None = None, mode: str = "all", repeat: bool = False) -> None:
    """``<name>_list`` and ``<name>_criteria`` for one category mapping."""
    if pairs is None:
        pairs = files.category_pairs(tables.spark, MAPPINGS[name])
    listed = notices.category_list(tables.read("notice_list"))
    matched = categories.categorise(listed, pairs, "cpvCodeAndName", mode)
    tables.overwrite(enforce(matched, schemas.CATEGORY_LIST), f"{name}_list")
    found = criteria.criteria_of(tables.read("notice_detail"), tables.read(f"{name}_list"), repeat)
    tables.overwrite(enforce(found, schemas.CRITERIA_TABLE), f"{name}_criteria")


def bidders_silver(tables: Tables, registry: DataFrame, registry_column: str = "fiscalNumber") -> None:
    silver = bidders.bidders_silver(tables.read("bidders_raw"), registry, registry_column)
    tables.overwrite(enforce(silver, schemas.BIDDERS), "bidders_silver")


def social_enterprises_in_social_contracts(tables: Tables, matched: DataFrame, id_column: str) -> DataFrame:
    """How many bidders of matched contracts are social enterprises, and how many are not."""
    split = bidders.participation_split(tables.read("bidders_silver"), matched, id_column)
    return reports.value_counts(split.where("social_contract"), "is_social_enterprise")


def matched_criteria(tables: Tables, path: str, schema: StructType, id_column: str, url_base: str) -> None:
    """Matched criteria exported as CSV -> table with the notice URL."""
    matched = files.read_csv(tables.spark, path, schema, multi_line=True)
    tables.overwrite(matching.with_url(matched, id_column, url_base), "matched_criteria")


def samples(tables: Tables, name: str, folder: str) -> None:
    """One CSV folder of sampled criteria per sample category."""
    drawn = sampling.sample_criteria(
        tables.read(f"{name}_criteria"),
        tables.read(f"{name}_list"),
        V.SAMPLE_CATEGORIES,
        V.AWARDED_ID,
        V.SAMPLE_SIZE,
        V.SAMPLE_SEED,
    )
    drawn.write.mode("overwrite").partitionBy("category").csv(folder, header=True, escape='"')


def _energy_criteria(tables: Tables, model_path: str) -> tuple[DataFrame, DataFrame]:
    """Green-energy criteria, and the model criteria for energy out of their file."""
    model = matching.model_criteria_of_groups(
        files.read_model_criteria(tables.spark, model_path), V.ENERGY_PRODUCT_GROUPS
    )
    return criteria.green_energy_criteria(tables.read("infra_criteria"), tables.read("infra_list")), model


def energy_prompts(tables: Tables, model_path: str) -> DataFrame:
    """Prompts matching the algorithms of green-energy criteria to the model criteria for energy."""
    energy, model = _energy_criteria(tables, model_path)
    return matching.prompts_of(energy, matching.taxonomy_text(model, "id", "text"), "algorithmDescription")


def energy_matches(tables: Tables, model_path: str, scorer: matching.Scorer | None = None) -> DataFrame:
    """Green-energy criteria with the model criterion they match; see ``matched``."""
    energy, model = _energy_criteria(tables, model_path)
    if scorer is not None:
        return matched(energy_prompts(tables, model_path), scorer)
    model = model.select(F.col("id").cast("string").alias("match"), "text")
    return matched(energy, None, "algorithmDescription", model, "match", "text")


def matched(
    rows: DataFrame,
    scorer: matching.Scorer | None,
    content: str | None = None,
    taxonomy: DataFrame | None = None,
    entry_key: str | None = None,
    entry_content: str | None = None,
) -> DataFrame:
    """documentId, noticeAwardCriteriaID, status, match, overlap, jaccard and the two texts of a response.

    With a scorer: its answers to the column ``prompt``, read and given a status; no overlap. Without: the
    entry that shares most words with ``content``, and the status ``ok`` or ``no_match``; no texts.
    """
    ids = ["documentId", "noticeAwardCriteriaID"]
    texts = V.RESPONSE_KEYS[1:]
    if scorer is not None:
        answered = matching.score_distinct(rows.select(*ids, "prompt"), "prompt", scorer).drop("prompt")
        read = matching.read_responses(answered, "response")
        none = [F.lit(None).cast("long").alias("overlap"), F.lit(None).cast("double").alias("jaccard")]
        return read.select(*ids, "status", "match", *none, *texts)
    keyed = rows.select(F.struct(*ids).alias("_ids"), F.col(content).alias("_content"))
    best = matching.best_match(keyed, "_ids", "_content", taxonomy, entry_key, entry_content)
    status = F.when(F.col("overlap").isNull(), "no_match").otherwise("ok").alias("status")
    none = [F.lit(None).cast("string").alias(c) for c in texts]
    return best.select("_ids.*", status, F.col(entry_key).alias("match"), "overlap", "jaccard", *none)


def social_taxonomy(spark: SparkSession) -> DataFrame:
    """(title, definition) of the social taxonomy."""
    return small_table(spark, title=list(V.SOCIAL_TAXONOMY), definition=list(V.SOCIAL_TAXONOMY.values()))


def social_prompts(tables: Tables) -> DataFrame:
    """Prompts matching social criteria to the social taxonomy."""
    return matching.prompts(
        tables.read("social_criteria"),
        matching.taxonomy_literal(V.SOCIAL_TAXONOMY),
        "noticeAwardCriteriaName",
        "noticeAwardCriteriaDescription",
        "algorithmDescription",
    )


def social_matches(tables: Tables, scorer: matching.Scorer | None = None) -> DataFrame:
    """Social criteria with the taxonomy entry they match; see ``matched``."""
    if scorer is not None:
        return matched(social_prompts(tables), scorer)
    parts = ["noticeAwardCriteriaName", "noticeAwardCriteriaDescription", "algorithmDescription"]
    rows = tables.read("social_criteria").withColumn("content", F.concat_ws(" ", *parts))
    return matched(rows, None, "content", social_taxonomy(tables.spark), "title", "definition")


def month_report(tables: Tables, pages: str, day: str = "publicationDate", cap: int = V.RESULT_CAP) -> DataFrame:
    """The fixed months, with the notices landed for each and the total that the pages state."""
    months = dates.windows(tables.spark, V.FIRST_MONTH, V.LAST_MONTH)
    return reports.month_report(months, files.read_list_pages(tables.spark, pages), day, cap)
