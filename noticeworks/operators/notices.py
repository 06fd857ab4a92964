"""Notice list and notice detail: bronze, silver, reserved contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import fixed_values as V
from noticeworks import schemas
from noticeworks.functions import json_text, text
from noticeworks.operators.joins import detail_join, rows_in
from noticeworks.operators.ranking import keep_first


def newest_first(date: str = "publicationDate", value: str = "estimatedValueRon") -> list[Column]:
    """The order in which the source delivers notices."""
    return [F.col(date).desc_nulls_last(), F.col(value).desc_nulls_last()]


def dedupe_list(landed: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per notice id: the first delivered.

    The default order takes landing position (``_page``, ``_line``, ``_pos``) where the rows
    carry it, else the order asked of the source; there a hash of the row decides between equals.
    """
    if order is None:
        positions = [F.col(c) for c in ("_page", "_line", "_pos") if c in landed.columns]
        order = positions or [*newest_first(), F.xxhash64(*landed.columns)]
    return keep_first(landed, ["cNoticeId"], order)


def as_text(notices: DataFrame) -> DataFrame:
    """The 24 list columns as text plus the text of the procedure state."""
    return notices.select(
        *[F.col(c).cast("string").alias(c) for c in schemas.LIST_COLUMNS],
        F.col("sysProcedureState.text").alias("sysProcedureStateText"),
    )


def awarded(notices: DataFrame, notice_type: str | None = None) -> DataFrame:
    """Awarded notices as text, of one notice type if given."""
    state = F.col("sysProcedureState.text") == V.AWARDED_TEXT
    if notice_type is not None:
        state = state & (F.col("sysNoticeTypeId").cast("string") == notice_type)
    return as_text(notices.where(state))


def of_types(notices: DataFrame, types: list[int]) -> DataFrame:
    return notices.where(F.col("sysNoticeTypeId").isin(types))


def restrict_detail(detail: DataFrame, notices: DataFrame, types: list[int]) -> DataFrame:
    """Detail documents of notices of the given types."""
    return rows_in(detail, of_types(notices, types), "documentId", "cNoticeId")


def restriction_flags(detail: DataFrame) -> DataFrame:
    """documentId and the three restriction flags of section 3, parsed once."""
    parsed = json_text.flags(F.col("section3"), schemas.RESTRICTION_FLAGS)
    # As a generator the text is parsed once, also when the flags are filtered on.
    return detail.select("documentId", F.inline(F.array(parsed)))


def silver_list(notices: DataFrame, detail: DataFrame) -> DataFrame:
    """Awarded notices with their restriction flags."""
    return detail_join(awarded(notices), restriction_flags(detail), "cNoticeId", "documentId")


def reserved_report(silver: DataFrame, url_base: str, any_flag: bool = False) -> DataFrame:
    """Reserved contracts with their URL.

    By default the sheltered-workshop flag alone decides; ``any_flag`` takes all three.
    """
    names = schemas.RESTRICTION_FLAGS if any_flag else schemas.RESTRICTION_FLAGS[:1]
    return silver.where(json_text.any_true(*[F.col(n) for n in names])).select(
        "cNoticeId",
        "restrictedToShelterdWorkshop",
        "restrictedToPrograms",
        text.notice_url(F.col("cNoticeId"), url_base).alias("URL"),
    )


def category_list(notices: DataFrame) -> DataFrame:
    """Columns of the category lists, before a category is assigned."""
    return notices.select(
        "cNoticeId",
        "contractTitle",
        "cpvCodeAndName",
        F.col("sysProcedureState.id").alias("status"),
        F.col("estimatedValueRon").try_cast("double").alias("value_estimate"),
    )


def attachments(lists: DataFrame, column: str = "filelist") -> DataFrame:
    """One row per attachment named in the file lists, with its unwrapped name."""
    docs = F.explode(json_text.parse(F.col(column), schemas.ATTACHMENT_LIST)["dfNoticeDocs"])
    return inventory(
        lists.select("documentId", docs.alias("_doc")).select(
            "documentId",
            F.col("_doc.noticeDocumentUrl").alias("url"),
            F.col("_doc.noticeDocumentName").alias("name"),
        ),
        "name",
    )


def inventory(files: DataFrame, name: str) -> DataFrame:
    """Adds ``signed`` and, for signed files, the name without the signature suffix."""
    signed = text.has_suffix(F.col(name), V.SIGNED_SUFFIXES)
    return files.withColumns(
        {
            "signed": signed,
            "unwrapped_name": F.when(signed, text.strip_extension(F.col(name))).otherwise(F.col(name)),
        }
    )


def award_ids(detail: DataFrame, wanted: DataFrame) -> DataFrame:
    """Details of the wanted notices with the id of their award notice, in id order."""
    return (
        rows_in(detail.select("documentId", "generalInfo"), wanted, "documentId", "cNoticeId")
        .select("documentId", json_text.field(F.col("generalInfo"), "caNoticeId").alias("caNoticeId"))
        .orderBy("documentId")
    )


def detail_requests(detail: DataFrame, key: str = "dfNoticeId", column: str = "generalInfo") -> DataFrame:
    """The id the detail sections are requested with; a default where the document has none."""
    wanted = json_text.field_or_default(F.col(column), key, V.DEFAULT_DOCUMENT_ID)
    return detail.select("documentId", wanted.alias(key))


def statements(raw: DataFrame) -> DataFrame:
    """Statement ids listed in the procedure reports."""
    ids = json_text.parse(F.col("statements"), schemas.STATEMENT_LIST)
    return raw.select("documentId", F.explode(ids).alias("_s")).select(
        "documentId", F.col("_s.procedureStatementId").alias("procedureStatementId")
    )
