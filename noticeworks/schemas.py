"""Declared schema of every table and of every JSON text that gets parsed."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _L, _I, _D, _B = StringType(), LongType(), IntegerType(), DoubleType(), BooleanType()

PROCEDURE_STATE = _struct(id=_I, text=_S)

NOTICE_LIST = _struct(
    cNoticeId=_L,
    noticeId=_L,
    procedureId=_L,
    noticeNo=_S,
    sysNoticeTypeId=_I,
    sysNoticeState=_S,
    contractingAuthorityNameAndFN=_S,
    contractTitle=_S,
    sysAcquisitionContractType=_S,
    sysProcedureType=_S,
    sysContractAssigmentType=_S,
    cpvCodeAndName=_S,
    estimatedValueRon=_D,
    isOnline=_B,
    hasLots=_B,
    noticeStateDate=_S,
    minTenderReceiptDeadline=_S,
    maxTenderReceiptDeadline=_S,
    errataNo=_S,
    sysNoticeVersionId=_I,
    tenderReceiptDeadlineExport=_S,
    estimatedValueExport=_S,
    sadId=_L,
    hasAppeal=_B,
    sysProcedureState=PROCEDURE_STATE,
)

# Notice list as landed: the publication date is what orders duplicates.
LANDED_NOTICE = StructType(NOTICE_LIST.fields + [StructField("publicationDate", _S, True)])

LIST_PAGE = _struct(total=_L, items=ArrayType(LANDED_NOTICE))

# The 24 list columns kept in the silver list, all as text, before the state text.
LIST_COLUMNS = [f.name for f in NOTICE_LIST.fields if f.name != "sysProcedureState"]

NOTICE_DETAIL = _struct(
    documentId=_S, generalInfo=_S, section1=_S, section2=_S, section3=_S, section4=_S, section6=_S
)

RESTRICTION_FLAGS = ["restrictedToShelterdWorkshop", "isReservedContract", "restrictedToPrograms"]

CRITERION = _struct(
    noticeID=_L,
    lotID=_L,
    noticeAwardCriteriaID=_L,
    directProportional=_B,
    noticeAwardCriteriaName=_S,
    noticeAwardCriteriaDescription=_S,
    algorithmDescription=_S,
    noticeAwardCriteriaOrder=_I,
    noticeAwardCriteriaWeight=_D,
    isElectronicCriteria=_B,
    isFrameworkAgreementCriteria=_B,
)

SECTION2 = _struct(
    section22=_struct(shortDescription=_S, noticeAwardCriteriaList=ArrayType(CRITERION))
)

# The same section with every criterion as a map, to see which keys it has.
SECTION2_KEYS = _struct(section22=_struct(noticeAwardCriteriaList=ArrayType(MapType(_S, _S))))

CRITERIA_TABLE = StructType(
    [StructField("documentId", _S, True), StructField("short_description", _S, True)] + CRITERION.fields
)

CATEGORY_LIST = _struct(
    cNoticeId=_S, contractTitle=_S, cpvCodeAndName=_S, category=_S, status=_I, value_estimate=_D
)

CATEGORY_MAP = MapType(_S, ArrayType(_S))

BIDDERS_RAW = _struct(documentId=_S, central_data=_S, statements=_S, participation=_S)

PARTICIPANT = _struct(
    statementSupplierId=_S,
    statementParticipantId=_S,
    sysProcedureSupplierClass=_S,
    contractPercent=_D,
    isLead=_B,
    fiscalNumber=_S,
    name=_S,
    tradeRegisterNumber=_S,
    representativeName=_S,
    sysSupplierCategory=_S,
    isGenerated=_B,
    entityId=_S,
    validationErrors=_S,
)

STATEMENT = _struct(
    versionNo=_I,
    statementSuppliers=ArrayType(_struct(statementParticipants=ArrayType(PARTICIPANT))),
)

PARTICIPATION = ArrayType(STATEMENT)
VERSIONS = ArrayType(_struct(versionNo=_I))

BIDDERS = StructType(
    PARTICIPANT.fields
    + _struct(documentId=_S, fiscalNumber_numeric=_S, is_social_enterprise=_B).fields
)

STATEMENT_LIST = ArrayType(_struct(procedureStatementId=_L))

AWARDS_RAW = _struct(documentId=_S, caNoticeId=_S, award_info=_S)

MODEL_CRITERIA = _struct(
    criteria=MapType(
        _S, _struct(id=_L, text=_S, product_group_subjects=ArrayType(_struct(product_group_id=_I)))
    )
)

ATTACHMENT_LIST = _struct(
    dfNoticeDocs=ArrayType(_struct(noticeDocumentUrl=_S, noticeDocumentName=_S))
)

RESPONSE = _struct(
    match=_S,
    criteria_from_actual_contract_in_original_romanian=_S,
    criteria_from_actual_contract_translated_in_english=_S,
)

REGISTRY = _struct(fiscalNumber=_S)
