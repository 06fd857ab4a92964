"""Notice, detail and bidder tables derived from the order tables, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeworks.functions.json_text import to_text

CODES = ["77314000", "45112710", "45233290", "15000000", "33100000", "39100000", "09300000", "65000000"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def notices(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a notice list. F orders are awarded; a few notices have no code."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    known = F.element_at(F.array(*[F.lit(c) for c in CODES]), (key % 8 + 1).cast("int"))
    spread = F.lpad(((key * 7919 + cust * 104729) % 100000000).cast("string"), 8, "0")
    code = F.when(cust % 4 == 0, known).otherwise(spread)
    state = F.struct(
        F.when(F.col("o_orderstatus") == "F", 5).otherwise(2).alias("id"),
        F.when(F.col("o_orderstatus") == "F", "Atribuita").otherwise("In desfasurare").alias("text"),
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, folder, "orders").select(
        key.alias("cNoticeId"),
        (key + 1).alias("noticeId"),
        (key * 10).alias("procedureId"),
        F.concat(F.lit("CN"), key).alias("noticeNo"),
        F.when(F.col("o_orderpriority") < "3", 2)
        .when(F.col("o_orderpriority") < "4", 7)
        .otherwise(12)
        .alias("sysNoticeTypeId"),
        F.col("o_orderstatus").alias("sysNoticeState"),
        F.concat(F.lit("Authority "), cust).alias("contractingAuthorityNameAndFN"),
        F.concat(F.lit("Contract "), key).alias("contractTitle"),
        F.lit("Services").alias("sysAcquisitionContractType"),
        F.col("o_orderpriority").alias("sysProcedureType"),
        F.lit(None).cast("string").alias("sysContractAssigmentType"),
        F.when(key % 97 != 0, F.concat(code, F.lit("-"), key % 10, F.lit(" item"))).alias("cpvCodeAndName"),
        F.col("o_totalprice").alias("estimatedValueRon"),
        (key % 2 == 0).alias("isOnline"),
        (key % 3 == 0).alias("hasLots"),
        day.alias("noticeStateDate"),
        day.alias("minTenderReceiptDeadline"),
        day.alias("maxTenderReceiptDeadline"),
        F.lit(None).cast("string").alias("errataNo"),
        F.lit(1).alias("sysNoticeVersionId"),
        day.alias("tenderReceiptDeadlineExport"),
        F.col("o_totalprice").cast("string").alias("estimatedValueExport"),
        (cust + 7).alias("sadId"),
        F.when(key % 5 != 0, key % 5 == 1).alias("hasAppeal"),
        state.alias("sysProcedureState"),
        day.alias("publicationDate"),
    )


def month_pages(listed: DataFrame, day: str, size: int, more: Column) -> DataFrame:
    """Result pages of at most ``size`` notices of one month, each with the month's number of notices plus ``more`` (of
    ``month``) as ``total``.

    Notices are numbered within their month and input split, so no task holds a whole month.
    """
    month = F.trunc(F.to_date(day), "MM")
    split = listed.select(month.alias("month"), F.spark_partition_id().alias("_split"), F.struct(*listed.columns).alias("item"))
    place = F.row_number().over(Window.partitionBy("month", "_split").orderBy("item.cNoticeId"))
    pages = (
        split.withColumn("_page", F.floor((place - 1) / size))
        .groupBy("month", "_split", "_page")
        .agg(F.collect_list("item").alias("items"))
    )
    totals = listed.groupBy(month.alias("month")).agg(F.count("*").alias("_n"))
    stated = (F.col("_n") + more).alias("total")
    return pages.join(totals, "month", "left").select(stated, "items")


def criteria_json(key: Column, n: Column, priority: Column, other: Column, section: Column) -> Column:
    """Section 2 text with ``n`` criteria; ``section`` false gives a null criteria section."""

    def criterion(i: Column) -> Column:
        return F.struct(
            key.alias("noticeID"),
            i.alias("lotID"),
            (key * 10 + i).alias("noticeAwardCriteriaID"),
            (i % 2 == 0).alias("directProportional"),
            F.when(i == 1, "Energie verde").otherwise("Garantie").alias("noticeAwardCriteriaName"),
            F.concat(priority, F.lit(" "), i).alias("noticeAwardCriteriaDescription"),
            F.when(other % 3 != 0, F.concat(F.lit("points "), other % 100)).alias("algorithmDescription"),
            i.cast("int").alias("noticeAwardCriteriaOrder"),
            (i * 12.5).alias("noticeAwardCriteriaWeight"),
            F.lit(True).alias("isElectronicCriteria"),
            F.lit(None).cast("boolean").alias("isFrameworkAgreementCriteria"),
        )

    numbers = F.when(n > 0, F.sequence(F.lit(1).cast("long"), n.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    body = F.struct(
        priority.alias("shortDescription"),
        F.transform(numbers, criterion).alias("noticeAwardCriteriaList"),
    )
    return to_text(F.struct(F.when(section, body).alias("section22")))


def details(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as detail documents.

    Missing, malformed, null and empty sections occur, and such with a weight that is no number, without a key, or
    with words behind the JSON value.
    """
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    section = (F.col("o_orderstatus") != "P") | (cust % 5 != 0)
    section2 = criteria_json(key, key % 4, F.col("o_orderpriority"), cust, section)
    section2 = F.when(key % 107 == 0, F.replace(section2, F.lit('Weight":12.5,'), F.lit('Weight":"12,5",'))).otherwise(section2)
    section2 = F.when(key % 109 == 0, F.replace(section2, F.lit('"isElectronicCriteria":true,'), F.lit(""))).otherwise(section2)
    section2 = F.when(key % 113 == 0, F.concat(section2, F.lit(" as sent"))).otherwise(section2)
    flags = F.struct(
        F.when(key % 6 != 0, key % 7 == 0).alias("restrictedToShelterdWorkshop"),
        (key % 9 == 0).alias("isReservedContract"),
        (key % 4 == 0).alias("restrictedToPrograms"),
    )
    general = F.struct((key + 5).alias("dfNoticeId"), (key * 3).alias("caNoticeId"))
    labels = F.when(
        key % 2 == 0,
        to_text(F.struct(F.lit("a").alias("personalSituation"), F.lit("b").alias("tpCriteriaQAStandard"))),
    ).otherwise(to_text(F.struct(F.lit("c").alias("tpCriteriaQAStandardMin"), F.lit("d").alias("contact"))))
    return table(spark, folder, "orders").select(
        key.cast("string").alias("documentId"),
        F.when(key % 8 == 0, F.lit("{}")).otherwise(to_text(general)).alias("generalInfo"),
        labels.alias("section1"),
        F.when(key % 101 == 0, F.lit("not json"))
        .when(key % 103 != 0, section2)
        .alias("section2"),
        F.when(cust % 11 == 0, F.lit("{}")).otherwise(to_text(flags)).alias("section3"),
        F.lit("{}").alias("section4"),
        F.lit("{}").alias("section6"),
    )


def bidders_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as participation documents.

    Versions run from 0 to ``o_orderkey % 3`` and the highest comes twice, so a third of
    the documents has no valid version and the others have a tie for the last element.
    """
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    last = (key % 3).cast("int")

    def participant(version: Column, copy: int, supplier: int) -> Column:
        fiscal = F.concat(F.lit("RO "), cust + supplier * 3 + copy)
        return F.struct(
            (key * 10 + supplier).cast("string").alias("statementSupplierId"),
            (key * 100 + supplier * 10 + version).cast("string").alias("statementParticipantId"),
            F.lit("class").alias("sysProcedureSupplierClass"),
            F.lit(62.5 if supplier == 1 else 37.5).alias("contractPercent"),
            F.lit(supplier == 1).alias("isLead"),
            F.when(cust % 13 != 0, fiscal).alias("fiscalNumber"),
            F.concat(F.lit("Bidder "), cust).alias("name"),
        )

    def statement(version: Column, copy: int) -> Column:
        first, second = (
            F.struct(F.array(participant(version, copy, supplier)).alias("statementParticipants")) for supplier in (1, 2)
        )
        suppliers = F.array_compact(F.array(first, F.when(cust % 2 == 1, second)))
        return F.struct(version.alias("versionNo"), suppliers.alias("statementSuppliers"))

    numbered = [F.when(last >= v, statement(F.lit(v), 0)) for v in range(3)]
    versions = F.array_compact(F.array(*numbered, statement(last, 1)))
    return table(spark, folder, "orders").select(
        key.cast("string").alias("documentId"),
        to_text(F.struct((key * 10).alias("procedureId"))).alias("central_data"),
        to_text(F.array(F.struct((key * 2).alias("procedureStatementId")))).alias("statements"),
        to_text(versions).alias("participation"),
    )
