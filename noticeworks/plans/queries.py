"""Every operator as a query over the driver tables: ``QUERIES[name](spark, folder)``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from noticeworks import fixed_values as V
from noticeworks.functions import dates, json_text, text
from noticeworks.operators import (
    audit,
    bidders,
    categories,
    criteria,
    joins,
    matching,
    notices,
    ranking,
    reports,
    sampling,
    worklist,
)
from noticeworks.plans import flows, standins
from noticeworks.plans.standins import table
from noticeworks.session import scratch_dir
from noticeworks.sources import files
from noticeworks.sources.tables import Tables, enforce
from noticeworks.streaming import incremental

URL_BASE = "https://notices.example/view/"

NAME_PREFIXES = {
    "Little things": ["small", "small r"],
    "Red and rings": ["red", "small ring"],
    "Temperature": ["hot", "cold", "cold b"],
    "Age": ["old", "new"],
}

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Categories and criteria


@query
def criteria_by_category(spark: SparkSession, folder: str) -> DataFrame:
    """Parts by category, their order lines as criteria: rows and distinct parts per category."""
    pairs = files.category_pairs(spark, NAME_PREFIXES)
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    listed = categories.categorise(parts, pairs, "p_name", "distinct_category")
    # Lines are counted per part before the join, so a part that holds a large share of
    # all lines is collapsed within the map tasks.
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    )
    return (
        listed.join(lines, F.col("p_partkey") == F.col("l_partkey"))
        .groupBy("category")
        .agg(
            F.sum("lines").alias("n_criteria"),
            F.count("*").alias("n_parts"),
            F.sum("quantity").alias("total_quantity"),
        )
    )


@query
def prefix_category_all(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return categories.categorise(parts, files.category_pairs(spark, NAME_PREFIXES), "p_name")


@query
def prefix_category_distinct(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    pairs = files.category_pairs(spark, NAME_PREFIXES)
    return categories.categorise(parts, pairs, "p_name", "distinct_category").select("p_partkey", "category")


@query
def prefix_category_wide(spark, folder):
    """A map that grows with the data: every supplier key is a prefix of order keys."""
    pairs = table(spark, folder, "supplier").select(
        F.concat(F.lit("nation "), "s_nationkey").alias("category"), F.col("s_suppkey").cast("string").alias("prefix")
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("code"))
    return categories.categorise(orders, pairs, "code")


def _listed(spark, folder, name, mode="all"):
    listed = notices.category_list(standins.notices(spark, folder))
    return categories.categorise(
        listed, files.category_pairs(spark, flows.MAPPINGS[name]), "cpvCodeAndName", mode
    )


@query
def categories_social(spark, folder):
    return _listed(spark, folder, "social")


@query
def categories_enterprise(spark, folder):
    return _listed(spark, folder, "enterprise")


@query
def categories_infra(spark, folder):
    return _listed(spark, folder, "infra")


@query
def criteria_social(spark, folder):
    """Criteria of notices in a social category, each once."""
    return criteria.criteria_of(standins.details(spark, folder), _listed(spark, folder, "social"))


@query
def criteria_enterprise(spark, folder):
    return criteria.criteria_of(standins.details(spark, folder), _listed(spark, folder, "enterprise"))


@query
def criteria_social_repeated(spark, folder):
    """Criteria once per list row of their notice."""
    listed = _listed(spark, folder, "social")
    found = criteria.criteria_of(standins.details(spark, folder), listed, repeat=True)
    return reports.value_counts(found, "documentId")


@query
def criteria_explode(spark, folder):
    """Order lines as criteria sections: packed to JSON text, parsed, exploded."""
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    section = standins.criteria_json(
        key, number % 3, F.col("l_returnflag"), F.col("l_partkey"), F.col("l_linestatus") == "O"
    )
    details = table(spark, folder, "lineitem").select(
        key.cast("string").alias("documentId"), F.col("l_suppkey"), section.alias("section2")
    )
    return criteria.explode_criteria(details, keep=["l_suppkey"])


@query
def energy_criteria(spark, folder):
    listed = _listed(spark, folder, "infra")
    found = criteria.criteria_of(standins.details(spark, folder), listed)
    return criteria.green_energy_criteria(found, listed).select(
        "documentId", "noticeAwardCriteriaName", "algorithmDescription", "category", "value_estimate"
    )


# Notice list and silver


@query
def awarded_list(spark, folder):
    return notices.awarded(standins.notices(spark, folder), V.PARTICIPATION_TYPE).orderBy("cNoticeId")


@query
def dedupe_keep_first(spark, folder):
    order = [F.col("l_shipdate").desc(), F.col("l_extendedprice").desc(), F.col("l_partkey"), F.col("l_suppkey")]
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    first = ranking.keep_first(lines, ["l_orderkey", "l_linenumber"], order)
    return first.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query
def landed_pages(spark, folder):
    """The same notices on pages 2 and 10, and twice, line after line, in one file of page 2: the first line stays."""
    path = scratch_dir(spark, "pages")
    listed = standins.notices(spark, folder)
    item = F.struct(*listed.columns)

    def page(number, *titles):
        lines = F.array(*[F.array(item.withField("contractTitle", F.concat("contractTitle", F.lit(t)))) for t in titles])
        pages = listed.select(F.explode(lines).alias("items")).select(F.lit(2).alias("total"), "items")
        pages.write.json(f"{path}/page_{number}", compression="snappy")

    page(10, " (page 10)")
    page(2, "", " (again)")
    pages = files.read_list_pages(spark, f"{path}/*")
    return notices.dedupe_list(pages).select(
        "cNoticeId", "contractTitle", "total", F.col("sysProcedureState.id").alias("state_id")
    )


@query
def restricted_detail(spark, folder):
    """Details of notices of types 2 and 7."""
    kept = notices.restrict_detail(
        standins.details(spark, folder), standins.notices(spark, folder), V.DETAIL_NOTICE_TYPES
    )
    return kept.select("documentId", "section3")


@query
def silver_list(spark, folder):
    silver = notices.silver_list(standins.notices(spark, folder), standins.details(spark, folder))
    return silver.select(
        "cNoticeId",
        "contractTitle",
        "estimatedValueRon",
        "sysProcedureStateText",
        "restrictedToShelterdWorkshop",
        "isReservedContract",
        "restrictedToPrograms",
    )


@query
def reserved_report(spark, folder):
    silver = notices.silver_list(standins.notices(spark, folder), standins.details(spark, folder))
    return notices.reserved_report(silver, URL_BASE)


@query
def reserved_any_flag(spark, folder):
    silver = notices.silver_list(standins.notices(spark, folder), standins.details(spark, folder))
    return notices.reserved_report(silver, URL_BASE, any_flag=True).select("cNoticeId")


@query
def detail_join(spark, folder):
    """Orders with their number of lines; the line side's own price column gives way."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("n_lines"), F.max("l_extendedprice").alias("o_totalprice"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return joins.detail_join(orders, lines, "o_orderkey", "l_orderkey")


@query
def semi_awarded_lines(spark, folder):
    awarded = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.rows_in(lines, awarded, "l_orderkey", "o_orderkey")


@query
def anti_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.rows_not_in(orders, table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey")


@query
def type_date_filter(spark, folder):
    orders = table(spark, folder, "orders")
    picked = orders.where(
        F.col("o_orderstatus").isin("F", "P") & dates.in_range(F.col("o_orderdate"), "1996-01-01", "1996-12-31")
    )
    return picked.select("o_orderkey", "o_orderstatus").orderBy("o_orderkey")


@query
def newest_first(spark, folder):
    """The whole list by date and value descending, as the source delivers notices; the id decides between equals."""
    listed = standins.notices(spark, folder).select("publicationDate", "cNoticeId", "estimatedValueRon")
    return listed.orderBy(*notices.newest_first(), "cNoticeId")


@query
def nested_field(spark, folder):
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    state = F.struct(F.col("o_orderstatus").alias("text"), price.alias("value"))
    packed = table(spark, folder, "orders").select("o_orderkey", state.alias("state"))
    return packed.select(
        "o_orderkey",
        F.col("state.text").alias("state_text"),
        F.col("state.value").try_cast("double").alias("state_value"),
    )


@query
def notice_url(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", text.notice_url(F.col("o_orderkey"), URL_BASE).alias("url"))


@query
def union_pages(spark, folder):
    """Two result pages that overlap: all orders, and those that are awarded once more."""
    listed = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return listed.unionByName(listed.where("o_orderstatus = 'F'"))


@query
def head_slice(spark, folder):
    return sampling.head(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100)


# JSON text


@query
def json_flag(spark, folder):
    """Flags of a JSON text: true, false, null and missing keys."""
    key = F.col("event_id")
    body = (
        F.when(key % 4 == 0, F.lit('{"a": true, "b": false}'))
        .when(key % 4 == 1, F.lit('{"a": null}'))
        .when(key % 4 == 2, F.lit('{"b": true}'))
        .otherwise(F.col("props"))
    )
    parsed = table(spark, folder, "events").select(key, "props", json_text.flags(body, ["a", "b"]).alias("_f"))
    return parsed.select(
        "event_id",
        json_text.field(F.col("props"), "k").alias("k"),
        json_text.field(F.col("props"), "absent").alias("absent"),
        F.col("_f.a").alias("a"),
        F.col("_f.b").alias("b"),
        json_text.any_true(F.col("_f.a"), F.col("_f.b")).alias("any_flag"),
    )


@query
def json_default(spark, folder):
    key = F.col("event_id")
    body = F.when(key % 3 == 0, F.regexp_replace("props", '"k"', '"z"')).when(key % 3 == 1, '{"z": null}')
    body = body.otherwise(F.col("props"))
    value = json_text.field_or_default(body, "z", V.DEFAULT_DOCUMENT_ID)
    return table(spark, folder, "events").select("event_id", value.alias("z"))


@query
def detail_requests(spark, folder):
    return notices.detail_requests(standins.details(spark, folder))


@query
def award_worklist(spark, folder):
    wanted = notices.awarded(standins.notices(spark, folder), V.PARTICIPATION_TYPE)
    return notices.award_ids(standins.details(spark, folder), wanted)


@query
def statement_ids(spark, folder):
    return notices.statements(standins.bidders_raw(spark, folder))


@query
def json_object_text(spark, folder):
    row = F.struct("c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("nation"))
    return table(spark, folder, "customer").select("c_custkey", json_text.to_text(row).alias("body"))


@query
def field_labels(spark, folder):
    """How often each field of section 1 occurs, with its long label."""
    fields = standins.details(spark, folder).select(F.explode(F.json_object_keys("section1")).alias("field"))
    return reports.with_labels(reports.value_counts(fields, "field"), "field")


# Bidders


@query
def latest_version(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    return ranking.keep_latest(turns, ["conv_id"], "turn", [F.col("role").desc()])


@query
def bidders_silver(spark, folder):
    registry = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("fiscalNumber"))
    silver = bidders.bidders_silver(standins.bidders_raw(spark, folder), registry)
    return silver.select(
        "documentId",
        "statementSupplierId",
        "statementParticipantId",
        "contractPercent",
        "isLead",
        "fiscalNumber",
        "fiscalNumber_numeric",
        "is_social_enterprise",
    )


@query
def participant_flag(spark, folder):
    registry = table(spark, folder, "supplier").select(text.digits(F.col("s_name")).alias("fiscalNumber"))
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("fiscalNumber"))
    digits = bidders.with_fiscal_digits(customers)
    flagged = joins.flag_in(digits, registry, "fiscalNumber_numeric", "fiscalNumber", "is_social_enterprise")
    return flagged.select("c_custkey", "fiscalNumber_numeric", "is_social_enterprise")


@query
def social_crosstab(spark, folder):
    """Customers with or without an urgent order, by registry membership."""
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    split = joins.flag_in(
        table(spark, folder, "customer").select("c_custkey"), urgent, "c_custkey", "o_custkey", "social_contract"
    )
    flagged = joins.flag_in(split, table(spark, folder, "supplier"), "c_custkey", "s_suppkey", "is_social_enterprise")
    return reports.crosstab(flagged, "social_contract", "is_social_enterprise")


@query
def social_participation(spark, folder):
    """Bidders of notices in a social category: social enterprises and others."""
    registry = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("fiscalNumber"))
    silver = bidders.bidders_silver(standins.bidders_raw(spark, folder), registry)
    split = bidders.participation_split(silver, _listed(spark, folder, "social"), "cNoticeId")
    return reports.value_counts(split.where("social_contract"), "is_social_enterprise")


@query
def participation_halves(spark, folder):
    """Rows on either side of the social / non-social split."""
    raw = bidders.explode_bidders(standins.bidders_raw(spark, folder))
    split = bidders.participation_split(raw, _listed(spark, folder, "social"), "cNoticeId")
    return split.groupBy("social_contract").agg(F.count("*").alias("n"))


# Samples and counts


@query
def sample_ids(spark, folder):
    awarded = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    return sampling.sample_ids(awarded, "o_orderkey", V.SAMPLE_SIZE, V.SAMPLE_SEED)


@query
def sample_rows(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return sampling.sample_rows(lines, "l_orderkey", V.SAMPLE_SIZE, V.SAMPLE_SEED)


@query
def sample_per_category(spark, folder):
    parts = table(spark, folder, "part")
    return sampling.sample_ids_per(parts, "p_type", "p_partkey", V.SAMPLE_SIZE, V.SAMPLE_SEED)


@query
def sample_criteria(spark, folder):
    listed = _listed(spark, folder, "social")
    found = criteria.criteria_of(standins.details(spark, folder), listed)
    drawn = sampling.sample_criteria(
        found, listed, V.SAMPLE_CATEGORIES, V.AWARDED_ID, V.SAMPLE_SIZE, V.SAMPLE_SEED
    )
    return drawn.select("category", "documentId", "noticeAwardCriteriaID")


@query
def value_counts(spark, folder):
    return reports.value_counts(table(spark, folder, "orders"), "o_orderstatus")


@query
def distinct_with_null(spark, folder):
    state = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("state")
    return reports.distinct_with_null(table(spark, folder, "orders").select(state), "state")


@query
def weight_histogram(spark, folder):
    return reports.histogram(table(spark, folder, "lineitem"), "l_quantity", 10, 10)


@query
def window_completeness(spark, folder):
    """Events per day against the expected days."""
    days = dates.windows(spark, "2024-01-01", "2024-02-05", "1 day")
    seen = table(spark, folder, "events").select(F.to_date("ts").alias("day"))
    return reports.completeness(days, seen, "day", cap=340).select("start_text", "end_text", "n", "status")


@query
def month_completeness(spark, folder):
    """Orders per publication month against the expected months."""
    months = dates.windows(spark, "1994-11-01", "2001-10-01")
    seen = table(spark, folder, "orders").select(F.to_date(F.trunc("o_orderdate", "MM")).alias("month"))
    return reports.completeness(months, seen, "month", cap=190).select("start_text", "end_text", "n", "status")


@query
def month_report(spark, folder):
    """Orders, 27 years later, as landed pages of their months; every other month states one notice more than landed."""
    path = scratch_dir(spark, "month-pages")
    later = F.add_months(F.to_date("publicationDate"), 27 * 12)
    listed = standins.notices(spark, folder).withColumn("publicationDate", later.cast("string"))
    pages = standins.month_pages(listed, "publicationDate", V.PAGE_SIZE, F.month("month") % 2)
    pages.write.json(path, compression="snappy")
    report = flows.month_report(Tables(spark, root=path), path, cap=200)
    return report.select("start_text", "end_text", "n", "total", "status")


@query
def saturated_months(spark, folder):
    seen = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return reports.saturated(seen, "month", cap=190)


@query
def resume_worklist(spark, folder):
    wanted = table(spark, folder, "orders").where(F.col("o_orderstatus").isin("F", "P"))
    return worklist.remaining(
        wanted.select("o_orderkey", "o_orderstatus"), table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey"
    )


@query
def dedupe_counts(spark, folder):
    keys = table(spark, folder, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"))
    return audit.duplicates(keys, "key")


@query
def audit_criteria(spark, folder):
    return audit.criteria_sections(standins.details(spark, folder))


@query
def audit_versions(spark, folder):
    return audit.bidder_versions(standins.bidders_raw(spark, folder))


@query
def audit_codes(spark, folder):
    return audit.codes(standins.notices(spark, folder), "cpvCodeAndName")


# Attachments


@query
def attachment_inventory(spark, folder):
    """File lists with one signed, one plain and one odd name per page."""
    page = F.col("page_id")
    stem = F.concat(F.lit("doc.v"), page)
    names = [
        F.concat(stem, F.when(page % 2 == 0, ".pdf.p7m").otherwise(".p7s")),
        F.concat(stem, F.lit(".pdf")),
        F.when(page % 3 == 0, ".hidden").when(page % 3 == 1, "noext").otherwise(".hidden.p7m"),
    ]
    docs = F.array(*[F.struct(F.col("url").alias("noticeDocumentUrl"), n.alias("noticeDocumentName")) for n in names])
    lists = table(spark, folder, "pages").select(
        page.cast("string").alias("documentId"), json_text.to_text(F.struct(docs.alias("dfNoticeDocs"))).alias("filelist")
    )
    return notices.attachments(lists)


@query
def attachment_scan(spark, folder):
    """Documents written as one folder of files per source, read back as binary files."""
    path = scratch_dir(spark, "attachments")
    table(spark, folder, "documents").select("source", "text").write.partitionBy("source").text(path)
    scanned = files.read_attachments(spark, path)
    return scanned.groupBy("documentId").agg(F.sum("length").alias("bytes"))


# Tables


@query
def table_roundtrip(spark, folder):
    """Overwrite, append twice, then replace the table with some of its own rows."""
    tables = Tables(spark, root=scratch_dir(spark, "tables"))
    customers = table(spark, folder, "customer")
    tables.overwrite(customers, "customer")
    tables.append(customers.where("c_nationkey < 10"), "customer")
    tables.append(customers.where("c_nationkey >= 20"), "customer")
    tables.replace(tables.read("customer").where("c_mktsegment <> 'BUILDING'"), "customer")
    return tables.read("customer")


@query
def catalog_roundtrip(spark, folder):
    """The same in catalog tables of a database of its own."""
    name = f"stock_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    tables = Tables(spark, database=name)
    customers = table(spark, folder, "customer")
    tables.overwrite(customers, "customer")
    tables.append(customers.where("c_nationkey < 10"), "customer")
    tables.replace(tables.read("customer").where("c_mktsegment <> 'BUILDING'"), "customer")
    return tables.read("customer")


CUSTOMER_CSV = StructType(
    [StructField(c, StringType(), True) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
)
CUSTOMER = StructType(
    [
        StructField("c_custkey", LongType(), True),
        StructField("c_name", StringType(), True),
        StructField("c_nationkey", IntegerType(), True),
        StructField("c_acctbal", DoubleType(), True),
        StructField("c_mktsegment", StringType(), True),
    ]
)


@query
def csv_roundtrip(spark, folder):
    path = scratch_dir(spark, "csv")
    files.write_csv(table(spark, folder, "customer"), path)
    return enforce(files.read_csv(spark, path, CUSTOMER_CSV), CUSTOMER)


EVENT = StructType(
    [
        StructField("event_id", LongType(), True),
        StructField("user_id", LongType(), True),
        StructField("event_type", StringType(), True),
        StructField("props", StringType(), True),
    ]
)


@query
def incremental_load(spark, folder):
    """Two landing folders with a checkpoint each, loaded into one target in turn; the last run finds nothing new."""
    base = scratch_dir(spark, "incremental")
    target = f"{base}/target"
    rows = table(spark, folder, "events").select(*EVENT.names)

    def run(name):
        incremental.load_new(spark, f"{base}/{name}", target, f"{base}/{name}-checkpoint", EVENT, "event_id")

    def land(name, some):
        some.write.mode("append").json(f"{base}/{name}", compression="snappy")

    land("first", rows.where(F.col("event_type") != "click"))
    run("first")
    land("second", rows.where("event_id % 3 = 0"))
    run("second")
    land("first", rows)
    run("first")
    run("second")
    return incremental.read_target(spark, target, EVENT)


@query
def load_quarantine(spark, folder):
    """Landed lines, some cut off, with words behind them, of wrong types or without an id: each is loaded or kept as it
    landed. A second checkpoint over the same files adds nothing."""
    base = scratch_dir(spark, "quarantine")
    ident = F.col("event_id")
    body = json_text.to_text(F.struct(*EVENT.names))
    line = (
        F.when(ident % 50 == 1, F.substring(body, 1, 20))
        .when(ident % 50 == 2, F.replace(body, F.concat(F.lit('"user_id":'), "user_id"), F.lit('"user_id":"none"')))
        .when(ident % 50 == 3, F.replace(body, F.concat(F.lit('"event_id":'), ident), F.lit('"event_id":null')))
        .when(ident % 50 == 4, F.concat(body, F.lit(" {}")))
        .when(ident % 50 == 5, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(body)
    )
    table(spark, folder, "events").select(line.alias("value")).write.text(f"{base}/landing", compression="snappy")
    for checkpoint in ("first", "lost and made anew"):
        incremental.load_new(spark, f"{base}/landing", f"{base}/target", f"{base}/{checkpoint}", EVENT, "event_id")
    loaded = incremental.read_target(spark, f"{base}/target", EVENT).select(F.lit("loaded").alias("reason"), body.alias("record"))
    return loaded.unionByName(incremental.read_quarantine(spark, f"{base}/target").select("reason", "record"))


# Matching


@query
def model_criteria_filter(spark, folder):
    """Documents as model-criteria documents; a repeated id keeps its last text."""

    def entry(ident, content, groups):
        subjects = F.transform(F.array(*groups), lambda g: F.struct(g.cast("int").alias("product_group_id")))
        return F.struct(ident.alias("id"), content.alias("text"), subjects.alias("product_group_subjects"))

    doc = F.col("doc_id")
    criteria_map = F.create_map(
        F.lit("first"), entry(doc, F.col("text"), [doc % 14, doc % 9]),
        F.lit("again"), entry(doc, F.col("source"), [doc % 13]),
        F.lit("other"), entry(doc + 10000000, F.col("lang"), [F.lit(12), F.lit(1)]),
    )
    bodies = table(spark, folder, "documents").select(json_text.to_text(F.struct(criteria_map.alias("criteria"))).alias("body"))
    return matching.model_criteria_of_groups(files.model_criteria(bodies, "body"), V.ENERGY_PRODUCT_GROUPS)


def _documents_as_criteria(spark, folder):
    name = F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("name")
    return table(spark, folder, "documents").select("doc_id", name, "text", "lang")


@query
def prompt_text(spark, folder):
    rows = _documents_as_criteria(spark, folder)
    made = matching.prompts(rows, matching.taxonomy_literal(V.SOCIAL_TAXONOMY), "name", "text", "lang")
    return made.select("doc_id", "prompt")


@query
def response_parse(spark, folder):
    """Responses that are plain or fenced, short of a key or with one too many, of wrong types, or not one JSON value."""
    doc = F.col("doc_id")
    match, original, english = V.RESPONSE_KEYS
    fields = [F.col("source").alias(match), F.col("text").alias(original), F.col("lang").alias(english)]
    full = json_text.to_text(F.struct(*fields))
    body = (
        F.when(doc % 9 == 0, full)
        .when(doc % 9 == 1, F.concat(F.lit("```json\n"), full, F.lit("\n```")))
        .when(doc % 9 == 2, json_text.to_text(F.struct(*fields[:2])))
        .when(doc % 9 == 3, json_text.to_text(F.struct(*fields, doc.alias("confidence"))))
        .when(doc % 9 == 5, json_text.to_text(F.struct(*fields[:2], F.lit(None).cast("string").alias(english))))
        .when(doc % 9 == 6, json_text.to_text(F.struct(doc.alias(match), *fields[1:])))
        .when(doc % 9 == 7, F.concat(full, F.lit(" as asked")))
        .when(doc % 9 == 8, F.concat(full, full))
        .otherwise(F.concat(F.lit("No match: "), F.col("text")))
    )
    read = matching.read_responses(table(spark, folder, "documents").select("doc_id", body.alias("response")), "response")
    return read.select("doc_id", "status", *V.RESPONSE_KEYS)


@query
def response_quarantine(spark, folder):
    bodies = table(spark, folder, "events").select("event_id", F.col("props").alias("response"))
    return matching.quarantined(matching.read_responses(bodies, "response"))


@query
def taxonomy_match(spark, folder):
    documents, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return matching.best_match(documents, "doc_id", "text", items, "item_id", "text", threshold=5)


@query
def social_match(spark, folder):
    """Documents matched to the social taxonomy, with their URL."""
    taxonomy = flows.social_taxonomy(spark)
    found = matching.best_match(table(spark, folder, "documents"), "doc_id", "text", taxonomy, "title", "definition")
    return matching.with_url(found, "doc_id", URL_BASE)


@query
def scorer_seam(spark, folder):
    """A user's scorer: the length of each text."""

    def text_lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": batch["text"].str.len().astype("int64")})

    rows = table(spark, folder, "documents").select("doc_id", "text")
    return matching.score_rows(rows, text_lengths, "doc_id long, score long")


@query
def scorer_distinct(spark, folder):
    """Event types scored once each and joined back to all events."""

    def upper(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(response=batch["event_type"].str.upper())

    rows = table(spark, folder, "events").select("event_id", "event_type")
    return matching.score_distinct(rows, "event_type", upper)


@query
def scorer_resumed(spark, folder):
    """Event details scored in two runs: the second gets those that the first had not, and those that it failed on."""
    rows = table(spark, folder, "events").select("event_id", "props")
    path = scratch_dir(spark, "answers")

    def scorer(mark, fails):
        def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if fails and batch["props"].str.contains("7").any():
                    raise ValueError("seven")
                yield batch.assign(response=mark + batch["props"])

        return scored

    first = matching.score_resumed(rows.where("event_id % 2 = 0"), "props", scorer("first ", True), path)
    failed = first.where("error = 'ValueError: seven'").select("props").distinct().count()
    both = matching.score_resumed(rows, "props", scorer("second ", False), path, portion=40)
    return both.withColumn("failed_before", F.lit(failed).cast("long"))


@query
def packed_prompts(spark, folder):
    """Documents against a taxonomy larger than a prompt: every entry stands in one prompt of each document."""
    criteria = table(spark, folder, "documents").select("doc_id", "source")
    packs = matching.packed_taxonomy(table(spark, folder, "benchmark"), "item_id", "text", 2_000)
    asked = matching.packed_prompts(criteria, packs, "source")
    return asked.groupBy("doc_id").agg(
        F.sum("entries").alias("entries"),
        (F.count("*") > 1).alias("several"),
        F.min((F.length("prompt") <= 3_000) | (F.col("entries") == 1)).alias("within"),
    )


@query
def categories_from_file(spark, folder):
    """The social categories out of a JSON mapping file."""
    path = scratch_dir(spark, "mapping")
    spark.createDataFrame([(json.dumps(V.SOCIAL_CATEGORIES),)], "value string").write.text(path)
    listed = notices.category_list(standins.notices(spark, folder))
    return categories.categorise(listed, files.read_category_pairs(spark, path), "cpvCodeAndName")


@query
def energy_matches(spark, folder):
    """Landed tables and a landed model document: categories, criteria, and the model criterion of each green-energy one."""
    base = scratch_dir(spark, "energy")
    tables = Tables(spark, root=f"{base}/tables")
    tables.overwrite(standins.notices(spark, folder), "notice_list")
    tables.overwrite(standins.details(spark, folder), "notice_detail")
    flows.category_tables(tables, "infra", mode="distinct_category")
    subjects = [{"product_group_id": 11}]
    model = {
        "a": {"id": 1, "text": "Points of energy", "product_group_subjects": subjects},
        "b": {"id": 2, "text": "Points: 7, solar energy", "product_group_subjects": subjects},
        "c": {"id": 3, "text": "points", "product_group_subjects": [{"product_group_id": 3}]},
    }
    spark.createDataFrame([(json.dumps({"criteria": model}),)], "value string").write.text(f"{base}/model")
    found = flows.energy_matches(tables, f"{base}/model")
    return found.select("documentId", "noticeAwardCriteriaID", "status", "match", "overlap", "jaccard")


@query
def keyword_filter(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.where(text.contains_all(F.col("text"), ["the", "and", "ing"])).select("doc_id", "lang")
