"""The SQL each query of ``queries`` has to agree with, over the same tables."""

from __future__ import annotations

from noticeworks import fixed_values as V
from noticeworks.plans import flows
from noticeworks.plans.queries import NAME_PREFIXES, URL_BASE
from noticeworks.plans.standins import CODES
from noticeworks.operators.matching import INSTRUCTION


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quoted_list(texts) -> str:
    return ", ".join(quoted(t) for t in texts)


def pairs(mapping: dict[str, list[str]]) -> str:
    rows = ", ".join(f"({quoted(c)}, {quoted(p)})" for c, ps in mapping.items() for p in ps)
    return f"(SELECT * FROM (VALUES {rows}) AS v(category, prefix))"


NOTICES = f"""
notices AS (
  SELECT o_orderkey AS cNoticeId, o_custkey, o_orderpriority, o_totalprice, o_orderstatus,
    'Contract ' || o_orderkey AS contractTitle,
    CASE WHEN o_orderkey % 97 <> 0 THEN
      CASE WHEN o_custkey % 4 = 0 THEN [{quoted_list(CODES)}][o_orderkey % 8 + 1]
           ELSE lpad(CAST((o_orderkey * 7919 + o_custkey * 104729) % 100000000 AS VARCHAR), 8, '0') END
      || '-' || (o_orderkey % 10) || ' item' END AS cpvCodeAndName,
    CASE WHEN o_orderstatus = 'F' THEN 5 ELSE 2 END AS status,
    CASE WHEN o_orderstatus = 'F' THEN 'Atribuita' ELSE 'In desfasurare' END AS state_text,
    CASE WHEN o_orderpriority < '3' THEN 2 WHEN o_orderpriority < '4' THEN 7 ELSE 12 END AS notice_type,
    strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM orders)"""

# Criteria of the detail documents, without going through JSON.
CRITERIA = """
details AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS documentId, o_orderkey, o_custkey, o_orderpriority, o_orderstatus,
    o_orderkey % 101 = 0 OR (o_orderkey % 103 <> 0 AND o_orderkey % 113 = 0) AS is_malformed,
    o_orderkey % 101 <> 0 AND o_orderkey % 103 = 0 AS is_missing,
    o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0 AND (o_orderstatus <> 'P' OR o_custkey % 5 <> 0) AS has_section
  FROM orders),
criteria AS (
  SELECT documentId, o_orderpriority AS short_description, o_orderkey AS noticeID, CAST(i AS BIGINT) AS lotID,
    o_orderkey * 10 + i AS noticeAwardCriteriaID, i % 2 = 0 AS directProportional,
    CASE WHEN i = 1 THEN 'Energie verde' ELSE 'Garantie' END AS noticeAwardCriteriaName,
    o_orderpriority || ' ' || i AS noticeAwardCriteriaDescription,
    CASE WHEN o_custkey % 3 <> 0 THEN 'points ' || (o_custkey % 100) END AS algorithmDescription,
    CAST(i AS INTEGER) AS noticeAwardCriteriaOrder, CASE WHEN i > 1 OR o_orderkey % 107 <> 0 THEN CAST(i * 12.5 AS DOUBLE) END AS noticeAwardCriteriaWeight,
    CASE WHEN o_orderkey % 109 <> 0 THEN true END AS isElectronicCriteria, CAST(NULL AS BOOLEAN) AS isFrameworkAgreementCriteria
  FROM (SELECT *, unnest(range(1, o_orderkey % 4 + 1)) AS i FROM details WHERE has_section))"""

FLAGS = """
flags AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS documentId,
    CASE WHEN o_custkey % 11 <> 0 AND o_orderkey % 6 <> 0 THEN o_orderkey % 7 = 0 END AS restrictedToShelterdWorkshop,
    CASE WHEN o_custkey % 11 <> 0 THEN o_orderkey % 9 = 0 END AS isReservedContract,
    CASE WHEN o_custkey % 11 <> 0 THEN o_orderkey % 4 = 0 END AS restrictedToPrograms
  FROM orders)"""

BIDDERS = """
bidders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS documentId,
    CAST(o_orderkey * 10 + s AS VARCHAR) AS statementSupplierId,
    CAST(o_orderkey * 100 + s * 10 + o_orderkey % 3 AS VARCHAR) AS statementParticipantId,
    CAST(CASE WHEN s = 1 THEN 62.5 ELSE 37.5 END AS DOUBLE) AS contractPercent, s = 1 AS isLead,
    CASE WHEN o_custkey % 13 <> 0 THEN 'RO ' || (o_custkey + s * 3 + 1) END AS fiscalNumber,
    CASE WHEN o_custkey % 13 <> 0 THEN CAST(o_custkey + s * 3 + 1 AS VARCHAR) END AS fiscalNumber_numeric
  FROM (SELECT *, unnest(range(1, o_custkey % 2 + 2)) AS s FROM orders WHERE o_orderkey % 3 >= 1)),
silver AS (
  SELECT *, coalesce(fiscalNumber_numeric IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier), false)
    AS is_social_enterprise
  FROM bidders)"""


def listed(name: str) -> str:
    return f"""
listed AS (
  SELECT cNoticeId, contractTitle, cpvCodeAndName, status, o_totalprice AS value_estimate, category
  FROM notices JOIN {pairs(flows.MAPPINGS[name])} p ON starts_with(cpvCodeAndName, prefix))"""


def overlap(items: str, key: str, content: str, threshold: int = 1) -> str:
    """Shared distinct words of documents and a taxonomy, the best entry per document."""
    words = "list_filter(list_distinct(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+')), lambda w: w <> '')"
    left, right = words.format("text"), words.format(content)
    return f"""
d AS (SELECT doc_id, {left} AS words FROM documents),
e AS (SELECT {key}, {right} AS words FROM {items}),
shared AS (
  SELECT doc_id, {key}, n, m, count(*) AS overlap
  FROM (SELECT doc_id, len(words) AS n, unnest(words) AS w FROM d) JOIN
       (SELECT {key}, len(words) AS m, unnest(words) AS w FROM e) USING (w)
  GROUP BY ALL),
best AS (
  SELECT doc_id, {key}, overlap, CAST(overlap AS DOUBLE) / (n + m - overlap) AS jaccard
  FROM shared
  WHERE overlap >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, {key}) = 1)"""


CRITERIA_OF = "WITH " + NOTICES + ",{0}," + CRITERIA + """
SELECT * FROM criteria WHERE documentId IN (SELECT CAST(cNoticeId AS VARCHAR) FROM listed)"""

DRAW = "md5({0} || ':42')"

SQL = {
    "criteria_by_category": f"""
SELECT category, count(*) AS n_criteria, count(DISTINCT p_partkey) AS n_parts, sum(l_quantity) AS total_quantity
FROM (SELECT DISTINCT category, p_partkey FROM part JOIN {pairs(NAME_PREFIXES)} p ON starts_with(p_name, prefix))
JOIN lineitem ON l_partkey = p_partkey
GROUP BY category""",
    "prefix_category_all": f"""
SELECT p_partkey, p_name, category FROM part JOIN {pairs(NAME_PREFIXES)} p ON starts_with(p_name, prefix)""",
    "prefix_category_distinct": f"""
SELECT DISTINCT p_partkey, category FROM part JOIN {pairs(NAME_PREFIXES)} p ON starts_with(p_name, prefix)""",
    "prefix_category_wide": """
SELECT CAST(o_orderkey AS VARCHAR) AS code, 'nation ' || s_nationkey AS category
FROM orders JOIN supplier ON starts_with(CAST(o_orderkey AS VARCHAR), CAST(s_suppkey AS VARCHAR))""",
    "categories_social": f"WITH {NOTICES},{listed('social')} SELECT * FROM listed",
    "categories_from_file": f"WITH {NOTICES},{listed('social')} SELECT * FROM listed",
    "categories_enterprise": f"WITH {NOTICES},{listed('enterprise')} SELECT * FROM listed",
    "categories_infra": f"WITH {NOTICES},{listed('infra')} SELECT * FROM listed",
    "criteria_social": CRITERIA_OF.format(listed("social")),
    "criteria_enterprise": CRITERIA_OF.format(listed("enterprise")),
    "criteria_social_repeated": f"""
WITH {NOTICES},{listed('social')},{CRITERIA}
SELECT documentId, count(*) AS n FROM criteria JOIN listed ON documentId = CAST(cNoticeId AS VARCHAR)
GROUP BY documentId""",
    "criteria_explode": """
SELECT CAST(l_orderkey AS VARCHAR) AS documentId, l_suppkey, l_returnflag AS short_description,
  l_orderkey AS noticeID, CAST(i AS BIGINT) AS lotID, l_orderkey * 10 + i AS noticeAwardCriteriaID,
  i % 2 = 0 AS directProportional, CASE WHEN i = 1 THEN 'Energie verde' ELSE 'Garantie' END AS noticeAwardCriteriaName,
  l_returnflag || ' ' || i AS noticeAwardCriteriaDescription,
  CASE WHEN l_partkey % 3 <> 0 THEN 'points ' || (l_partkey % 100) END AS algorithmDescription,
  CAST(i AS INTEGER) AS noticeAwardCriteriaOrder, CAST(i * 12.5 AS DOUBLE) AS noticeAwardCriteriaWeight,
  true AS isElectronicCriteria, CAST(NULL AS BOOLEAN) AS isFrameworkAgreementCriteria
FROM (SELECT *, unnest(range(1, l_linenumber % 3 + 1)) AS i FROM lineitem WHERE l_linestatus = 'O')""",
    "energy_criteria": f"""
WITH {NOTICES},{listed('infra')},{CRITERIA}
SELECT documentId, noticeAwardCriteriaName, algorithmDescription, category, value_estimate
FROM criteria JOIN listed ON documentId = CAST(cNoticeId AS VARCHAR)
WHERE noticeAwardCriteriaName = 'Energie verde' AND category = {quoted(V.ENERGY_CATEGORY)}""",
    "awarded_list": f"""
WITH {NOTICES}
SELECT CAST(cNoticeId AS VARCHAR) AS cNoticeId, CAST(cNoticeId + 1 AS VARCHAR) AS noticeId,
  CAST(cNoticeId * 10 AS VARCHAR) AS procedureId, 'CN' || cNoticeId AS noticeNo,
  CAST(notice_type AS VARCHAR) AS sysNoticeTypeId, o_orderstatus AS sysNoticeState,
  'Authority ' || o_custkey AS contractingAuthorityNameAndFN, contractTitle,
  'Services' AS sysAcquisitionContractType, o_orderpriority AS sysProcedureType,
  CAST(NULL AS VARCHAR) AS sysContractAssigmentType, cpvCodeAndName,
  CAST(o_totalprice AS VARCHAR) AS estimatedValueRon,
  CASE WHEN cNoticeId % 2 = 0 THEN 'true' ELSE 'false' END AS isOnline,
  CASE WHEN cNoticeId % 3 = 0 THEN 'true' ELSE 'false' END AS hasLots,
  day AS noticeStateDate, day AS minTenderReceiptDeadline, day AS maxTenderReceiptDeadline,
  CAST(NULL AS VARCHAR) AS errataNo, '1' AS sysNoticeVersionId, day AS tenderReceiptDeadlineExport,
  CAST(o_totalprice AS VARCHAR) AS estimatedValueExport, CAST(o_custkey + 7 AS VARCHAR) AS sadId,
  CASE WHEN cNoticeId % 5 = 0 THEN NULL WHEN cNoticeId % 5 = 1 THEN 'true' ELSE 'false' END AS hasAppeal,
  state_text AS sysProcedureStateText
FROM notices WHERE state_text = 'Atribuita' AND notice_type = 2""",
    "dedupe_keep_first": """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_extendedprice, l_partkey, l_suppkey
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY lineitem.l_shipdate DESC, l_extendedprice DESC, l_partkey, l_suppkey) = 1""",
    "landed_pages": f"""
WITH {NOTICES}
SELECT cNoticeId, contractTitle, CAST(2 AS BIGINT) AS total, status AS state_id FROM notices""",
    "restricted_detail": f"""
WITH {NOTICES},{FLAGS}
SELECT documentId,
  CASE WHEN o_custkey % 11 = 0 THEN '{{}}' ELSE
    '{{"restrictedToShelterdWorkshop":' || coalesce(CAST(restrictedToShelterdWorkshop AS VARCHAR), 'null')
    || ',"isReservedContract":' || CAST(isReservedContract AS VARCHAR)
    || ',"restrictedToPrograms":' || CAST(restrictedToPrograms AS VARCHAR) || '}}' END AS section3
FROM flags JOIN notices ON documentId = CAST(cNoticeId AS VARCHAR)
WHERE notice_type IN (2, 7)""",
    "silver_list": f"""
WITH {NOTICES},{FLAGS}
SELECT CAST(cNoticeId AS VARCHAR) AS cNoticeId, contractTitle, CAST(o_totalprice AS VARCHAR) AS estimatedValueRon,
  state_text AS sysProcedureStateText, restrictedToShelterdWorkshop, isReservedContract, restrictedToPrograms
FROM notices JOIN flags ON documentId = CAST(cNoticeId AS VARCHAR) WHERE state_text = 'Atribuita'""",
    "reserved_report": f"""
WITH {NOTICES},{FLAGS}
SELECT documentId AS cNoticeId, restrictedToShelterdWorkshop, restrictedToPrograms, '{URL_BASE}' || documentId AS "URL"
FROM notices JOIN flags ON documentId = CAST(cNoticeId AS VARCHAR)
WHERE state_text = 'Atribuita' AND restrictedToShelterdWorkshop""",
    "reserved_any_flag": f"""
WITH {NOTICES},{FLAGS}
SELECT documentId AS cNoticeId
FROM notices JOIN flags ON documentId = CAST(cNoticeId AS VARCHAR)
WHERE state_text = 'Atribuita' AND (coalesce(restrictedToShelterdWorkshop, false)
  OR coalesce(isReservedContract, false) OR coalesce(restrictedToPrograms, false))""",
    "detail_join": """
SELECT o_orderkey, o_orderstatus, o_totalprice, n_lines
FROM orders JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "semi_awarded_lines": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "anti_orders": """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "type_date_filter": """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'""",
    "newest_first": f"""
WITH {NOTICES}
SELECT day AS publicationDate, cNoticeId, o_totalprice AS estimatedValueRon FROM notices""",
    "nested_field": """
SELECT o_orderkey, o_orderstatus AS state_text, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS state_value
FROM orders""",
    "notice_url": f"SELECT o_orderkey, '{URL_BASE}' || o_orderkey AS url FROM orders",
    "union_pages": """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
    "head_slice": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100",
    "json_flag": """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent,
  CASE WHEN event_id % 4 = 0 THEN true END AS a,
  CASE event_id % 4 WHEN 0 THEN false WHEN 2 THEN true END AS b,
  event_id % 4 IN (0, 2) AS any_flag
FROM events""",
    "json_default": """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 2 THEN '111' END AS z FROM events""",
    "detail_requests": """
SELECT CAST(o_orderkey AS VARCHAR) AS documentId,
  CASE WHEN o_orderkey % 8 = 0 THEN '111' ELSE CAST(o_orderkey + 5 AS VARCHAR) END AS dfNoticeId
FROM orders""",
    "award_worklist": f"""
WITH {NOTICES}
SELECT CAST(cNoticeId AS VARCHAR) AS documentId,
  CASE WHEN cNoticeId % 8 <> 0 THEN CAST(cNoticeId * 3 AS VARCHAR) END AS caNoticeId
FROM notices WHERE state_text = 'Atribuita' AND notice_type = 2""",
    "statement_ids": """
SELECT CAST(o_orderkey AS VARCHAR) AS documentId, o_orderkey * 2 AS procedureStatementId FROM orders""",
    "json_object_text": """
SELECT c_custkey, CAST(json_object('c_custkey', c_custkey, 'c_mktsegment', c_mktsegment,
  'nation', CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END) AS VARCHAR) AS body
FROM customer""",
    "field_labels": f"""
WITH fields AS (
  SELECT unnest(CASE WHEN o_orderkey % 2 = 0 THEN ['personalSituation', 'tpCriteriaQAStandard']
    ELSE ['tpCriteriaQAStandardMin', 'contact'] END) AS field FROM orders)
SELECT field, count(*) AS n,
  CASE field {' '.join(f'WHEN {quoted(k)} THEN {quoted(v)}' for k, v in V.FIELD_LABELS.items())} END AS label
FROM fields GROUP BY field""",
    "latest_version": """
SELECT conv_id, turn, role FROM conversations WHERE turn >= 1
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC) = 1""",
    "bidders_silver": f"WITH {BIDDERS} SELECT * FROM silver",
    "participant_flag": """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]+', '', 'g') AS fiscalNumber_numeric,
  regexp_replace(c_name, '[^0-9]+', '', 'g') IN (SELECT regexp_replace(s_name, '[^0-9]+', '', 'g') FROM supplier)
    AS is_social_enterprise
FROM customer""",
    "social_crosstab": """
SELECT c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS social_contract,
  c_custkey IN (SELECT s_suppkey FROM supplier) AS is_social_enterprise, count(*) AS n
FROM customer GROUP BY ALL""",
    "social_participation": f"""
WITH {NOTICES},{listed('social')},{BIDDERS}
SELECT is_social_enterprise, count(*) AS n FROM silver
WHERE documentId IN (SELECT CAST(cNoticeId AS VARCHAR) FROM listed) GROUP BY is_social_enterprise""",
    "participation_halves": f"""
WITH {NOTICES},{listed('social')},{BIDDERS}
SELECT documentId IN (SELECT CAST(cNoticeId AS VARCHAR) FROM listed) AS social_contract, count(*) AS n
FROM bidders GROUP BY ALL""",
    "sample_ids": f"""
SELECT DISTINCT o_orderkey FROM (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY {DRAW.format('o_orderkey')}, o_orderkey LIMIT 30)""",
    "sample_rows": f"""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (
  SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem)
  ORDER BY {DRAW.format('l_orderkey')}, l_orderkey LIMIT 30)""",
    "sample_per_category": f"""
SELECT p_type, p_partkey FROM part
QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY {DRAW.format('p_partkey')}, p_partkey) <= 30""",
    "sample_criteria": f"""
WITH {NOTICES},{listed('social')},{CRITERIA},
drawn AS (
  SELECT category, id FROM (
    SELECT DISTINCT category, CAST(cNoticeId AS VARCHAR) AS id FROM listed
    WHERE category IN ({quoted_list(V.SAMPLE_CATEGORIES)}) AND status = 5)
  WHERE id IN (SELECT documentId FROM criteria)
  QUALIFY row_number() OVER (PARTITION BY category ORDER BY {DRAW.format('id')}, id) <= 30)
SELECT category, documentId, noticeAwardCriteriaID FROM criteria JOIN drawn ON documentId = id""",
    "value_counts": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "distinct_with_null": """
SELECT count(DISTINCT state) + max(CASE WHEN state IS NULL THEN 1 ELSE 0 END) AS n
FROM (SELECT nullif(o_orderstatus, 'P') AS state FROM orders)""",
    "weight_histogram": """
SELECT bin, CAST(bin * 10 AS DOUBLE) AS bin_start, coalesce(n, 0) AS n
FROM range(10) AS b(bin) LEFT JOIN (
  SELECT CAST(least(floor(l_quantity / 10), 9) AS BIGINT) AS bin, count(*) AS n
  FROM lineitem WHERE l_quantity BETWEEN 0 AND 100 GROUP BY 1) USING (bin)""",
    "window_completeness": """
SELECT strftime(day, '%Y-%m-%d') || 'T00:00:00.000Z' AS start_text, strftime(day, '%Y-%m-%d') || 'T23:59:59.999Z' AS end_text,
  coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'empty' WHEN n >= 340 THEN 'saturated' ELSE 'ok' END AS status
FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) AS day)
LEFT JOIN (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1) USING (day)
UNION ALL SELECT * FROM (SELECT NULL, NULL, count(*) AS n, 'outside' FROM events
  WHERE (ts >= DATE '2024-01-01' AND ts < DATE '2024-02-06') IS NOT TRUE) WHERE n > 0""",
    "month_completeness": """
SELECT strftime(month, '%Y-%m-%d') || 'T00:00:00.000Z' AS start_text,
  strftime(last_day(month), '%Y-%m-%d') || 'T23:59:59.999Z' AS end_text,
  coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'empty' WHEN n >= 190 THEN 'saturated' ELSE 'ok' END AS status
FROM (SELECT unnest(generate_series(DATE '1994-11-01', DATE '2001-10-01', INTERVAL 1 MONTH)) AS month)
LEFT JOIN (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1) USING (month)
UNION ALL SELECT * FROM (SELECT NULL, NULL, count(*) AS n, 'outside' FROM orders
  WHERE (o_orderdate >= DATE '1994-11-01' AND o_orderdate < DATE '2001-11-01') IS NOT TRUE) WHERE n > 0""",
    "month_report": """
WITH shifted AS (SELECT o_orderkey, o_orderdate + INTERVAL 27 YEAR AS day FROM orders),
months AS (SELECT unnest(generate_series(DATE '2022-01-01', DATE '2026-12-01', INTERVAL 1 MONTH)) AS month),
counts AS (SELECT date_trunc('month', day) AS month, count(*) AS n FROM shifted GROUP BY 1),
report AS (
  SELECT month, coalesce(n, 0) AS n, CASE WHEN n IS NOT NULL THEN n + month(month) % 2 END AS total
  FROM months LEFT JOIN counts USING (month))
SELECT strftime(month, '%Y-%m-%d') || 'T00:00:00.000Z' AS start_text,
  strftime(last_day(month), '%Y-%m-%d') || 'T23:59:59.999Z' AS end_text, n, total,
  CASE WHEN total >= 200 THEN 'saturated' WHEN n = 0 THEN 'empty' WHEN n < total THEN 'missing' ELSE 'ok' END AS status
FROM report
UNION ALL SELECT * FROM (SELECT NULL, NULL, count(*) AS n, NULL, 'outside' FROM shifted
  WHERE day < DATE '2022-01-01' OR day >= DATE '2027-01-01') WHERE n > 0""",
    "saturated_months": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 190""",
    "resume_worklist": """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderstatus IN ('F', 'P') AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "dedupe_counts": """
SELECT count(*) AS "before", count(DISTINCT l_orderkey || '-' || l_linenumber) AS "after" FROM lineitem""",
    "audit_criteria": f"""
WITH {CRITERIA}
SELECT count(*) AS n, count(*) FILTER (is_missing) AS missing, count(*) FILTER (is_malformed) AS malformed,
  count(*) FILTER (NOT has_section) AS no_section, count(*) FILTER (NOT has_section) AS no_list,
  count(*) FILTER (has_section AND o_orderkey % 4 = 0) AS empty_list, 
  CAST(coalesce(sum(o_orderkey % 4) FILTER (has_section AND o_orderkey % 109 = 0), 0) AS BIGINT) AS incomplete,
  count(*) FILTER (has_section AND o_orderkey % 107 = 0 AND o_orderkey % 4 > 0) AS mistyped
FROM details""",
    "audit_versions": """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS malformed, count(*) FILTER (o_orderkey % 3 = 0) AS no_valid_version FROM orders""",
    "audit_codes": "SELECT count(*) AS n, count(*) FILTER (o_orderkey % 97 = 0) AS missing FROM orders",
    "attachment_inventory": """
WITH named AS (
  SELECT CAST(page_id AS VARCHAR) AS documentId, url, 'doc.v' || page_id AS stem, page_id FROM pages)
SELECT documentId, url, stem || CASE WHEN page_id % 2 = 0 THEN '.pdf.p7m' ELSE '.p7s' END AS name, true AS signed,
  stem || CASE WHEN page_id % 2 = 0 THEN '.pdf' ELSE '' END AS unwrapped_name FROM named
UNION ALL SELECT documentId, url, stem || '.pdf', false, stem || '.pdf' FROM named
UNION ALL SELECT documentId, url, CASE page_id % 3 WHEN 0 THEN '.hidden' WHEN 1 THEN 'noext' ELSE '.hidden.p7m' END,
  page_id % 3 = 2, CASE page_id % 3 WHEN 1 THEN 'noext' ELSE '.hidden' END FROM named""",
    "attachment_scan": """
SELECT 'source=' || source AS documentId, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source""",
    "table_roundtrip": """
SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' AND (c_nationkey < 10 OR c_nationkey >= 20)""",
    "catalog_roundtrip": """
SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_nationkey < 10""",
    "csv_roundtrip": "SELECT * FROM customer",
    "incremental_load": "SELECT event_id, user_id, event_type, props FROM events",
    "load_quarantine": """
WITH landed AS (
  SELECT event_id AS id, '{"event_id":' || event_id || ',"user_id":' || user_id AS head,
    ',"event_type":"' || event_type || '","props":' || CAST(to_json(props) AS VARCHAR) || '}' AS tail FROM events)
SELECT
  CASE id % 50 WHEN 1 THEN 'malformed' WHEN 2 THEN 'wrong_type' WHEN 3 THEN 'no_id' WHEN 4 THEN 'malformed' WHEN 5 THEN 'malformed'
    ELSE 'loaded' END AS reason,
  CASE id % 50 WHEN 1 THEN substr(head || tail, 1, 20) WHEN 2 THEN '{"event_id":' || id || ',"user_id":"none"' || tail
    WHEN 3 THEN replace(head, '"event_id":' || id, '"event_id":null') || tail WHEN 4 THEN head || tail || ' {}'
    WHEN 5 THEN '[' || head || tail || ']' ELSE head || tail END AS record
FROM landed""",
    "model_criteria_filter": """
WITH entries AS (
  SELECT doc_id AS id, text, doc_id % 14 IN (11, 12) OR doc_id % 9 IN (11, 12) AS tied, 1 AS pos FROM documents
  UNION ALL SELECT doc_id, source, doc_id % 13 IN (11, 12), 2 FROM documents
  UNION ALL SELECT doc_id + 10000000, lang, true, 3 FROM documents)
SELECT id, arg_max(text, pos) AS text FROM entries WHERE tied GROUP BY id""",
    "prompt_text": f"""
SELECT doc_id, {quoted(INSTRUCTION)} || chr(10) || 'Model criteria:' || chr(10) || {quoted(chr(10).join(f'{k}: {v}' for k, v in V.SOCIAL_TAXONOMY.items()))}
  || chr(10) || 'Contract criterion: ' || CASE WHEN doc_id % 7 <> 0 THEN source ELSE '' END
  || ': ' || text || ', ' || lang AS prompt
FROM documents""",
    "response_parse": """
SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'missing_key' WHEN 3 THEN 'extra_key'
    WHEN 5 THEN 'wrong_type' WHEN 6 THEN 'wrong_type' ELSE 'not_json' END AS status,
  CASE WHEN doc_id % 9 IN (0, 1, 2, 3, 5) THEN source END AS "match",
  CASE WHEN doc_id % 9 IN (0, 1, 2, 3, 5, 6) THEN text END AS criteria_from_actual_contract_in_original_romanian,
  CASE WHEN doc_id % 9 IN (0, 1, 3, 6) THEN lang END AS criteria_from_actual_contract_translated_in_english
FROM documents""",
    "response_quarantine": "SELECT event_id, props AS response, 'missing_key' AS status FROM events",
    "taxonomy_match": f"""
WITH {overlap('benchmark', 'item_id', 'text', 5)}
SELECT doc_id, item_id, overlap, jaccard FROM documents LEFT JOIN best USING (doc_id)""",
    "social_match": f"""
WITH taxonomy AS (SELECT * FROM (VALUES {', '.join(f'({quoted(k)}, {quoted(v)})' for k, v in V.SOCIAL_TAXONOMY.items())})
  AS v(title, definition)),{overlap('taxonomy', 'title', 'definition')}
SELECT doc_id, title, overlap, jaccard, '{URL_BASE}' || doc_id AS "URL" FROM documents LEFT JOIN best USING (doc_id)""",
    "scorer_seam": "SELECT doc_id, length(text) AS score FROM documents",
    "scorer_distinct": "SELECT event_id, event_type, upper(event_type) AS response FROM events",
    "scorer_resumed": """
WITH first AS (SELECT DISTINCT props FROM events WHERE event_id % 2 = 0)
SELECT event_id, e.props, CASE WHEN f.props IS NULL OR contains(e.props, '7') THEN 'second ' ELSE 'first ' END || e.props AS response,
  CAST(NULL AS VARCHAR) AS error, (SELECT count(*) FROM first WHERE contains(props, '7')) AS failed_before
FROM events e LEFT JOIN first f ON f.props = e.props""",
    "packed_prompts": """
SELECT doc_id, (SELECT count(*) FROM benchmark) AS entries, true AS several, true AS within FROM documents""",
    "energy_matches": """
WITH words AS (SELECT * FROM (VALUES (1, ['points', 'of', 'energy']), (2, ['points', '7', 'solar', 'energy'])) v(id, w)),
found AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 <> 0 THEN ['points', CAST(o_custkey % 100 AS VARCHAR)] END AS w
  FROM (SELECT DISTINCT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0 AND (o_orderstatus <> 'P' OR o_custkey % 5 <> 0)
      AND o_orderkey % 4 >= 1 AND o_orderkey % 97 <> 0
      AND starts_with(CASE WHEN o_custkey % 4 = 0
        THEN ['77314000', '45112710', '45233290', '15000000', '33100000', '39100000', '09300000', '65000000'][o_orderkey % 8 + 1]
        ELSE lpad(CAST((o_orderkey * 7919 + o_custkey * 104729) % 100000000 AS VARCHAR), 8, '0') END, '09')))
SELECT CAST(o_orderkey AS VARCHAR) AS documentId, o_orderkey * 10 + 1 AS noticeAwardCriteriaID,
  CASE WHEN w IS NULL THEN 'no_match' ELSE 'ok' END AS status,
  CASE WHEN w IS NULL THEN NULL WHEN w[2] = '7' THEN '2' ELSE '1' END AS "match",
  CASE WHEN w IS NULL THEN NULL WHEN w[2] = '7' THEN 2 ELSE 1 END::BIGINT AS overlap,
  CASE WHEN w IS NULL THEN NULL WHEN w[2] = '7' THEN 0.5 ELSE 0.25 END::DOUBLE AS jaccard
FROM found""",
    "keyword_filter": """
SELECT doc_id, lang FROM documents WHERE contains(text, 'the') AND contains(text, 'and') AND contains(text, 'ing')""",
}
