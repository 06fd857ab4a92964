"""Landed files to reports, end to end on a small invented corpus."""

import json

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from noticeworks import fixed_values as V
from noticeworks import schemas
from noticeworks.plans import flows
from noticeworks.sources import files
from noticeworks.sources.tables import Tables
from noticeworks.streaming import incremental

URL = "https://notices.example/view/"


def item(ident, code, kind=2, state="Atribuita", **more):
    state_id = V.AWARDED_ID if state == V.AWARDED_TEXT else 2
    return {
        "cNoticeId": ident, "cpvCodeAndName": code, "sysNoticeTypeId": kind, "contractTitle": f"T{ident}",
        "estimatedValueRon": 10.5 * ident, "sysProcedureState": {"id": state_id, "text": state}, **more,
    }


def criterion(ident, name="Pret", detail="how"):
    values = dict.fromkeys(V.CRITERION_KEYS)
    values.update(noticeID=ident, noticeAwardCriteriaName=name, noticeAwardCriteriaDescription="d", algorithmDescription=detail)
    return values


def detail(ident, criteria, sheltered=False):
    return {
        "documentId": str(ident),
        "generalInfo": json.dumps({"caNoticeId": ident * 10}),
        "section2": json.dumps({"section22": {"shortDescription": "s", "noticeAwardCriteriaList": criteria}}),
        "section3": json.dumps({"restrictedToShelterdWorkshop": sheltered}),
    }


@pytest.fixture
def tables(spark, tmp_path):
    landing = tmp_path / "pages"
    landing.mkdir()
    items = [
        item(1, "77314000-5 green spaces"), item(1, "99999999-0 duplicate"), item(2, "15000000-8 food"),
        item(3, "09310000-5 electricity"), item(4, "15110000-2 meat", state="In desfasurare"), item(5, "45000000-7 works", kind=12),
    ]
    (landing / "page.json").write_text(json.dumps({"total": len(items), "items": items}))
    tables = Tables(spark, root=str(tmp_path / "tables"))
    flows.notice_list(tables, str(landing))

    details = [
        detail(1, [criterion(1), criterion(1, "Social")], sheltered=True),
        detail(2, [criterion(2)]),
        detail(3, [criterion(3, V.GREEN_ENERGY_NAME, "solar supply"), criterion(3)]),
        detail(5, [criterion(5)]),
    ]
    drops = tmp_path / "details"
    drops.mkdir()
    (drops / "a.json").write_text("\n".join(map(json.dumps, details)))
    target = str(tmp_path / "loaded")
    incremental.load_new(spark, str(drops), target, str(tmp_path / "ck"), schemas.NOTICE_DETAIL, "documentId")
    tables.overwrite(incremental.read_target(spark, target, schemas.NOTICE_DETAIL), "notice_detail")

    statement = {"versionNo": 1, "statementSuppliers": [{"statementParticipants": [{"fiscalNumber": "RO 7"}, {"fiscalNumber": "8"}]}]}
    raw = [("1", None, None, json.dumps([statement])), ("2", None, None, json.dumps([statement]))]
    tables.overwrite(spark.createDataFrame(raw, schemas.BIDDERS_RAW), "bidders_raw")
    return tables


def ids(df, column):
    return sorted(r[column] for r in df.collect())


def test_flow(spark, tables, tmp_path):
    assert ids(tables.read("notice_list"), "cNoticeId") == [1, 2, 3, 4, 5]
    assert ids(flows.detail_worklist(tables), "cNoticeId") == [4]
    assert ids(flows.bidder_worklist(tables), "cNoticeId") == ["3"]
    assert ids(flows.award_worklist(tables), "caNoticeId") == ["10", "20", "30"]

    flows.restrict_detail(tables)
    assert ids(tables.read("notice_detail"), "documentId") == ["1", "2", "3"]

    flows.silver_list(tables)
    assert ids(tables.read("notice_list_silver"), "cNoticeId") == ["1", "2", "3"]
    flows.reserved_report(tables, URL, str(tmp_path / "reserved"))
    report = spark.read.csv(str(tmp_path / "reserved"), header=True).collect()
    assert [(r["cNoticeId"], r["restrictedToShelterdWorkshop"], r["URL"]) for r in report] == [("1", "true", URL + "1")]

    flows.category_tables(tables, "social")
    listed = tables.read("social_list")
    assert listed.schema.names == schemas.CATEGORY_LIST.names
    assert ids(listed, "cNoticeId") == ["1", "1", "1", "2", "4"]
    assert ids(tables.read("social_criteria"), "documentId") == ["1", "1", "2"]
    flows.category_tables(tables, "social", mode="distinct_category", repeat=True)
    assert ids(tables.read("social_list"), "cNoticeId") == ["1", "1", "2", "4"]
    assert ids(tables.read("social_criteria"), "documentId") == ["1", "1", "1", "1", "2"]

    flows.samples(tables, "social", str(tmp_path / "samples"))
    sampled = spark.read.csv(str(tmp_path / "samples"), header=True).collect()
    assert [(r["category"], r["documentId"]) for r in sampled] == [("Food", "2")]

    pairs = tmp_path / "map.json"
    pairs.write_text(json.dumps(V.INFRA_CATEGORIES))
    flows.category_tables(tables, "infra", files.read_category_pairs(spark, str(pairs)))
    model = tmp_path / "model.json"
    entry = {"id": 11619, "text": "solar", "product_group_subjects": [{"product_group_id": 11}]}
    model.write_text(json.dumps({"criteria": {"a": entry}}))
    [prompt] = flows.energy_prompts(tables, str(model)).collect()
    assert prompt["documentId"] == "3" and "11619: solar" in prompt["prompt"]
    assert prompt["prompt"].endswith("Contract criterion: solar supply")
    [energy] = flows.energy_matches(tables, str(model)).collect()
    assert (energy["documentId"], energy["match"], energy["status"], energy["overlap"]) == ("3", "11619", "ok", 1)
    assert flows.social_prompts(tables).count() == 5

    def answer(batches):
        for batch in batches:
            yield batch.assign(response=json.dumps(dict.fromkeys(V.RESPONSE_KEYS, "A")))

    answers = flows.social_matches(tables, answer).collect()
    assert len(answers) == 5 and {(r["status"], r["match"]) for r in answers} == {("ok", "A")}
    by_words = flows.social_matches(tables)
    assert by_words.columns == flows.social_matches(tables, answer).columns
    assert {(r["match"] or "none")[:2] for r in by_words.collect()} <= {"A.", "B.", "C.", "D.", "E ", "no"}
    assert len({r["noticeAwardCriteriaID"] for r in answers}) == len({r["noticeAwardCriteriaID"] for r in by_words.collect()})
    [scored] = flows.energy_matches(tables, str(model), answer).collect()
    assert scored["status"] == "ok" and scored["match"] == "A" and scored["noticeAwardCriteriaID"] == energy["noticeAwardCriteriaID"]

    registry = spark.createDataFrame([("7",)], schemas.REGISTRY)
    flows.bidders_silver(tables, registry)
    silver = tables.read("bidders_silver")
    assert silver.schema.names == schemas.BIDDERS.names and silver.count() == 4
    (tmp_path / "matched.csv").write_text('ID,match\n1,"A, first"\n1,B\n')
    as_text = StructType([StructField("ID", StringType()), StructField("match", StringType())])
    flows.matched_criteria(tables, str(tmp_path / "matched.csv"), as_text, "ID", URL)
    matched = tables.read("matched_criteria")
    assert sorted(map(tuple, matched.collect())) == [("1", "A, first", URL + "1"), ("1", "B", URL + "1")]
    counts = flows.social_enterprises_in_social_contracts(tables, matched, "ID")
    assert sorted(map(tuple, counts.collect())) == [(False, 1), (True, 1)]
