import json


from noticeworks import fixed_values as V
from noticeworks import schemas
from noticeworks.operators import audit, bidders, criteria, notices, worklist

URL = "https://notices.example/view/"


def notice(ident, kind=2, state="Atribuita", code="15000000-0", **more):
    row = dict.fromkeys(schemas.NOTICE_LIST.names)
    row.update(
        cNoticeId=ident,
        sysNoticeTypeId=kind,
        cpvCodeAndName=code,
        contractTitle=f"Contract {ident}",
        sysProcedureState={"id": 5 if state == "Atribuita" else 2, "text": state},
        **more,
    )
    return row


def detail(ident, **sections):
    row = dict.fromkeys(schemas.NOTICE_DETAIL.names)
    row.update(documentId=ident, **sections)
    return row


def notice_table(spark, rows):
    return spark.createDataFrame(rows, schemas.NOTICE_LIST)


def detail_table(spark, rows):
    return spark.createDataFrame(rows, schemas.NOTICE_DETAIL)


def section2(items, text="short"):
    return json.dumps({"section22": {"shortDescription": text, "noticeAwardCriteriaList": items}})


def criterion(**given):
    return {**dict.fromkeys(V.CRITERION_KEYS), **given}


def test_awarded_is_text(spark):
    df = notice_table(
        spark,
        [notice(1, isOnline=True, estimatedValueRon=12.5), notice(2, 7), notice(3, state="Open"), notice(4, state=None)],
    )
    both = notices.awarded(df).orderBy("cNoticeId").collect()
    assert [r["cNoticeId"] for r in both] == ["1", "2"]
    assert both[0]["isOnline"] == "true" and both[0]["estimatedValueRon"] == "12.5"
    assert both[0]["sysProcedureStateText"] == "Atribuita" and len(both[0]) == 25
    assert {type(v) for r in both for v in r} == {str, type(None)}
    assert [r["cNoticeId"] for r in notices.awarded(df, V.PARTICIPATION_TYPE).collect()] == ["1"]


def test_dedupe_by_landing_position_and_by_source_order(spark):
    schema = "_page string, _pos int, cNoticeId long, contractTitle string, publicationDate string, estimatedValueRon double"
    rows = [("p1", 4, 1, "late", "2024-01-02", 9.0), ("p1", 3, 1, "early", "2024-01-01", 1.0), ("p2", 0, 2, "x", None, None)]
    landed = spark.createDataFrame(rows, schema)
    assert {r["contractTitle"] for r in notices.dedupe_list(landed).collect()} == {"early", "x"}
    by_date = notices.dedupe_list(landed.drop("_page", "_pos"))
    assert {r["contractTitle"] for r in by_date.collect()} == {"late", "x"}


def test_silver_and_reserved(spark):
    listed = notice_table(spark, [notice(i) for i in range(1, 8)] + [notice(8, state="Open")])
    flags = {
        "1": '{"restrictedToShelterdWorkshop": true, "restrictedToPrograms": true, "isReservedContract": false}',
        "2": '{"restrictedToShelterdWorkshop": false, "restrictedToPrograms": true}',
        "3": '{"restrictedToShelterdWorkshop": null}',
        "4": "{}",
        "5": "malformed",
        "6": None,
        "8": '{"restrictedToShelterdWorkshop": true}',
    }
    details = detail_table(spark, [detail(k, section3=v) for k, v in flags.items()])
    silver = notices.silver_list(listed, details)
    rows = {r["cNoticeId"]: r for r in silver.collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5", "6"]
    assert [rows[i]["restrictedToShelterdWorkshop"] for i in "123456"] == [True, False, None, None, None, None]
    assert silver.columns.count("contractTitle") == 1
    report = notices.reserved_report(silver, URL).collect()
    assert [tuple(r) for r in report] == [("1", True, True, URL + "1")]
    assert {r["cNoticeId"] for r in notices.reserved_report(silver, URL, any_flag=True).collect()} == {"1", "2"}


def test_restrict_detail_compares_mixed_id_types(spark):
    listed = notice_table(spark, [notice(1, 2), notice(2, 7), notice(3, 12)])
    details = detail_table(spark, [detail(i) for i in ("1", "1", "2", "3", "not a number", None)])
    kept = notices.restrict_detail(details, listed, V.DETAIL_NOTICE_TYPES)
    assert sorted(r["documentId"] for r in kept.collect()) == ["1", "1", "2"]


def test_criteria(spark):
    full = [criterion(noticeID=1, lotID=i, noticeAwardCriteriaName=f"n{i}", noticeAwardCriteriaWeight=12.5) for i in (1, 2)]
    partial = {"noticeAwardCriteriaName": "only name"}
    cases = {
        "two": section2(full),
        "partial": section2([partial]),
        "empty list": section2([]),
        "null list": section2(None),
        "empty section": '{"section22": {}}',
        "null section": '{"section22": null}',
        "no section": "{}",
        "malformed": "bad",
        "null": None,
    }
    details = detail_table(spark, [detail(k, section2=v) for k, v in cases.items()])
    out = criteria.explode_criteria(details)
    assert out.columns == schemas.CRITERIA_TABLE.names
    rows = sorted((r["documentId"], r["noticeAwardCriteriaName"], r["noticeAwardCriteriaWeight"]) for r in out.collect())
    assert rows == [("partial", "only name", None), ("two", "n1", 12.5), ("two", "n2", 12.5)]
    counts = audit.criteria_sections(details).first().asDict()
    assert counts == dict(n=9, missing=1, malformed=1, no_section=4, no_list=6, empty_list=1, incomplete=1, mistyped=0)


def test_criteria_of_category(spark):
    details = detail_table(spark, [detail(i, section2=section2([criterion(noticeAwardCriteriaName="a")])) for i in "123"])
    listed = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "cNoticeId long, category string")
    once = criteria.criteria_of(details, listed)
    assert sorted(r["documentId"] for r in once.collect()) == ["1", "2"]
    repeated = criteria.criteria_of(details, listed, repeat=True)
    assert sorted(r["documentId"] for r in repeated.collect()) == ["1", "1", "2"]


def test_attachments(spark):
    docs = [{"noticeDocumentUrl": "u", "noticeDocumentName": n} for n in ("a.pdf", "a.pdf.p7m", "a.p7s", ".hidden", "noext")]
    lists = spark.createDataFrame(
        [("1", json.dumps({"dfNoticeDocs": docs})), ("2", '{"dfNoticeDocs": []}'), ("3", "bad")], "documentId string, filelist string"
    )
    rows = {r["name"]: (r["signed"], r["unwrapped_name"]) for r in notices.attachments(lists).collect()}
    assert rows == {
        "a.pdf": (False, "a.pdf"), "a.pdf.p7m": (True, "a.pdf"), "a.p7s": (True, "a"),
        ".hidden": (False, ".hidden"), "noext": (False, "noext"),
    }


def statement(version, *names, suppliers=None):
    if suppliers is None:
        suppliers = [{"statementParticipants": [{"name": n, "fiscalNumber": n} for n in names]}]
    return {"versionNo": version, "statementSuppliers": suppliers}


def test_latest_version_and_bidders(spark):
    cases = {
        "1,3,2": [statement(1, "old"), statement(3, "RO 33"), statement(2, "mid")],
        "2,2": [statement(2, "first"), statement(2, "last 2")],
        "only 0": [statement(0, "zero")],
        "empty": [],
        "no participants": [statement(1)],
        "no suppliers": [statement(1, suppliers=[])],
        "two": [statement(1, "a7", None)],
    }
    raw = spark.createDataFrame(
        [(k, None, None, json.dumps(v)) for k, v in cases.items()] + [("bad", None, None, "bad")], schemas.BIDDERS_RAW
    )
    registry = spark.createDataFrame([("33",), ("33",), (None,), ("7",)], schemas.REGISTRY)
    rows = bidders.bidders_silver(raw, registry).collect()
    got = sorted((r["documentId"], r["name"], r["fiscalNumber_numeric"], r["is_social_enterprise"]) for r in rows if r["name"])
    assert got == [("1,3,2", "RO 33", "33", True), ("2,2", "last 2", "2", False), ("two", "a7", "7", True)]
    [unnamed] = [r for r in rows if not r["name"]]
    assert unnamed["documentId"] == "two" and unnamed["is_social_enterprise"] is False
    counts = audit.bidder_versions(raw).first()
    assert (counts["n"], counts["malformed"], counts["no_valid_version"]) == (8, 1, 3)


def test_worklists(spark):
    wanted = spark.createDataFrame([("10",), ("9",), ("x",), ("2",)], "id string")
    landed = spark.createDataFrame([(2,), (None,)], "documentId long")
    assert [r["id"] for r in worklist.remaining(wanted, landed, "id", "documentId").collect()] == ["9", "10", "x"]
    general = {"1": '{"caNoticeId": 7, "dfNoticeId": 8}', "2": "{}", "3": "bad", "4": '{"dfNoticeId": null}'}
    details = detail_table(spark, [detail(k, generalInfo=v) for k, v in general.items()])
    ids = spark.createDataFrame([("1",), ("2",)], "cNoticeId string")
    assert [tuple(r) for r in notices.award_ids(details, ids).collect()] == [("1", "7"), ("2", None)]
    assert dict(map(tuple, notices.detail_requests(details).collect())) == {"1": "8", "2": "111", "3": "111", "4": None}


def test_audit_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert tuple(audit.duplicates(df, "k").first()) == (4, 3)
    assert tuple(audit.codes(df, "k").first()) == (4, 1)
    assert tuple(audit.json_column(df, "k").first()) == (4, 1, 3)
    assert tuple(audit.duplicates(df.where("false"), "k").first()) == (0, 0)


def test_category_list_reads_bad_estimates_as_null(spark):
    rows = spark.createDataFrame(
        [(1, "t", "15", {"id": 5, "text": "x"}, "12.5"), (2, "t", "15", None, "n/a")],
        "cNoticeId long, contractTitle string, cpvCodeAndName string, sysProcedureState struct<id:int,text:string>, estimatedValueRon string",
    )
    out = notices.category_list(rows).orderBy("cNoticeId").collect()
    assert [(r["status"], r["value_estimate"]) for r in out] == [(5, 12.5), (None, None)]


def test_values_lost_to_their_type_and_text_behind_the_value_are_counted(spark):
    def body(weight, order):
        item = {"noticeID": 1, "noticeAwardCriteriaWeight": weight, "noticeAwardCriteriaOrder": order}
        return json.dumps({"section22": {"noticeAwardCriteriaList": [item]}})

    texts = [body(12.5, 1), body("12,5", 1), body(None, 1.5), body(3, 2) + " end", body(1, 1) + "{}"]
    details = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "documentId string, section2 string")
    counts = audit.criteria_sections(details).first()
    assert (counts["malformed"], counts["mistyped"]) == (2, 2)
    rows = {r["documentId"]: (r["noticeAwardCriteriaWeight"], r["noticeAwardCriteriaOrder"]) for r in criteria.explode_criteria(details).collect()}
    assert rows == {"0": (12.5, 1), "1": (None, 1), "2": (None, None), "3": (3.0, 2), "4": (1.0, 1)}
