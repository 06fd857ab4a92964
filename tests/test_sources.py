import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from noticeworks import schemas
from noticeworks.operators import joins, notices
from noticeworks.session import scratch_dir
from noticeworks.sources import files, tables
from noticeworks.sources.tables import Tables, enforce


@pytest.mark.parametrize("in_catalog", [False, True])
def test_overwrite_append_replace(spark, tmp_path, in_catalog):
    if in_catalog:
        spark.sql("CREATE DATABASE IF NOT EXISTS stock")
        tables = Tables(spark, database="stock")
    else:
        tables = Tables(spark, root=str(tmp_path))
    tables.overwrite(spark.range(5), "numbers")
    tables.append(spark.range(5, 8), "numbers")
    assert tables.read("numbers").count() == 8
    tables.replace(tables.read("numbers").where("id % 2 = 0"), "numbers")
    assert sorted(r["id"] for r in tables.read("numbers").collect()) == [0, 2, 4, 6]
    assert in_catalog or [x.name for x in tmp_path.iterdir() if x.name[0] != "."] == ["numbers"]


def test_scratch_is_below_the_shared_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_enforce(spark):
    schema = schemas.CATEGORY_LIST
    rows = spark.createDataFrame([("n/a", "Food", 1, "5", "15", "T")], "value_estimate string, category string, cNoticeId long, status string, cpvCodeAndName string, contractTitle string")
    out = enforce(rows, schema)
    assert out.schema.names == schema.names
    assert tuple(out.first()) == ("1", "T", "15", "Food", 5, None)


def test_csv_keeps_quotes_breaks_and_nulls(spark, tmp_path):
    rows = [("1", 'say "x", then'), ("2", "two\nlines"), ("3", None)]
    schema = StructType([StructField("id", StringType()), StructField("t", StringType())])
    files.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "csv"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "csv"), schema, multi_line=True).collect())) == rows


def test_list_pages(spark, tmp_path):
    item = {"cNoticeId": 1, "contractTitle": "first", "sysProcedureState": {"id": 5, "text": "Atribuita"}, "isOnline": True}
    pages = [{"total": 3, "items": [item, {**item, "contractTitle": "again"}]}, {"total": 3, "items": [{**item, "cNoticeId": 2}]}, {"total": 0, "items": []}]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps(page, indent=1))
    landed = files.read_list_pages(spark, str(tmp_path), multi_line=True)
    assert landed.count() == 3
    first = notices.dedupe_list(landed).orderBy("cNoticeId").collect()
    assert [(r["cNoticeId"], r["contractTitle"]) for r in first] == [(1, "first"), (2, "first")]
    assert first[0]["sysProcedureState"]["text"] == "Atribuita"


def test_attachment_files(spark, tmp_path):
    for doc, name, body in (("10", "a.pdf", b"abc"), ("10", "a.pdf.p7m", b"12345"), ("11", "noext", b"x"), ("11", "empty", b"")):
        (tmp_path / doc).mkdir(exist_ok=True)
        (tmp_path / doc / name).write_bytes(body)
    scanned = files.read_attachments(spark, str(tmp_path))
    assert "content" not in scanned.columns
    rows = notices.inventory(scanned, "name").collect()
    assert sorted((r["documentId"], r["unwrapped_name"], r["length"], r["signed"]) for r in rows) == [
        ("10", "a.pdf", 3, False), ("10", "a.pdf", 5, True), ("11", "empty", 0, False), ("11", "noext", 1, False),
    ]
    content = files.read_attachments(spark, str(tmp_path), with_content=True).collect()
    assert {r["name"]: bytes(r["content"]) for r in content} == {"a.pdf": b"abc", "a.pdf.p7m": b"12345", "noext": b"x", "empty": b""}
    assert all(r["modificationTime"] is not None for r in content)


def test_many_folders_are_listed_by_tasks(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"d {k}" / "inner").mkdir(parents=True)
        (tmp_path / f"d {k}" / "inner" / "x.pdf").write_bytes(b"1" * k)
    (tmp_path / "top").write_bytes(b"")
    for root in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        assert sorted(r["length"] for r in files.read_attachments(spark, root).collect()) == sorted([0, *range(40)])
    dealt = spark.read.format("file_listing").option("folders", 7).load(str(tmp_path))
    assert dealt.rdd.getNumPartitions() == 7 and dealt.count() == 41


def test_replacing_a_table_disturbs_no_reader(spark, tmp_path, monkeypatch):
    held = Tables(spark, root=str(tmp_path))

    def values():
        return sorted(r["id"] for r in held.read("t").collect())

    held.overwrite(spark.range(5), "t")
    before = held.read("t")
    held.replace(held.read("t").where("id > 1"), "t")
    assert values() == [2, 3, 4]
    assert before.count() == 5
    held.append(spark.range(9, 10), "t")
    between = held.read("t")
    # A writer that dies between its rows and the pointer leaves the table as it was.
    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_note", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            held.replace(held.read("t").where("id > 3"), "t")
    assert values() == [2, 3, 4, 9]
    held.overwrite(held.read("t").where("id > 3"), "t")
    assert values() == [4, 9] and between.count() == 4
    for _ in range(4):
        held.replace(held.read("t"), "t")
    assert values() == [4, 9]
    versions = [p for p in (tmp_path / ".versions" / "t").iterdir()]
    assert len(versions) <= tables.GRACE + 1 and not (tmp_path / "t").exists()


def test_id_joins(spark):
    rows = spark.createDataFrame([("1",), ("01",), ("x",), (None,)], "id string")
    ids = spark.createDataFrame([(1,), (1,), (None,)], "key long")
    assert [r["id"] for r in joins.rows_in(rows, ids, "id", "key").collect()] == ["1"]
    assert {r["id"] for r in joins.rows_not_in(rows, ids, "id", "key").collect()} == {"01", "x", None}
    flagged = {r["id"]: r["f"] for r in joins.flag_in(rows, ids, "id", "key", "f").collect()}
    assert flagged == {"1": True, "01": False, "x": False, None: False}
    both = joins.rows_in(rows, ids, "id", "key").unionAll(joins.rows_not_in(rows, ids, "id", "key"))
    assert both.exceptAll(rows).count() == 0 and both.count() == rows.count()


def test_detail_join_drops_colliding_columns(spark):
    left = spark.createDataFrame([(1, "mine")], "id long, title string")
    right = spark.createDataFrame([("1", "theirs", 5), ("1", "other", 6)], "doc string, title string, n int")
    out = joins.detail_join(left, right, "id", "doc")
    assert out.columns == ["id", "title", "n"]
    assert sorted(map(tuple, out.collect())) == [(1, "mine", 5), (1, "mine", 6)]
    assert out.select(F.col("title")).distinct().count() == 1


def test_pages_arrive_by_number_line_and_place(spark, tmp_path):
    def item(ident, title):
        return {"cNoticeId": ident, "contractTitle": title}

    lines = {
        "page_10.json": [[item(1, "ten")], [item(3, "ten")]],
        "page_2.json": [[item(2, "two"), item(1, "two")], [item(1, "later line"), item(2, "later line")]],
    }
    for name, pages in lines.items():
        (tmp_path / name).write_text("\n".join(json.dumps({"total": 9, "items": p}) for p in pages))
    landed = files.read_list_pages(spark, str(tmp_path))
    for rows in (landed, landed.orderBy(F.rand(3)), landed.repartition(7, "contractTitle")):
        kept = {r["cNoticeId"]: r["contractTitle"] for r in notices.dedupe_list(rows).collect()}
        assert kept == {1: "two", 2: "two", 3: "ten"}
