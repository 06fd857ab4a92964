import json

import pytest

from noticeworks import schemas
from noticeworks.streaming import incremental


def drop(folder, name, ids, body="x"):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"documentId": i, "section2": body}) for i in ids]
    (folder / name).write_text("\n".join(lines))


def test_each_file_and_each_id_once(spark, tmp_path):
    landing, target, checkpoint = (tmp_path / n for n in ("landing", "target", "checkpoint"))

    def run():
        incremental.load_new(
            spark, str(landing), str(target), str(checkpoint), schemas.NOTICE_DETAIL, "documentId"
        )
        rows = incremental.read_target(spark, str(target), schemas.NOTICE_DETAIL).collect()
        return sorted((r["documentId"], r["section2"]) for r in rows)

    drop(landing, "a.json", ["1", "2", "2"])
    assert run() == [("1", "x"), ("2", "x")]
    drop(landing, "b.json", ["2", "3"], "y")
    expected = [("1", "x"), ("2", "x"), ("3", "y")]
    assert run() == expected
    assert run() == expected

    # A batch that wrote its rows but was not recorded is run again: same rows.
    for record in (checkpoint / "commits").glob("*1*"):
        record.unlink()
    assert run() == expected

    # The checkpoint is lost: every file is loaded again.
    checkpoint = tmp_path / "another"
    assert [ident for ident, _ in run()] == ["1", "2", "3"]


def load(spark, landing, target, checkpoint):
    incremental.load_new(spark, str(landing), str(target), str(checkpoint), schemas.NOTICE_DETAIL, "documentId")
    rows = incremental.read_target(spark, str(target), schemas.NOTICE_DETAIL).collect()
    return sorted((r["documentId"], r["section2"]) for r in rows)


def test_two_landing_folders_share_a_target(spark, tmp_path):
    target = tmp_path / "target"
    drop(tmp_path / "jan", "a.json", ["jan0", "jan1", "both"], "jan")
    drop(tmp_path / "feb", "a.json", ["feb0", "both"], "feb")
    load(spark, tmp_path / "jan", target, tmp_path / "c1")
    expected = [("both", "jan"), ("feb0", "feb"), ("jan0", "jan"), ("jan1", "jan")]
    assert load(spark, tmp_path / "feb", target, tmp_path / "c2") == expected
    drop(tmp_path / "jan", "b.json", ["jan2"], "jan")
    assert load(spark, tmp_path / "jan", target, tmp_path / "c1") == [*expected, ("jan2", "jan")]


def test_a_lost_checkpoint_keeps_rows_of_files_that_are_gone(spark, tmp_path):
    landing, target = tmp_path / "landing", tmp_path / "target"
    drop(landing, "a.json", ["1", "2"])
    load(spark, landing, target, tmp_path / "c1")
    (landing / "a.json").unlink()
    drop(landing, "b.json", ["2", "3"], "y")
    assert load(spark, landing, target, tmp_path / "c2") == [("1", "x"), ("2", "x"), ("3", "y")]


def load_ids(spark, tmp_path, name, ids, **options):
    """One load of these ids from a folder of its own."""
    drop(tmp_path / name, "a.json", ids)
    incremental.load_new(
        spark, str(tmp_path / name), str(tmp_path / "t"), str(tmp_path / f"c-{name}"), schemas.NOTICE_DETAIL, "documentId", **options
    )


def test_an_index_probe_reads_no_ids_of_other_loads(spark, tmp_path):
    """However many loads there are, a batch of new ids reads next to none, and one of known ids their buckets alone."""
    target = str(tmp_path / "t")
    read = {}
    for k in range(9):
        load_ids(spark, tmp_path, f"l{k}", [f"{k}-{i}" for i in range(200)], compacted=False)
        if k not in (2, 8):
            continue
        now = incremental.manifest(spark, target)
        assert len(now.loads) == k + 1
        for kind, ids in (("new", [f"new-{i}" for i in range(100)]), ("known", ["0-7"])):
            rows = spark.createDataFrame([(x,) for x in ids], "documentId string")
            asked = rows.withColumn("_bucket", incremental.bucket_of("documentId"))
            hits = incremental.suspects(spark, target, now, asked, "documentId")
            stored = incremental.stored_ids(spark, target, now, hits, "documentId", schemas.NOTICE_DETAIL)
            read[k, kind] = 0 if stored is None else stored.count()
    assert read[2, "new"] <= 60 and read[8, "new"] <= 60
    assert 1 <= read[2, "known"] <= 20 and 1 <= read[8, "known"] <= 20


def test_filters_know_every_id(spark, tmp_path):
    ids = [f"id {i}" for i in range(3000)]
    load_ids(spark, tmp_path, "l", ids)
    target = str(tmp_path / "t")
    rows = spark.createDataFrame([(x,) for x in ids], "documentId string")
    asked = rows.withColumn("_bucket", incremental.bucket_of("documentId"))
    hits = incremental.suspects(spark, target, incremental.manifest(spark, target), asked, "documentId")
    assert hits.count() == 3000


def test_compaction_bounds_the_files(spark, tmp_path):
    target = tmp_path / "t"
    for k in range(9):
        load_ids(spark, tmp_path, f"l{k}", [f"{k}-{i}" for i in range(5)] + ["0-0"])
    now = incremental.manifest(spark, str(target))
    assert len(now.loads) <= incremental.FAN
    kept = [p for p in (target / "rows").iterdir() if p.is_dir()]
    assert len(kept) <= len(now.loads) + incremental.FAN * (incremental.GRACE + 1)
    assert len(list((target / "manifest").glob("v=*"))) <= incremental.GRACE + 1
    rows = incremental.read_target(spark, str(target), schemas.NOTICE_DETAIL)
    assert sorted(r["documentId"] for r in rows.collect()) == sorted(f"{k}-{i}" for k in range(9) for i in range(5))


def test_a_crash_in_the_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    for k in range(4):
        load_ids(spark, tmp_path, f"l{k}", [f"{k}-{i}" for i in range(5)], compacted=False)
    before = incremental.read_target(spark, target, schemas.NOTICE_DETAIL)

    def ids():
        return sorted(r["documentId"] for r in incremental.read_target(spark, target, schemas.NOTICE_DETAIL).collect())

    expected = ids()

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "commit", crash)
        with pytest.raises(RuntimeError):
            incremental.compact(spark, target, schemas.NOTICE_DETAIL, "documentId")
    assert ids() == expected
    incremental.compact(spark, target, schemas.NOTICE_DETAIL, "documentId")
    assert len(incremental.manifest(spark, target).loads) == 1
    assert ids() == expected
    # Who has read the manifest before the compaction still finds the rows.
    assert sorted(r["documentId"] for r in before.collect()) == expected
    load_ids(spark, tmp_path, "more", ["0-1", "9"])
    assert ids() == sorted([*expected, "9"])


def test_a_batch_that_dies_before_its_manifest_is_run_again(spark, tmp_path, monkeypatch):
    landing, target, checkpoint = (tmp_path / n for n in ("landing", "t", "c"))
    drop(landing, "a.json", ["1", "2"])
    (landing / "b.json").write_text('{"documentId": "3"\n\n{"section2": "x"}\n{"documentId": "4"} tail\n{"documentId": "5"}')

    def run():
        incremental.load_new(spark, str(landing), str(target), str(checkpoint), schemas.NOTICE_DETAIL, "documentId")
        rows = incremental.read_target(spark, str(target), schemas.NOTICE_DETAIL).collect()
        bad = incremental.read_quarantine(spark, str(target)).collect()
        return sorted(r["documentId"] for r in rows), sorted((r["reason"], r["record"]) for r in bad)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "commit", crash)
        with pytest.raises(Exception, match="lost"):
            run()
    expected = (
        ["1", "2", "5"],
        [("malformed", '{"documentId": "3"'), ("malformed", '{"documentId": "4"} tail'), ("no_id", '{"section2": "x"}')],
    )
    assert run() == expected
    assert run() == expected
    # The manifest is written, but the checkpoint does not know it.
    for record in (checkpoint / "commits").glob("*0*"):
        record.unlink()
    assert run() == expected
    checkpoint = tmp_path / "another"
    assert run() == expected


def test_records_of_wrong_types(spark, tmp_path):
    schema = "id long, n long, o struct<p:long>"
    schema = spark.createDataFrame([], schema).schema
    lines = [
        '{"id": 1, "n": 2, "o": {"p": 3}}',
        '{"id": 2, "n": "two"}',
        '{"id": "x"}',
        '{"id": 4, "o": {"p": "q"}}',
        '{"id": 5},{"id": 6}',
        '{"id": 7}],"v":[{"id": 8}',
        "null",
        "3",
        '{"id": 9, "_end": "guess"}',
    ]
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text("\n".join(lines))
    incremental.load_new(spark, str(tmp_path / "landing"), str(tmp_path / "t"), str(tmp_path / "c"), schema, "id")
    rows = incremental.read_target(spark, str(tmp_path / "t"), schema).collect()
    assert sorted(map(tuple, rows)) == [(1, 2, (3,)), (9, None, None)]
    bad = incremental.read_quarantine(spark, str(tmp_path / "t")).collect()
    assert {r["record"]: r["reason"] for r in bad} == dict(
        zip(lines[1:8], ["wrong_type", "wrong_type", "wrong_type", "malformed", "malformed", "malformed", "malformed"])
    )


def test_batches_of_single_files(spark, tmp_path):
    landing = tmp_path / "landing"
    for i, name in enumerate("abc"):
        drop(landing, f"{name}.json", [str(i), "shared"], name)
    incremental.load_new(
        spark, str(landing), str(tmp_path / "t"), str(tmp_path / "c"), schemas.NOTICE_DETAIL, "documentId", files_per_batch=1
    )
    loaded = incremental.read_loads(spark, str(tmp_path / "t"), schemas.NOTICE_DETAIL)
    assert loaded.select("_load").distinct().count() == 3
    assert sorted(r["documentId"] for r in loaded.collect()) == ["0", "1", "2", "shared"]
    assert loaded.where("documentId = 'shared'").first()["section2"] == "a"


def test_unreadable_records(spark, tmp_path):
    landing = tmp_path / "landing"
    drop(landing, "a.json", ["1"])
    (landing / "b.json").write_text('{"documentId": "2"\n{"section2": "no id"}\n{"documentId": "3"}')
    incremental.load_new(
        spark, str(landing), str(tmp_path / "t"), str(tmp_path / "c"), schemas.NOTICE_DETAIL, "documentId"
    )
    loaded = incremental.read_target(spark, str(tmp_path / "t"), schemas.NOTICE_DETAIL)
    assert sorted(r["documentId"] for r in loaded.collect()) == ["1", "3"]
    bad = incremental.unreadable(spark, str(landing), "documentId").collect()
    assert sorted(r["record"] for r in bad) == ['{"documentId": "2"', '{"section2": "no id"}']
    assert all(r["file"].endswith("b.json") for r in bad)
