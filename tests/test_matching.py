import json

import pytest
from pyspark.sql import functions as F

from noticeworks import fixed_values as V
from noticeworks.functions import text
from noticeworks.operators import matching
from noticeworks.sources import files
from noticeworks.sources.tables import small_table

MODEL = {
    "criteria": {
        "a": {"id": 1, "text": "one", "product_group_subjects": [{"product_group_id": 11}]},
        "b": {"id": 2, "text": "two", "product_group_subjects": [{"product_group_id": 3}]},
        "c": {"id": 3, "text": "three", "product_group_subjects": []},
        "d": {"id": 1, "text": "one again", "product_group_subjects": [{"product_group_id": 5}, {"product_group_id": 12}]},
        "e": {"id": 1, "text": "one elsewhere", "product_group_subjects": [{"product_group_id": 4}]},
        "f": {"id": 4, "text": "four", "product_group_subjects": [{"product_group_id": 11}, {"product_group_id": 12}]},
    }
}


def test_model_criteria(spark, tmp_path):
    path = tmp_path / "model.txt"
    path.write_text(json.dumps(MODEL, indent=1), encoding="utf-8")
    read = files.read_model_criteria(spark, str(path))
    assert [r["key"] for r in read.orderBy("pos").collect()] == list("abcdef")
    kept = matching.model_criteria_of_groups(read, V.ENERGY_PRODUCT_GROUPS)
    assert sorted(map(tuple, kept.collect())) == [(1, "one again"), (4, "four")]


def test_prompts(spark):
    rows = spark.createDataFrame([(1, "name", None, "how")], "id int, n string, d string, a string")
    taxonomy = small_table(spark, key=["B", "A"], definition=["second", "first"])
    made = matching.prompts(rows, matching.taxonomy_text(taxonomy, "key", "definition"), "n", "d", "a").first()["prompt"]
    assert "A: first\nB: second" in made and made.endswith("name: , how")
    literal = matching.prompts(rows, matching.taxonomy_literal({"A": "first", "B": "second"}), "n", "d", "a")
    assert literal.first()["prompt"] == made


def test_taxonomy_text_has_no_bound(spark, monkeypatch):
    monkeypatch.setattr(matching, "MAX_ENTRIES", 1)
    taxonomy = small_table(spark, key=["B", "A"], definition=["x", "y"])
    assert spark.range(1).select(matching.taxonomy_text(taxonomy, "key", "definition")).first()[0] == "A: y\nB: x"


def test_a_repeated_id_has_one_text_whatever_the_order(spark):
    rows = [(1, 0, "b", [11]), (1, 0, "c", [11]), (1, 0, "a", [12])]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "id long, pos int, text string, groups array<int>")
        assert matching.model_criteria_of_groups(df, [11, 12]).first()["text"] == "c"


def test_responses(spark):
    full = dict(zip(V.RESPONSE_KEYS, ("11604", "verde", "green")))
    cases = {
        "ok": json.dumps(full),
        "fenced": "```json\n" + json.dumps(full) + "\n```",
        "missing": json.dumps({"match": "1"}),
        "extra": json.dumps({**full, "why": 1}),
        "text": "no match",
        "list": "[1]",
        "null": None,
        "trailing": json.dumps(full) + " as asked",
        "twice": json.dumps(full) + json.dumps(full),
        "listed": json.dumps(full) + "," + json.dumps(full),
        "closed": json.dumps(full) + "],[" + json.dumps(full),
        "null match": json.dumps({**full, "match": None}),
        "number": json.dumps({**full, "match": 3}),
        "object": json.dumps({**full, "match": {"id": 3}}),
    }
    rows = spark.createDataFrame(list(cases.items()), "id string, response string")
    read = matching.read_responses(rows, "response")
    status = {r["id"]: r["status"] for r in read.collect()}
    assert status == {
        "ok": "ok", "fenced": "ok", "missing": "missing_key", "extra": "extra_key",
        "text": "not_json", "list": "not_json", "null": "not_json", "trailing": "not_json", "twice": "not_json",
        "listed": "not_json", "closed": "not_json", "null match": "wrong_type", "number": "wrong_type", "object": "wrong_type",
    }
    good = matching.accepted(read).collect()
    assert {r["id"] for r in good} == {"ok", "fenced"} and {r["match"] for r in good} == {"11604"}
    assert matching.quarantined(read).columns == ["id", "response", "status"]
    assert matching.quarantined(read).count() == 12


def best_by_hand(rows, entries, threshold):
    import re

    def words(s):
        return {w for w in re.split(r"[^\w]+", (s or "").lower()) if w}

    out = []
    for key, content in rows:
        own = words(content)
        scored = [
            (-len(own & words(c)), k is None, k or 0, len(words(c)), len(own & words(c)) / len(own | words(c)))
            for k, c in entries
            if own & words(c)
        ]
        best = min(scored, default=(0, True, 0, 0, 0))
        good = -best[0] >= max(1, threshold)
        out.append((key, None if best[1] else best[2], -best[0], round(best[4], 9)) if good else (key, None, None, None))
    return sorted(out, key=repr)


ROWS = [
    (1, "green energy supply"), (1, "green energy supply"), (1, "safety at work"), (2, "nothing shared"),
    (3, "work work energy"), (4, ""), (None, "green energy"), (5, None),
]
ENTRIES = [
    (20, "energy supply green"), (10, "work safety"), (30, "energy at work"), (10, "work safety at home"), (None, "energy"),
    (None, "green energy supply shared"), (40, ""), (10, "work safety"),
]


@pytest.mark.parametrize("form", ["in row", "shuffled"])
@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_best_match_is_one_result_in_both_forms(spark, monkeypatch, form, threshold):
    if form == "shuffled":
        monkeypatch.setattr(matching, "MAX_BYTES", 1)
    criteria = spark.createDataFrame(ROWS, "id int, content string")
    taxonomy = spark.createDataFrame(ENTRIES, "entry int, definition string")
    found = matching.best_match(criteria, "id", "content", taxonomy, "entry", "definition", threshold)
    rows = [(r["id"], r["entry"], r["overlap"], r["jaccard"] and round(r["jaccard"], 9)) for r in found.collect()]
    assert sorted(rows, key=repr) == best_by_hand(ROWS, ENTRIES, threshold)
    assert ("ArrowEvalPython" in found._jdf.queryExecution().optimizedPlan().toString()) == (form == "in row")


def test_empty_taxonomy(spark):
    criteria = spark.createDataFrame(ROWS, "id int, content string")
    none = spark.createDataFrame([], "entry int, definition string")
    rows = matching.best_match(criteria, "id", "content", none, "entry", "definition").collect()
    assert len(rows) == len(ROWS) and all(r["entry"] is None and r["overlap"] is None for r in rows)


def test_forms_agree_on_whole_documents(spark, monkeypatch):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")

    def run(threshold):
        found = matching.best_match(documents, "doc_id", "text", items, "item_id", "text", threshold)
        return sorted(map(tuple, found.collect()))

    in_row = [run(t) for t in (1, 5)]
    monkeypatch.setattr(matching, "MAX_BYTES", 1)
    assert [run(t) for t in (1, 5)] == in_row and len(in_row[0]) == documents.count()


def test_scorer_and_url(spark):
    def shout(batches):
        for batch in batches:
            yield batch.assign(loud=batch["t"].str.upper())

    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    scored = matching.score_rows(rows, shout, "id int, t string, loud string")
    assert sorted(r["loud"] for r in scored.collect()) == ["A", "B"]
    assert matching.with_url(rows.where("id = 1"), "id", "u/").first()["URL"] == "u/1"
    assert rows.select(F.size(text.tokens(F.col("t")))).count() == 2


def test_scoring_resumes_and_keeps_errors(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def scorer(fails):
        def scored(batches):
            for batch in batches:
                if batch["t"].isin(fails).any():
                    raise ValueError("no")
                seen.add(len(batch))
                yield batch.assign(response=batch["t"].str.upper())

        return scored

    def run(texts, fails=()):
        before = seen.value
        rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
        out = matching.score_resumed(rows, "t", scorer(list(fails)), str(tmp_path / "answers"), portion=2).collect()
        return {r["t"]: (r["response"], r["error"]) for r in out}, len(out), seen.value - before

    found, n, calls = run(["a", "b", "b", None, "c"], ["b"])
    assert found == {"a": ("A", None), "b": (None, "ValueError: no"), "c": ("C", None), None: (None, None)}
    assert (n, calls) == (5, 2)
    found, _, calls = run(["a", "b", "c", "d"])
    assert found == {x: (x.upper(), None) for x in "abcd"} and calls == 2
    found, _, calls = run(["a", "b", "c", "d"])
    assert found == {x: (x.upper(), None) for x in "abcd"} and calls == 0
    assert run([])[:2] == ({}, 0)


def test_a_run_that_dies_keeps_its_portions(spark, tmp_path, monkeypatch):
    texts = spark.createDataFrame([(f"text {k}",) for k in range(60)], "t string")
    seen = spark.sparkContext.accumulator(0)

    def scorer(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch.assign(response=batch["t"])

    calls, score = [], matching.score_rows

    def dying(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return score(*args)

    with monkeypatch.context() as patch:
        patch.setattr(matching, "score_rows", dying)
        with pytest.raises(RuntimeError):
            matching.score_resumed(texts, "t", scorer, str(tmp_path / "a"), portion=15)
    done = matching.read_answers(spark, str(tmp_path / "a")).count()
    assert 10 < done < 50 and seen.value == done
    out = matching.score_resumed(texts, "t", scorer, str(tmp_path / "a"), portion=15)
    assert out.where("response = t and error is null").count() == 60 and seen.value == 60


def test_first_fit():
    assert matching.first_fit([7, 5, 4, 3, 1], 10) == [0, 1, 1, 0, 1]
    assert matching.first_fit([30, 2, 9], 10) == [0, 1, 2]
    assert matching.first_fit([], 10) == []


def test_packed_prompts_hold_each_entry_once(spark, monkeypatch):
    monkeypatch.setattr(matching, "PACKED_TOGETHER", 40)
    entries = [(k, f"entry {k} " + "x" * (k % 37)) for k in range(150)] + [(900, "y" * 500), (901, None)]
    taxonomy = spark.createDataFrame(entries, "id int, t string")
    packs = matching.packed_taxonomy(taxonomy, "id", "t", 200)
    lines = {r["pack"]: r["lines"].split("\n") for r in packs.collect()}
    assert sorted(x for p in lines.values() for x in p) == sorted(f"{k}: {t or ''}" for k, t in entries)
    assert all(len("\n".join(p)) <= 200 or len(p) == 1 for p in lines.values())
    criteria = spark.createDataFrame([(1, "one"), (2, "two")], "k int, c string")
    asked = matching.packed_prompts(criteria, packs, "c").collect()
    assert len(asked) == 2 * len(lines)
    for r in asked:
        assert all(f"\n{x}\n" in r["prompt"] for x in lines[r["pack"]]) and r["prompt"].endswith({1: ": one", 2: ": two"}[r["k"]])
    empty = matching.packed_taxonomy(taxonomy.where("false"), "id", "t", 200)
    assert matching.packed_prompts(criteria, empty, "c").count() == 0


def test_merged_answers(spark):
    rows = [(1, "a", "not_json"), (1, "b", "ok"), (1, "c", "ok"), (2, "b", "missing_key"), (2, "a", "extra_key")]
    read = spark.createDataFrame(rows, "k int, pack string, status string")
    assert sorted((r["k"], r["pack"]) for r in matching.merged_answers(read, "k").collect()) == [(1, "b"), (2, "a")]
