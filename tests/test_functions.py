import os

import pytest
from pyspark.sql import functions as F

from noticeworks.functions import dates, json_text, text


def values(spark, column, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def test_strip_extension(spark):
    names = ["a.pdf", "a.pdf.p7m", "a.p7s", ".hidden", "noext", "..a", "a.", "a.b.c", "..a.b"]
    assert values(spark, text.strip_extension, names) == [os.path.splitext(n)[0] for n in names]


def test_digits(spark):
    inputs = ["RO 123", "123", None, "none", "٣٤", "007", "R1O2 3"]
    assert values(spark, text.digits, inputs) == ["123", "123", None, "", "٣٤", "007", "123"]


def test_strip_fence(spark):
    inputs = ['```json\n{"a": 1}\n```', '{"a": 1}', ' \n{"a": 1}\t', '```json{"a": "```json"}```', "```json```"]
    expected = [i.removeprefix("```json").removesuffix("```").strip() for i in inputs]
    assert values(spark, text.strip_fence, inputs) == expected


def test_suffix_and_keywords(spark):
    assert values(spark, lambda c: text.has_suffix(c, [".p7m", ".p7s"]), ["a.p7m", "a.p7s", "p7s", "a.pdf"]) == [
        True, True, False, False,
    ]
    assert values(spark, lambda c: text.contains_all(c, ["98/2016", "56"]), ["art 56 98/2016", "56"]) == [True, False]


def test_joined_reads_null_as_empty(spark):
    assert values(spark, lambda c: text.joined(c, ": ", c), ["a", None]) == ["a: a", ": "]
    assert values(spark, lambda c: text.notice_url(c, "u/"), ["1", None]) == ["u/1", "u/"]


def test_field_or_default(spark):
    inputs = ['{"k": 5}', '{"k": null}', "{}", "bad", None, "[1]", '{"k": "x"}']
    assert values(spark, lambda c: json_text.field_or_default(c, "k", "111"), inputs) == [
        "5", None, "111", "111", "111", "111", "x",
    ]
    assert values(spark, lambda c: json_text.field(c, "k"), inputs) == ["5", None, None, None, None, None, "x"]


def test_flags_and_malformed(spark):
    inputs = ['{"a": true}', '{"a": false}', '{"a": null}', "{}", "bad", None]
    assert values(spark, lambda c: json_text.flags(c, ["a"])["a"], inputs) == [True, False, None, None, None, None]
    assert values(spark, json_text.malformed, inputs) == [False, False, False, False, True, False]
    assert values(spark, lambda c: json_text.any_true(json_text.flags(c, ["a"])["a"]), inputs) == [
        True, False, False, False, False, False,
    ]


def test_windows(spark):
    rows = dates.windows(spark, "2022-01-01", "2026-12-01").orderBy("window_start").collect()
    assert len(rows) == 60
    assert rows[25]["start_text"] == "2024-02-01T00:00:00.000Z"
    assert rows[25]["end_text"] == "2024-02-29T23:59:59.999Z"


def test_in_range_includes_both_days(spark):
    inputs = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-02 23:59:59", "2024-02-03 00:00:00"]
    keep = lambda c: dates.in_range(c.cast("timestamp_ntz"), "2024-02-01", "2024-02-02")
    assert values(spark, keep, inputs) == [False, True, True, False]


@pytest.mark.parametrize("value,expected", [("The cat, the CAT!", ["the", "cat"]), ("", []), ("Été 5", ["été", "5"])])
def test_tokens(spark, value, expected):
    assert values(spark, text.tokens, [value]) == [expected]


def test_strip_fence_strips_what_python_strips(spark):
    inputs = ["\u2003x\u3000", "\x1c y \x85", "```json \u00a0{}\u2028```", "```", "`` `"]
    expected = [i.removeprefix("```json").removesuffix("```").strip() for i in inputs]
    assert values(spark, text.strip_fence, inputs) == expected
