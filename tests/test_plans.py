"""The plans have the shape they need on large data."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from noticeworks.operators import categories, joins, matching, ranking
from noticeworks.plans.queries import QUERIES
from noticeworks.sources import files

FOLDER = "/root/testdata/sf0.001"
SCORERS = {"scorer_seam", "scorer_distinct", "taxonomy_match", "social_match", "energy_matches"}
#: Files are listed by a Python data source, entries packed by a Python function.
PYTHON = {"attachment_scan", "packed_prompts"}


def plan(df, part="executedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SCORERS])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_module.queries()[name](spark, FOLDER))
    assert name in PYTHON or "Python" not in text and "InPandas" not in text
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize(
    "name", ["criteria_social", "reserved_any_flag", "bidders_silver", "social_participation", "energy_criteria"]
)
def test_json_is_parsed_once(spark, settings, name):
    settings(spark__sql__maxMetadataStringLength="100000", spark__sql__debug__maxToStringFields="1000")
    text = plan(entry_module.queries()[name](spark, FOLDER), "optimizedPlan")
    assert text.count("from_json(") == 1


@pytest.mark.parametrize("name", ["audit_criteria", "audit_versions"])
def test_audits_parse_whole_texts_once(spark, settings, name):
    """One parse; the second one stands behind a condition, for texts that go on behind their value."""
    settings(spark__sql__maxMetadataStringLength="100000", spark__sql__debug__maxToStringFields="1000")
    text = plan(entry_module.queries()[name](spark, FOLDER), "optimizedPlan")
    assert text.count("from_json(") == 2 and "parse_json(" not in text
    assert re.search(r"CASE WHEN [^\n]*\.whole[^\n]* ELSE from_json\(", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry_module.queries()["type_date_filter"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text and "In(o_orderstatus" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>", text)
    lines = plan(entry_module.queries()["semi_awarded_lines"](spark, FOLDER))
    assert "LeftSemi" in lines and "l_extendedprice" not in lines


def test_attachment_bytes_are_not_read(spark, tmp_path):
    (tmp_path / "1").mkdir()
    (tmp_path / "1" / "a").write_bytes(b"x")
    assert "content" not in plan(files.read_attachments(spark, str(tmp_path)))


def test_first_rows_are_cut_before_the_shuffle(spark):
    text = plan(ranking.keep_first(spark.range(10).selectExpr("id % 2 as k", "id"), ["k"], [F.col("id")]))
    assert re.search(r"Final(.|\n)*Exchange(.|\n)*WindowGroupLimit.*Partial", text)


def test_small_maps_are_broadcast_without_shuffling_notices(spark):
    parts = spark.read.parquet(f"{FOLDER}/part.parquet").select("p_partkey", "p_name")
    for mode in ("all", "distinct_category"):
        text = plan(categories.categorise(parts, files.category_pairs(spark, {"a": ["re", "red"]}), "p_name", mode))
        left = text[text.index("p_partkey") : text.index("FileScan")]
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning(_prefix" not in left


def test_small_taxonomy_is_scored_without_a_shuffle(spark):
    text = plan(entry_module.queries()["social_match"](spark, FOLDER))
    assert "hashpartitioning" not in text and text.count("ArrowEvalPython") == 1


# A third of the rows share one key; everything is too large to broadcast.


@pytest.fixture
def large(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )


@pytest.fixture
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20000)
    return spark.range(0, 300000, 1, 8).select(key.alias("k"), "id")


@pytest.fixture
def ids(spark):
    hot_id = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 10000)
    return spark.range(0, 60000, 1, 8).select(hot_id.alias("i"))


def is_split(df, n):
    assert len(df.collect()) == n
    return "skew=true" in plan(df)


def test_hot_ids_are_split(hot, ids, large):
    known = {r["i"] for r in ids.distinct().collect()}
    rows = [r["k"] for r in hot.collect()]
    n = sum(k in known for k in rows)
    assert is_split(joins.rows_in(hot, ids, "k", "i"), n)
    assert is_split(joins.rows_not_in(hot, ids, "k", "i"), len(rows) - n)
    assert is_split(joins.flag_in(hot, ids, "k", "i", "f"), len(rows))
    assert is_split(joins.detail_join(hot, ids.distinct().withColumn("v", F.lit(1)), "k", "i"), n)


def test_missing_ids_are_split(hot, ids, large):
    rows = hot.withColumn("k", F.nullif("k", F.lit(7)))
    assert is_split(joins.flag_in(rows, ids, "k", "i", "f"), 300000)
    assert is_split(joins.rows_not_in(rows, ids, "k", "i"), joins.flag_in(rows, ids, "k", "i", "f").where("not f").count())


@pytest.mark.parametrize("mode", ["all", "distinct_category"])
def test_hot_prefix_is_split(spark, hot, large, mode):
    pairs = spark.range(0, 20000, 1, 4).selectExpr("cast(id % 97 as string) category", "cast(id + 10000 as string) prefix")
    code = F.when(F.col("id") % 3 == 0, "10045").otherwise(F.concat(F.lit("9"), F.col("id") % 9999))
    df = categories.categorise(hot.select(code.alias("code"), "id"), pairs, "code", mode)
    assert is_split(df, 100000)


def test_copies_of_a_criterion_are_split_and_scored_once(spark, hot, large, monkeypatch):
    monkeypatch.setattr(matching, "MAX_BYTES", 1)
    content = F.when(F.col("id") % 3 == 0, "green energy").otherwise(F.concat(F.lit("energy "), F.col("id") % 50))
    rows = hot.select(F.lit(1).alias("k"), content.alias("t"))
    taxonomy = spark.createDataFrame([(1, "green"), (2, "energy green"), (3, "energy")], "e int, d string")
    found = matching.best_match(rows, "k", "t", taxonomy, "e", "d")
    assert is_split(found, 300000)
    counts = {(r["e"], r["overlap"]): r["n"] for r in found.groupBy("e", "overlap").agg(F.count("*").alias("n")).collect()}
    assert counts == {(2, 2): 100000, (2, 1): 200000}


def test_copies_of_a_text_are_split_and_scored_once(spark, hot, large):
    seen = spark.sparkContext.accumulator(0)

    def scorer(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch.assign(response=batch["t"].str.upper())

    content = F.when(F.col("id") % 3 == 0, "green").otherwise(F.concat(F.lit("e"), F.col("id") % 5000))
    found = matching.score_distinct(hot.select("id", content.alias("t")), "t", scorer)
    assert is_split(found, 300000)
    assert seen.value == 5001
    assert found.where("response <> upper(t)").count() == 0
