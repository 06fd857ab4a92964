import pytest
from pyspark.sql import functions as F

from noticeworks.functions import dates
from noticeworks.operators import ranking, reports, sampling
from noticeworks.plans import standins

# Criterion weights and their histogram.
WEIGHTS = [
    5, 10, 10, 30, 20, 40, 30, 10, 30, 40, 6, 10, 6, 25, 25, 10, 15, 5, 10, 30,
    30, 10, 30, 40, 30, 30, 20, 10, 5, 30, 15, 30, 10, 15, 2, 30, 5, 5, 5, 5, 5,
]
BINS = [11, 12, 4, 11, 3, 0, 0, 0, 0, 0]


def test_histogram(spark):
    weights = spark.createDataFrame([(float(w),) for w in WEIGHTS], "w double")
    rows = reports.histogram(weights, "w", 10, 10).orderBy("bin").collect()
    assert [r["n"] for r in rows] == BINS
    assert [r["bin_start"] for r in rows] == [float(i * 10) for i in range(10)]


def test_histogram_edges(spark):
    values = spark.createDataFrame([(0.0,), (9.999,), (100.0,), (99.0,), (-1.0,), (100.1,), (None,)], "w double")
    counts = {r["bin"]: r["n"] for r in reports.histogram(values, "w", 10, 10).collect()}
    assert counts[0] == 2 and counts[9] == 2 and sum(counts.values()) == 4


def test_distinct_with_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "v string")
    assert reports.distinct_with_null(df, "v").first()["n"] == 3
    assert reports.distinct_with_null(df.dropna(), "v").first()["n"] == 2
    assert reports.distinct_with_null(df.where("false"), "v").first()["n"] == 0


def test_value_counts(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (None,)], "v boolean")
    assert [tuple(r) for r in reports.value_counts(df, "v").collect()] == [(False, 2), (True, 1)]


def test_completeness(spark):
    months = dates.windows(spark, "2024-01-01", "2024-03-01")
    rows = spark.createDataFrame([("2024-01-01",)] * 3 + [("2024-03-01",)], "m string").select(F.col("m").cast("date"))
    found = reports.completeness(months, rows, "m", cap=3).orderBy("window_start").collect()
    assert [(r["n"], r["status"]) for r in found] == [(3, "saturated"), (0, "empty"), (1, "ok")]
    assert reports.saturated(rows, "m", cap=3).first()["n"] == 3


@pytest.fixture
def ids(spark):
    return spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("c"))


def test_sample_does_not_depend_on_partitioning(ids):
    def draw(df):
        return {r["k"] for r in sampling.sample_ids(df, "k", 30, 42).collect()}

    assert draw(ids) == draw(ids.repartition(7)) == draw(ids.union(ids)) and len(draw(ids)) == 30
    assert draw(ids) != {r["k"] for r in sampling.sample_ids(ids, "k", 30, 43).collect()}


@pytest.mark.parametrize("n", [1, 999, 1001, 3000])
def test_first_n(spark, n):
    rows = spark.range(6000).selectExpr("id % 2 as k", "id")
    found = ranking.first_n(rows, ["k"], [F.col("id").desc()], n)
    lowest = {r["k"]: (r["low"], r["n"]) for r in found.groupBy("k").agg(F.min("id").alias("low"), F.count("*").alias("n")).collect()}
    count = min(n, 3000)
    assert lowest == {0: (5998 - 2 * (count - 1), count), 1: (5999 - 2 * (count - 1), count)}


def test_small_populations_come_whole(spark, ids):
    assert sampling.sample_ids(ids.limit(5), "k", 30, 42).count() == 5
    per = sampling.sample_ids_per(ids, "c", "k", 10, 42).groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in per} == {0: 10, 1: 10, 2: 10}


@pytest.mark.parametrize("bound", [100_000, 0])
def test_sample_criteria(spark, monkeypatch, bound):
    monkeypatch.setattr(sampling, "MAX_BROADCAST_IDS", bound)
    listed = spark.createDataFrame(
        [(i, "Food" if i % 2 else "Furniture", 5 if i < 40 else 2) for i in range(60)] + [(1, "Food", 5), (99, "Food", 5)],
        "cNoticeId long, category string, status int",
    )
    criteria = spark.range(60).selectExpr("cast(id as string) documentId", "explode(array(1, 2)) lot")
    drawn = sampling.sample_criteria(criteria, listed, ["Food", "Furniture", "Absent"], 5, 4, 42)
    rows = drawn.collect()
    assert len(rows) == 2 * 4 * 2
    assert {r["category"] for r in rows} == {"Food", "Furniture"}
    assert all(int(r["documentId"]) < 40 for r in rows)


def test_head_is_by_id(spark):
    assert [r["id"] for r in sampling.head(spark.range(100).repartition(5), "id", 3).collect()] == [0, 1, 2]


def test_labels(spark):
    rows = spark.createDataFrame([("personalSituation",), ("other",)], "field string")
    labels = {r["field"]: r["label"] for r in reports.with_labels(rows, "field").collect()}
    assert labels["other"] is None and labels["personalSituation"].startswith("III.1.1)")


def test_month_pages_are_bounded(spark):
    days = ["2024-01-03"] * 950 + ["2024-02-01"] * 30 + [None] * 15
    rows = [(k, day) for k, day in enumerate(days)]
    listed = spark.createDataFrame(rows, "cNoticeId long, publicationDate string").repartition(3)
    pages = standins.month_pages(listed, "publicationDate", 100, F.month("month") % 2).collect()
    items = [(i["cNoticeId"], i["publicationDate"]) for p in pages for i in p["items"]]
    assert sorted(items, key=lambda r: r[0]) == rows
    assert max(len(p["items"]) for p in pages) == 100
    totals = {(i["publicationDate"], p["total"]) for p in pages for i in p["items"]}
    assert totals == {("2024-01-03", 951), ("2024-02-01", 30), (None, None)}
