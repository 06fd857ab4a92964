import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st

from noticeworks import fixed_values as V
from noticeworks.operators.categories import categorise, shortest_prefixes
from noticeworks.sources import files

CODES = ["77314000-1", "45112710-5", "45233290-8", "45232", "331", "15", "09", "1", None, "4523329"]


def brute(codes, mapping):
    return sorted(
        (code, category)
        for code in codes
        if code is not None
        for category, prefixes in mapping.items()
        for prefix in prefixes
        if code.startswith(prefix)
    )


def run(spark, codes, mapping, mode="all"):
    notices = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "id long, code string")
    rows = categorise(notices, files.category_pairs(spark, mapping), "code", mode).collect()
    return sorted((r["code"], r["category"]) for r in rows)


@pytest.mark.parametrize("mapping", [V.SOCIAL_CATEGORIES, V.ENTERPRISE_CATEGORIES, V.INFRA_CATEGORIES])
def test_all_matches(spark, mapping):
    assert run(spark, CODES, mapping) == brute(CODES, mapping)


def test_nested_prefixes_repeat_a_notice(spark):
    found = run(spark, ["77314000-1"], V.SOCIAL_CATEGORIES)
    assert len(found) == 3 and len(set(found)) == 2


def test_distinct_category(spark):
    assert run(spark, CODES, V.SOCIAL_CATEGORIES, "distinct_category") == sorted(
        set(brute(CODES, V.SOCIAL_CATEGORIES))
    )


def test_join_beyond_broadcast_size_gives_the_same(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert run(spark, CODES, V.SOCIAL_CATEGORIES) == brute(CODES, V.SOCIAL_CATEGORIES)


@hypothesis_settings(max_examples=8, deadline=None)
@given(
    st.dictionaries(
        st.sampled_from("abc"), st.lists(st.text("12", max_size=4), min_size=1, max_size=5, unique=True), min_size=1
    ),
    st.lists(st.text("12", max_size=5), min_size=1, max_size=8, unique=True),
)
def test_random_maps(spark, mapping, codes):
    assert run(spark, codes, mapping) == brute(codes, mapping)
    assert run(spark, codes, mapping, "distinct_category") == sorted(set(brute(codes, mapping)))


def test_shortest_prefixes(spark):
    pairs = files.category_pairs(spark, {"a": ["7731", "77314", "5"], "b": ["77314"]})
    assert sorted(map(tuple, shortest_prefixes(pairs).collect())) == [("a", "5"), ("a", "7731"), ("b", "77314")]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        run(spark, CODES, V.INFRA_CATEGORIES, "first")


def test_map_file(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text('{"Food": ["15"],\n "Roads": ["45233", "3499"]}', encoding="utf-8")
    pairs = files.read_category_pairs(spark, str(path))
    assert sorted(map(tuple, pairs.collect())) == [("Food", "15"), ("Roads", "3499"), ("Roads", "45233")]


def test_fixed_maps():
    assert len(V.SOCIAL_CATEGORIES) == 22 and sum(map(len, V.SOCIAL_CATEGORIES.values())) == 39
    assert len(V.ENTERPRISE_CATEGORIES) == 126 and len({p for [p] in V.ENTERPRISE_CATEGORIES.values()}) == 126
    assert [p for [p] in V.INFRA_CATEGORIES.values()] == ["09", "65", "45"]
