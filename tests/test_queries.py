"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_module
import oracle
from noticeworks.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = entry_module.queries()[name](spark, FOLDER)
    assert oracle.difference(df, con, entry_module.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4
