"""Every registered query against its DuckDB text on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from simquarry.plans.catalog import ORACLE as TEXTS
from simquarry.plans.catalog import QUERIES
from tests.compare import duck, run

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, ok = run(spark, con, SF_DIR, name, QUERIES[name], TEXTS[name])
    assert ok, message
    assert "EMPTY" not in message


def test_every_query_has_sql():
    assert set(TEXTS) == set(QUERIES)


def test_entry_has_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(TEXTS) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["ticket_id", "created_at", "username", "n_landings", "message"]
    assert df.count() > 0
