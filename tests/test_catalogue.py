"""Every registered query against its SQL on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from lakeward.operators import keys
from lakeward.plans import catalogue, oracles
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")
QUERIES, ORACLES = catalogue.QUERIES, oracles.ORACLES
@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sql, name):
    assert compare(spark, sql, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", ["fk_flagged", "policy_valid", "fact_claims", "fact_sales"])
def test_equals_sql_when_lookups_are_too_large_to_broadcast(spark, sql, name, monkeypatch):
    monkeypatch.setattr(keys.lookup_join, "__defaults__", _with_hot_rows(3))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(spark, sql, QUERIES[name], ORACLES[name], SF_DIR) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _with_hot_rows(rows):
    """Defaults of lookup_join with keys of a few rows counting as hot."""
    spread_by, hot, _, salts = keys.lookup_join.__defaults__
    return spread_by, hot, rows, salts


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() > 0 and "rejection_rate_pct" in rows.columns
