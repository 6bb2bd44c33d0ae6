"""Every registered query against its SQL twin."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from tallyloom.checks.compare import connect, differences
from tallyloom.checks.oracle import ORACLE
from tallyloom.checks.queries import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, spark, con):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, con, ORACLE[name]) == []
    assert con.sql(ORACLE[name]).limit(1).fetchall(), "an empty result proves nothing"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 391
    assert df.columns[:2] == ["customer_id", "order_month"]
