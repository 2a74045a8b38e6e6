"""Every registered query against its SQL."""

import pytest
from oracle import connect, differences

import __spark_entry__ as spark_entry

QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry_runs(spark):
    df = spark_entry.entry(spark)
    assert df.columns[:2] == ["event_id", "user_id"] and df.count() > 0
