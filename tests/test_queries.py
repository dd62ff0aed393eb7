"""Every registered query that SQL can express, beside its SQL."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, con, sf_dir):
    message, _, _ = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name])
    spark.catalog.clearCache()
    assert message == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "label" in df.columns
