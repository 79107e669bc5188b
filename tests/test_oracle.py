"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as registry
import oracle

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registry.call_queries(), registry.call_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["month", "label", "upsales_success", "concerns_addressed", "calls"]
    assert df.count() > 0
