"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from passagerank.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
KEYS = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, con, key):
    df = entry.queries()[key](spark, SF_DIR)
    rows = df.collect()
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert rows
        return
    result = con.execute(sql)
    assert difference(rows, df.columns, result.fetchall(), [d[0] for d in result.description]) is None


def test_every_query_but_the_trained_ones_has_sql():
    assert set(KEYS) - set(entry.oracle_sql()) == {"lambdamart_rank", "random_forest_rank"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
