"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_contract(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "thread_rank" and df.count() > 0
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert differences(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0
