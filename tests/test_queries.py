import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
ORACLES, QUERIES = contract.oracle_sql(), contract.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, con.execute(ORACLES[name]).fetch_df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["id", "sales"] and out.count() > 0
