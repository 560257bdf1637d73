import pytest
from compare import compare

from textengine.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert Q.QUERIES.keys() == Q.SQL.keys()


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query_matches_sql(spark, name):
    compare(spark, SF, Q.QUERIES[name], Q.SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(Q.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
