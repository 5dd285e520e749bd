import os

import pytest

import __spark_entry__ as entry
from registry import oracle, queries
from compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(oracle.SQL)
    assert set(queries.QUERIES) <= set(entry.queries())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["doc_id", "lang", "tokenized"] and result.count() > 0
