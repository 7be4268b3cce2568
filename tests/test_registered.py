import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    n, ok, why = compare(spark, con, name, FOLDER)
    assert ok is not False, why
    assert n > 0 or name in ("C1_search",)


def test_entry(spark):
    assert entry.entry(spark).columns == ["district", "avg_rating", "total_count"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
