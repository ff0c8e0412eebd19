"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import pytest
from oracle import compare, connect

from corpusloom.queries import all_queries

CHECKED = {name: q for name, q in all_queries().items() if q.sql}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, sf, name):
    query = CHECKED[name]
    assert compare(spark, con, sf, query.build, query.sql) is None


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(5).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
