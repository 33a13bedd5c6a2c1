"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# At the smallest size these tables hold no such row.
EMPTY = {"orphans"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None or name in EMPTY and df.isEmpty()
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 6
    assert df.columns == ["source", "content_type", "n_items", "n_ids", "engagement", "context_chars"]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
