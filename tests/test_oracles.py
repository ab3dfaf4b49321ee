"""Every registered query against its SQL."""

import pytest
from oracle import compare
from support import SF

from feedloom.plans import load_all

QUERIES = load_all()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    q = QUERIES[name]
    assert compare(spark, con, name, q.run, q.sql, SF).startswith("ok")


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if not q.sql] == []


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1500
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
