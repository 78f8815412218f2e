"""Every named query against its SQL twin."""

from __future__ import annotations

import pytest
from shared import DATA

import __spark_entry__ as entry
import check

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return check.connect(DATA)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    got = check.rows_of(df.columns, df.collect())
    result = con.execute(SQL[name])
    assert got == check.rows_of([c[0] for c in result.description], result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["anunciante", "marca", "registros", "total_inversion"]
