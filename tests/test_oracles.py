"""Every registered query with a DuckDB twin agrees with it (columns, rows, values)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import connect, rows

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).fetchdf()
    gc, gr = rows(got)
    wc, wr = rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "target" in df.columns and "elo_diff" in df.columns
