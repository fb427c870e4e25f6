"""Every query with SQL gives the same rows in Spark and in DuckDB; the others run."""

import pytest

from tests.conftest import DATA
from tests.oracle import connect, rows
from tidemark.plans import archive, changes, operators

SQL = {**changes.SQL, **archive.SQL, **operators.SQL}
QUERIES = {**changes.QUERIES, **archive.QUERIES, **operators.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry_registers_everything():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
