"""Every registered query that has SQL gives the same table in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL
from tools.check import TABLES, canonical

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, db, name):
    mine = QUERIES[name](spark, SMALL).toPandas()
    theirs = db.sql(SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert canonical(mine) == canonical(theirs)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
