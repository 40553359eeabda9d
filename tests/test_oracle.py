"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from mercato.checks.registry import ORACLES, QUERIES
from mercato.sources.readers import TABLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(tuple(str(x) for x in r) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    want = duck.sql(contract.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    place = [want.columns.index(c) for c in cols]
    expected = [[r[i] for i in place] for r in want.fetchall()]
    assert _sorted(got.select(*[f"`{c}`" for c in cols]).collect()) == _sorted(expected)
    assert expected, "a query that returns nothing checks nothing"
