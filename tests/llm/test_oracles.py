"""Queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from mercato.llm.queries import ORACLES, QUERIES
from mercato.sources.readers import TABLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    cols = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, want))
    assert want
