"""Every query with SQL against DuckDB at the smallest scale."""

import os

import duckdb
import pytest
from chainlake.plans.catalog import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(DATA):
        path = f"{DATA}/{name}" + ("/*.parquet" if os.path.isdir(f"{DATA}/{name}") else "")
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    wanted = duck.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    rows = sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect())))
    assert rows == sorted(map(repr, wanted.select(*columns).fetchall()))
