"""The operators that SQL can express against DuckDB, over whole tables."""

import glob
import os

import duckdb
import pytest

from tidemark.llm import oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(oracles.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    have = sorted(map(tuple, df.select(*names).collect()), key=str)
    assert have == sorted(want.fetchall(), key=str)
