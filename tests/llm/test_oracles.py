"""Registered queries against their SQL, run by DuckDB on the same files."""

import glob
import os

import duckdb
import pytest

from freshet.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
