"""The queries that have an oracle, against DuckDB on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from cohortlens.llm.queries import oracle_sql

sys.path.insert(0, os.path.join(os.path.dirname(entry.__file__), "tools"))
from check_oracle import TABLES, canon  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(columns, cur.fetchall())
    con.close()
