"""The training-data queries that SQL can express, against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from lodestream.llm.queries import ORACLE, QUERIES


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(show(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df, want = QUERIES[name](spark, sf), con.sql(ORACLE[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(want.fetchall(), want.columns)
