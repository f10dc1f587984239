"""Every registered query of the engine against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from lodestream.plans.oracle import ORACLE
from lodestream.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(show(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    want = duck.sql(ORACLE[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert canon(got, df.columns) == canon(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_imports_without_the_training_data_folder():
    import __spark_entry__ as entry

    assert {"strip_markup", "leader_clusters", "fact_rows"} <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
