"""Every registered query of the library against DuckDB on the smallest tables, or for its rows alone."""

import glob
import os

import duckdb
import pytest

from fieldglass.plans.catalogue import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(values):
    return sorted((tuple(None if v != v else v for v in r) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = rows(tuple(r[c] for c in columns) for r in df.collect())
    run = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in run.description]
    assert sorted(names) == columns
    want = rows(tuple(r[names.index(c)] for c in columns) for r in run.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
