"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, rows) == canonical(names, cur.fetchall())


def test_sql_only_for_known_queries():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 3 and "auc" in df.columns
