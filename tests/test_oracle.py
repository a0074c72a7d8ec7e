"""Every query with SQL against DuckDB on sf0.001 (the driver checks sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, rows_key

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered_and_entry_runs(spark):
    assert set(SQL) <= set(entry.queries())
    assert entry.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    spark_rows = rows_key(tuple(r[c] for c in order) for r in df.collect())
    idx = [rel.columns.index(c) for c in order]
    duck_rows = rows_key(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert spark_rows == duck_rows
