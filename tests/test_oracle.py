"""Every registered query runs; those with oracle SQL must equal DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from beaconry.session import TABLES
from check_oracle import TYPES, cell


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, data, duck):
    df = queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(cell(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want
    types = {r[0]: r[1] for r in duck.execute("DESCRIBE " + sql).fetchall()}
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == types


def test_entry(spark, data):
    assert entry(spark).count() == 5


def test_names():
    assert set(oracle_sql()) <= set(queries())
