"""Every story query runs on the smallest tables, and those with SQL give what the SQL gives."""

import duckdb
import pytest

from storyloom.plans import details, details_oracle, oracle, queries

QUERIES, ORACLE_SQL = queries.QUERIES | details.QUERIES, oracle.ORACLE_SQL | details_oracle.ORACLE_SQL

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings labels pages benchmark conversations".split()


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    return repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    got = sql.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(got.columns)
    at = [got.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in rows) == sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())


def test_entry_without_the_training_data_operators():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
