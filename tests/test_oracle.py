"""Every query with check SQL must agree with DuckDB on the smallest fixture."""

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    columns = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == columns
    theirs = sorted(result.select(*[f'"{c}"' for c in columns]).fetchall(), key=str)
    assert mine and mine == theirs


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["userid", "itemid", "score"] and df.count() > 0
