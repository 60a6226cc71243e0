"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return float(value) if hasattr(value, "as_tuple") or isinstance(value, float) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def test_names():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 80


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    rows = table(df.columns, df.collect())
    assert rows
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows == table(columns, result.fetchall())
