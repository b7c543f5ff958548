"""Each contract query against its SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES = {query.__name__: query for query in contract.contract.ALL}
SQL = contract.oracle.SQL


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    yield con
    con.close()


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


def _rows(columns, rows):
    names = sorted(columns)
    return sorted((repr(tuple(dict(zip(columns, row))[n] for n in names)) for row in rows))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, map(tuple, df.collect())) == _rows(columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["ID", "Predicted_AwT_score", "Predicted_SoE_score"] and df.count() > 0
