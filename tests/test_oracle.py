"""Every query against its SQL in DuckDB, on the smallest scale factor; queries without SQL must give rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    return 0.0 if isinstance(value, float) and value == 0 else value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    got = df.collect()
    if name not in SQL:
        assert got
        return
    cur = duck.execute(SQL[name])
    want = cur.fetchall()
    assert table(df.columns, got) == table([d[0] for d in cur.description], want)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["c_mktsegment", "time", "n_risk", "n_event", "n_censored", "surv"] and df.count() > 0
