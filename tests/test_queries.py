"""Every registered query on the smallest data set, against its SQL where there is one."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


def test_every_sql_belongs_to_a_query():
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    if name not in ORACLE:
        assert df.count() > 0
        return
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(plain(v) for v in r) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == want


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
