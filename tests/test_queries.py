"""Every registered query of the library against its SQL, and the driver's entry."""

import math

import duckdb
import pytest

import __spark_entry__
from annolith.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v == int(v) else round(v, 6)
    return v if v is None or isinstance(v, (bool, int, str)) else str(v)


def rows_of(rows, columns, order):
    return sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    got = df.collect()
    if name not in catalogue.ORACLES:
        assert got
        return
    sql = duck.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in sql.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(got, df.columns, sorted(columns)) == rows_of(sql.fetchall(), columns, sorted(columns))


def test_entry(spark):
    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and out.columns == ["figure", "key", "n"]
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
