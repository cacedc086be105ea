"""Every query that has SQL gives what DuckDB gives, on the smallest tables."""

import os

import duckdb
import pytest

from sedimenta.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{SF}/{name}.parquet"
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def cell(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_sql(spark, duck, name):
    frame = catalogue.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted(tuple(cell(r[c]) for c in columns) for r in frame.collect())
    wanted = duck.sql(catalogue.ORACLES[name])
    own = list(wanted.columns)
    assert sorted(own) == columns
    assert got == sorted(tuple(cell(dict(zip(own, r, strict=True))[c]) for c in columns) for r in wanted.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_others_give_rows(spark, name):
    frame = catalogue.QUERIES[name](spark, SF)
    assert frame.count() > 0 and len(set(frame.columns)) == len(frame.columns)
