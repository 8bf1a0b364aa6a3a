"""The registered queries against their DuckDB oracles (the driver's check), at sf0.001."""
import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from feedspark.plans.landing import TABLES
from feedspark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "\u0000"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(got, df.columns) == _rows(want, rel.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "mo_id", "name", "tenant_id"]
    assert df.count() > 0
