"""Registered training-data queries against their SQL."""
import duckdb
import pytest

import __spark_entry__ as entry
from feedspark.llm.oracle import ORACLE_SQL
from feedspark.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(ORACLE_SQL[name])
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    got = sorted(map(repr, df.select(*sorted(df.columns)).toPandas().itertuples(index=False, name=None)))
    rows = sorted(map(repr, want.df()[sorted(df.columns)].itertuples(index=False, name=None)))
    assert got == rows


def test_all_fourteen_are_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
