"""Derived landing areas: documents and files, whatever the number of tasks."""
import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from feedspark.plans import landing as L


@pytest.fixture
def tables(spark, tmp_path):
    """1200 events of one month, and orders of two months with four lines each
    (a part twice in an order; a customer and an extract without a value)."""
    day = lambda i: dt.datetime(2024, 1 + i % 2, 1 + i % 9)
    frames = {
        "nation": ([(0, "A"), (1, "B")], "n_nationkey long, n_name string"),
        "customer": ([(i, f"C{i}", "M", i % 2 if i else None) for i in range(30)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey long"),
        "part": ([(i, f"P{i}") for i in range(20)], "p_partkey long, p_name string"),
        "supplier": ([(i, f"S{i}", i % 2) for i in range(40)], "s_suppkey long, s_name string, s_nationkey long"),
        "orders": ([(i, i % 30, day(i) if i != 7 else None, "1-URGENT" if i % 3 else L.LOW_PRIORITY, "O") for i in range(600)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string"),
        "lineitem": ([(i, (i + k // 2) % 20, k, day(i + k), "N") for i in range(600) for k in range(4)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string"),
        "events": ([(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i // 2), i % 30, "click", float(i % 100)) for i in range(1200)],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"sf/{name}.parquet"))
    return str(tmp_path / "sf")


def plain(value):
    """A document with its lists in order."""
    def order(x):
        if isinstance(x, dict):
            return {k: order(v) for k, v in x.items()}
        return sorted((order(v) for v in x), key=lambda v: json.dumps(v, sort_keys=True)) if isinstance(x, list) else x

    return json.dumps(order(json.loads(value)), sort_keys=True)


def held(spark, root):
    return sorted((r.feed_file or "", plain(r.value)) for r in spark.read.text(root).collect())


@pytest.mark.parametrize("feed", list(L.BUILDERS))
def test_documents_do_not_depend_on_the_number_of_tasks(spark, tables, tmp_path, monkeypatch, feed):
    few = held(spark, L.write_landing(spark, tables, str(tmp_path / "few"), [feed]))
    monkeypatch.setattr(L, "TASK_ROWS", 50)
    many = held(spark, L.write_landing(spark, tables, str(tmp_path / "many"), [feed]))
    assert few == many and len(few) > 1


def test_a_large_file_is_written_by_several_tasks_and_compressed(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "TASK_ROWS", 300)
    root = L.write_landing(spark, tables, str(tmp_path / "x"), ["daypart"])
    parts = list(tmp_path.glob("x/feed_file=*/part-*"))
    assert len(parts) > 1 and all(p.name.endswith(".gz") for p in parts)
    n = spark.read.text(root).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert n < spark.read.text(root).count()


@pytest.mark.parametrize("feed", list(L.BUILDERS))
def test_documents_are_grouped_where_their_rows_were_dealt(spark, tables, feed):
    """No move of half-made documents or JSON text: in the plan nothing is
    exchanged above the one explicit repartition."""
    docs = L.BUILDERS[feed](L.read_tables(spark, tables))
    moves = re.findall(r"Exchange (\w+partitioning\([^)]*\)|SinglePartition|RoundRobin\w*\([^)]*\)), (\w+)", docs._jdf.queryExecution().executedPlan().toString())
    by_user = [i for i, (_, why) in enumerate(moves) if why.startswith("REPARTITION")]
    above = [m for m in moves if "chunk" in m[0] or "extract" in m[0]]
    assert by_user and not above
