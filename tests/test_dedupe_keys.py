import datetime as dt
import io
from contextlib import redirect_stdout

from pyspark.sql import Window
from pyspark.sql import functions as F

from feedspark.operators.dedupe import first_seen
from feedspark.operators.keys import assign_ids


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_earliest_wins_with_tiebreak_and_null_first(spark):
    rows = [
        ("k1", dt.datetime(2018, 1, 2), "late"),
        ("k1", dt.datetime(2018, 1, 1), "b"),
        ("k1", dt.datetime(2018, 1, 1), "a"),  # tie: smallest tiebreak wins
        ("k2", None, "nullts"),  # null extract sorts first and wins
        ("k2", dt.datetime(2017, 1, 1), "x"),
        (None, dt.datetime(2018, 1, 1), "n1"),  # null keys form one group
        (None, dt.datetime(2019, 1, 1), "n2"),
    ]
    df = spark.createDataFrame(rows, "k string, extract_datetime timestamp, name string")
    got = sorted((r.k or "", r.name) for r in first_seen(df, ["k"], tiebreak=["name"]).collect())
    assert got == [("", "n1"), ("k1", "a"), ("k2", "nullts")]


def test_order_independent(spark):
    rows = [(f"k{i % 7}", dt.datetime(2018, 1, 1 + i % 3), f"n{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, extract_datetime timestamp, name string")
    a = sorted(map(tuple, first_seen(df, ["k"], tiebreak=["name"]).collect()))
    b = sorted(map(tuple, first_seen(df.repartition(13).orderBy(F.rand(1)), ["k"], tiebreak=["name"]).collect()))
    assert a == b


def test_window_group_limit_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "cast(id as timestamp) as extract_datetime")
    assert "WindowGroupLimit" in _plan(first_seen(df, ["k"]))


def test_name_is_a_key_like_any_other(spark):
    df = spark.createDataFrame([("a", "n1", dt.datetime(2018, 1, 1)), ("a", "n2", dt.datetime(2018, 1, 2))], "k string, name string, extract_datetime timestamp")
    assert first_seen(df, ["k", "name"]).count() == first_seen(df, ["name"]).count() == 2


def test_few_rows_make_few_ranges(spark):
    df = spark.range(300).selectExpr("id % 3 as tenant_id", "cast(id as string) as mo_id")
    assert assign_ids(df, ["tenant_id", "mo_id"]).select(F.spark_partition_id()).distinct().count() == 1


def test_assign_ids_equals_global_row_number(spark):
    df = spark.range(5000).selectExpr("cast(id % 25 as long) as tenant_id", "cast(id * 7919 % 5000 as string) as mo_id")
    got = assign_ids(df, ["tenant_id", "mo_id"], start=101, num_partitions=7)
    want = df.withColumn("id", F.row_number().over(Window.orderBy("tenant_id", "mo_id")) + 100)
    assert sorted(map(tuple, got.select("id", "tenant_id", "mo_id").collect())) == sorted(
        map(tuple, want.select("id", "tenant_id", "mo_id").collect())
    )
    assert got.columns[0] == "id"


def test_assign_ids_empty(spark):
    df = spark.createDataFrame([], "tenant_id long, mo_id string")
    assert assign_ids(df, ["tenant_id", "mo_id"]).count() == 0
