"""JDBC source/sink logic without a database: Spark's reader/writer ``jdbc``
calls are replaced by stubs that record what they were asked."""
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from feedspark.plans.catalog import JdbcCatalog
from feedspark.sources.lookups import read_jdbc


def test_ranged_read_uses_bounds_of_the_table(spark, monkeypatch):
    calls = []

    def fake_jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None, predicates=None, properties=None):
        calls.append({"table": table, "column": column, "lo": lowerBound, "hi": upperBound, "n": numPartitions, "props": properties})
        if table.startswith("(SELECT MIN"):
            return spark.createDataFrame([(5, 900)], "lo long, hi long")
        return spark.createDataFrame([(5, "a")], "id long, mo_id string")

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_jdbc)
    df = read_jdbc(spark, "jdbc:x://h/db", "media.client", {"user": "u"}, partition_column="id", num_partitions=4)
    assert df.count() == 1
    assert "MIN(id)" in calls[0]["table"] and "media.client" in calls[0]["table"]
    assert calls[1] == {"table": "media.client", "column": "id", "lo": 5, "hi": 901, "n": 4, "props": {"fetchsize": "10000", "user": "u"}}


def test_single_partition_read_without_column(spark, monkeypatch):
    calls = []

    def fake_jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None, predicates=None, properties=None):
        calls.append((table, column, numPartitions))
        return spark.createDataFrame([(1, "T")], "id long, mo_id string")

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_jdbc)
    read_jdbc(spark, "jdbc:x://h/db", "tenant", {}, num_partitions=4)
    assert calls == [("tenant", None, None)]


def test_append_leaves_id_to_the_database(spark, monkeypatch):
    seen = {}

    def fake_write(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, props=properties, cols=self._df.columns, parts=self._df.rdd.getNumPartitions())

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_write)
    cat = JdbcCatalog(spark, "jdbc:x://h/db", {"user": "u"}, schema="media", writers=3)
    rows = spark.createDataFrame([("A", "Acme", 7)], "mo_id string, name string, tenant_id long")
    cat.append("client", rows)
    assert seen["table"] == "media.client" and seen["mode"] == "append"
    assert seen["cols"] == ["mo_id", "name", "tenant_id"]  # no id: the database makes it
    assert seen["props"]["stringtype"] == "unspecified"
    assert seen["parts"] == 3


def test_no_writers_or_partitions_is_refused(spark):
    import pytest

    rows = spark.createDataFrame([("A",)], "mo_id string")
    from feedspark.sinks.tables import append_jdbc, append_table

    for call in (
        lambda: append_jdbc(rows, "jdbc:x://h/db", "t", {}, writers=0),
        lambda: append_table(rows, "/nowhere", writers=0),
        lambda: read_jdbc(spark, "jdbc:x://h/db", "t", {}, num_partitions=0),
    ):
        with pytest.raises(ValueError, match="at least 1"):
            call()


def test_incremental_loads_need_a_ledger(spark):
    import pytest

    from feedspark.plans import incremental

    with pytest.raises(ValueError, match="ledger"):
        incremental.run(spark.range(1), JdbcCatalog(spark, "jdbc:x://h/db", {}), "client", lambda d: d, [])
